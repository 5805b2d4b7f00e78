"""Affinity mining on Spark: cleaning and profiling of interaction tables, set
similarity (exact Jaccard, MinHash, banded LSH) and association rules.

Every operator takes and returns Spark DataFrames and keeps its work on the
executors; nothing is collected to the driver.
"""

__version__ = "0.1.0"
