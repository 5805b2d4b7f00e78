"""Samples of exact size per stratum, and how far a sample's distribution is off.

The sample of a stratum is the ``k`` rows of smallest seeded hash.  That is a
uniform sample, the same on every run and partitioning, and it is mergeable: the
least k of all are among the least k of each part.  Spark keeps k rows of a
stratum per task before the shuffle, so a stratum of any size costs k rows a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def place(key: Column, seed: int = 42) -> Column:
    """A row's place in the order that samples are taken in."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def stratified_sample(df: DataFrame, stratum: str, key: str, k: int, seed: int = 42) -> DataFrame:
    """``k`` rows of every stratum (all, if it has fewer); ``key`` identifies rows."""
    order = Window.partitionBy(stratum).orderBy("_place", key)
    return (df.withColumn("_place", place(F.col(key), seed)).withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") <= k).drop("_place", "_rank"))


def cumulative(df: DataFrame, col: str) -> DataFrame:
    """(x, share): the share of values up to each distinct value.  The window runs
    over distinct values."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("x")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy().orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return counts.select("x", (F.sum("c").over(upto) / F.sum("c").over(Window.partitionBy())).alias("share"))


def largest_distance(full: DataFrame, sample: DataFrame, col: str) -> DataFrame:
    """(n_full, n_sample, distance): rows with a value, and the largest distance
    of the two cumulative histograms (0 if one is empty)."""
    both = full.select(F.col(col).alias("x"), F.lit(1).alias("f"), F.lit(0).alias("s")).unionByName(
        sample.select(F.col(col).alias("x"), F.lit(0).alias("f"), F.lit(1).alias("s"))).filter("x is not null")
    counts = both.groupBy("x").agg(F.sum("f").alias("f"), F.sum("s").alias("s"))
    upto = Window.partitionBy().orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    steps = counts.select(F.sum("f").over(upto).alias("f"), F.sum("s").over(upto).alias("s"),
                          F.sum("f").over(every).alias("nf"), F.sum("s").over(every).alias("ns"))
    gap = F.when((F.col("nf") > 0) & (F.col("ns") > 0), F.abs(F.col("f") / F.col("nf") - F.col("s") / F.col("ns"))).otherwise(0.0)
    return steps.agg(F.coalesce(F.max("nf"), F.lit(0)).alias("n_full"), F.coalesce(F.max("ns"), F.lit(0)).alias("n_sample"),
                     F.round(F.coalesce(F.max(gap), F.lit(0.0)), 6).alias("distance"))
