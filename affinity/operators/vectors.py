"""Exact 0/1 feature vectors over a dense index of all elements.

The index is built where the elements are: distinct elements are range-partitioned
and sorted, each partition counts its own, and the counts of the partitions
before (one row a partition) turn places into a dense index in order of element.
No vocabulary reaches the driver and no window runs over all elements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .skew import join_by_key, key_counts


def dense_index(elements: DataFrame, col: str = "element") -> DataFrame:
    """(element, index): distinct elements in order, from 0; stored."""
    placed = materialize(
        elements.select(F.col(col).alias("element")).filter(F.col("element").isNotNull()).distinct()
        .repartitionByRange("element").sortWithinPartitions("element")
        .select("element", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "universe")
    parts = placed.groupBy("part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(shift, "part").select("element", (F.col("row") + F.col("shift")).alias("index"))


def feature_vectors(members: DataFrame) -> DataFrame:
    """(entity, features): a sparse 0/1 vector (``pyspark.ml.linalg``) of the size
    of the universe for every set; empty sets have none.  A set's vector is one
    row, so use this for sets that fit in one."""
    from pyspark.ml.linalg import SparseVector, VectorUDT

    members = materialize(members.select("entity", "element").filter(F.col("element").isNotNull()).distinct(), "members")
    index = dense_index(members)
    size = index.agg(F.count(F.lit(1))).first()[0]
    if size >= 1 << 31:
        raise ValueError("a vector has fewer than 2^31 places")

    @F.udf(VectorUDT())
    def ones(places):
        return SparseVector(size, places, [1.0] * len(places))

    indexed = join_by_key(members, index, ["element"], key_counts(members, ["element"]))
    sets = indexed.groupBy("entity").agg(F.sort_array(F.collect_list(F.col("index").cast("int"))).alias("places"))
    return sets.select("entity", ones("places").alias("features"))
