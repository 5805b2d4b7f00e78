"""Connected components of an edge list, by alternating star contraction.

Each round joins every node to the smallest node it knows: a large-star step
links a node's larger neighbours to its smallest, a small-star step its smaller
ones.  Each edge becomes one edge, so they never grow in number, rounds grow with the
logarithm of the nodes, and nothing is collected.  Minima are pre-aggregated map
side, so a hub with a third of all edges costs one row per task.  The rounds end
when one aggregate finds only stars, without a further round.  Each round is
a written table, so lost executors repeat one round only.  Rounds shuffle three
times and no more, and their tables have as many files as their rows need: on
many small partitions tasks, not rows, are what a round costs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import materialize

#: Rows a task writes, if that are fewer tasks than there are partitions.
TASK_ROWS = 50_000


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # dealt by hi once: the rest of the round needs no other order
    large = (edges.join(least, edges["lo"] == least["u"])
             .select("hi", F.col("m").alias("lo")).repartition("hi").distinct())
    root = large.groupBy("hi").agg(F.min("lo").alias("m"))
    # of each node one edge to its smallest, the others between the two
    return large.join(root, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"),
                                         F.col("m").alias("lo"))


def _settled(edges: DataFrame) -> bool:
    """Has every upper end edges to one node only, that is no upper end?"""
    ends = edges.select(F.col("hi").alias("u"), "lo", F.lit(0).alias("root")).unionByName(
        edges.select(F.col("lo").alias("u"), F.lit(None).cast(edges.schema["lo"].dataType).alias("lo"), F.lit(1).alias("root")))
    return (ends.groupBy("u").agg(F.min("lo").alias("first"), F.max("lo").alias("last"), F.max("root").alias("root"))
            .filter(F.col("first").isNotNull() & ((F.col("root") > 0) | (F.col("first") < F.col("last")))).isEmpty())


def connected_components(edges: DataFrame, a: str = "id1", b: str = "id2") -> DataFrame:
    """(id, component) of every node that has an edge to another one;
    component is the smallest id that can be reached.  Rows with a null end and
    loops are no edges; repeated edges and either order count once.  ``edges``
    are read four times."""
    now = (edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
           .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("lo") < F.col("hi"))))
    files = max(1, -(-now.count() // TASK_ROWS))  # no round has more rows
    while True:
        now = materialize(_stars(now).coalesce(files), "stars")
        if _settled(now):
            break
    return (now.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
            .unionByName(now.select(F.col("lo").alias("id"), F.col("lo").alias("component")))
            .groupBy("id").agg(F.min("component").alias("component")))
