"""Mixing sources to target weights by capped water-filling.

Each source has a size (words), a weight and a cap of ``max_epochs`` times its
size.  All sources together share the total size by weight.  A source whose
share is above its cap is clamped there, and the excess goes to the others by
weight, until none is above: the water level where the sum of
min(cap, level * weight) is the total.  Sorted by cap / weight, the clamped
sources are a prefix, so one window over the table of sources finds the level.

A source then takes each document floor(target / size) times (whole
repetitions), and documents that make up the remaining fraction once more.
These are chosen by seeded hash order of doc_id and text: words are summed by (source, hash
bucket), running sums over the buckets say which bucket holds the boundary, and
a running sum inside each (source, bucket) finds the document.  So a source
with a third of all rows is ``16 ** bucket_digits`` small groups, and the taken
words are within one document of the target.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a source without words has target 0 and its documents are taken
as a whole floor(0) times, that is never; rows that repeat a doc_id, or have
none, have places of their own by their texts; equal rows take part each for itself; an empty table gives an empty result;
further columns stay as they are,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import text_or_empty, word_count

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
BUCKET_DIGITS = 3


def water_filling(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                  max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source_key, source_size, target) from (source_key, source_size).

    The windows see one row per source.
    """
    order = Window.orderBy("source_key")
    cycle = F.array(*map(F.lit, weights))
    weighed = (sizes.withColumn("w", F.get(cycle, (F.row_number().over(order) - 1) % len(weights)).cast("long"))
               .withColumn("cap", F.col("source_size") * max_epochs))
    every = Window.partitionBy(F.lit(0))
    # exact order of cap / weight: cross-multiplied by the product of all weights
    scale = 1
    for w in set(weights):
        scale *= w
    by_ratio = every.orderBy(F.expr(f"cap * ({scale} div w)"), "source_key").rowsBetween(
        Window.unboundedPreceding, -1)
    from_here = (weighed
                 .withColumn("total", F.sum("source_size").over(every))
                 .withColumn("w_all", F.sum("w").over(every))
                 .withColumn("cap_before", F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)))
                 .withColumn("w_before", F.coalesce(F.sum("w").over(by_ratio), F.lit(0))))
    # level if the sources before this one are clamped and the rest are not
    level = (F.col("total") - F.col("cap_before")).cast("double") / (F.col("w_all") - F.col("w_before")).cast("double")
    free = F.col("w") * level < F.col("cap")
    leveled = from_here.withColumn("level", F.min(F.when(free, F.struct("cap_before", level.alias("level"))))
                                   .over(every)["level"])
    return leveled.select("source_key", "source_size", F.when(
        F.col("level").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("cap").cast("double"), F.col("w") * F.col("level"))).alias("target"))


def planned(rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            seed: str = SEED, bucket_digits: int = BUCKET_DIGITS) -> DataFrame:
    """Rows (doc_id, source, size, text_hash and any others) with source_size, target
    and reps, the times to take each."""
    # "0..." before "1": sources by code point, null last
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    place = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                           F.lit(":"), F.col("text_hash")))
    carried = [c for c in rows.columns if c not in ("source", "text_hash")]
    rows = (rows.select(*carried, key.alias("source_key"), place.alias("place"))
            .withColumn("bucket", F.substring("place", 1, bucket_digits)))
    buckets = rows.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    targets = water_filling(buckets.groupBy("source_key").agg(F.sum("words").alias("source_size")),
                            weights, max_epochs)
    running = Window.partitionBy("source_key").orderBy("bucket")
    share = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(share)).otherwise(F.lit(0)).cast("long")
    plan = (buckets.join(targets, "source_key")
            .withColumn("before", F.sum("words").over(running) - F.col("words"))
            .withColumn("whole", whole)
            .withColumn("more", F.col("target") - F.col("whole") * F.col("source_size"))
            .select("source_key", "bucket", "source_size", "target", "before", "whole", "more"))
    inside = Window.partitionBy("source_key", "bucket").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # the document that holds the boundary is taken if more than half of it is below
    middle = F.col("before") + F.col("upto") - F.col("size") / 2
    return (rows.join(plan, ["source_key", "bucket"])
            .withColumn("upto", F.sum("size").over(inside))
            .withColumn("reps", F.col("whole") + F.when(middle < F.col("more"), 1).otherwise(0))
            .select(*carried, "source_size", "target", "reps"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "source",
                       word_count(text_or_empty()).alias("size"), F.md5(text_or_empty()).alias("text_hash"))
    return (planned(rows, **options).filter("reps > 0")
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), "reps"))).select("doc.*"))


def mix_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per document."""
    # the texts are only counted, so they stay out of the rows that move
    slim = docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), F.md5(text_or_empty()).alias("text_hash"))
    return planned(slim).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken"))
