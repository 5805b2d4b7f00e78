"""Mergeable sketches: distinct counts and quantiles per group, rolled up
without reading the rows again.

A sketch per group has a fixed size, is merged map side, and is kept as a
column.  Totals, and groups of groups, are unions of sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: log2 of the registers of a distinct-count sketch; its relative standard error
#: is about 1.04 / sqrt(2 ** LG_REGISTERS).
LG_REGISTERS = 12
#: Size parameter of a quantile sketch; ranks are off by about RANK_ERROR at most
#: (99 of 100 cases).
QUANTILE_K, RANK_ERROR = 400, 0.0075
#: Rows that a task makes distinct at once, so that its hash table is bounded
#: whatever the input's size.
ROWS_A_TASK = 4_000_000


def distinct_error(lg: int = LG_REGISTERS) -> float:
    return 1.04 / (1 << lg) ** 0.5


def distinct_sketches(df: DataFrame, groups: Sequence[str], col: str, lg: int = LG_REGISTERS) -> DataFrame:
    """(groups, sketch) of the distinct values of ``col``."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(col, lg).alias("sketch"))


def rolled_up(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The sketches of coarser groups, or of all."""
    return sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def distinct_report(df: DataFrame, group: str, col: str, lg: int = LG_REGISTERS, deviations: float = 4.0) -> DataFrame:
    """(group, exact, within_bound) for each group and for all (null group):
    exact distinct values, and whether the sketch's estimate lies within
    ``deviations`` standard errors (and one) of them.

    The two columns are stored once, and dealt by group and value into tasks of
    about ``ROWS_A_TASK`` rows."""
    df = materialize(df.select(group, col), "values")
    sketches = distinct_sketches(df, [group], col, lg)
    every = rolled_up(sketches).select(F.lit(None).cast(df.schema[group].dataType).alias(group), "sketch")
    estimates = distinct_estimates(sketches.unionByName(every))
    present = df.filter(F.col(col).isNotNull())
    pairs = present.repartition(max(1, -(-present.count() // ROWS_A_TASK)), group, col).distinct()
    exact = (pairs.groupBy(group).agg(F.count(F.lit(1)).alias("exact"))
             .unionByName(pairs.select(col).distinct().agg(F.count(F.lit(1)).alias("exact")).select(
                 F.lit(None).cast(df.schema[group].dataType).alias(group), "exact")))
    joined = exact.join(estimates.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")))
    slack = deviations * distinct_error(lg) * F.col("exact") + 1
    return joined.select(group, "exact", (F.abs(F.col("distinct") - F.col("exact")) <= slack).alias("within_bound"))


def quantile_sketches(df: DataFrame, groups: Sequence[str], col: str, k: int = QUANTILE_K) -> DataFrame:
    """(groups, sketch) of the values of ``col``."""
    return df.groupBy(*groups).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The other columns, with a row per share: (share, value)."""
    rest = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*rest, F.inline(F.array(*[F.struct(
        F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("value")) for s in shares])))


def ranks(sketches: DataFrame, values: Sequence[float]) -> DataFrame:
    """The other columns, with a row per value: (value, rank), rank being the share
    of values up to it."""
    rest = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*rest, F.inline(F.array(*[F.struct(
        F.lit(float(v)).alias("value"), F.kll_sketch_get_rank_double("sketch", F.lit(float(v))).alias("rank")) for v in values])))


def quantile_report(df: DataFrame, group: str, col: str, shares: Sequence[float], k: int = QUANTILE_K) -> DataFrame:
    """(group, share, n, within_bound) for each group and for all (null
    group): is ``share`` within RANK_ERROR of the exact ranks, the shares of values
    below the sketch's quantile and up to it?"""
    df = df.filter(F.col(col).isNotNull())
    sketches = quantile_sketches(df, [group], col, k)
    kind = df.schema[group].dataType
    found = quantiles(sketches, shares).unionByName(
        quantiles(merged_quantiles(sketches), shares).select(F.lit(None).cast(kind).alias(group), "share", "value"))
    # counts of distinct values, so that no row meets a quantile by itself
    histogram = df.groupBy(group, F.col(col).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c"))
    histogram = histogram.unionByName(histogram.groupBy("x").agg(F.sum("c").alias("c")).select(
        F.lit(None).cast(kind).alias(group), "x", "c"))
    wanted = found.groupBy(F.col(group).alias("_g")).agg(F.collect_list(F.struct("share", "value")).alias("q"))
    met = histogram.join(wanted, F.col(group).eqNullSafe(F.col("_g"))).select(group, "x", "c", F.inline("q"))
    sums = met.groupBy(group, "share").agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("x") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"))
    slack = RANK_ERROR * F.col("n") + 1
    return sums.select(group, "share", "n", ((F.col("below") - slack <= F.col("share") * F.col("n"))
                                             & (F.col("share") * F.col("n") <= F.col("upto") + slack)).alias("within_bound"))
