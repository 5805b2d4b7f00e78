"""Cleaning and projection operators (nulls, duplicates, labels, categories)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import category_key


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in every column, in one pass."""
    return df.select([F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null (in ``subset`` when given)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def drop_nulls_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: drop_nulls(df) for name, df in frames.items()}


def dedupe(df: DataFrame, keys: Sequence[str] | None = None,
           prefer: Sequence[str] | None = None) -> DataFrame:
    """Drop duplicates.

    Without ``keys`` whole rows are compared.  With ``keys`` one row per key
    survives: the one with the largest ``prefer`` columns (default: the
    remaining columns in order; for interactions that is latest ts, then
    highest rating when ``prefer=('ts', 'rating')``).

    Planned as a hash aggregate of ``max(struct(...))``: partial aggregation
    runs before the shuffle, so a hot key costs one row per map task, not a
    sort of all its rows in one task.
    """
    if not keys:
        return df.dropDuplicates()
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates()
    order = [c for c in (prefer or rest) if c in rest]
    packed = order + [c for c in rest if c not in order]
    best = F.max(F.struct(*[F.col(c) for c in packed])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c)
                        for c in df.columns])


def dedupe_all(frames: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    return {name: dedupe(df, keys.get(name)) for name, df in frames.items()}


def clean_report(raw: DataFrame, keys: Sequence[str] | None = None,
                 prefer: Sequence[str] | None = None) -> DataFrame:
    """Rows before / after / removed for the null step and the duplicate step.

    One pass: each key counts its rows and those without nulls, map side first,
    and a key stays as one row if it has any without; the two stage rows are
    generated from the sums.  (``prefer`` says which row stays, not how many.)
    """
    whole = F.lit(True)
    for c in raw.columns:
        whole = whole & F.col(c).isNotNull()
    per_key = raw.groupBy(*(keys or raw.columns)).agg(F.count(F.lit(1)).alias("_all"), F.count_if(whole).alias("_whole"))
    n = [F.coalesce(F.sum("_all"), F.lit(0)).alias("n0"), F.coalesce(F.sum("_whole"), F.lit(0)).alias("n1"),
         F.count_if(F.col("_whole") > 0).alias("n2")]
    stages = F.array(
        F.struct(F.lit("nulls").alias("step"), F.col("n0").alias("rows_before"),
                 F.col("n1").alias("rows_after")),
        F.struct(F.lit("duplicates").alias("step"), F.col("n1").alias("rows_before"),
                 F.col("n2").alias("rows_after")))
    return (per_key.agg(*n).select(F.inline(stages))
            .withColumn("removed", F.col("rows_before") - F.col("rows_after")))


def binarize(df: DataFrame, col: str = "rating", threshold: float = 3.5,
             out: str = "binary_rating") -> DataFrame:
    """1 when ``col >= threshold`` else 0 (null counts as 0)."""
    return df.withColumn(out, F.when(F.col(col) >= threshold, 1).otherwise(0))


def binary_distribution(df: DataFrame, label: str = "binary_rating") -> DataFrame:
    """count and percent per label value (the total comes from a window over
    the few label groups, not over the rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(label, "count", F.round(100.0 * F.col("count") / total, 6).alias("pct"))


def like_summary(df: DataFrame, label: str = "binary_rating") -> DataFrame:
    """One row: total, likes, dislikes, their percents and 'n (p%)' strings."""
    s = df.agg(F.count(F.lit(1)).alias("total"),
               F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).cast("bigint").alias("likes"))
    s = s.withColumn("dislikes", F.col("total") - F.col("likes"))
    like_pct = F.when(F.col("total") > 0, 100.0 * F.col("likes") / F.col("total")).otherwise(0.0)
    dislike_pct = F.when(F.col("total") > 0, 100.0 * F.col("dislikes") / F.col("total")).otherwise(0.0)
    return s.select(
        "total", "likes", "dislikes",
        F.round(like_pct, 6).alias("like_pct"), F.round(dislike_pct, 6).alias("dislike_pct"),
        F.format_string("%d (%.2f%%)", F.col("likes"), F.round(like_pct, 2)).alias("likes_label"),
        F.format_string("%d (%.2f%%)", F.col("dislikes"), F.round(dislike_pct, 2)).alias("dislikes_label"))


def liked(df: DataFrame, col: str = "rating", threshold: float = 3.5) -> DataFrame:
    """Positive interactions (``col >= threshold``); pushed to the scan."""
    return df.filter(F.col(col) >= threshold)


def explode_categories(items: DataFrame, id_col: str = "item_id", col: str = "genres",
                       sep: str = "|", out: str = "genre") -> DataFrame:
    """One row per (item, category piece) of a delimited category string."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return items.select(id_col, F.explode(F.split(F.col(col), pattern)).alias(out))


def canonical_map(items: DataFrame, col: str = "genres", sep: str = "|") -> DataFrame:
    """(raw, key, canonical, n): every raw spelling, its grouping key and the
    most frequent raw spelling of that key (ties: smallest spelling).

    Counting is a distributed aggregate over the exploded pieces; the window
    partitions by key and sees only the few spellings of one key.
    """
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    raw = items.select(F.explode(F.split(F.col(col), pattern)).alias("raw"))
    counts = raw.groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    keyed = counts.withColumn("key", category_key(F.col("raw")))
    w = Window.partitionBy("key").orderBy(F.col("n").desc(), F.col("raw").asc())
    best = (keyed.withColumn("_r", F.row_number().over(w)))
    canon = F.first(F.when(F.col("_r") == 1, F.col("raw")), ignorenulls=True).over(
        Window.partitionBy("key"))
    return best.select("raw", "key", canon.alias("canonical"), "n")


def normalize_categories(items: DataFrame, mapping: DataFrame, id_col: str = "item_id",
                         col: str = "genres", sep: str = "|") -> DataFrame:
    """Replace every piece by its canonical spelling (unmapped pieces kept,
    trimmed), drop repeats, sort, re-join with ``sep``.  Null or blank
    category strings are returned as they are.

    The map is joined as a table (AQE broadcasts it when its measured size is
    small, otherwise it is a shuffle join), never collected to the driver.
    """
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    m = (mapping.select(F.trim("raw").alias("_piece"), F.col("canonical").alias("_canon"))
         .dropDuplicates(["_piece"]))
    other = [c for c in items.columns if c not in (id_col, col)]
    blank = F.col(col).isNull() | (F.trim(F.col(col)) == "")
    # repeated rows are worked on once and given back as often as they came
    distinct = items.filter(~blank).groupBy(id_col, *other, col).agg(F.count(F.lit(1)).alias("_times"))
    pieces = (distinct.select(id_col, *other, col, "_times",
                           F.explode(F.split(F.col(col), pattern)).alias("_piece"))
              .withColumn("_piece", F.trim("_piece")))
    mapped = (pieces.join(m, "_piece", "left")
              .withColumn("_v", F.coalesce("_canon", "_piece")))
    joined = F.array_join(F.array_sort(F.collect_set("_v")), sep)
    out = (mapped.groupBy(id_col, *other, col, "_times").agg(joined.alias("_new"))
           .withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))))
    kept = items.filter(blank)
    norm = out.select(id_col, *other, F.col("_new").alias(col))
    return norm.unionByName(kept.select(id_col, *other, col))


def category_report(before: DataFrame, after: DataFrame, col: str = "genres",
                    sep: str = "|") -> DataFrame:
    """distinct pieces before, after, and the reduction in percent (0 when
    there is none before) -- one aggregate over the two tagged piece sets."""
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)

    def pieces(df: DataFrame, tag: int) -> DataFrame:
        return df.select(F.lit(tag).alias("_t"),
                         F.explode(F.split(F.col(col), pattern)).alias("_p"))

    both = pieces(before, 0).unionByName(pieces(after, 1))
    counts = both.agg(F.count_distinct(F.when(F.col("_t") == 0, F.col("_p"))).alias("distinct_before"),
                      F.count_distinct(F.when(F.col("_t") == 1, F.col("_p"))).alias("distinct_after"))
    red = F.when(F.col("distinct_before") > 0,
                 (1.0 - F.col("distinct_after") / F.col("distinct_before")) * 100.0).otherwise(0.0)
    return counts.select("distinct_before", "distinct_after", F.round(red, 6).alias("reduction_pct"))


def contains_any(df: DataFrame, col: str, needles: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` contains any of the substrings."""
    cond = None
    for n in needles:
        c = F.col(col).contains(n)
        cond = c if cond is None else (cond | c)
    return df.filter(cond)
