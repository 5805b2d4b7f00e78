"""Profiling aggregates: activity, popularity, approval, categories, sparsity,
and their top-k listings.

Every report is one aggregate (partial aggregation before the shuffle); joins
with the item dimension come after the aggregate, so only one row per item
meets the dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_sample_predicate
from .clean import explode_categories


def _r6(c):
    return F.round(c, 6)


def user_activity(df: DataFrame, user: str = "user_id") -> DataFrame:
    """(user, num_ratings)."""
    return df.groupBy(user).agg(F.count(F.lit(1)).alias("num_ratings"))


def item_activity(df: DataFrame, items: DataFrame, item: str = "item_id",
                  rating: str = "rating", title: str = "title") -> DataFrame:
    """(item, num_ratings, avg_rating, title) for items present in both."""
    agg = df.groupBy(item).agg(F.count(F.lit(1)).alias("num_ratings"),
                               F.avg(rating).alias("avg_rating"))
    return agg.join(items.select(item, title), item)


def describe_counts(activity: DataFrame, col: str = "num_ratings") -> DataFrame:
    """n, mean, sample stddev, min, max, approximate median of a count column."""
    return activity.agg(
        F.count(F.lit(1)).alias("n"),
        _r6(F.avg(col)).alias("mean"),
        _r6(F.stddev_samp(col)).alias("stddev"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.percentile_approx(col, 0.5).alias("median"))


def rating_stats(df: DataFrame, rating: str = "rating") -> DataFrame:
    """n, mean, stddev, min, max and approximate quartiles of the ratings."""
    q = F.percentile_approx(rating, [0.25, 0.5, 0.75])
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        _r6(F.avg(rating)).alias("mean"),
        _r6(F.stddev_samp(rating)).alias("stddev"),
        F.min(rating).alias("min"),
        F.max(rating).alias("max"),
        q.alias("_q")).select("n", "mean", "stddev", "min", "max",
                              F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                              F.col("_q")[2].alias("q3"))


def rating_distribution(df: DataFrame, rating: str = "rating") -> DataFrame:
    """count and percent per rating value, plus cumulative count and percent.

    The windows run over the aggregated histogram (one row per distinct
    rating value), never over the interaction rows.
    """
    hist = df.groupBy(rating).agg(F.count(F.lit(1)).alias("count"))
    everything = Window.partitionBy()
    upto = Window.partitionBy().orderBy(rating).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("count").over(everything)
    cum = F.sum("count").over(upto)
    return hist.select(rating, "count",
                       _r6(100.0 * F.col("count") / total).alias("pct"),
                       cum.alias("cum_count"),
                       _r6(100.0 * cum / total).alias("cum_pct"))


def item_quality(df: DataFrame, items: DataFrame, label: str = "binary_rating",
                 min_ratings: int = 0, item: str = "item_id", title: str = "title") -> DataFrame:
    """(item, total_ratings, approval_pct = 100 * mean(label), title);
    items under ``min_ratings`` are dropped when ``min_ratings > 0``."""
    q = df.groupBy(item).agg(F.count(F.lit(1)).alias("total_ratings"),
                             (F.avg(label) * 100.0).alias("approval_pct"))
    if min_ratings > 0:
        q = q.filter(F.col("total_ratings") >= min_ratings)
    return q.join(items.select(item, title), item).select(
        item, "total_ratings", _r6(F.col("approval_pct")).alias("approval_pct"), title)


def category_supply(items: DataFrame, item: str = "item_id", col: str = "genres") -> DataFrame:
    """(genre, num_items): catalogue size per category."""
    return (explode_categories(items, item, col)
            .groupBy("genre").agg(F.count(F.lit(1)).alias("num_items")))


def category_activity(df: DataFrame, items: DataFrame, item: str = "item_id",
                      rating: str = "rating", col: str = "genres") -> DataFrame:
    """(genre, num_items, num_ratings, avg_rating) for genres with ratings.

    Interactions are first reduced to one row per item (count, sum), so the
    fan-out join with the exploded categories sees items, not interactions.
    """
    per_item = df.groupBy(item).agg(F.count(F.lit(1)).alias("_n"), F.sum(rating).alias("_s"))
    exploded = explode_categories(items, item, col)
    demand = (per_item.join(exploded, item)
              .groupBy("genre").agg(F.sum("_n").alias("num_ratings"), F.sum("_s").alias("_s")))
    supply = category_supply(items, item, col)
    return supply.join(demand, "genre").select(
        "genre", "num_items", "num_ratings",
        _r6(F.col("_s") / F.col("num_ratings")).alias("avg_rating"))


def category_niches(activity: DataFrame, min_ratings: int = 100, scale: float = 0.7,
                    unknown: str = "(no genres listed)") -> DataFrame:
    """categories with at least ``min_ratings`` ratings, without the
    no-category label, with bubble size = scale * num_items."""
    return (activity.filter((F.col("genre") != unknown) & (F.col("num_ratings") >= min_ratings))
            .withColumn("bubble_size", _r6(F.col("num_items") * scale)))


def sparsity(df: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """distinct users and items, interactions, possible cells, density % and
    sparsity %, mean interactions per user and per item.

    Users and items are grouped each by themselves (added up map side first), so
    no row is repeated per distinct count; the items enter as a scalar subquery.
    """
    num_items = df.groupBy(item).agg(F.count(F.lit(1)).alias("_n")).agg(F.count(item).alias("n")).scalar()
    s = (df.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
         .agg(F.count(user).alias("num_users"), F.coalesce(F.sum("_n"), F.lit(0)).alias("num_ratings"))
         .withColumn("num_items", num_items))
    possible = F.col("num_users") * F.col("num_items")
    density = 100.0 * F.col("num_ratings") / possible
    return s.select("num_users", "num_items", "num_ratings", possible.alias("possible"),
                    _r6(density).alias("density_pct"), _r6(100.0 - density).alias("sparsity_pct"),
                    _r6(F.col("num_ratings") / F.col("num_users")).alias("mean_per_user"),
                    _r6(F.col("num_ratings") / F.col("num_items")).alias("mean_per_item"))


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """Global top-k with a total order (Spark plans TakeOrderedAndProject:
    each task keeps k rows, no full sort)."""
    return df.orderBy(*order).limit(k)


def top_items_sql(interactions_df: DataFrame, items_df: DataFrame, k: int = 20) -> DataFrame:
    """The flagship SQL: top-k items by number of ratings with the rounded
    mean rating (ties broken by item id).  Interactions become one row an
    item before they meet the items, which have one row an id."""
    spark = interactions_df.sparkSession
    return spark.sql(
        """
        SELECT m.item_id, m.title, r.num_ratings, r.avg_rating
        FROM (SELECT item_id, COUNT(rating) AS num_ratings, ROUND(AVG(rating), 2) AS avg_rating
              FROM {r} GROUP BY item_id) r
        JOIN {m} m ON r.item_id = m.item_id
        ORDER BY num_ratings DESC, m.item_id
        LIMIT {k}
        """, r=interactions_df, m=items_df, k=int(k))


def item_counts_topk(df: DataFrame, k: int = 20, item: str = "item_id") -> DataFrame:
    """Count per item (the map/reduce count) and its top k."""
    counts = df.groupBy(item).agg(F.count(F.lit(1)).alias("num_ratings"))
    return top_k(counts, k, F.col("num_ratings").desc(), F.col(item))


def hash_sample(df: DataFrame, id_col: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Reproducible id sample (see ``hash_sample_predicate``)."""
    return df.filter(hash_sample_predicate(F.col(id_col), fraction, seed))
