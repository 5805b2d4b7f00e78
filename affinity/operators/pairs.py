"""Unordered pairs of members that share a group, safe for hot groups.

A group with m members has m(m-1)/2 pairs.  Joining members to themselves
on the group key would put all of them in one task.  Here a group larger
than ``block`` is cut into nb = ceil(m / block) hash blocks and every tile
(bi <= bj) of block pairs becomes its own join key, so a join key carries
at most block x block pairs however large the group is.  Every unordered
pair is produced exactly once per shared group (tile (min, max) of its two
blocks); nothing is dropped or capped.  Members learn the size of their group
by a join salted with ``SALTS`` parts, so a hot group isn't whole there either.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import join_by_key

DEFAULT_BLOCK = 1024
SALTS = 8


def pairs_within_groups(members: DataFrame, group_cols: Sequence[str], id_col: str,
                        block: int = DEFAULT_BLOCK, carried: Sequence[str] = (),
                        keep: Callable[[str, str], Column] | None = None) -> DataFrame:
    """(group_cols..., id1, id2) with id1 < id2 for every two distinct
    members of a group.  ``members`` must hold distinct (group, id) rows.
    Columns that are ``carried`` go along as ``_x_`` and ``_y_`` with their names,
    and ``keep`` makes of these prefixes, which may change places, the condition
    for a pair."""
    g = list(group_cols)
    m = members.select(*g, F.col(id_col).alias("_id"), *carried)
    sizes = (m.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > 1)
             .select(*g, F.greatest(F.lit(1), F.ceil(F.col("_n") / block)).cast("int").alias("_nb"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    salt = F.pmod(F.xxhash64(F.lit("salt"), "_id"), F.lit(SALTS)).cast("int")
    blocked = (m.withColumn("_salt", salt).join(sizes, [*g, "_salt"])
               .withColumn("_b", F.pmod(F.xxhash64("_id"), F.col("_nb")).cast("int")))
    # left copy of a member of block b goes to tiles (b, j), j >= b;
    # right copy goes to tiles (i, b), i <= b.
    left = blocked.select(*g, F.col("_id").alias("_x"), F.col("_b").alias("_bi"),
                          *[F.col(c).alias(f"_x_{c}") for c in carried],
                          F.explode(F.sequence(F.col("_b"), F.col("_nb") - 1)).alias("_bj"))
    right = blocked.select(*[F.col(c).alias(f"_r_{c}") for c in g], F.col("_id").alias("_y"),
                           F.col("_b").alias("_rbj"), *[F.col(c).alias(f"_y_{c}") for c in carried],
                           F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_rbi"))
    cond = [left[c] == right[f"_r_{c}"] for c in g] + [
        left["_bi"] == right["_rbi"], left["_bj"] == right["_rbj"]]
    joined = left.join(right, cond).filter(
        (F.col("_bi") < F.col("_bj")) | (F.col("_x") < F.col("_y")))
    if keep:
        joined = joined.filter(keep("_x_", "_y_"))
    return joined.select(*g, F.least("_x", "_y").alias("id1"), F.greatest("_x", "_y").alias("id2"))


def linked_pairs(members: DataFrame, group_cols: Sequence[str], id_col: str, block: int = DEFAULT_BLOCK) -> DataFrame:
    """(id1, id2), id1 < id2, each once: every two members that share some group.

    The groups of a family of near copies are much alike, so its pairs would meet
    in each of them.  Here groups with the same least member have a main one,
    the largest, which makes all of its pairs; the others only make those of
    members that the main one lacks.  All other pairs of theirs are pairs of the
    main one, so none is left out.  ``members`` (distinct rows) should be stored.
    """
    g = list(group_cols)
    m = members.select(*g, F.col(id_col).alias("_id")).filter(F.col("_id").isNotNull())
    groups = m.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least")).filter("_n > 1")
    mains = groups.groupBy("_least").agg(F.max(F.struct("_n", *g)).alias("_main"))
    table = groups.join(mains, "_least").select(
        *g, "_n", "_least", (F.struct("_n", *g) == F.col("_main")).alias("_is_main"),
        F.ceil(F.col("_n") / block).cast("int").alias("_nb"))
    rows = join_by_key(m, table, g, table, "_n").withColumn("_b", F.pmod(F.xxhash64("_id"), F.col("_nb")).cast("int"))
    held = rows.filter("_is_main").select("_least", "_id", F.lit(True).alias("_in"))
    placed = rows.join(held, ["_least", "_id"], "left").withColumn("_out", F.col("_is_main") | F.col("_in").isNull())
    left = placed.filter("_out").select(*g, F.col("_id").alias("_x"), F.col("_b").alias("_bi"),
                                        F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_bj"))
    right = placed.select(*[F.col(c).alias(f"_r_{c}") for c in g], F.col("_id").alias("_y"), "_out", F.col("_b").alias("_rbj"),
                          F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_rbi"))
    cond = [left[c] == right[f"_r_{c}"] for c in g] + [left["_bi"] == right["_rbi"], left["_bj"] == right["_rbj"]]
    # two that the main group lacks meet twice
    met = left.join(right, cond).filter((F.col("_x") != F.col("_y")) & (~F.col("_out") | (F.col("_x") < F.col("_y"))))
    return met.select(F.least("_x", "_y").alias("id1"), F.greatest("_x", "_y").alias("id2")).distinct()
