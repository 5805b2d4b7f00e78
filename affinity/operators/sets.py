"""Set representation and exact Jaccard similarity.

Canonical form of a family of sets is the long table (entity, element) with
distinct rows; set sizes and arrays are derived from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, with_package
from .pairs import DEFAULT_BLOCK, pairs_within_groups


def set_members(df: DataFrame, entity: str, element: str, rating: str | None = None,
                threshold: float | None = None) -> DataFrame:
    """Distinct (entity, element), optionally from positive rows only."""
    if rating is not None and threshold is not None:
        df = df.filter(F.col(rating) >= threshold)
    return (df.select(F.col(entity).alias("entity"), F.col(element).alias("element"))
            .filter(F.col("entity").isNotNull() & F.col("element").isNotNull())
            .distinct())


def mixed_members(interactions: DataFrame, tags: DataFrame, threshold: float, user: str = "user_id",
                  item: str = "item_id", rating: str = "rating", tag: str = "tag") -> DataFrame:
    """Distinct (entity, element) of items with the users who like them and the
    tags they carry; elements are marked with their kind, so none is both."""
    users = set_members(interactions, item, user, rating, threshold).withColumn("element", F.concat(F.lit("u:"), F.col("element").cast("string")))
    return users.unionByName(set_members(tags, item, tag).withColumn("element", F.concat(F.lit("t:"), F.col("element"))))


def set_sizes(members: DataFrame) -> DataFrame:
    """(entity, set_size)."""
    return members.groupBy("entity").agg(F.count(F.lit(1)).alias("set_size"))


def set_arrays(members: DataFrame) -> DataFrame:
    """(entity, elements array, set_size).  Only for sets of bounded
    size (a document's shingles, a guarded basket): the array of one set is
    built in one task."""
    return members.groupBy("entity").agg(F.collect_list("element").alias("elements"),
                                         F.count(F.lit(1)).alias("set_size"))


def overlap_counts(members: DataFrame, block: int = DEFAULT_BLOCK) -> DataFrame:
    """(id1, id2, inter): pairs of entities sharing at least one element,
    with the size of the intersection (inverted index on the element)."""
    pairs = pairs_within_groups(members, ["element"], "entity", block)
    # hardly two rows of a pair are in one task, so nothing is added up before the shuffle
    return pairs.repartition("id1", "id2").groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("inter"))


def jaccard_pairs(members: DataFrame, min_jaccard: float = 0.0,
                  block: int = DEFAULT_BLOCK) -> DataFrame:
    """Exact Jaccard of every pair with a non-empty intersection:
    (id1, id2, inter, union, jaccard), id1 < id2; pairs with similarity 0
    never materialise.  ``min_jaccard`` keeps pairs with jaccard >= it.

    Members bring the size of their set to the pairs, so pairs move once."""
    sizes = set_sizes(members).withColumnRenamed("set_size", "size")
    sized = members.join(sizes, "entity").select("element", F.struct("entity", "size").alias("m"))
    met = pairs_within_groups(sized, ["element"], "m", block).select(
        F.col("id1.entity").alias("id1"), F.col("id2.entity").alias("id2"), (F.col("id1.size") + F.col("id2.size")).alias("both"))
    # hardly two rows of a pair are in one task, so nothing is added up before the shuffle
    out = (met.repartition("id1", "id2").groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("inter"), F.max("both").alias("both"))
           .select("id1", "id2", "inter", (F.col("both") - F.col("inter")).alias("union")))
    out = out.withColumn("jaccard", F.col("inter") / F.col("union"))
    if min_jaccard > 0:
        out = out.filter(F.col("jaccard") >= min_jaccard)
    return out


def jaccard_of_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Exact Jaccard for given pairs (id1, id2) only: (id1, id2, inter,
    union, jaccard).  Work is the total size of the first sets of the pairs,
    never all pairs."""
    sizes = set_sizes(members)
    m1 = members.select(F.col("entity").alias("id1"), "element")
    m2 = members.select(F.col("entity").alias("id2"), "element")
    p = pairs.select("id1", "id2").distinct()
    inter = (p.join(m1, "id1").join(m2, ["id2", "element"])
             .groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("inter")))
    s1 = sizes.select(F.col("entity").alias("id1"), F.col("set_size").alias("n1"))
    s2 = sizes.select(F.col("entity").alias("id2"), F.col("set_size").alias("n2"))
    out = (p.join(inter, ["id1", "id2"], "left").na.fill(0, ["inter"])
           .join(s1, "id1").join(s2, "id2")
           .select("id1", "id2", "inter", (F.col("n1") + F.col("n2") - F.col("inter")).alias("union")))
    return out.withColumn("jaccard", F.col("inter") / F.col("union"))


def jaccard_in_rows(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """As ``jaccard_of_pairs`` for sets that fit in a row each: one array per set,
    two joins by id, and the intersection in the row."""
    arrays = members.groupBy("entity").agg(F.sort_array(F.collect_list("element")).alias("e"))
    j = (pairs.select("id1", "id2").join(arrays.select(F.col("entity").alias("id1"), F.col("e").alias("e1")), "id1")
         .join(arrays.select(F.col("entity").alias("id2"), F.col("e").alias("e2")), "id2"))
    inter = F.size(F.array_intersect("e1", "e2")).cast("long")
    return (j.select("id1", "id2", inter.alias("inter"), (F.size("e1") + F.size("e2")).alias("both"))
            .select("id1", "id2", "inter", (F.col("both") - F.col("inter")).alias("union"))
            .withColumn("jaccard", F.col("inter") / F.col("union")))


#: So many ids may be broadcast.
FEW_IDS = 500_000

#: Sets that a task holds on each side while it compares their pairs.
CELL_SETS = 256


def compared(pairs: DataFrame, arrays: DataFrame, compare: Callable, ddl: str, column: str = "elements") -> DataFrame:
    """(id1, id2, and ``ddl``'s columns) of the pairs: ``compare`` has the two sorted
    arrays and returns a tuple of numbers.  Pairs (stored ones) are distinct.

    Ids that are in many pairs together are dealt into cells of about ``CELL_SETS``,
    and pairs by the cells of both, so a set moves once a cell that it meets,
    not once a pair, and not at all if it is in none."""
    import pyarrow as pa

    ends = pairs.select(F.col("id1").alias("id"), F.col("id2").alias("other")).unionByName(
        pairs.select(F.col("id2").alias("id"), F.col("id1").alias("other")))
    homes = ends.groupBy("id").agg(F.min("other").alias("other")).select("id", F.least("id", "other").alias("home"))
    cells = homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / CELL_SETS).alias("cells"))
    placed = materialize(homes.join(cells, "home").select(
        "id", F.xxhash64("home", F.pmod(F.xxhash64("id"), F.col("cells"))).alias("cell")), "cells")
    dealt = (pairs.select("id1", "id2").join(placed.select(F.col("id").alias("id1"), F.col("cell").alias("c1")), "id1")
             .join(placed.select(F.col("id").alias("id2"), F.col("cell").alias("c2")), "id2")
             .select(F.xxhash64("c1", "c2").alias("tile"), "id1", "id2"))
    needed = dealt.select("tile", F.explode(F.array("id1", "id2")).alias("id1")).distinct()
    # most sets are in no pair: these needn't move
    if placed.count() <= FEW_IDS:
        arrays = arrays.join(F.broadcast(placed.select(F.col("id").alias("entity"))), "entity", "left_semi")
    held = needed.join(arrays.select(F.col("entity").alias("id1"), F.col(column).alias("e")), "id1")
    kind = pairs.schema["id1"].dataType
    rows = (held.select("tile", "id1", F.lit(None).cast(kind).alias("id2"), "e")
            .unionByName(dealt.withColumn("e", F.lit(None).cast(arrays.schema[column].dataType)))
            .repartition("tile").sortWithinPartitions("tile", F.col("id2").asc_nulls_first()))
    schema = f"id1 {kind.simpleString()}, id2 {kind.simpleString()}, {ddl}"
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches):
        now, sets = None, {}
        for b in batches:
            tiles, one, two = (b.column(k).to_pylist() for k in range(3))
            ends = b.column(3).offsets.to_numpy()
            flat = b.column(3).values.to_numpy()
            found = []
            for i, (tile, x, y) in enumerate(zip(tiles, one, two)):
                if tile != now:
                    now, sets = tile, {}
                if y is None:
                    sets[x] = flat[ends[i]:ends[i + 1]].copy()
                else:
                    found.append((x, y, *compare(sets[x], sets[y])))
            if found:
                one, two, *rest = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(one, b.column(1).type), pa.array(two, b.column(2).type), *map(pa.array, rest)],
                                                 names=names)

    return with_package(rows).mapInArrow(work, schema)


def shared_elements(a, b) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted arrays."""
    import numpy as np

    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared, len(both) - shared


def jaccard_in_cells(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """As ``jaccard_of_pairs`` for stored distinct pairs and sets in rows, sorted."""
    return compared(pairs, arrays, shared_elements, "inter long, union long").withColumn("jaccard", F.col("inter") / F.col("union"))


def equal_sets(arrays: DataFrame) -> DataFrame:
    """(entity, rep): the least entity of those with the same set (sorted arrays, by a
    128-bit digest).  Entities that are null are left out: they are in no pair."""
    keyed = arrays.filter(F.col("entity").isNotNull()).select(
        "entity", F.xxhash64("elements").alias("d1"), F.xxhash64(F.lit(1), "elements").alias("d2"))
    reps = keyed.groupBy("d1", "d2").agg(F.min("entity").alias("rep"))
    return keyed.join(reps, ["d1", "d2"]).select("entity", "rep")


def representatives(arrays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``equal_sets``, stored, and the sets of the representatives.  The other
    entities' ids are broadcast if they are few, so that ``arrays`` (stored) needn't
    be shuffled and written again."""
    classes = materialize(equal_sets(arrays), "classes")
    others = classes.filter("entity <> rep").select("entity")
    known = arrays.filter(F.col("entity").isNotNull())
    if others.count() <= FEW_IDS:
        return classes, known.join(F.broadcast(others), "entity", "left_anti")
    return classes, materialize(known.join(others, "entity", "left_anti"), "sets")


def of_all_entities(found: DataFrame, classes: DataFrame, within: DataFrame | None = None) -> DataFrame:
    """Pairs of representatives as pairs of all entities.  ``within`` (rep, and the
    further columns of ``found``) has the values of two entities of one class."""
    rest = [c for c in found.columns if c not in ("id1", "id2")]
    a = classes.select(F.col("rep").alias("id1"), F.col("entity").alias("_a"))
    b = classes.select(F.col("rep").alias("id2"), F.col("entity").alias("_b"))
    between = found.join(a, "id1").join(b, "id2").select(
        F.least("_a", "_b").alias("id1"), F.greatest("_a", "_b").alias("id2"), *rest)
    inside = pairs_within_groups(classes, ["rep"], "entity")
    if within is not None:
        inside = inside.join(within, "rep")
    return between.unionByName(inside.select("id1", "id2", *rest))


def top_pairs(pairs: DataFrame, titles: DataFrame, k: int = 20, id_col: str = "item_id",
              title: str = "title", digits: int = 4) -> DataFrame:
    """Top-k pairs by Jaccard (ties by ids) with both titles, rounded."""
    t1 = titles.select(F.col(id_col).alias("id1"), F.col(title).alias("title1"))
    t2 = titles.select(F.col(id_col).alias("id2"), F.col(title).alias("title2"))
    top = pairs.orderBy(F.col("jaccard").desc(), "id1", "id2").limit(k)
    return (top.join(t1, "id1", "left").join(t2, "id2", "left")
            .select("id1", "id2", "title1", "title2", F.round("jaccard", digits).alias("jaccard")))
