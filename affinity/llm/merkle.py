"""Merkle manifest of a dataset, and its verification by a recursive query.

Every row is a leaf: the SHA-256 of its fields.  The leaves of a source stand
in order of doc_id; runs of ``FANOUT`` consecutive nodes become their hash,
until one node is left, the source's subroot.  The subroots, ordered by source,
give the root in the same way.

Building: leaves are hashed once and written.  They are range-partitioned by
(source, doc_id, leaf), so a source with a third of all rows is many partitions;
a leaf's place is its place in its partition plus the leaves of its source in
the partitions before, which one small table of counts gives.  Each further
level groups at most ``FANOUT`` rows, and is written as node rows that name
their parent: (tree, level, place, parent, hash).  Levels are as many as the
largest source needs, the logarithm of its rows.

Verifying: a recursive common table expression starts with the leaves, those
of one run in one row, as they have all siblings above the run in common.  Each
turn joins a row with the node rows' siblings at its level, appends the siblings
to the proof and folds the hash of every leaf of the run into that of its parent;
a row that has reached its subroot goes on in the tree of sources.  A leaf
verifies if its folded hash is the root.  So a row carries its proof once for
``FANOUT`` leaves.  Hashes are kept as 32 bytes and hashed as their hex text.

Defined results: null fields are written ``-``; null sources are a tree of their
own, first in order; null doc_ids come first in their source; rows that repeat a
doc_id follow each other by leaf hash, and equal rows are a leaf each; an empty
table gives no nodes and an empty result; columns that aren't ``FIELDS`` are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import ascii_lower
from affinity.session import materialize

FANOUT = 16
#: The columns that a leaf holds, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree above the sources' trees.
TOP_TREE = -1
#: Bytes of a hash.
HASH = 32


def hash_of(value: Column) -> Column:
    """The SHA-256 as bytes."""
    return F.unhex(F.sha2(value, 256))


def as_text(hashes: Column) -> Column:
    """Bytes of hashes as lower-case hex."""
    return F.lower(F.hex(hashes))


def leaf_hash(text: Column) -> Column:
    """The hash of a row with ``text`` in place of its text."""
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return hash_of(F.concat(*parts))


def every_fifth(key: str = "doc_id") -> Column:
    """Is the unsigned crc32 of the id as text a multiple of 5?"""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """(tree, place, source, doc_id, leaf, found) per row, in order; stored.
    ``found`` is the hash that a later reading of the row gives: of the text with
    A-Z lower-cased where ``altered`` says so, else the leaf."""
    altered = F.lit(False) if altered is None else altered
    hashed = materialize(docs.select(*FIELDS).select(
        "source", F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(F.col("text")).alias("leaf"),
        F.when(altered, leaf_hash(ascii_lower(F.col("text")))).alias("found")), "leaf-hashes")
    keys = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc_nulls_first("found")]
    ordered = materialize(hashed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "source", "doc_id", "leaf", F.coalesce("found", "leaf").alias("found"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "leaves-in-order")
    # a row per source and partition
    parts = ordered.groupBy("source", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    trees = parts.groupBy("source").agg(F.sum("n").alias("size"))
    trees = trees.withColumn("tree", F.row_number().over(Window.orderBy(F.asc_nulls_first("source"))).cast("long") - 1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = parts.join(trees, parts["source"].eqNullSafe(trees["source"])).select(
        F.col("part").alias("p_part"), parts["source"].alias("p_source"), "tree", "size", (F.col("before") - F.col("first")).alias("shift"))
    placed = ordered.join(parts, (ordered["part"] == parts["p_part"]) & ordered["source"].eqNullSafe(parts["p_source"]))
    return materialize(placed.select("tree", (F.col("row") + F.col("shift")).alias("place"), "size", "source", "doc_id", "leaf", "found"), "leaves")


def _above(nodes: DataFrame, level: int, fanout: int) -> DataFrame:
    """Nodes of this level from those below, (tree, place, size, hash), each with
    the hashes of its children; trees of one node have none."""
    run = F.aggregate(F.array_sort(F.collect_list(F.struct("place", "hash"))), F.lit(b""), lambda all_, x: F.concat(all_, x["hash"]))
    return (nodes.filter("size > 1").groupBy("tree", "size", F.expr(f"place div {fanout}").alias("up")).agg(run.alias("children"))
            .select("tree", F.lit(level).alias("level"), F.col("up").alias("place"), F.ceil(F.col("size") / fanout).alias("size"),
                    "children", hash_of(as_text(F.col("children"))).alias("hash"))
            .withColumn("parent", F.when(F.col("size") > 1, F.expr(f"place div {fanout}"))))


def _built(start: DataFrame, fanout: int, name: str) -> DataFrame:
    """All nodes above ``start`` (tree, place, size, hash); stored level by level."""
    found, level, now = None, 0, start
    while found is None or not now.isEmpty():
        level += 1
        now = materialize(_above(now, level, fanout), f"{name}-{level}")
        found = now if found is None else found.unionByName(now)
    return found


def manifest(leaf_rows: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """The nodes above the leaves, (tree, level, place, size, children, hash,
    parent), and (tree, subroot) of every source; both stored.  ``size`` is the
    number of nodes in the tree's level, ``parent`` the place of the node's parent
    one level above, ``children`` the hashes of those below, joined.  The leaves of
    TOP_TREE are the subroots, their places the trees' numbers."""
    inner = _built(leaf_rows.select("tree", "place", "size", F.col("leaf").alias("hash")), fanout, "nodes")
    roots = materialize(inner.filter("size = 1").select("tree", F.col("hash").alias("subroot")).unionByName(
        leaf_rows.filter("size = 1").select("tree", F.col("leaf").alias("subroot"))), "subroots")
    number = roots.agg(F.count(F.lit(1))).scalar()
    top = _built(roots.select(F.lit(TOP_TREE).cast("long").alias("tree"), F.col("tree").alias("place"),
                              F.col("subroot").alias("hash")).withColumn("size", number), fanout, "top")
    return materialize(inner.unionByName(top), "manifest"), roots


#: A row is a run of leaves: the node it has reached, the hash folded up to there
#: of each of its leaves, and the siblings met above the run.
CLIMB = """
WITH RECURSIVE climb (run_tree, run, tree, level, place, folded, proof) AS (
  SELECT run_tree, run, tree, level, place, folded, X'' FROM {{runs}}
  UNION ALL
  SELECT run_tree, run,
         CASE WHEN last THEN {top}L ELSE tree END, CASE WHEN last THEN 0 ELSE level END, CASE WHEN last THEN tree ELSE place END,
         transform(folded, f -> unhex(sha2(lower(hex(concat(before, f, after))), 256))), concat(proof, before, after)
  FROM (SELECT c.run_tree, c.run, n.tree, n.level, n.place, n.size = 1 AND n.tree <> {top} AS last, c.folded, c.proof,
               substring(n.children, 1, cast(c.place % {fanout} AS int) * {hash}) AS before,
               substring(n.children, cast(c.place % {fanout} AS int) * {hash} + {hash} + 1, {fanout} * {hash}) AS after
        FROM climb c JOIN {{nodes}} n ON n.tree = c.tree AND n.level = c.level + 1 AND n.place = c.place div {fanout})
)
SELECT run_tree, run, folded, proof FROM climb WHERE tree = {top} AND level = {height}"""


def verified(leaf_rows: DataFrame, nodes: DataFrame, roots: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per leaf:
    its way to the root with the hash ``found`` in the leaf's place."""
    spark = leaf_rows.sparkSession
    runs = materialize(
        leaf_rows.groupBy("tree", "size", F.expr(f"place div {fanout}").alias("run"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "doc_id", "leaf", "found"))).alias("members"))
        .select(F.col("tree").alias("run_tree"), "run", "size", "members"), "runs")
    last = F.col("size") <= fanout  # the run is all of its tree
    # left and right of each leaf are the others of its run
    def others(first: Column, length: Column) -> Column:
        return F.aggregate(F.slice("members", first, length), F.lit(b""), lambda all_, m: F.concat(all_, m["leaf"]))
    folded = F.when(F.col("size") == 1, F.transform("members", lambda m: m["found"])).otherwise(
        F.transform("members", lambda m, i: hash_of(as_text(F.concat(
            others(F.lit(1), i), m["found"], others(i + 2, F.lit(fanout)))))))
    start = runs.select("run_tree", "run", F.when(last, F.lit(TOP_TREE)).otherwise(F.col("run_tree")).cast("long").alias("tree"),
                        F.when(last, 0).otherwise(1).alias("level"), F.when(last, F.col("run_tree")).otherwise(F.col("run")).alias("place"),
                        folded.alias("folded"))
    top = nodes.filter(f"tree = {TOP_TREE}").agg(F.max("level"), F.max_by("hash", "level")).first()
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # one row per run and level, however many
    try:
        climbed = materialize(spark.sql(CLIMB.format(top=TOP_TREE, fanout=fanout, hash=HASH, height=top[0] or 0), runs=start, nodes=nodes), "climbed")
    finally:
        spark.conf.set(limit, before)
    root = F.lit(bytes(top[1])) if top[1] else F.col("subroot")  # a single source's subroot is the root
    return (runs.join(climbed, ["run_tree", "run"]).join(roots.withColumnRenamed("tree", "run_tree"), "run_tree")
            .select("subroot", "proof", "folded", "members", F.posexplode("members").alias("i", "m"))
            .select(F.col("m.doc_id").alias("doc_id"), as_text(F.col("m.leaf")).alias("leaf"), as_text(F.col("subroot")).alias("subroot"),
                    as_text(root).alias("root"),
                    F.sha2(as_text(F.concat(others(F.lit(1), F.col("i")), others(F.col("i") + 2, F.lit(fanout)), "proof")), 256)
                    .alias("proof_sha256"), as_text(F.get("folded", F.col("i"))).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def manifest_digest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Build the manifest of ``docs``, tamper with every fifth id, and verify."""
    rows = leaves(docs, every_fifth())
    return verified(rows, *manifest(rows, fanout), fanout)
