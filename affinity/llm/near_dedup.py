"""Near-duplicate documents by a chosen-path set similarity join on MinHash.

A document is the set of its 64-bit hashed shingles of ``width`` words; two are linked if
their sets have Jaccard similarity ``threshold`` or more; a component is all
that links reach, and its smallest doc_id stays.

Candidates come from ``trees`` chosen-path trees.  Each starts at a coordinate
of its own.  A node of a tree is a set of documents; it chooses minwise
coordinates (one, and a second with the chance 1/threshold - 1) from its path,
and its documents go on by their MinHash value at each, so a linked pair is
expected in one child or more of every node that it shares.  That is a mean: a
pair may leave a tree, with a chance that ``survival`` gives, and the number of
trees follows from it so that RECALL of the pairs at the threshold are still
together at the deepest level.  Nodes of up to ``small`` documents are
compared exhaustively on sketches of one byte per coordinate; larger ones
branch on.

The work is done in rounds, each confirmed on full sets:

1. In every node of the first level some members are pivots (the one most like
   the others in small nodes, about PIVOTS in large ones), and members that
   resemble them make pairs with the nearest.  That is at most two pairs per
   member and node, and resolves groups of copies, and most of a family of near
   copies, however large.
2. With the components of round 1 known, only pairs of different components can
   matter.  Nodes that lie in one component are done.  Small nodes compare all
   pairs of different components, and each member keeps its nearest one.  In
   large nodes in which that is little work (``MEETINGS``), and in all that are
   left at the last level, the members outside the main component are compared
   with every member, in tiles of ``BLOCK`` by ``BLOCK``; other large nodes branch
   to the next of ``LEVELS``.  So no pair is left out by a cap.
3. With the components of round 2, all pairs of different components that are
   left are candidates.  Only documents with a nearest one can have any, so the
   nodes keep these alone, and they are compared by the ``BOTTOM`` least hashes of
   the set besides the sketch.  These tell pairs just under the threshold from
   links: exactly for sets that are no larger, else within four standard
   deviations.  So a group of copies and many texts that almost belong to it
   don't make a candidate of each of their pairs.

A document's way down a tree depends on its own MinHash values only, so it
carries its paths at all levels from the start and branching joins nothing.

Equal sets are one representative (the smallest doc_id) before all this, by a
128-bit digest, with an id of its own: a doc_id may have several texts, or be null.  Sketch estimates lose a pair at exactly the threshold about
once in 100,000 times; the trees miss it about once in 1,000 times (RECALL).

Skew: a node of any size is only ever counted (pre-aggregated), branched row by
row, or cut into tiles of about BLOCK * BLOCK members by as many of those that
they are compared with (``in_tiles``); only nodes of up to ``small`` members and
tiles are brought together in a task.  Rows are dealt to these cells once, without
a join: lists of members joined on hot nodes were split into a task each.

Defined results: a null or empty text, or one without words, has an empty set,
and is linked with nothing; with fewer than ``width`` words the whole sequence
is the one shingle; rows that repeat a doc_id with one text get one verdict,
those with different texts one for each; rows with a null doc_id link like
others but never name a component that has an id; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import tokens
from affinity.llm.common import salt_of, salted, spread
from affinity.llm.components import connected_components
from affinity.session import materialize, with_package

WIDTH = 3
THRESHOLD = 0.85
COORDINATES = 128
#: Pairs at the threshold that share a node of the deepest level.
RECALL = 0.999
SMALL = 256
#: Depths at which nodes are looked at.
LEVELS = (1, 2, 5)
#: Large nodes in which so few sketches meet don't branch on: all members are
#: compared with those outside the main component, in tiles.
MEETINGS = 1 << 21
#: Members that are compared with as many outsiders at once.
BLOCK = 64
#: Pairs that a task holds before it keeps the nearest of each document only.
HELD_PAIRS = 1 << 19
SALTS = 16
#: Ids that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 4_000_000
#: The same for sets with their digests and owners, so that built sets move once.
BROADCAST_SETS = BROADCAST_IDS // 8
#: Pairs whose sketches agree by so many standard deviations less than the
#: threshold are no candidates (about 1 in 100,000 at the threshold); pivots,
#: which lose nothing, take the nearer ones only.
DEVIATIONS, PIVOT_DEVIATIONS = 5, 3.2
PIVOTS = 16
#: Text or rows that are looked at at once.
BATCH_BYTES = 2 << 20
#: Least hashes of a set that rows carry in the last round.
BOTTOM = 512

U = np.uint64
MIX = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]
#: The first coordinate of each tree.
ROOTS = np.random.default_rng(11).permutation(COORDINATES)
MULTIPLIERS = (np.random.default_rng(7).integers(0, 1 << 63, COORDINATES, np.uint64) << U(1)) | U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * MIX[3]
    x = (x ^ (x >> U(29))) * MIX[4]
    return x ^ (x >> U(32))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in turn, and each set's size."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(tokens.whole(texts)))
    words, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(words), 0)
    counts = tokens._sums(real.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0])
    coded = words.filter(real).dictionary_encode()
    hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    h = hashes[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.uint64)
    starts = tokens.starts_of(counts)
    full = np.zeros(len(h), np.uint64)
    for k, m in enumerate(MIX[0] + np.arange(0, 2 * width, 2, dtype=np.uint64) * MIX[1]):
        full[:len(h) - k] += h[k:] * m
    full = mixed(full)
    sets, sizes = [], np.zeros(len(counts), np.int64)
    for i, (lo, n) in enumerate(zip(starts.tolist(), counts.tolist())):
        if n >= width:
            found = np.unique(full[lo:lo + n - width + 1])
        elif n:
            short = np.zeros(1, np.uint64) + MIX[2] * U(n)
            for k in range(n):
                short = mixed(short + h[lo + k])
            found = short
        else:
            continue
        sets.append(found)
        sizes[i] = len(found)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), sizes


def signatures(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MinHash values (rows, COORDINATES); rows of empty sets are all zero."""
    out = np.zeros((len(sizes), COORDINATES), np.uint32)
    rows = np.flatnonzero(sizes)
    starts, upto = tokens.starts_of(sizes[rows]), np.cumsum(sizes[rows])
    at = 0
    while at < len(rows):  # so many sets at a time as stay in a CPU's cache
        stop = max(at + 1, int(np.searchsorted(upto, (starts[at] + 32768))))
        part, cuts = flat[starts[at]:upto[stop - 1]], starts[at:stop] - starts[at]
        for k, m in enumerate(MULTIPLIERS):
            out[rows[at:stop], k] = np.minimum.reduceat(part * m, cuts) >> U(32)
        at = stop
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The 2-d array of binary values of one length."""
    if not len(column):
        return np.empty((0, width), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def digests(flat: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    """The two halves of each set's digest."""
    ends = np.cumsum(sizes).tolist()
    halves = np.frombuffer(b"".join(hashlib.blake2b(flat[e - n:e], digest_size=16).digest()
                                    for e, n in zip(ends, sizes.tolist())), np.int64).reshape(-1, 2)
    return [pa.array(halves[:, 0]), pa.array(halves[:, 1])]


def text_key(text: Column | str = "text") -> Column:
    """With doc_id, what tells rows apart: 128 bits of the text."""
    return F.unhex(F.md5(text))


def described(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_key, n_shingles, d1, d2, signature): size, digest and
    MinHash of each set."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_shingles", pa.int64()), ("d1", pa.int64()),
                        ("d2", pa.int64()), ("signature", pa.binary())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.small_batches(batches, BATCH_BYTES):
            flat, sizes = shingle_sets(b.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(sizes), *digests(flat, sizes), _binary(signatures(flat, sizes))],
                schema=schema)

    return with_package(docs).select(F.col("doc_id").cast("long"), "text", text_key().alias("text_key")).mapInArrow(
        describe, "doc_id long, text_key binary, n_shingles long, d1 long, d2 long, signature binary")


def represented(rows: DataFrame) -> DataFrame:
    """(id, doc_id, d1, d2, copies, n, signature) of each set that isn't empty,
    with its smallest doc_id; ids are in no order, so that the sets move once."""
    return (rows.filter("n_shingles > 0").groupBy("d1", "d2")
            .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
                 F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
            .sortWithinPartitions("d1", "d2").withColumn("id", F.monotonically_increasing_id()))


def full_sets(docs: DataFrame, reps: DataFrame, ids: DataFrame, most: int, width: int = WIDTH,
              least: int | None = None) -> DataFrame:
    """(id, items): the sorted shingle hashes of the sets ``ids`` (``most`` at
    most) names, each once; only the ``least`` first ones if given.  A set is built from the rows
    of its doc_id, and those that have other texts are told by the digest."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.small_batches(batches, BATCH_BYTES):
            flat, sizes = shingle_sets(b.column(1), width)
            ends = np.cumsum(sizes).tolist()
            items = pa.array([flat[e - n:e][:least].tobytes() for e, n in zip(ends, sizes.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *digests(flat, sizes), items],
                                             names=["doc_id", "d1", "d2", "items"])

    wanted = reps.join(ids, "id", "left_semi").select("id", F.col("doc_id").alias("own"), "d1", "d2")
    owners = wanted.select("own")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.join(small(owners, most), rows["doc_id"].eqNullSafe(owners["own"]), "left_semi")
    built = with_package(rows).mapInArrow(build, "doc_id long, d1 long, d2 long, items binary")
    wanted = small(wanted, most, BROADCAST_SETS)
    found = built.join(wanted, (built["d1"] == wanted["d1"]) & (built["d2"] == wanted["d2"])
                       & built["doc_id"].eqNullSafe(wanted["own"]))
    return found.groupBy("id").agg(F.first("items").alias("items"))


def survival(threshold: float, depth: int) -> float:
    """The chance that a pair at the threshold shares a node of this depth in
    one tree: the first step is one choice, each further one may be two."""
    share = 1.0
    for _ in range(depth - 1):
        share -= (1 / threshold - 1) * (threshold * share) ** 2
    return threshold * share


def trees_for(threshold: float, recall: float = RECALL) -> int:
    """Trees that keep this share of the pairs at the threshold down to the
    deepest level."""
    if not 0.5 <= threshold < 1:
        raise ValueError("two choices a node need a threshold from 0.5 to below 1")
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(threshold, LEVELS[-1])))


def _coordinates(path: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, coordinates) of the first choices of all paths, then of the second
    ones, which differ from the first."""
    first = (mixed(path ^ MIX[0]) % U(COORDINATES)).astype(np.int64)
    other = (mixed(path ^ MIX[1]) % U(COORDINATES - 1)).astype(np.int64) + 1
    chance = (mixed(path ^ MIX[2]) >> U(11)).astype(float) / (1 << 53)
    more = np.flatnonzero(chance < 1 / threshold - 1)
    return (np.concatenate([np.arange(len(path)), more]),
            np.concatenate([first, (first[more] + other[more]) % COORDINATES]))


def branched(reps: DataFrame, trees: int, threshold: float = THRESHOLD) -> DataFrame:
    """(path, id, tail): each document's nodes at the first of LEVELS, and its
    ways on from there, each the paths at the other levels."""

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.small_batches(batches, BATCH_BYTES):
            values = _matrix(b.column(1), np.uint32, COORDINATES)

            def child(path: np.ndarray, at: np.ndarray, where: np.ndarray) -> np.ndarray:
                return mixed(mixed(path * MIX[3] + where.astype(np.uint64)) + values[at, where])

            for tree in range(trees):
                at = np.arange(len(values))
                top = way = child(np.full(len(values), tree + 1, np.uint64), at, np.full(len(values), ROOTS[tree]))
                ways: list[np.ndarray] = []
                for depth in range(2, LEVELS[-1] + 1):
                    rows, where = _coordinates(way, threshold)
                    way, at, ways = child(way[rows], at[rows], where), at[rows], [w[rows] for w in ways]
                    if depth in LEVELS:
                        ways.append(way)
                tail = np.stack(ways, 1)[np.argsort(at, kind="stable")].view(np.int64)
                cuts = np.r_[0, np.cumsum(np.bincount(at, minlength=len(values)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(top.view(np.int64)), b.column(0), pa.ListArray.from_arrays(
                        pa.array(cuts), pa.FixedSizeListArray.from_arrays(
                            pa.array(tail.ravel()), tail.shape[1]).cast(pa.list_(pa.int64())))],
                    names=["path", "id", "tail"])

    return with_package(reps).select("id", "signature").mapInArrow(branch, "path long, id long, tail array<array<long>>")


def sketches(reps: DataFrame) -> DataFrame:
    """(id, n, sketch): the last byte of each MinHash value."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = _matrix(b.column(2), np.uint32, COORDINATES)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _binary(values.astype(np.uint8))],
                                             names=["id", "n", "sketch"])

    return with_package(reps).select("id", "n", "signature").mapInArrow(cut, "id long, n long, sketch binary")


def shared_nodes(rows: DataFrame) -> DataFrame:
    """Rows of nodes with two members or more, with the node's size."""
    sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return rows.join(sizes, "path")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by their first column, cut between its values."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        path = b.column(0).to_numpy()
        change = np.flatnonzero(path[1:] != path[:-1])
        if held and (held[-1].column(0)[-1].as_py() != path[0]):
            yield _joined(held)
            held = []
        last = int(change[-1]) + 1 if len(change) else 0
        if last:
            yield _joined([*held, b.slice(0, last)])
            held = []
        held.append(b.slice(last))
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _alike(n1: np.ndarray, n2: np.ndarray, agreement: np.ndarray, threshold: float,
           deviations: float = DEVIATIONS) -> np.ndarray:
    """Could sets of these sizes and this agreement be linked?"""
    lo, hi = np.minimum(n1, n2), np.maximum(n1, n2)
    slack = deviations * math.sqrt(threshold * (1 - threshold) / COORDINATES)
    return (agreement >= (threshold - slack) * COORDINATES) & (lo >= threshold * hi - 1e-9)


def _agreement(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.count_nonzero(sketches == one, axis=-1)


LARGEST = np.iinfo(np.uint64).max


def may_link(one: np.ndarray, n1: int, others: list[np.ndarray], n2: np.ndarray,
             threshold: float = THRESHOLD) -> np.ndarray:
    """Which of ``others`` may be linked with ``one``?  All are sorted least
    hashes of sets of the sizes ``n1`` and ``n2``, none empty.  Up to the last
    hash that both have kept these are samples of the sets, or the whole sets."""
    counts, flat = np.array([len(x) for x in others]), np.concatenate(others)
    ends = np.cumsum(counts)
    upto = np.minimum(np.where(n2 > counts, flat[ends - 1], LARGEST), one[-1] if n1 > len(one) else LARGEST)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    inside = flat <= np.repeat(upto, counts)
    theirs = np.add.reduceat(inside.astype(np.int64), ends - counts)
    shared = np.add.reduceat((inside & (one[at] == flat)).astype(np.int64), ends - counts)
    union = np.searchsorted(one, upto, side="right") + theirs - shared
    slack = np.where(upto == LARGEST, 1e-9, 4 * np.sqrt(threshold * (1 - threshold) * union))
    return shared >= threshold * union - slack


def _hashes(column: pa.Array, rows: np.ndarray) -> list[np.ndarray]:
    return [np.frombuffer(column[int(r)].as_buffer(), np.uint64) for r in rows]


PAIR_DDL = "id1 long, id2 long"


def _pairs(a: list, b: list) -> pa.RecordBatch:
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["id1", "id2"])


NEAREST, ALL = range(2)


def _nearest(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (one, other, agreement) the best of each one and of each other."""
    one, other, same = (np.concatenate(x) for x in zip(*found))
    kept = []
    for ids in (one, other):
        order = np.lexsort((-same, ids))
        kept.append(order[np.r_[True, ids[order][1:] != ids[order][:-1]]])
    kept = np.unique(np.concatenate(kept))
    return one[kept], other[kept], same[kept]


def in_tiles(nodes: DataFrame, facing: Column) -> DataFrame:
    """``nodes`` (path, id, size, facings) with the ``cell`` that a row is compared
    in.  Small nodes are a cell of their own (side 0).  Larger ones are cut into
    tiles of about BLOCK * BLOCK members (side 1) by as many of the ``facings``
    that are ``facing`` the members (side 2): a member stands in each tile of its
    row, one that is facing in each tile of its column as well."""
    most = BLOCK * BLOCK
    across, down = F.ceil(F.col("facings") / most), F.ceil(F.col("size") / most)

    def cells(row: Column, column: Column, side: int) -> Column:
        return F.struct(F.xxhash64("path", row, column).alias("cell"), F.lit(side).alias("side"))

    def place(parts: Column) -> Column:
        return F.pmod(F.xxhash64("id"), parts)

    none = F.lit(0).cast("long")
    as_member = F.transform(F.sequence(none, across - 1), lambda k: cells(place(down), k, 1))
    as_facing = F.when(facing, F.transform(
        F.sequence(none, down - 1), lambda k: cells(k, place(across), 2))).otherwise(F.array())
    alone = F.array(F.struct(F.col("path").alias("cell"), F.lit(0).alias("side")))
    return nodes.withColumn("at", F.explode(F.when(F.col("size") <= SMALL, alone).otherwise(F.concat(as_member, as_facing))))


def pivot_pairs(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Candidate pairs: in small nodes of the members with the pivot, in larger
    ones with their two nearest pivots, which are about PIVOTS of the members,
    drawn by hash.  Two, so that members tie the pivots of a family to each other."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _runs(batches):
            cell, ids, n, side = (b.column(k).to_numpy() for k in (0, 1, 2, 4))
            sketch = _matrix(b.column(3), np.uint8, COORDINATES)
            first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            ends = np.r_[first[1:], len(cell)]
            two = first[(ends - first == 2) & (side[first] == 0)]
            two = two[_alike(n[two], n[two + 1], _agreement(sketch[two], sketch[two + 1]), threshold)]
            a, c = [ids[two]], [ids[two + 1]]
            for lo, hi in zip(first.tolist(), ends.tolist()):
                alone, member = (lo + int(k) for k in np.searchsorted(side[lo:hi], (1, 2)))
                if alone - lo > 2:
                    same = np.stack([_agreement(sketch[lo:alone], one) for one in sketch[lo:alone]])
                    pivot = int(same.sum(0).argmax())
                    hit = np.flatnonzero(_alike(n[lo:alone], n[lo + pivot], same[pivot], threshold, PIVOT_DEVIATIONS))
                    hit = lo + hit[hit != pivot]
                    a.append(np.full(len(hit), ids[lo + pivot]))
                    c.append(ids[hit])
                for r in range(alone, member if member < hi else alone):
                    same = _agreement(sketch[member:hi], sketch[r])
                    hit = np.flatnonzero(_alike(n[member:hi], n[r], same, threshold, PIVOT_DEVIATIONS) & (ids[member:hi] != ids[r]))
                    hit = member + hit[np.argsort(-same[hit], kind="stable")[:2]]
                    a.append(np.full(len(hit), ids[r]))
                    c.append(ids[hit])
            yield _pairs(a, c)

    drawn = F.pmod(F.xxhash64("path", "id"), F.col("size")) < PIVOTS
    dealt = in_tiles(nodes.withColumn("facings", F.lit(PIVOTS)), drawn).select(
        F.col("at.cell").alias("cell"), "id", "n", "sketch", F.col("at.side").alias("side"))
    return with_package(dealt.repartition("cell").sortWithinPartitions("cell", "side", "id")).mapInArrow(near, PAIR_DDL)


def node_pairs(nodes: DataFrame, pick: int, threshold: float = THRESHOLD) -> DataFrame:
    """Candidate pairs of different components: in small nodes of all members,
    in larger ones of members with those outside the main component.  Either all
    that the least hashes allow, or of each row with the nearest that it meets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def meet(b: pa.RecordBatch, sketch: np.ndarray, one: slice, other: slice) -> None:
            ids, n, comp = (b.column(k).to_numpy() for k in (1, 2, 4))
            for lo in range(one.start, one.stop, BLOCK):
                own = np.arange(lo, min(lo + BLOCK, one.stop))
                same = np.stack([_agreement(sketch[other], x) for x in sketch[own]])
                good = _alike(n[own, None], n[None, other], same, threshold) & (comp[own, None] != comp[None, other])
                if not good.any():
                    continue
                if pick == NEAREST:
                    like = np.where(good, same, -1)
                    i, j = np.flatnonzero(good.any(1)), np.flatnonzero(good.any(0))
                    i, j = np.concatenate([i, like.argmax(0)[j]]), np.concatenate([like.argmax(1)[i], j])
                else:
                    used = np.flatnonzero(good.any(0))
                    theirs = dict(zip(used.tolist(), _hashes(b.column(6), other.start + used)))
                    for x in np.flatnonzero(good.any(1)).tolist():
                        y = np.flatnonzero(good[x])
                        mine = _hashes(b.column(6), own[x:x + 1])[0]
                        good[x, y] = may_link(mine, n[own[x]], [theirs[k] for k in y.tolist()], n[other][y], threshold)
                    i, j = np.nonzero(good)
                found.append((ids[own[i]], ids[other][j], same[i, j]))

        for b in _runs(batches):
            path, ids, comp, side = (b.column(k).to_numpy() for k in (0, 1, 4, 5))
            n, sketch = b.column(2).to_numpy(), _matrix(b.column(3), np.uint8, COORDINATES)
            first = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
            ends = np.r_[first[1:], len(path)]
            two = first[(ends - first == 2) & (side[first] == 0)]
            same = np.count_nonzero(sketch[two] == sketch[two + 1], axis=1)
            keep = _alike(n[two], n[two + 1], same, threshold) & (comp[two] != comp[two + 1])
            two, same = two[keep], same[keep]
            if pick == ALL and len(two):
                least = [_hashes(b.column(6), np.array((r, r + 1))) for r in two]
                keep = np.array([may_link(x, n[r], [y], n[r + 1:r + 2], threshold)[0] for r, (x, y) in zip(two, least)], bool)
                two, same = two[keep], same[keep]
            if len(two):
                found.append((ids[two], ids[two + 1], same))
            for lo, hi in zip(first.tolist(), ends.tolist()):
                alone, member = (lo + int(k) for k in np.searchsorted(side[lo:hi], (1, 2)))
                if alone - lo > 2 and not (comp[lo:alone] == comp[lo]).all():
                    meet(b, sketch, slice(lo, alone), slice(lo, alone))
                if alone < member < hi:
                    meet(b, sketch, slice(alone, member), slice(member, hi))
            if pick == ALL:
                yield _pairs(*([f[k] for f in found] for k in range(2)))
                found.clear()
            elif sum(len(f[0]) for f in found) > HELD_PAIRS:
                found[:] = [_nearest(found)]
        if found:
            yield _pairs(*([x] for x in _nearest(found)[:2]))

    least = ["least"] if pick == ALL else []
    dealt = in_tiles(nodes.withColumnRenamed("outsiders", "facings"), F.col("comp") != F.col("main")).select(
        F.col("at.cell").alias("cell"), "id", "n", "sketch", "comp", F.col("at.side").alias("side"), *least)
    return with_package(dealt.repartition("cell").sortWithinPartitions("cell", "side", "id")).mapInArrow(compare, PAIR_DDL)


def small(ids: DataFrame, most: int, limit: int = BROADCAST_IDS) -> DataFrame:
    """``ids``, ``most`` at most, for a broadcast unless there are many; they are
    counted only if that may be."""
    return F.broadcast(ids) if most <= limit or ids.count() <= limit else ids


def either_end(pairs: DataFrame) -> DataFrame:
    """(id) of all ids in pairs."""
    return pairs.select(F.col("id1").alias("id")).unionByName(pairs.select(F.col("id2").alias("id"))).distinct()


def confirmed(docs: DataFrame, reps: DataFrame, pairs: DataFrame, name: str, width: int = WIDTH,
              threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (stored ones, each once) whose full sets are similar enough; stored."""
    least, of = Fraction(str(threshold)).as_integer_ratio()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, other = (b.column(k).to_pylist() for k in (2, 3))
            keep = []
            for x, y in zip(one, other):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(of * shared >= least * (len(both) - shared))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["id1", "id2"])

    most = 2 * pairs.count()
    sets = full_sets(docs, reps, small(either_end(pairs), most), most, width)
    one = sets.select(F.col("id").alias("id1"), F.col("items").alias("items1"))
    other = sets.select(F.col("id").alias("id2"), F.col("items").alias("items2"))
    checked = pairs.join(one, "id1").join(other, "id2").select("id1", "id2", "items1", "items2")
    return materialize(checked.mapInArrow(check, PAIR_DDL), f"{name}-links")


def cross_pairs(level: DataFrame, marks: DataFrame, parts: DataFrame, pick: int, threshold: float = THRESHOLD) -> DataFrame:
    """Candidate pairs of different components, from all levels: of each
    member with the nearest in a node, or all.  Rows of nodes are ids and paths;
    ``marks`` (id, n, sketch, and least hashes for all pairs) are joined with those
    that are compared, the nodes of all levels together."""
    placed = level.join(parts.withColumnRenamed("component", "comp"), "id", "left").withColumn(
        "comp", F.coalesce("comp", "id"))
    met = []
    for step in range(len(LEVELS)):
        # nodes that lie in one component are done
        parted = (placed.groupBy("path", "comp").agg(F.count(F.lit(1)).alias("k"))
                  .groupBy("path").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("size"))
                  .select("path", "size", F.col("m.comp").alias("main"), (F.col("size") - F.col("m.k")).alias("outsiders"))
                  .filter("outsiders > 0"))
        live = materialize(placed.join(parted, "path"), "live")
        last = step == len(LEVELS) - 1
        few = F.lit(last) | (F.col("size") <= SMALL) | (F.col("size") * F.col("outsiders") <= MEETINGS)
        met.append(live.filter(few).drop("tail"))
        deeper = live.filter(~few)
        if last or deeper.isEmpty():
            break
        placed = (deeper.drop("size", "main", "outsiders")
                  .withColumn("path", F.explode(F.array_distinct(F.transform("tail", lambda way: way[0]))))
                  .withColumn("tail", F.transform(F.filter("tail", lambda way: way[0] == F.col("path")),
                                                  lambda way: F.slice(way, 2, len(LEVELS)))))
    return node_pairs(reduce(DataFrame.unionByName, met).join(marks, "id"), pick, threshold)


def verdicts(docs: DataFrame, width: int = WIDTH, trees: int | None = None,
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept), one row per input row."""
    rows = materialize(described(docs, width), "described")
    reps = materialize(represented(rows), "representatives")
    level = materialize(shared_nodes(branched(reps, trees or trees_for(threshold), threshold)), "nodes")
    marks = materialize(sketches(reps), "sketches")
    marked = level.select("path", "id", "size").join(marks, "id")
    pairs = materialize(pivot_pairs(marked, threshold).distinct(), "pivot-pairs")
    links = confirmed(docs, reps, pairs, "pivot", width, threshold)
    parts = connected_components(links)
    for name, pick in (("nearest", NEAREST), ("cross", ALL)):
        if pick == ALL:
            most = 2 * pairs.count()
            ids = small(either_end(pairs), most)
            level = level.join(ids, "id", "left_semi")
            least = full_sets(docs, reps, ids, most, width, BOTTOM).withColumnRenamed("items", "least")
            marks = materialize(marks.join(least, "id"), "least-hashes")
        pairs = materialize(cross_pairs(level.drop("size"), marks, parts, pick, threshold).distinct(), f"{name}-pairs")
        more = confirmed(docs, reps, pairs, name, width, threshold)
        if not more.isEmpty():
            links = links.unionByName(more)
            parts = connected_components(links)

    # where a set's documents go, if not each to itself
    ids = reps.select("id", "doc_id", "d1", "d2", "copies")
    members = ids.join(parts, "id")
    roots = members.groupBy("component").agg(F.min("doc_id").alias("root"))
    linked = (members.withColumn("_salt", salt_of("id", SALTS))
              .join(salted(roots, SALTS), ["component", "_salt"]).select("d1", "d2", "root"))
    copied = (ids.filter("copies > 1").join(parts, "id", "left_anti")
              .select("d1", "d2", F.col("doc_id").alias("root")))
    joined = (rows.drop("signature").withColumn("_salt", spread(SALTS))
              .join(salted(linked.unionByName(copied), SALTS), ["d1", "d2", "_salt"], "left"))
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "text_key", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_components(docs: DataFrame, width: int = WIDTH, trees: int | None = None,
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    return verdicts(docs, width, trees, threshold).drop("text_key")


def dedup_near(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose component has a smaller doc_id than
    theirs; documents without a doc_id stay if they resemble none that has one."""
    gone = (verdicts(docs, width, threshold=threshold).filter("not kept")
            .select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_text")).distinct())
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone"])
                     & (text_key(docs["text"]) == gone["_gone_text"]), "left_anti")
