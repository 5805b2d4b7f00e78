"""Document fingerprints from content-defined chunks.

A gear hash rolls over a text's bytes: each step shifts the hash left by a bit
and adds a fixed random number of the byte, so it depends on the last 32 bytes.
A chunk ends where the hash has zeros in a mask.  Chunking is normalised: no chunk
is shorter than ``least`` bytes; up to ``normal`` bytes a mask with more bits
must be zero, beyond it one with fewer, and at ``most`` bytes the chunk ends
anyway.  So chunk lengths lie close to ``normal``, and boundaries follow the
content: an edit changes the chunks that it touches, and the others are found
again wherever they have moved.

A fingerprint is the set of a text's chunks, each a 64-bit digest with its length
in bytes, in order of digest.  The likeness of a fingerprint to another is its
containment: the bytes of its chunks that the other has too, as a share of the
bytes of all its chunks, each distinct chunk counted once.

``with_next`` gives each document the one that follows it in descending order of
doc_id.  The places of range partitions are drawn from ids and text hashes alone.
Each text then moves once, to its range, and the first document of a range goes
to the range before as well, as the one that follows its last.  A range is read
as a stream, so no task holds more than two documents of it besides a batch.

Defined results: a null text counts as empty; empty texts have an empty
fingerprint, which is like itself (1) and like no other (0); the only document of a
table follows itself; null doc_ids come last; rows that repeat a doc_id are
ordered by text hash; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import tokens
from affinity.session import materialize, with_package

LEAST, NORMAL, MOST = 16, 48, 192
#: Bits that must be zero before and after the normal length.
STRICT_BITS, LOOSE_BITS = 7, 4
REACH = 32
BATCH_BYTES = 4 << 20
#: Ranges that texts are dealt into at most.
MOST_PARTS = 1 << 20
GEAR = np.random.default_rng(13).integers(1, 1 << 32, 256, np.uint32)
GEAR[0] = 0  # what stands before a text counts as nothing


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: the sum of GEAR[byte k places before] << k
    over the last REACH bytes, summed by doubling."""
    h = GEAR[data]
    step = 1
    while step < REACH:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def _next_true(flags: np.ndarray, none: int) -> np.ndarray:
    """For each place the first place from there on with a flag."""
    at = np.where(flags, np.arange(len(flags), dtype=np.int32), np.int32(none))
    return np.minimum.accumulate(at[::-1])[::-1]


def chunk_ends(texts: list[bytes], least: int = LEAST, normal: int = NORMAL, most: int = MOST) -> list[list[int]]:
    """Where the chunks of each text end, in bytes."""
    pad = bytes(REACH)
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(pad + pad.join(texts) + bytes(most + 1), np.uint8)
    begins = tokens.starts_of(sizes + REACH) + REACH
    h = gear_hashes(data)
    top = np.uint32(32)
    # a chunk that ends after byte p ends at place p + 1
    strict = np.concatenate([[False], h >> (top - np.uint32(STRICT_BITS)) == 0])
    loose = np.concatenate([[False], h >> (top - np.uint32(LOOSE_BITS)) == 0])
    n, none = len(data), len(data) + most
    first, later = _next_true(strict, none), _next_true(loose, none)
    at = np.arange(n - most, dtype=np.int32)
    early = first[least:least + len(at)]
    late = np.minimum(later[normal + 1:normal + 1 + len(at)], at + np.int32(most))
    following = memoryview(np.where(early <= at + np.int32(normal), early, late).astype(np.int32))
    out = []
    for lo, size in zip(begins.tolist(), sizes.tolist()):
        ends, p, hi = [], lo, lo + size
        while p < hi:
            p = min(following[p], hi)
            ends.append(p - lo)
        out.append(ends)
    return out


def fingerprints(texts: list[bytes]) -> list[dict[int, int]]:
    """The digests of each text's chunks with their lengths."""
    digest = xxhash.xxh3_64_intdigest
    out = []
    for text, ends in zip(texts, chunk_ends(texts)):
        found, lo = {}, 0
        for hi in ends:
            found[digest(text[lo:hi])] = hi - lo
            lo = hi
        out.append(found)
    return out


def written(fingerprint: dict[int, int]) -> str:
    """``digest:length`` of all chunks in order of digest, with commas between."""
    return ",".join([f"{d:016x}:{fingerprint[d]}" for d in sorted(fingerprint)])


def containment(one: dict[int, int], other: dict[int, int]) -> float:
    """The share of ``one`` that ``other`` holds, weighed by length."""
    if not one:
        return 0.0 if other else 1.0
    return sum(one[d] for d in one.keys() & other.keys()) / sum(one.values())


def edited(text: str, following: str) -> str:
    """``text`` with the last half of its code points replaced by as many first
    ones of ``following``, or all if it has fewer."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _bucket(bounds: Column, key: Column) -> Column:
    """How many bounds (sorted) are at most ``key``, less one; by bisection."""
    start = F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = F.get(bounds, mid) <= key
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & below, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & ~below, mid).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST_PARTS.bit_length())), start, halve)["lo"] - 1


def with_next(docs: DataFrame) -> DataFrame:
    """Ranges of documents in descending order of doc_id: (part, after, doc_id,
    text), sorted by part and in order within it.  Each range ends with a row that
    follows it (``after``) and belongs to the next one."""
    parts = min(MOST_PARTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # descending, nulls last
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.struct(F.col("doc_id").isNull().alias("z"), (-1 - F.col("doc_id")).alias("d"), F.xxhash64("text").alias("h")).alias("key"))
    keys = materialize(rows.select("key"), "keys")
    # the first of each partition: a row per partition
    heads = materialize(keys.repartitionByRange(parts, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
                        .select("key").distinct(), "heads")
    bounds = heads.agg(F.array_sort(F.collect_list("key"))).scalar()
    bounds, rows = F.col("bounds"), rows.withColumn("bounds", bounds)
    placed = rows.withColumn("part", _bucket(bounds, F.col("key")))
    number = F.size(bounds)
    here = F.struct("part", F.lit(False).alias("after"))
    before = F.struct(F.pmod(F.col("part") - 1, number).alias("part"), F.lit(True).alias("after"))
    spread = placed.select("doc_id", "text", "key", F.explode(F.when(
        F.get(bounds, F.col("part")) == F.col("key"), F.array(here, before)).otherwise(F.array(here))).alias("to"))
    return (spread.select("to.part", "to.after", "doc_id", "text", "key").repartitionById(parts, "part")
            .sortWithinPartitions("part", "after", "key").drop("key"))


def fingerprinted(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) per document."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row: part, doc_id, text, fingerprint
        for b in tokens.small_batches(batches, BATCH_BYTES):
            part, after, doc_id, text = (c.to_pylist() for c in b.columns)
            chunks = fingerprints([t.encode() for t in text])
            rows = ([held] if held else []) + [
                None if a else (p, i, t, c) for p, a, i, t, c in zip(part, after, doc_id, text, chunks)]
            # what may follow each of ``rows``, and its part
            following = list(zip(part, text, chunks))
            pairs = [(row, nxt) for row, nxt in zip(rows, following if held else following[1:]) if row and row[0] == nxt[0]]
            held = rows[-1]
            changed = [edited(row[2], nxt[1]).encode() for row, nxt in pairs]
            marks = fingerprints(changed)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[1] for row, _ in pairs], pa.int64()), pa.array([len(row[2]) for row, _ in pairs], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
                 pa.array([written(row[3]) for row, _ in pairs], pa.string()), pa.array(list(map(written, marks)), pa.string()),
                 pa.array([containment(row[3], m) for (row, _), m in zip(pairs, marks)], pa.float64()),
                 pa.array([containment(row[3], nxt[2]) for row, nxt in pairs], pa.float64())],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_package(with_next(docs)).mapInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
