"""Token-id output: documents as range-coded blocks of ids, and back.

Documents are sorted by doc_id over range partitions, encoded with a public
tokenizer, and each partition writes its ids as blocks of whole documents
(``range_coder.pack_blocks``: header, doc_ids, lengths, checksums, coded ids).
Each block is a binary record of a table with its place: the partition
(shard), the block's number and first id in the shard.  Spark's writer commits
the files task by task, so a lost executor leaves no half-written shard.

Reading needs no order: a block decodes on its own, and the id before it is the
sum of the shards before plus the block's first id.  The only table summed by
one task has a row per shard.

Defined results: a null text is an empty one, of just the end id; null doc_ids
come first; rows that repeat a doc_id follow each other, ordered by their texts'
hash; an empty table gives no blocks and an empty result; further columns are
ignored.  Null doc_ids are written as the smallest 64-bit integer and read back
as null.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.llm import range_coder, tokens
from affinity.session import checkpoint_root, with_package

END_ID = 2
BLOCK_IDS = 524_288
BLOCKS_AT_ONCE = 8
NO_ID = -(1 << 63)

BLOCK_SCHEMA = pa.schema([("shard", pa.int32()), ("number", pa.int32()), ("first", pa.int64()),
                          ("n_ids", pa.int64()), ("block", pa.binary())])
BLOCK_DDL = "shard int, number int, first long, n_ids long, block binary"
DOC_SCHEMA = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("first", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
DOC_DDL = "doc_id long, shard int, first long, n_tokens long, ids_crc32 long"


def encoded_blocks(docs: DataFrame, path: str, end_id: int = END_ID,
                   block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of the sorted documents, one row each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush(docs_of_blocks):
            nonlocal number, first
            blobs = range_coder.pack_blocks(docs_of_blocks)
            sizes = np.array([len(d[2]) for d in docs_of_blocks], np.int64)
            n = len(blobs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard), pa.int32()), pa.array(np.arange(number, number + n), pa.int32()),
                 pa.array(first + tokens.starts_of(sizes)), pa.array(sizes), pa.array(blobs, pa.binary())],
                schema=BLOCK_SCHEMA)
            number, first = number + n, first + int(sizes.sum())

        doc_ids, counts, ids, pending = [], [], [], 0
        for b in tokens.small_batches(batches):
            flat, size = tokens.with_end(*tokens.encode(b.column(1), path), end_id)
            own = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            # a block ends after the document that reaches block_ids
            upto = pending + np.cumsum(size)
            at = done = 0
            while at < len(size):
                stop = min(int(np.searchsorted(upto, block_ids)) + 1, len(size))
                hi = done + int(size[at:stop].sum())
                doc_ids.append(own[at:stop])
                counts.append(size[at:stop])
                ids.append(flat[done:hi])
                if upto[stop - 1] >= block_ids:
                    held.append((np.concatenate(doc_ids), np.concatenate(counts), np.concatenate(ids)))
                    doc_ids, counts, ids = [], [], []
                    upto = upto - upto[stop - 1]
                at, done = stop, hi
            pending = int(upto[-1]) if len(upto) else pending
            while len(held) >= BLOCKS_AT_ONCE:
                yield from flush(held[:BLOCKS_AT_ONCE])
                held = held[BLOCKS_AT_ONCE:]
        if doc_ids:
            held.append((np.concatenate(doc_ids), np.concatenate(counts), np.concatenate(ids)))
        if held:
            yield from flush(held)

    ordered = (docs.select(F.col("doc_id").cast("long"), "text")
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text")))
    return with_package(ordered).select("doc_id", "text").mapInArrow(build, BLOCK_DDL)


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
              block_ids: int = BLOCK_IDS) -> None:
    """Write the documents' ids to ``folder``, which must not exist."""
    (encoded_blocks(docs, path or tokens.vocabulary(), end_id, block_ids)
     .write.option("compression", "none").parquet(folder))


def _decoded(batches: Iterator[pa.RecordBatch]):
    """(shard, first, doc_ids, counts, ids) of every block."""
    for b in batches:
        for i in range(0, b.num_rows, BLOCKS_AT_ONCE):
            part = b.slice(i, BLOCKS_AT_ONCE)
            shard, first, blob = (part.column(k).to_pylist() for k in range(3))
            for s, f, (doc_ids, counts, ids) in zip(shard, first, range_coder.unpack_blocks(blob)):
                yield s, f, doc_ids, counts, ids


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in ``folder``,
    from the decoded ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, first, doc_ids, counts, ids in _decoded(batches):
            starts = tokens.starts_of(counts)
            raw = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(starts.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array(np.full(len(crc), shard), pa.int32()),
                 pa.array(first + starts), pa.array(counts), pa.array(crc, pa.int64())], schema=DOC_SCHEMA)

    blocks = spark.read.schema(BLOCK_DDL).parquet(folder)
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    return (with_package(blocks).select("shard", "first", "block").mapInArrow(digest, DOC_DDL).join(shards, "shard")
            .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))


def round_trip(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids to the shared checkpoint folder and read them back."""
    spark = docs.sparkSession
    folder = (f"{checkpoint_root(spark)}/affinity-{spark.sparkContext.applicationId}/"
              f"ids-{uuid.uuid4().hex}")
    write_ids(docs, folder, path, end_id)
    return read_documents(spark, folder)
