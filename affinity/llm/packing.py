"""Best-fit packing of token sequences under several capacities at once.

Vector best-fit: a piece is a vector of tokens, one document, and attention
cost (its length squared); a sequence has a residual capacity in each.  Pieces
come in falling order of tokens, and each goes to the sequence that can hold
it in every dimension and that scores best: the smallest weighted norm of the
residual that would be left (``rule="norm"``) or the largest weighted
dot-product of demand and residual (``rule="dot"``).  If none can, a new
sequence opens.

Spark splits the work: pieces are cut where the texts are, and hashed into
groups of about ``group_pieces``, each packed by itself with sequence numbers
of its own.  The bound keeps a group's memory fixed at any input size; a group
wastes at most about one sequence, so its size sets the loss (one sequence in
thousands).  The row's place in its partition is hashed too, so a document
that repeats a million times spreads over all groups.

Defined results: a null text is an empty one, and is the piece of just the end
id; pieces longer than ``capacity`` don't exist, as only longer documents are
cut; repeated rows are packed each for itself; a null doc_id is packed like any
other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import tokens
from affinity.session import materialize, with_package

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 8192
#: Text that is encoded at once: as a stage, this shares an executor with a full heap.
BATCH_BYTES = 6 << 20
#: Sequences of one group are numbered below this.
SPAN = 1 << 32

PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                          ("length", pa.int64()), ("ids_crc32", pa.int64()), ("row", pa.int64())])
PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PACKED_DDL = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              "sequence_id long, offset long")


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row): each document's ids with
    the end id, cut at ``capacity``; row is the piece's place in its partition."""
    path = path or tokens.vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        try:
            for b in tokens.small_batches(batches, BATCH_BYTES):
                ids, size = tokens.with_end(*tokens.encode(b.column(1), path), end_id)
                count = -(-size // capacity)
                doc = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(doc)) - np.repeat(tokens.starts_of(count), count)
                start = piece * capacity
                length = np.minimum(size[doc] - start, capacity)
                lo = tokens.starts_of(size)[doc] + start
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(lo.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64()),
                     pa.array(np.arange(row, row + len(doc)))], schema=PIECE_SCHEMA)
                row += len(doc)
        finally:
            tokens.forget()  # else workers hold it through all later stages

    return with_package(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_DDL)


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: float, rule: str = "norm",
             weights: tuple[float, float, float] = (1.0, 0.05, 0.05)) -> np.ndarray:
    """The sequence of each piece; pieces must come in falling order of length."""
    limits = np.array([capacity, max_docs, max_cost], float)
    w = np.array(weights)
    demand = np.stack([lengths, np.ones(len(lengths)), np.square(lengths, dtype=float)], 1) / limits
    if (demand > 1).any():
        raise ValueError("a piece is larger than an empty sequence")
    chosen = np.empty(len(lengths), np.int64)
    left = np.empty((max(len(lengths), 1), 3))  # residuals of the open sequences
    number = np.empty(len(left), np.int64)
    n_open = n_all = 0
    smallest = lengths[-1] / capacity if len(lengths) else 0
    slack = 1e-12
    for i, need in enumerate(demand):
        best = -1
        if n_open:
            rest = left[:n_open] - need
            fits = np.flatnonzero(rest.min(axis=1) >= -slack)
            if len(fits):
                score = np.square(rest[fits]) @ w if rule == "norm" else -(left[fits] * need) @ w
                best = fits[score.argmin()]
        if best < 0:
            best, n_open = n_open, n_open + 1
            left[best], number[best] = 1.0, n_all
            n_all += 1
        chosen[i] = number[best]
        left[best] -= need
        if left[best, 0] < smallest - slack or left[best].min() <= slack:  # nothing fits any more
            n_open -= 1
            left[best], number[best] = left[n_open], number[n_open]
    return chosen


def pack(pieces: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None,
         max_cost: float | None = None, rule: str = "norm",
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``token_pieces`` with sequence_id and offset.

    ``max_docs`` and ``max_cost`` default to what a full sequence of one-token
    documents, and of one document, would have, and then never bind.  A piece
    that is over ``max_cost`` by itself has a sequence of its own.
    """
    max_docs, max_cost = max_docs or capacity, max_cost or float(capacity) ** 2

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True],
                              kind="stable")
        size = pdf["length"].to_numpy()
        full = int(((size == capacity) | (size.astype(float) ** 2 > max_cost)).sum())  # these have a sequence each
        bins = np.concatenate([np.arange(full), full + best_fit(size[full:], capacity, max_docs, max_cost, rule)])
        pdf["sequence_id"] = pdf["_group"].to_numpy() * SPAN + bins
        by_bin = np.argsort(bins, kind="stable")
        size, bins = size[by_bin], bins[by_bin]
        before = tokens.starts_of(size)
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        offset = np.empty(len(size), np.int64)
        offset[by_bin] = before - np.repeat(before[first], np.diff(np.r_[first, len(bins)]))
        pdf["offset"] = offset
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    stored = materialize(pieces, "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    group = F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups))
    return stored.withColumn("_group", group).groupBy("_group").applyInPandas(fill, PACKED_DDL)


def pack_documents(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(token_pieces(docs, path), **options)
