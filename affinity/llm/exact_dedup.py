"""Exact dedup with counting quotient filters.

Each partition builds a counting quotient filter over the 64-bit fingerprints
of its texts: the high bits (quotient) select a run, the low bits (remainder)
are kept sorted inside the run, and a counter follows each remainder that
occurs more than once.  A filter holds every fingerprint bit, so it counts
without error.  It is cut into shards by quotient; the shards of all
partitions merge losslessly, as sorted remainders of equal quotients meet and
their counters add.  Fingerprints counted once belong to unique texts and need
no further work.  All others go to byte verification, which groups whole
normalised texts, so a fingerprint collision can never merge two texts.

A group of copies may hold a third of all rows: verification aggregates map
side first and splits each fingerprint over ``salts`` partitions.

Defined results: a null text counts as empty; empty texts are copies of each
other; texts equal up to the case of A-Z are copies; the largest doc_id of a
group stays; rows that repeat a doc_id all get that doc_id's verdict and each
counts in ``group_size``; a null doc_id never wins against a number, and a
group without any doc_id keeps its rows; an empty table gives an empty result.
Columns besides ``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import ascii_lower, salted, spread, text_or_empty
from affinity.session import with_package

REMAINDER_BITS = 40
QUOTIENT_BITS = 64 - REMAINDER_BITS
REMAINDER_MASK = np.uint64((1 << REMAINDER_BITS) - 1)
SALTS = 16
#: Rows a shard at most; one task merges a shard's filters.
SHARD_ROWS = 4_000_000

FILTER_SCHEMA = ("shard int, quotients binary, runs binary, remainders binary, "
                 "counted binary, counters binary")


def count_sorted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in order with the sum of their counts.  The
    stable sort merges runs that are sorted already."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def filter_row(keys: np.ndarray, counts: np.ndarray) -> dict[str, bytes]:
    """A filter over sorted distinct fingerprints: the occupied quotients, the
    length of each run, the remainders in slot order (5 bytes each), and the
    slots that have a counter with those counters."""
    quotients, runs = np.unique(keys >> np.uint64(REMAINDER_BITS), return_counts=True)
    slots = (keys & REMAINDER_MASK).astype("<u8").view(np.uint8).reshape(-1, 8)
    counted = np.flatnonzero(counts > 1)
    return {"quotients": quotients.astype("<u4").tobytes(), "runs": runs.astype("<u4").tobytes(),
            "remainders": np.ascontiguousarray(slots[:, :REMAINDER_BITS // 8]).tobytes(),
            "counted": counted.astype("<u4").tobytes(),
            "counters": counts[counted].astype("<u8").tobytes()}


def filter_keys(quotients: bytes, runs: bytes, remainders: bytes, counted: bytes,
                counters: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints and counts that ``filter_row`` was given."""
    slots = np.zeros((len(remainders) * 8 // REMAINDER_BITS, 8), np.uint8)
    slots[:, :REMAINDER_BITS // 8] = np.frombuffer(remainders, np.uint8).reshape(len(slots), -1)
    high = np.repeat(np.frombuffer(quotients, "<u4").astype(np.uint64), np.frombuffer(runs, "<u4"))
    counts = np.ones(len(slots), np.int64)
    counts[np.frombuffer(counted, "<u4")] = np.frombuffer(counters, "<u8").astype(np.int64)
    return high << np.uint64(REMAINDER_BITS) | slots.view("<u8").ravel(), counts


def partition_filters(fingerprints: DataFrame, shards: int) -> DataFrame:
    """One filter row per partition and shard of its quotients."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
        if not parts:
            return
        all_keys = np.concatenate(parts)
        keys, counts = count_sorted(all_keys, np.ones(len(all_keys), np.int64))
        shard = (keys >> np.uint64(REMAINDER_BITS)) * np.uint64(shards) >> np.uint64(QUOTIENT_BITS)
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(keys) else []
        rows = [{"shard": int(shard[lo])} | filter_row(keys[lo:hi], counts[lo:hi])
                for lo, hi in zip(starts, [*starts[1:], len(keys)])]
        for i in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[i:i + 256], schema=schema)

    schema = pa.schema([("shard", pa.int32())] + [(n, pa.binary()) for n in
                       ("quotients", "runs", "remainders", "counted", "counters")])
    return with_package(fingerprints.select("fp")).mapInArrow(build, FILTER_SCHEMA)


def merged_counts(filters: DataFrame) -> DataFrame:
    """(fp, n) of the fingerprints that occur more than once anywhere."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [filter_keys(*row) for row in pdf[["quotients", "runs", "remainders", "counted",
                                                   "counters"]].itertuples(index=False)]
        keys, counts = count_sorted(*(np.concatenate(x) for x in zip(*parts)))
        many = counts > 1
        return pd.DataFrame({"fp": keys[many].view(np.int64), "n": counts[many]})

    return filters.groupBy("shard").applyInPandas(merge, "fp long, n long")


def dedup_exact(docs: DataFrame, salts: int = SALTS, shards: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per input row."""
    shards = shards or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.count() // SHARD_ROWS)
    rows = (docs.select("doc_id", ascii_lower(text_or_empty()).alias("norm"))
            .select("doc_id", "norm", F.xxhash64("norm").alias("fp"),
                    spread(salts).alias("_salt")))
    repeated = salted(merged_counts(partition_filters(rows, shards)).select("fp"), salts)
    classes = (rows.join(repeated, ["fp", "_salt"], "left_semi")
               .groupBy("fp", "_salt", "norm").agg(F.max("doc_id").alias("keep_id"),
                                                   F.count(F.lit(1)).alias("group_size"))
               .groupBy("fp", "norm").agg(F.max("keep_id").alias("keep_id"),
                                          F.sum("group_size").alias("group_size"))
               .select("fp", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size"))
    slim = rows.select("doc_id", "fp", "_salt", F.sha2("norm", 256).alias("text_sha256"))
    out = slim.join(salted(classes, salts), ["fp", "_salt", "text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
