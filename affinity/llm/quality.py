"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each text is described by ``STATISTICS`` (lengths, shares of character classes,
repetition of words, word pairs and lines).  Standardised, they pass through
random Fourier features, which approximate a Gaussian kernel.  Each partition
sums its part of the normal equations, the parts are added by rows, and the
ridge solution of that ``FEATURES`` by ``FEATURES`` system gives raw scores.
Isotonic regression on rows kept out of the fit turns them into probabilities.

Only two things come to the driver, both of a fixed size: the summed equations
and the calibration scores, at most ``fit_rows`` rows.  ``fit_rows`` bounds the
labelled rows used, chosen by hash; every document is scored.

Defined results: a null text counts as empty and is scored like any text;
labels that are null, not 0 or 1, or of no document are ignored; a doc_id with
conflicting labels takes their majority, and a tie counts as 1; without labels
of both kinds every score is the share of label 1 (0.5 if there is none at all);
repeated rows get equal scores; an empty table gives an empty result; further
columns are ignored by the scores and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm import tokens
from affinity.llm.common import held_out
from affinity.session import materialize, with_package

FIT_ROWS = 20_000
FEATURES = 256
RIDGE = 1e-2
SEED = 11
#: One in so many sampled rows calibrates instead of fitting.
CALIBRATE = 4
#: Text that is described at once.
BATCH_BYTES = 2 << 20

CLASSES = {"lower": "abcdefghijklmnopqrstuvwxyz", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789",
           "space": " \t\r\x0b\x0c", "line": "\n", "stop": ".,;:", "mark": "!?", "bar": "|", "symbol": "#*$%&<>@^~_=+\\/",
           "other": "'\"()[]{}-`"}
STATISTICS = ("log_bytes", "log_words", *CLASSES, "high", "word_bytes", "short_words", "distinct_words",
              "distinct_pairs", "distinct_lines", "line_bytes")
_TABLE = np.full(256, len(CLASSES) + 1, np.uint8)
_TABLE[128:] = len(CLASSES)
for _k, _chars in enumerate(CLASSES.values()):
    _TABLE[[ord(c) for c in _chars]] = _k


def _distinct(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many distinct codes each text has."""
    text = np.repeat(np.arange(len(counts)), counts)
    both = np.sort((text.astype(np.int64) << 40) | codes)
    first = both[np.flatnonzero(np.r_[True, both[1:] != both[:-1]])] >> 40 if len(both) else both
    return np.bincount(first, minlength=len(counts))


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    texts = tokens.whole(texts)
    n_bytes = pc.binary_length(texts).to_numpy().astype(np.int64)
    some, begins = np.flatnonzero(n_bytes), tokens.starts_of(n_bytes)
    _, offsets, data = texts.buffers()
    first = np.frombuffer(offsets, np.int64)[0] if len(texts) else 0
    flat = _TABLE[np.frombuffer(data, np.uint8)[first:first + n_bytes.sum()]] if len(some) else np.empty(0, np.uint8)
    size = np.maximum(n_bytes, 1)
    shares = []
    for k in range(len(CLASSES) + 1):
        found = np.zeros(len(size), np.int64)
        if len(some):
            found[some] = np.add.reduceat(flat == k, begins[some], dtype=np.int32)
        shares.append(found / size)

    def parts(split: pa.Array):
        values, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        real = pc.greater(pc.binary_length(values), 0)
        counts = tokens._sums(real.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0])
        coded = values.filter(real).dictionary_encode()
        return counts, coded.indices.to_numpy().astype(np.int64), coded.dictionary

    words, codes, distinct = parts(pc.ascii_split_whitespace(texts))
    length = pc.binary_length(distinct).to_numpy().astype(np.int64)[codes]
    bounds = np.concatenate([[0], np.cumsum(words)])
    many = np.maximum(words, 1)
    pairs = np.maximum(words - 1, 0)
    inside = np.ones(max(len(codes) - 1, 0), bool)
    inside[bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(codes))] - 1] = False
    mixed = ((codes[:-1] * 1_000_003 + codes[1:]) & ((1 << 40) - 1))[inside] if len(codes) else codes
    lines, line_codes, _ = parts(pc.split_pattern(texts, "\n"))
    some_lines = np.maximum(lines, 1)
    columns = [np.log1p(n_bytes), np.log1p(words), *shares, tokens._sums(length, bounds) / many,
               tokens._sums((length <= 3).astype(np.int64), bounds) / many, _distinct(codes, words) / many,
               _distinct(mixed, pairs) / np.maximum(pairs, 1), _distinct(line_codes, lines) / some_lines,
               np.log1p(n_bytes / some_lines)]
    return np.stack(columns, 1)


@dataclass(frozen=True)
class Model:
    """What scores a row of statistics; ``prior`` alone if nothing was fitted."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    raw: np.ndarray | None = None         # calibration: raw scores ...
    calibrated: np.ndarray | None = None  # ... and their probabilities

    def features(self, stats: np.ndarray) -> np.ndarray:
        return fourier((stats - self.mean) / self.scale)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.prior)
        return np.interp(self.features(stats) @ self.weights, self.raw, self.calibrated)


def fourier(x: np.ndarray) -> np.ndarray:
    """sqrt(2 / D) cos(x W + b), with a constant; the kernel's width is the
    square root of the number of statistics."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], FEATURES - 1))
    shift = rng.uniform(0, 2 * np.pi, FEATURES - 1)
    z = np.cos(np.clip(x, -8, 8) @ w + shift) * np.sqrt(2 / FEATURES)
    return np.concatenate([z, np.ones((len(x), 1))], 1)


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function nearest to the labels, by pooling
    adjacent violators; between steps it is interpolated."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, lowest and highest raw score
    for r, y in zip(raw[order].tolist(), label[order].tolist()):
        blocks.append([y, 1, r, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y2, n2, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y2, blocks[-1][1] + n2, blocks[-1][2], high]
    knots = np.array([(r, y / n) for y, n, low, high in blocks for r in (low, high)])
    return knots[:, 0], knots[:, 1]


def training_rows(docs: DataFrame, marks: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(label, part, stats) of at most ``fit_rows`` labelled documents that
    aren't held out; part is 0 for calibration rows."""
    chosen = (marks.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    # at most fit_rows rows of 12 bytes: safe to broadcast
    # a doc_id that repeats is one row, with the least of its texts; repeats are dropped map side
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(
        F.min("text").alias("text")).select(
        "label", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(CALIBRATE)).alias("part"), "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.small_batches(batches, BATCH_BYTES):
            stats = statistics(b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(stats), pa.list_(pa.float64()))], names=["label", "part", "stats"])

    return materialize(with_package(rows).mapInArrow(describe, "label int, part long, stats array<double>"), "fit")


def fit(docs: DataFrame, marks: DataFrame, fit_rows: int = FIT_ROWS, ridge: float = RIDGE) -> Model:
    """The classifier of ``marks`` (doc_id, quality) on the texts of ``docs``."""
    rows = training_rows(docs, marks, fit_rows)
    spots = [F.col("stats")[k] for k in range(len(STATISTICS))]
    summary = rows.agg(F.count(F.lit(1)), F.avg("label"), F.array(*map(F.avg, spots)), F.array(*map(F.stddev_pop, spots))).first()
    n, share = summary[0], summary[1]
    if not n or share in (0.0, 1.0):
        return Model(0.5 if not n else float(share))
    scale = np.array(summary[3])
    base = Model(float(share), np.array(summary[2]), np.where(scale > 1e-9, scale, 1.0))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, FEATURES + 1))
        for b in batches:
            z = base.features(np.array(b.column(1).to_pylist()))
            y = b.column(0).to_numpy().astype(float)
            total += np.concatenate([z.T @ z, (z.T @ y)[:, None]], 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"][:1], "row": [np.sum(np.stack(pdf["row"].tolist()), axis=0)]})

    def raw_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = base.features(np.array(b.column(1).to_pylist()).reshape(-1, len(STATISTICS))) @ weights
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw)], names=["label", "raw"])

    parts = (with_package(rows).filter("part <> 0").select("label", "stats").mapInArrow(equations, "i long, row array<double>")
             .groupBy("i").applyInPandas(add, "i long, row array<double>"))
    system = np.array([r["row"] for r in sorted(parts.toArrow().to_pylist(), key=lambda r: r["i"])])
    if not system.size:
        return Model(float(share))
    count = system[-1, -2]  # the constant feature counts the rows
    weights = np.linalg.solve(system[:, :-1] + ridge * max(count, 1) / FEATURES * np.eye(FEATURES), system[:, -1])
    scored = rows.filter("part = 0").select("label", "stats").mapInArrow(raw_scores, "label int, raw double").toArrow()
    if not scored.num_rows:
        return Model(float(share))
    raw, calibrated = isotonic(scored["raw"].to_numpy(), scored["label"].to_numpy().astype(float))
    return Model(base.prior, base.mean, base.scale, weights, raw, calibrated)


def quality(text: str | Column, model: Model) -> Column:
    """The score of each text, 0 to 1."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        done = [model.score(statistics(b.column(0)))
                for b in tokens.small_batches([pa.RecordBatch.from_arrays([texts], names=["text"])], BATCH_BYTES)]
        return pa.array(np.concatenate(done) if done else np.empty(0))

    return score(text)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    scored = with_package(docs).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                                       quality("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    return with_package(docs).filter(quality("text", fit(docs, marks)) >= 0.5)
