"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time.

``build_index`` cuts the documents into blocks of about ``BLOCK_BYTES`` of text.
A block is one row: its documents with their lengths, and for each of its terms
the documents that hold it, in order, with the occurrences.  Beside each list
stand its length, its most occurrences and its shortest document, which bound
any score in it before the list is read.  The index is a written table; corpus
statistics (documents, terms, documents per query term) are sums over it.

A query meets every block.  There, its short lists are summed term at a time
into accumulators (``SHORT_SHARE`` of the block's documents at most).  These then
act as one more list, with a bound of its own, beside the long ones, and all go
document at a time over windows of ``WINDOW`` documents.  A window, or a whole
block, is skipped if its bounds don't reach the score of the query's ``top``-th
document so far.  Inside a window the lists of the largest bounds name the
candidates; the others are only looked up for candidates that can still get
there.  The best of a query are kept from block to block of a task, and Spark
ranks what the tasks found.  Equal scores are never skipped, so results are
exact.

Queries are dealt into groups of about ``GROUP`` items; each block meets each
group.  The groups are a written table, so that Spark broadcasts them only as
long as their measured size allows.  A task keeps the best of ``HELD`` items at
most and hands on those of the least recent groups before more come.

Defined results: null texts and texts without a term hold nothing and count
nowhere; documents without a positive score aren't listed; a null doc_id is
listed after all others of equal score; rows that repeat a doc_id are ranked
each for itself; rows that repeat an item_id are one item with all their terms,
a null item_id being one as well; items without terms list nothing; empty tables
give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm import tokens
from affinity.llm.common import ascii_lower
from affinity.session import arrow_batches, materialize, with_package

#: Fixed value: one term (ASCII letters and digits, and all beyond ASCII).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same on bytes: what isn't in a term becomes a blank, A-Z become a-z.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() and chr(c).islower() or chr(c).isdigit()
              else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

TOP = 50
BLOCK_BYTES = 4 << 20
#: Bytes of a record batch of texts or of blocks, and blocks that a writer or reader
#: of the index holds at a time: a task's memory is that of a few blocks, however many it has.
BATCH_BYTES = 8 << 20
INDEX_FILES = {"parquet.block.row.count.limit": "2", "parquet.page.size.row.check.min": "1"}
GROUP = 256
HELD = 4096
WINDOW = 1024
#: Lists are short as long as together they have so many postings a document.
SHORT_SHARE = 0.25

INDEX_DDL = ("n_docs long, n_terms long, doc_ids binary, no_id binary, lengths binary, terms array<string>, "
             "dfs array<int>, most binary, least binary, docs binary, tfs binary")


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many terms each text has, and all terms in turn, dictionary-encoded."""
    texts = tokens.whole(texts)
    _, offsets, data = texts.buffers()
    folded = (data.to_pybytes() if data else b"").translate(_FOLD)
    plain = pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(folded))
    parts = pc.ascii_split_whitespace(plain)
    words, cuts = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(words), 0)
    counts = tokens._sums(real.to_numpy(zero_copy_only=False).astype(np.int64), cuts - cuts[0])
    return counts, words.filter(real).dictionary_encode()


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The blocks of the index, one row each; stored."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tokens.small_batches(batches, block_bytes):
            counts, words = terms_of(b.column(1))
            held = np.flatnonzero(counts)
            if not len(held):
                continue
            place = np.repeat(np.arange(len(held)), counts[held])
            key, tf = np.unique(words.indices.to_numpy().astype(np.int64) << 32 | place, return_counts=True)
            doc = (key & 0xFFFFFFFF).astype(np.uint32)
            df = np.bincount(key >> 32, minlength=len(words.dictionary))
            starts = tokens.starts_of(df)
            ids = b.column(0).take(pa.array(held))
            lengths = counts[held].astype(np.int64)
            row = {"n_docs": len(held), "n_terms": int(lengths.sum()),
                   "doc_ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                   "no_id": ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                   "lengths": lengths.astype("<i8").tobytes(), "terms": words.dictionary.to_pylist(), "dfs": df.tolist(),
                   "most": np.maximum.reduceat(tf, starts).astype("<i8").tobytes(),
                   "least": np.minimum.reduceat(lengths[doc], starts).astype("<i8").tobytes(),
                   "docs": doc.astype("<u4").tobytes(), "tfs": tf.astype("<u4").tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", pa.binary()), ("no_id", pa.binary()),
                        ("lengths", pa.binary()), ("terms", pa.list_(pa.string())), ("dfs", pa.list_(pa.int32())),
                        ("most", pa.binary()), ("least", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary())])
    rows = with_package(docs).select(F.col("doc_id").cast("long"), "text")
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return materialize(rows.mapInArrow(build, INDEX_DDL), "postings", **INDEX_FILES)


def weighed_items(items: DataFrame, index: DataFrame) -> DataFrame:
    """(query_group, item_id, terms, weights, n_docs, n_terms) per item; stored."""
    asked = items.select(F.col("item_id").cast("long"), F.explode(F.array_distinct(
        F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))).alias("term")).distinct()
    totals = index.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms"))
    listed = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select("x.*")
    wanted = asked.select(F.col("term").alias("terms")).distinct()
    found = listed.join(wanted, "terms", "left_semi").groupBy(F.col("terms").alias("term")).agg(F.sum("dfs").alias("df"))
    # one row of totals, read as literals
    n_docs, n_terms = totals.select("n_docs").scalar(), totals.select("n_terms").scalar()
    weight = F.floor(1000 * F.ln((2 * F.col("n_docs") + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    groups = F.greatest(F.lit(1), F.ceil(items.agg(F.count(F.lit(1))).scalar() / GROUP))
    rows = (asked.join(found, "term").withColumns({"n_docs": n_docs, "n_terms": n_terms})
            .withColumn("w", weight.cast("long")).groupBy("item_id")
            .agg(F.collect_list("term").alias("terms"), F.collect_list("w").alias("weights"),
                 F.first("n_docs").alias("n_docs"), F.first("n_terms").alias("n_terms")))
    return materialize(rows.withColumn("query_group", F.pmod(F.xxhash64("item_id"), groups)), "queries")


class _Block:
    """A block's lists, read when a query needs them."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids, self.lengths = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
        self.no_id = np.frombuffer(row["no_id"], bool)
        self.norm = 20 * self.norms(self.lengths, n_docs, n_terms)
        self.cuts = np.concatenate([[0], np.cumsum(row["dfs"])])
        self.docs, self.tfs = np.frombuffer(row["docs"], "<u4"), np.frombuffer(row["tfs"], "<u4")
        most = np.frombuffer(row["most"], "<i8")
        self.bounds = 1_000_000_000 * most // (1000 * most + 20 * self.norms(np.frombuffer(row["least"], "<i8"), n_docs, n_terms))
        self.edges = np.arange(0, len(self.ids), WINDOW)
        self.read: dict[int, tuple] = {}

    @staticmethod
    def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
        return 100 - 50 + 50 * lengths * n_docs // n_terms

    def postings(self, t: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Documents, scores, where each window begins, and its best score."""
        if t not in self.read:
            part = slice(self.cuts[t], self.cuts[t + 1])
            docs, tf = self.docs[part], self.tfs[part].astype(np.int64)
            self.read[t] = self.windowed(docs, w * (1_000_000_000 * tf // (1000 * tf + self.norm[docs])))
        return self.read[t]

    def windowed(self, docs: np.ndarray, scores: np.ndarray):
        begins = np.searchsorted(docs, np.append(self.edges, len(self.ids)))
        best = np.zeros(len(self.edges), np.int64)
        some = np.flatnonzero(np.diff(begins))
        if len(some):
            best[some] = np.maximum.reduceat(scores, begins[some])
        return docs, scores, begins, best


class _Best:
    """The best documents of one item so far."""

    def __init__(self, top: int):
        self.top, self.least = top, 1
        self.scores, self.ids, self.no_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        scores, ids, no_id = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -scores))[:self.top]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]
        if len(order) == self.top:
            self.least = int(self.scores[-1])


def search_block(block: _Block, terms: list[int], weights: list[int], best: _Best) -> None:
    """Enter the block's documents of one query into ``best``; ``terms`` are
    places of lists in the block."""
    lists = sorted((int(block.cuts[t + 1] - block.cuts[t]), t, w) for t, w in zip(terms, weights) if w > 0)
    if sum(w * int(block.bounds[t]) for _, t, w in lists) < best.least:
        return
    # term at a time: short lists become one, of sums
    room, short = SHORT_SHARE * len(block.ids), 0
    while short < len(lists) and lists[short][0] <= room:
        room -= lists[short][0]
        short += 1
    iterators = [block.postings(t, w) for _, t, w in lists[short:]]
    if short == 1:
        iterators.append(block.postings(*lists[0][1:]))
    elif short:
        read = [block.postings(t, w) for _, t, w in lists[:short]]
        docs, at = np.unique(np.concatenate([r[0] for r in read]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, at, np.concatenate([r[1] for r in read]))
        iterators.append(block.windowed(docs, sums))
    # document at a time, window by window
    bounds = np.stack([i[3] for i in iterators])
    total = bounds.sum(0)
    for k in range(len(total)):
        if total[k] < best.least:
            continue
        order = np.argsort(-bounds[:, k], kind="stable")
        rest = int(total[k])
        first = block.edges[k]
        scores = np.zeros(WINDOW, np.int64)
        used = 0
        # documents in none of the lists read so far have ``rest`` at most
        while used < len(order) and rest >= best.least and bounds[order[used], k]:
            docs, values, begins, _ = iterators[order[used]]
            part = slice(begins[k], begins[k + 1])
            scores[docs[part] - first] += values[part]
            rest -= int(bounds[order[used], k])
            used += 1
        found = np.flatnonzero(scores + rest >= best.least)
        found = found[scores[found] > 0]
        got = scores[found]
        for i in order[used:]:
            if not bounds[i, k] or not len(found):
                break
            docs, values, begins, _ = iterators[i]
            part = slice(begins[k], begins[k + 1])
            here = docs[part]
            at = np.minimum(np.searchsorted(here, found + first), len(here) - 1)
            got = got + np.where(here[at] == found + first, values[part][at], 0)
            rest -= int(bounds[i, k])
            able = got + rest >= best.least
            found, got = found[able], got[able]
        able = got >= best.least
        if able.any():
            docs = found[able] + first
            best.add(got[able], block.ids[docs], block.no_id[docs])


def found_in_tasks(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents of each item; stored."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int | None, _Best] = {}

        def hand_on(keys: list) -> pa.RecordBatch:
            done = [held.pop(k) for k in keys]
            sizes = [len(d.ids) for d in done]
            owner = pa.array(keys, pa.int64()).take(pa.array(np.repeat(np.arange(len(keys)), sizes)))
            ids, no_id, scores = (np.concatenate([getattr(d, n) for d in done]) for n in ("ids", "no_id", "scores"))
            return pa.RecordBatch.from_arrays([owner, pa.array(ids, pa.int64(), mask=no_id), pa.array(scores)],
                                              names=["item_id", "doc_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                items = row.column("items")[0].as_py()
                wanted = pa.array([t for item in items for t in item["terms"]], pa.string())
                place = pc.index_in(wanted, row.column("terms").flatten()).fill_null(-1).to_pylist()
                block = _Block({n: row.column(n)[0].as_py() for n in (
                    "doc_ids", "no_id", "lengths", "most", "least", "docs", "tfs")}
                    | {"dfs": row.column("dfs").flatten().to_numpy()}, items[0]["n_docs"], items[0]["n_terms"])
                at = 0
                for item in items:
                    own = place[at:at + len(item["terms"])]
                    at += len(item["terms"])
                    known = [(t, w) for t, w in zip(own, item["weights"]) if t >= 0]
                    if known:
                        best = held.pop(item["item_id"], None) or _Best(top)
                        search_block(block, [t for t, _ in known], [w for _, w in known], best)
                        held[item["item_id"]] = best  # the latest stands last
                if len(held) > HELD:
                    yield hand_on(list(held)[:len(held) - HELD // 2])
        if held:
            yield hand_on(list(held))

    groups = queries.groupBy("query_group").agg(F.collect_list(
        F.struct("item_id", "terms", "weights", "n_docs", "n_terms")).alias("items"))
    known = queries.agg(F.collect_set("query_group")).scalar()
    rows = (with_package(index).drop("n_docs", "n_terms").withColumn("query_group", F.explode(known))
            .join(groups, "query_group").drop("query_group"))
    with arrow_batches(index.sparkSession, BATCH_BYTES):
        return materialize(rows.mapInArrow(search, "item_id long, doc_id long, score long"), "found")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item."""
    index = build_index(docs)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found_in_tasks(index, weighed_items(items, index), top)
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
