"""Line dedup: lines that many documents share are dropped.

Lines are exploded and normalised, hashed to 128 bits, and the distinct
documents of each hash are counted.  A line whose key has ``min_chars`` code
points or more and is in ``min_docs`` documents or more is dropped everywhere
but in the largest doc_id that holds it.  The dropped positions come back to
each document, which is put together again by position.  The exploded rows
carry hashes, never text; only the last join moves texts, once.

A hot line may be in a third of all documents: counting pre-aggregates map
side, and the join back to the line positions is salted.

Defined results: a null or empty text is one empty line; lines inside the
document that is kept stay, repeats too; a null doc_id is no document for the
count and is never the one that keeps; a document that loses all lines gets an
empty text; rows that repeat a doc_id count as one document, each keeps its own
text (exactly equal rows give equal results); an empty table gives an empty
result; further columns are ignored by ``dropped_lines`` and kept as they are
by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import SPACE_CHARS, ascii_lower, let, salted, spread, text_or_empty

MIN_CHARS = 20
MIN_DOCS = 3
SALTS = 16


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_hashes(docs: DataFrame, min_chars: int, salts: int) -> DataFrame:
    """(doc_id, _rid, pos, h1, h2, _salt) of every line long enough."""
    key = ascii_lower(F.trim(F.col("line"), F.lit(SPACE_CHARS)))
    return (docs.select("doc_id", "text", spread(salts).alias("_salt"))
            .select("doc_id", F.xxhash64("text").alias("_rid"), "_salt",
                        F.posexplode(lines_of(text_or_empty())).alias("pos", "line"))
            .filter(F.length("line") >= min_chars)
            .select("doc_id", "_rid", "_salt", "pos", key.alias("key"))
            .filter(F.length("key") >= min_chars)
            .select("doc_id", "_rid", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit(1), "key").alias("h2"), "_salt"))


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, keep_id) of the lines that are in too many documents."""
    return (_line_hashes(docs, min_chars, 1).groupBy("h1", "h2")
            .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keep_id"))
            .filter(F.col("n_docs") >= min_docs))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  salts: int = SALTS) -> DataFrame:
    """(doc_id, _rid, drop): the positions each text loses; _rid is the text's hash."""
    shared = salted(shared_lines(docs, min_chars, min_docs).select("h1", "h2", "keep_id"), salts)
    return (_line_hashes(docs, min_chars, salts).join(shared, ["h1", "h2", "_salt"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .groupBy("doc_id", "_rid").agg(F.collect_set("pos").alias("drop")))


def _with_drops(docs: DataFrame, min_chars: int, min_docs: int, salts: int) -> tuple[DataFrame, Column, Column]:
    """``docs`` joined with their dropped positions; these, and the kept text."""
    drops = dropped_lines(docs, min_chars, min_docs, salts).withColumnsRenamed(
        {"doc_id": "_drop_id", "_rid": "_drop_rid", "drop": "_drop"})
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops["_drop_id"])
                       & (F.xxhash64(docs["text"]) == drops["_drop_rid"]), "left")
    text, drop = F.coalesce(docs["text"], F.lit("")), drops["_drop"]
    rest = let(lines_of(text), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop), lambda i: F.get(lines, i)), "\n"))
    return joined, drop, F.when(drop.isNull(), text).otherwise(rest)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                salts: int = SALTS) -> DataFrame:
    """``docs`` with the kept texts; a column n_chars is counted anew."""
    joined, _, kept = _with_drops(docs, min_chars, min_docs, salts)
    new = {"text": kept, "n_chars": F.length(kept).cast(dict(docs.dtypes).get("n_chars", "long"))}
    return joined.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])


def line_dedup_digest(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      salts: int = SALTS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per document."""
    docs = docs.select("doc_id", "text")
    joined, drop, kept = _with_drops(docs, min_chars, min_docs, salts)
    return joined.select(
        docs["doc_id"], F.size(lines_of(F.coalesce(docs["text"], F.lit("")))).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"))
