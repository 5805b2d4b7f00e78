"""Quality rules by distribution divergence, in DataFrame expressions only.

For each language the whole corpus gives two references: the histogram of
character classes, and that of its ``COMMON`` most frequent words (lower-cased)
with one bin for all others.  A document's own histograms are compared with those of
its language by Jensen-Shannon distance (base 2, so 0 to 1).  Texts under
``MIN_WORDS`` words have too few words for that and aren't judged by it.

Base rules, counted beside: fewer than 50 words, or more than half of the words
inside repeated 3-word windows.

Repeated windows are found inside the row: windows are hashed, and only rows in
which hashes repeat sort them, so the cost is n log n in the length of a text and no
row is ever gathered with others.

Texts are read twice: to count words, and to count all that is counted per
document.  The counts are written, and the character references are sums over
them.  References are one row per language; they are written out, so Spark sees
their size and broadcasts them only while they are small.

Defined results: a null text counts as none; a null lang is a language of its
own; a language whose references are empty judges nothing; ties among frequent
words go to the word first in code-point order; repeated rows get equal results;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import SPACE, SPACE_CHARS, let, text_or_empty
from affinity.session import materialize

MIN_BASE_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"

COMMON = 20
#: Up to so many distinct repeated windows are looked up one by one.
FEW_REPEATS = 32
MIN_WORDS = 100
MAX_CHAR_DISTANCE = 0.24
MAX_WORD_DISTANCE = 0.32

#: Character classes by what is removed from what the ones before left.
CLASSES = ("[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()\-]+", r"\p{L}+")


def words_of(text: Column) -> Column:
    """The words of a text in order, none for a text of white space."""
    inner = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(inner) == 0, F.array().cast("array<string>")).otherwise(F.split(inner, SPACE))


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs more than once.
    ``words`` must be bound (a column or lambda variable)."""

    def words_in(at: Column) -> Column:
        # a window adds three words, less those that the one before covers
        return F.aggregate(F.transform(at, lambda i, k: F.when(k == 0, 3).otherwise(
            F.least(F.lit(3), i - F.get(at, k - 1)))), F.lit(0), lambda total, n: total + n)

    def sorted_out(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])),
            lambda x: x["i"])))

    def covered(hashes: Column) -> Column:
        twice = let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda x, k: F.get(s, k - 1) == x)))
        return let(twice, lambda few: let(F.when(F.size(few) > FEW_REPEATS, sorted_out(hashes)).otherwise(F.filter(
            F.transform(hashes, lambda h, i: F.when(F.array_contains(few, h), i)), lambda i: i.isNotNull())), words_in))

    def hashed(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.size(w) - 2),
                           lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    return F.when(F.size(words) < 3, 0).otherwise(let(hashed(words), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACE_CHARS))) > 0),
               lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def without_classes(text: Column) -> list[Column]:
    """The text, and what is left of it after each class is taken out."""
    left = [text]
    for pattern in CLASSES:
        left.append(F.regexp_replace(left[-1], pattern, ""))
    return left


def class_counts(text: Column) -> list[Column]:
    """Characters of each class, and of none."""
    left = without_classes(text)
    return [*[F.length(a) - F.length(b) for a, b in zip(left, left[1:])], F.length(left[-1])]


def common_words(docs: DataFrame) -> DataFrame:
    """(lang_key, r_words, r_counts) per language: the most frequent words; stored."""
    words = (docs.select(F.coalesce("lang", F.lit("")).alias("lang_key"),
                         F.explode(words_of(F.lower(text_or_empty()))).alias("word"))
             .groupBy("lang_key", "word").agg(F.count(F.lit(1)).alias("n")))
    # one row per language and distinct word by here
    rank = F.row_number().over(Window.partitionBy("lang_key").orderBy(F.desc("n"), "word"))
    top = (words.withColumn("rank", rank).filter(F.col("rank") <= COMMON).groupBy("lang_key")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "word", F.col("n").cast("double").alias("n")))).alias("top")))
    return materialize(top.select("lang_key", F.col("top")["word"].alias("r_words"), F.col("top")["n"].alias("r_counts")), "common-words")


def counted(docs: DataFrame) -> DataFrame:
    """Per document its base counts, the counts of character classes (``chars``) and
    of its language's common words (``common``), and ``r_counts``; stored."""
    text = F.col("text")
    rows = (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang_key"), text_or_empty().alias("text"))
            .join(common_words(docs), "lang_key", "left"))

    def found(w: Column) -> Column:
        return F.transform(F.coalesce("r_words", F.array().cast("array<string>")),
                           lambda one: (F.size(w) - F.size(F.array_remove(w, one))).cast("double"))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    # symbols and white space are read off what the classes leave, not searched for again
    classes = class_counts(text)
    return materialize(rows.select(
        "doc_id", "lang_key", let(words_of(text), of_words).alias("w"), let(words_of(F.lower(text)), found).alias("common"),
        duplicate_lines(text).alias("n_dup_lines"), (F.length(text) - classes[1]).cast("long").alias("word_chars"),
        F.regexp_count(without_classes(text)[-1], F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.array(*[c.cast("double") for c in classes]).alias("chars"),
        F.coalesce("r_counts", F.array().cast("array<double>")).alias("r_counts")).select(
            "doc_id", "lang_key", "w.*", "common", "n_dup_lines", "word_chars", "n_symbols", "chars", "r_counts"), "rule-counts")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts; null if one is empty."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    return let(F.struct(total(p).alias("p"), total(q).alias("q")), lambda t: F.when((t["p"] > 0) & (t["q"] > 0), F.sqrt(F.greatest(
        F.lit(0.0), F.aggregate(F.zip_with(p, q, lambda x, y: let(F.struct((x / t["p"]).alias("x"), (y / t["q"]).alias("y")), lambda s: (
            term(s["x"], (s["x"] + s["y"]) / 2) + term(s["y"], (s["x"] + s["y"]) / 2)) / 2)),
            F.lit(0.0), lambda s, x: s + x)))))


def judged(docs: DataFrame) -> DataFrame:
    """Per document the base counts, char_distance, word_distance, base_failed
    and kept."""
    rows = counted(docs)
    sums = [F.sum(F.col("chars")[k]) for k in range(len(CLASSES) + 1)]
    refs = materialize(rows.groupBy("lang_key").agg(F.array(*sums).alias("r_chars"), F.sum("n_words").cast("double").alias("r_all")), "references")
    rows = rows.join(refs, "lang_key")

    def with_rest(a: Column, every: Column) -> Column:
        return F.concat(a, F.array(F.greatest(F.lit(0.0), every - F.aggregate(a, F.lit(0.0), lambda s, x: s + x))))

    failed = (F.col("n_words") < MIN_BASE_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    odd = ((F.col("n_words") >= MIN_WORDS)
           & ((F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE)
              | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)))
    return (rows.withColumns({
        "char_distance": distance(F.col("chars"), F.col("r_chars")),
        "word_distance": F.when(F.size("r_counts") > 0, distance(
            with_rest(F.col("common"), F.col("n_words").cast("double")), with_rest(F.col("r_counts"), F.col("r_all")))),
        "base_failed": failed})
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "char_distance",
                "word_distance", "base_failed", (~F.col("base_failed") & ~odd).alias("kept")))


def rules_digest(docs: DataFrame) -> DataFrame:
    return judged(docs.select("doc_id", "lang", "text")).drop("char_distance", "word_distance")
