"""Language of words, spans and documents, for texts that mix languages.

The script of a word (Unicode ranges of its letters) narrows the candidates to
the languages that were seen in that script.  Each candidate scores a word by
the log-probability of its character trigrams.  Viterbi then labels all words of
a text: every word pays its score, every change of language a penalty, so a
few odd words don't break a span but a quoted passage does.  The document's
language is the label of most letters, and its score is their share.

The model holds trigram and script counts per language, of a fixed size
(``BUCKETS`` plus scripts), summed on Spark over a bounded sample: about
``fit_documents`` documents of each language, chosen by hash.

Defined results: a null text, and one without letters, is ``und`` with score 0;
documents of null lang don't train; with nothing to learn from everything is
``und``; ties go to the language first in code-point order; repeated rows get
equal results; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import tokens
from affinity.llm.common import held_out
from affinity.session import with_package

FIT_DOCUMENTS = 3_000
#: Languages that a model knows at most: the most frequent ones.
MOST_LANGUAGES = 200
BUCKETS = 1 << 15
#: In nats; a word alone must be that much clearer to be another language.
SWITCH_PENALTY = 12.0
#: Smallest share of a language's letters that makes a script one of its own.
SCRIPT_SHARE = 0.002
SMOOTHING = 0.5

#: First code point of each range and the script that begins there.
SCRIPT_RANGES = (
    (0x0000, "none"), (0x0041, "latin"), (0x005B, "none"), (0x0061, "latin"), (0x007B, "none"), (0x00C0, "latin"),
    (0x02B0, "none"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x2C00, "other"), (0x3000, "none"), (0x3041, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "none"), (0xF900, "han"),
    (0xFB00, "other"), (0xFE00, "none"), (0xFF66, "kana"), (0xFFA0, "none"), (0x20000, "han"))
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES} - {"none"})
_STARTS = np.array([start for start, _ in SCRIPT_RANGES])
_SCRIPT = np.array([SCRIPTS.index(name) if name != "none" else len(SCRIPTS) for _, name in SCRIPT_RANGES])
NO_SCRIPT = len(SCRIPTS)


@dataclass(frozen=True)
class Words:
    """Distinct words of a batch and where they occur."""

    counts: np.ndarray   # words of each text
    codes: np.ndarray    # distinct word of each occurrence
    letters: np.ndarray  # code points of each distinct word, 0 for words without a letter
    script: np.ndarray   # script of most letters, NO_SCRIPT without letters
    grams: np.ndarray    # buckets of all trigrams of all distinct words ...
    n_grams: np.ndarray  # ... and how many each word has


def words_of(texts: pa.Array) -> Words:
    parts = pc.ascii_split_whitespace(pc.utf8_lower(tokens.whole(texts)))
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    letters = pc.match_substring_regex(coded.dictionary, r"\p{L}").to_numpy(zero_copy_only=False)
    words = coded.dictionary.to_pylist()
    length = pc.utf8_length(coded.dictionary).to_numpy().astype(np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    script = _SCRIPT[np.searchsorted(_STARTS, points, "right") - 1]
    word = np.repeat(np.arange(len(words)), length)
    table = np.bincount(word * (NO_SCRIPT + 1) + script, minlength=len(words) * (NO_SCRIPT + 1)).reshape(-1, NO_SCRIPT + 1)
    best = table[:, :NO_SCRIPT].argmax(1) if len(words) else np.empty(0, np.int64)
    best = np.where(table[:, :NO_SCRIPT].sum(1) > 0, best, NO_SCRIPT)
    # trigrams of the word between two blanks
    padded = np.full(len(points) + 2 * len(words), 32, np.int64)
    starts = tokens.starts_of(length + 2)
    padded[np.arange(len(points)) + np.repeat(starts + 1 - tokens.starts_of(length), length)] = points
    first = np.arange(int(length.sum())) + np.repeat(starts - tokens.starts_of(length), length)
    a, b, c = padded[first], padded[first + 1], padded[np.minimum(first + 2, max(len(padded) - 1, 0))]
    grams = ((a * 0x1F123BB5 + b * 0x9E3779B1 + c * 0x85EBCA77) >> 7) & (BUCKETS - 1)
    return Words(np.diff(offsets), coded.indices.to_numpy().astype(np.int64), np.where(letters, length, 0), best, grams, length)


def counted(sample: DataFrame) -> DataFrame:
    """(lang, bucket, n): trigrams, then letters of each script from BUCKETS on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in tokens.small_batches(batches):
            for lang in pc.unique(b.column(0)).to_pylist():
                w = words_of(b.column(1).filter(pc.equal(b.column(0), lang)))
                times = np.bincount(w.codes, minlength=len(w.letters)) * (w.letters > 0)
                total = totals.setdefault(lang, np.zeros(BUCKETS + NO_SCRIPT + 1))
                total[:BUCKETS] += np.bincount(w.grams, np.repeat(times, w.n_grams), BUCKETS)
                total[BUCKETS:] += np.bincount(w.script, times * w.letters, NO_SCRIPT + 1)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at].astype(np.int64))],
                                             names=["lang", "bucket", "n"])

    return (with_package(sample).select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


@dataclass(frozen=True)
class Model:
    langs: list[str]
    scores: np.ndarray   # log-probability (BUCKETS, languages)
    allowed: np.ndarray  # (scripts and none, languages)

    def word_scores(self, w: Words) -> np.ndarray:
        """(distinct words, languages): sums of trigram scores, far lower for
        languages outside the word's script, 0 for words without a letter."""
        out = np.zeros((len(w.letters), len(self.langs)))
        some = np.flatnonzero(w.n_grams)
        if len(some):
            out[some] = np.add.reduceat(self.scores[w.grams], tokens.starts_of(w.n_grams)[some], axis=0)
        out -= np.where(self.allowed[w.script], 0.0, 1e4)
        out[w.letters == 0] = 0.0
        return out - out.max(1, initial=-np.inf, keepdims=True) if len(out) else out

    def labels(self, w: Words) -> np.ndarray:
        """The language (number) of every word of every text: the best path."""
        scores = self.word_scores(w)
        order = np.argsort(-w.counts, kind="stable")
        start, count = tokens.starts_of(w.counts)[order], w.counts[order]
        k = len(self.langs)
        state = np.zeros((len(order), k))
        came = np.empty((len(w.codes), k), np.int16)
        steps = int(count[0]) if len(count) else 0
        busy = len(count) - np.searchsorted(count[::-1], np.arange(1, steps + 1))
        own = np.arange(k)
        for t in range(steps):
            n = busy[t]
            now, at = state[:n], start[:n] + t
            best = now.argmax(1)
            change = now[np.arange(n), best][:, None] - SWITCH_PENALTY
            moved = change > now
            came[at] = np.where(moved, best[:, None], own)
            state[:n] = np.where(moved, change, now) + scores[w.codes[at]]
        out = np.empty(len(w.codes), np.int16)
        here = state.argmax(1)
        for t in range(steps - 1, -1, -1):
            n = busy[t]
            at = start[:n] + t
            out[at] = here[:n]
            here[:n] = came[at, here[:n]]
        return out


def fit(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Model:
    """A model from the documents that aren't held out and have a lang, of the
    MOST_LANGUAGES most frequent ones."""
    usable = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & ~F.coalesce(held_out(), F.lit(False)))
    known = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    sizes = {r["lang"]: r["n"] for r in known.toArrow().to_pylist()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.empty((BUCKETS, 0)), np.empty((NO_SCRIPT + 1, 0), bool))
    place = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30))
    chance = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, fit_documents / sizes[lang]) * (1 << 30))])
    found = counted(usable.filter(place < chance[F.col("lang")])).toArrow()
    table = np.zeros((BUCKETS + NO_SCRIPT + 1, len(langs)))
    column = pc.index_in(found["lang"], pa.array(langs)).to_numpy()
    table[found["bucket"].to_numpy(), column] = found["n"].to_numpy()
    grams, scripts = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script of no known language rules none out
    allowed[NO_SCRIPT] = True
    return Model(langs, np.log(grams / grams.sum(0)), allowed)


RESULT_DDL = "doc_id long, held_out boolean, lang_pred string, score double, spans string"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) per document; spans lists
    ``lang:first word:last word`` of each stretch in one language."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.langs, "und"], object)
        k = len(model.langs)
        for b in tokens.small_batches(batches):
            w = words_of(b.column(2))
            n = len(w.counts)
            text = np.repeat(np.arange(n), w.counts)
            letters = w.letters[w.codes]
            real = letters > 0
            got = model.labels(w) if k else np.zeros(len(text), np.int16)
            share = np.bincount(text * max(k, 1) + got, letters, n * max(k, 1)).reshape(n, max(k, 1))
            total = share.sum(1)
            known = (total > 0) & (k > 0)
            best = np.where(known, share.argmax(1), k)
            score = np.where(known, share.max(1) / np.maximum(total, 1), 0.0)
            place = np.arange(len(text)) - np.repeat(tokens.starts_of(w.counts), w.counts)
            at, label_, spot = text[real], got[real], place[real]
            cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (label_[1:] != label_[:-1])]) if len(at) else np.empty(0, np.int64)
            last = np.r_[cut[1:], len(at)] - 1 if len(cut) else cut
            stretches: list[list[str]] = [[] for _ in range(n)]
            for t, lang, lo, hi in zip(at[cut].tolist(), names[label_[cut]] if k else [], spot[cut].tolist(), spot[last].tolist()):
                stretches[t].append(f"{lang}:{lo}:{hi}")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names[best], pa.string()), pa.array(score),
                 pa.array([",".join(s) for s in stretches])], names=["doc_id", "held_out", "lang_pred", "score", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return with_package(rows).mapInArrow(label, RESULT_DDL)
