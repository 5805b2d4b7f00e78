"""String expressions: category keys, shingles and title similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: ASCII punctuation removed from category spellings
# (the 32 characters !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~ as four code-point ranges)
PUNCTUATION_CLASS = "[!-/:-@\\[-`{-~]"
# fixed values: spellings that mean "no category"
UNKNOWN_SPELLINGS = ("", "(no genres listed)")
UNKNOWN_KEY = "unknown"


def stem_word(w: Column) -> Column:
    """Light English suffix stripping of one lower-case word (a stand-in for a
    per-row stemming library).  Words of length <= 3 are kept.

    Rules, applied in order: sses -> ss; ies -> i; a final s not after s or u
    is dropped; final y -> i; a final e after three letters is dropped.
    (science -> scienc, comedies / comedy -> comedi, thrillers -> thriller)
    """
    s = F.regexp_replace(w, "sses$", "ss")
    s = F.regexp_replace(s, "ies$", "i")
    s = F.regexp_replace(s, "([^su])s$", "$1")
    s = F.regexp_replace(s, "y$", "i")
    s = F.regexp_replace(s, "([a-z]{3})e$", "$1")
    return F.when(F.length(w) > 3, s).otherwise(w)


def category_key(c: Column) -> Column:
    """Grouping key of a category spelling: trim, lower, strip ASCII
    punctuation, split on whitespace, stem each word, join with one space.
    Null, blank and '(no genres listed)' map to 'unknown'."""
    t = F.trim(c)
    cleaned = F.regexp_replace(F.lower(t), PUNCTUATION_CLASS, "")
    words = F.split(F.trim(F.regexp_replace(cleaned, "\\s+", " ")), " ")
    key = F.array_join(F.transform(words, stem_word), " ")
    return F.when(c.isNull() | t.isin(*UNKNOWN_SPELLINGS), F.lit(UNKNOWN_KEY)).otherwise(key)


def words_of(text: Column) -> Column:
    """Lower-cased text split on one space (empty words kept)."""
    return F.split(F.lower(text), " ")


def shingles(words: Column, n: int = 3) -> Column:
    """array of n-word shingles of a word array (empty when fewer than n
    words).  ``words`` must be a column reference (see ``words_of``), so the
    split is done once per text and not once per shingle."""
    starts = F.sequence(F.lit(0), F.size(words) - n)
    arr = F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " "))
    return F.when(F.size(words) >= n, arr).otherwise(F.array().cast("array<string>"))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once per row: an expression named inside a
    lambda is evaluated anew for every element, a bound lambda variable isn't."""
    return F.transform(F.array(value), body)[0]


def title_similarity(a: Column, b: Column) -> Column:
    """1 - levenshtein(lower a, lower b) / longer length, in [0, 1]."""
    la, lb = F.lower(a), F.lower(b)
    longest = F.greatest(F.length(la), F.length(lb))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        1.0 - F.levenshtein(la, lb) / longest)
