"""Token ids of whole Arrow text columns, through the tokenizers library.

A text's ids are the ids of its words in order, since white space never
joins into a token.  So each batch is split into words, every distinct word is
cut at plain punctuation, and only distinct pieces go to the library.
Pieces of plain lower-case letters are one word each to the tokenizer and go to
its model without its rules.  Words with a letter that the tokenizer takes apart
(into a letter and a mark, which it joins to punctuation) aren't cut.  All other
pieces, and whole texts that may hold special tokens, are encoded by its rules.
Tests compare the result with encoding each text as a whole.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_PIECES = 1_500_000
#: Punctuation that no rule of the tokenizer joins to a letter (so no apostrophe).
PUNCTUATION = r"[.,:;!?|*$%&#=()\[\]{}<>]"
AFTER_WORD = rf"([\p{{L}}\p{{N}}])({PUNCTUATION})"
BEFORE_WORD = rf"({PUNCTUATION})([\p{{L}}\p{{N}}])"
PLAIN_LETTERS = "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
PLAIN = f"^[a-z{PLAIN_LETTERS}]+$"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer, and what its rules make of the plain letters beyond ASCII."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    return tok, str.maketrans({c: tok.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in PLAIN_LETTERS})


@lru_cache(maxsize=1 << 16)
def _taken_apart(path: str, letter: str) -> bool:
    tok, _ = load(path)
    return len(tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(letter))) > 1


def _cut_at_punctuation(words: pa.Array, path: str) -> pa.Array:
    """The words with a blank on both sides of punctuation that stands by itself."""
    marked = pc.match_substring_regex(words, PUNCTUATION)
    apart = pc.replace_with_mask(words, marked, pc.replace_substring_regex(pc.replace_substring_regex(
        words.filter(marked), AFTER_WORD, r"\1 \2"), BEFORE_WORD, r"\1 \2"))
    wide = words.filter(pc.match_substring_regex(words, r"[^\x00-\x{FF}]"))
    odd = [c for c in set("".join(wide.to_pylist())) if c > "\xff" and c.isalnum() and _taken_apart(path, c)]
    if not odd:
        return apart
    return pc.if_else(pc.match_substring_regex(words, "[" + "".join(odd) + "]"), words, apart)


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i]:starts[i] + lengths[i]] of every i, joined."""
    total = int(lengths.sum())
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64  # half the memory
    shift = (starts - (np.cumsum(lengths) - lengths)).astype(kind)
    at = np.repeat(shift, lengths)
    at += np.arange(total, dtype=kind)
    return values[at]


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _one_by_one(tok, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    found = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    return (np.array([i for ids in found for i in ids], np.uint32),
            np.array([len(ids) for ids in found], np.int64))


class _Seen:
    """Pieces that this Python worker has encoded, up to ``CACHED_PIECES``."""

    def __init__(self):
        self.pieces = pa.array([], pa.large_string())
        self.ids, self.size = np.empty(0, np.uint32), np.empty(0, np.int32)

    def add(self, pieces: pa.Array, path: str) -> None:
        ids, size = _encode_pieces(pieces, path)
        self.pieces = pa.concat_arrays([self.pieces, pieces.cast(pa.large_string())])
        self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size.astype(np.int32)])


@lru_cache(maxsize=4)
def _seen(path: str) -> list[_Seen]:
    return [_Seen()]


def forget() -> None:
    """Give back what this Python worker keeps of the pieces that it has encoded;
    it may go on to other work."""
    _seen.cache_clear()
    pa.default_memory_pool().release_unused()


def _encode_cached(pieces: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``_encode_pieces``; pieces met in an earlier batch aren't encoded again."""
    holder = _seen(path)
    at = pc.index_in(pieces, holder[0].pieces)
    new = pc.is_null(at).to_numpy(zero_copy_only=False)
    if len(holder[0].pieces) + np.count_nonzero(new) > CACHED_PIECES:
        holder[0], new = _Seen(), np.ones(len(pieces), bool)
    seen = holder[0]
    at = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at[new] = len(seen.pieces) + np.arange(np.count_nonzero(new))
    seen.add(pieces.filter(pa.array(new)), path)
    size = seen.size[at].astype(np.int64)
    return ragged(seen.ids, starts_of(seen.size.astype(np.int64))[at], size), size


def _encode_pieces(pieces: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    tok, letters = load(path)
    plain = pc.match_substring_regex(pieces, PLAIN).to_numpy(zero_copy_only=False)
    rest = np.flatnonzero(~plain)
    got, size = _one_by_one(tok, pieces.take(pa.array(rest)).to_pylist())
    tokenize, found, counts = tok.model.tokenize, [], []
    for w in pieces.filter(pa.array(plain)).to_pylist():
        word = tokenize(w if w.isascii() else w.translate(letters))
        counts.append(len(word))
        found += [t.id for t in word]  # tokens are objects: none is kept
    flat = np.array(found, np.uint32)
    lengths = np.zeros(len(plain), np.int64)
    lengths[plain] = counts
    lengths[rest] = size
    starts = np.zeros(len(plain), np.int64)
    starts[plain] = starts_of(lengths[plain])
    starts[rest] = len(flat) + starts_of(size)
    return ragged(np.concatenate([flat, got]), starts, lengths), lengths


def _split(texts: pa.Array, splitter) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets of each text's parts, the parts as codes, and the distinct parts."""
    parts = splitter(texts)
    coded = parts.flatten().dictionary_encode()
    offsets = parts.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.indices.to_numpy().astype(np.int64), coded.dictionary


def whole(texts: pa.Array) -> pa.Array:
    """The texts in buffers of their own, null as empty.  Arrow's functions
    that split text go wrong on slices of an array (seen in version 23)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.offset:
        texts = texts.take(pa.array(np.arange(len(texts))))
    return pc.fill_null(texts.cast(pa.large_string()), "")


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids in order, and the number of ids of each text (null: none)."""
    texts = whole(texts)
    special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
    simple = pc.if_else(pa.array(special), pa.scalar("", pa.large_string()), texts) if special.any() else texts
    in_text, words, distinct = _split(simple, lambda a: pc.ascii_split_whitespace(pc.ascii_lower(a)))
    in_word, pieces, distinct = _split(_cut_at_punctuation(distinct, path), lambda a: pc.split_pattern(a, " "))
    ids, size = _encode_cached(distinct, path)
    word_ids, word_size = ragged(ids, starts_of(size)[pieces], size[pieces]), _sums(size[pieces], in_word)
    out = ragged(word_ids, starts_of(word_size)[words], word_size[words])
    lengths = _sums(word_size[words], in_text)
    if special.any():
        apart, apart_size = _one_by_one(load(path)[0], texts.filter(pa.array(special)).to_pylist())
        starts = starts_of(lengths)
        starts[special] = len(out) + starts_of(apart_size)
        lengths = lengths.copy()
        lengths[special] = apart_size
        out = ragged(np.concatenate([out, apart]), starts, lengths)
    return out, lengths


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``end`` after the ids of each text."""
    return np.insert(ids, np.cumsum(lengths), end).astype(np.uint32), lengths + 1


def small_batches(batches, most: int = 12 << 20):
    """Record batches cut to about ``most`` bytes of rows, so that memory
    doesn't depend on how Spark sizes them.  One row is never cut."""
    for b in batches:
        step = max(1, int(b.num_rows * most / max(b.nbytes, 1)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)
