"""Hash helpers: element ids for string sets, the MinHash family, hash sampling."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import MERSENNE_P


def element_hash(c: Column) -> Column:
    """The first 60 bits of a string's md5 as bigint, stable across engines and
    runs.  It is the identity of an element in exact sets; hash functions
    reduce it modulo p themselves."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")


def hash_family(k: int, seed: int = 42) -> list[tuple[int, int]]:
    """k coefficient pairs (a, b) of h(x) = (a*x + b) mod p, p = 2^31 - 1.

    a is drawn from [1, p-1] (a = p would make every hash constant) and b from
    [0, p-1].  Prefixes of a longer family are the shorter families, so one
    family of max(k) serves every k.
    """
    rng = random.Random(seed)
    out = []
    for _ in range(k):
        a = rng.randint(1, MERSENNE_P - 1)
        b = rng.randint(0, MERSENNE_P - 1)
        out.append((a, b))
    return out


def hash_sample_predicate(c: Column, fraction: float, seed: int = 42) -> Column:
    """Deterministic Bernoulli-like sample on an integer id.

    Keeps ids whose universal hash falls below fraction * p.  The same ids are
    kept on every run, every partitioning and every engine (unlike
    ``DataFrame.sample`` on a re-computed input).
    """
    a, b = hash_family(1, seed)[0]
    # reduced first, so ids of any size neither overflow nor raise
    x = F.pmod(c.cast("bigint"), F.lit(MERSENNE_P))
    h = F.pmod(x * F.lit(a) + F.lit(b), F.lit(MERSENNE_P))
    return h < F.lit(int(fraction * MERSENNE_P))
