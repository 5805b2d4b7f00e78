"""MinHash signatures and their accuracy against exact Jaccard.

Sets move once, as arrays of at most about ``CHUNK`` elements, and are signed
inside their rows; no row per (element, hash) is ever made.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_family
from ..params import MERSENNE_P
from .pairs import DEFAULT_BLOCK, pairs_within_groups

#: positional code of a signature value: h * 2^31 + v (v < 2^31), so that two
#: signatures agree at position h exactly when they share the code; a
#: signature array is the k codes sorted (= ordered by h).
CODE_SHIFT = 1 << 31

#: elements of a set that are signed in one row
CHUNK = 16384

#: numbers that numpy hashes at once (bounds task memory, and stays in the cache)
STEP = 32768

#: Positions of a signature whose bits share a number.
WORD = 60


def signatures_long(members: DataFrame, k: int = 200, seed: int = 42,
                    family: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(entity, h, v): v = min over the set of (a_h * x + b_h) mod p.

    A set is gathered into one row, a set of more than ``CHUNK`` elements into
    one row per cell of about so many; rows are signed by numpy, and only the
    signatures of cells are merged by a shuffle.
    """
    fam = list(family) if family is not None else hash_family(k, seed)
    rows = members.select("entity", F.col("element").cast("bigint").alias("element"))
    large = (rows.groupBy(F.col("entity").alias("_e")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CHUNK)
             .select("_e", F.ceil(F.col("_n") / CHUNK).alias("_cells")))
    cell = F.pmod(F.xxhash64("element"), F.col("_cells"))
    arrays = (rows.join(large, F.col("entity").eqNullSafe(F.col("_e")), "left")
              .groupBy("entity", cell.alias("cell")).agg(F.collect_list("element").alias("elements")))
    codes = _minhash_codes(fam)
    # a set of nulls only has a signature of nulls
    nothing = F.array_repeat(F.lit(None).cast("bigint"), len(fam))
    parts = arrays.select("entity", "cell", F.coalesce(codes("elements"), nothing).alias("sig"))
    whole, cells = (signatures_to_long(parts.filter(f)) for f in ("cell IS NULL", "cell IS NOT NULL"))
    return whole.unionByName(cells.groupBy("entity", "h").agg(F.min("v").alias("v")))


def minima_of(fam: Sequence[tuple[int, int]]):
    """A function: the k least hash values of an array of elements.

    (a * x + b) mod p is read off the fraction of (a * x + b) / p, in units of 2^-64,
    that a product and a sum leave when they wrap.  The constants are rounded down and b's
    is moved up by 2^31 + 2, so a fraction is too large by at most that, and never
    wraps; values are 2^33 apart, so the least fraction is that of the least value.
    """
    import numpy as np

    p = MERSENNE_P
    scale = np.array([(x << 64) // p for x, _ in fam], dtype=np.uint64)[:, None]
    shift = np.array([(y << 64) // p + (1 << 31) + 2 for _, y in fam], dtype=np.uint64)[:, None]
    kk, low = len(fam), np.uint64((1 << 32) - 1)

    def least(elements):
        x = np.mod(np.asarray(elements, dtype=np.int64), p).astype(np.uint64)
        best = np.full(kk, np.iinfo(np.uint64).max, dtype=np.uint64)
        # a piece of the table of fractions stays in the cache
        step = max(64, min(len(x), STEP // 16))
        rows = max(1, STEP // step)
        piece = np.empty((min(rows, kk), step), dtype=np.uint64)
        for r in range(0, kk, rows):
            a, b = scale[r:r + rows], shift[r:r + rows]
            for start in range(0, len(x), step):
                chunk = x[start:start + step]
                u = piece[:len(a), :len(chunk)]
                np.multiply(a, chunk, out=u)
                np.add(u, b, out=u)
                np.minimum(best[r:r + rows], u.min(axis=1), out=best[r:r + rows])
        # the whole part of best * p / 2^64
        return ((best >> np.uint64(32)) * np.uint64(p) + ((best & low) * np.uint64(p) >> np.uint64(32))) >> np.uint64(32)

    return least


def _minhash_codes(fam: Sequence[tuple[int, int]]):
    """A pandas UDF: the codes of the signature of an array of elements, null if it is empty."""
    import numpy as np
    import pandas as pd
    from pyspark.sql import types as T

    offsets = np.arange(len(fam), dtype=np.int64) * CODE_SHIFT
    least = minima_of(fam)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def minhash_codes(sets: pd.Series) -> pd.Series:
        return pd.Series([None if arr is None or len(arr) == 0 else offsets + least(arr).astype(np.int64) for arr in sets], dtype=object)

    return minhash_codes


def signatures_from_arrays(df: DataFrame, entity: str, elements: str, k: int = 200,
                           seed: int = 42,
                           family: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """(entity, sig) for sets held inside one row (a document's shingle ids).

    The set never leaves its row: an Arrow-batched pandas UDF hashes the
    elements with numpy (k x chunk matrix, min over the chunk), so there is
    no shuffle and no per-element row.  Empty sets get no signature and are
    dropped.  Same values and codes as ``signatures_long`` +
    ``signature_arrays``.
    """
    fam = list(family) if family is not None else hash_family(k, seed)
    minhash_codes = _minhash_codes(fam)
    # a condition on the signature would have it made once more
    return df.filter(F.size(elements) > 0).select(F.col(entity).alias("entity"), minhash_codes(F.col(elements)).alias("sig"))


def signatures_to_long(sigs: DataFrame) -> DataFrame:
    """(entity, h, v) from positional-code arrays."""
    return (sigs.select("entity", F.posexplode("sig").alias("h", "code"))
            .select("entity", "h", (F.col("code") - F.col("h").cast("bigint") * F.lit(CODE_SHIFT)).alias("v")))


def signature_arrays(sig_long: DataFrame) -> DataFrame:
    """(entity, sig): the k positional codes of a signature, sorted by h
    (k values per entity, so the array is bounded)."""
    code = F.col("h").cast("bigint") * F.lit(CODE_SHIFT) + F.col("v")
    return sig_long.groupBy("entity").agg(F.array_sort(F.collect_list(code)).alias("sig"))


def matches(s1: Column, s2: Column, k) -> Column:
    """Number of positions among the first k where two signatures agree."""
    kk = k if isinstance(k, Column) else F.lit(int(k))
    return F.size(F.array_intersect(F.slice(s1, 1, kk), F.slice(s2, 1, kk)))


def with_signatures(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    a = sigs.select(F.col("entity").alias("id1"), F.col("sig").alias("sig1"))
    b = sigs.select(F.col("entity").alias("id2"), F.col("sig").alias("sig2"))
    return pairs.join(a, "id1").join(b, "id2")


def minima(sigs: DataFrame, family: Sequence[tuple[int, int]]) -> DataFrame:
    """(entity, x, w0, w1, ...): the elements (mod p) that a signature's values come
    from, with a bit for each position, ``WORD`` to a word.

    A hash is a bijection on [0, p), so a value tells its element.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    kk = len(family)
    words = -(-kk // WORD)
    inverse = np.array([pow(x, -1, MERSENNE_P) for x, _ in family], dtype=np.uint64)
    shift = np.array([y for _, y in family], dtype=np.uint64)
    p = np.uint64(MERSENNE_P)

    def split(batches):
        for batch in batches:
            sig = batch.column(1)
            n = np.asarray(pc.fill_null(pc.list_value_length(sig), 0), dtype=np.int64)
            code = np.asarray(sig.flatten(), dtype=np.int64)
            row, h = np.repeat(np.arange(len(n)), n), code // CODE_SHIFT
            row, h, code = row[h < kk], h[h < kk], code[h < kk]
            x = ((code % CODE_SHIFT).astype(np.uint64) + p - shift[h]) % p * inverse[h] % p
            key = (row.astype(np.uint64) << np.uint64(31)) | x
            order = np.argsort(key)
            key, h = key[order], h[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
            bits = [np.add.reduceat(np.where(h // WORD == w, np.int64(1) << (h % WORD), 0), first) if len(first)
                    else np.zeros(0, dtype=np.int64) for w in range(words)]
            key = key[first]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array((key >> np.uint64(31)).astype(np.int64))),
                 pa.array((key & p).astype(np.int64)), *[pa.array(b) for b in bits]],
                names=["entity", "x", *[f"w{w}" for w in range(words)]])

    kind = sigs.schema["entity"].dataType.simpleString()
    return sigs.select("entity", "sig").mapInArrow(
        split, f"entity {kind}, x long, " + ", ".join(f"w{w} long" for w in range(words)))


def shared_minima(sigs: DataFrame, k_values: Sequence[int], family: Sequence[tuple[int, int]],
                  block: int = DEFAULT_BLOCK) -> DataFrame:
    """(id1, id2, m0, m1, ...): in how many of the first k positions two signatures
    agree, for each k, of all pairs that agree anywhere.

    Pairs meet at the elements that their equal values come from and bring bits
    of positions there, not signatures.
    """
    words = [f"w{w}" for w in range(-(-len(family) // WORD))]
    held = minima(sigs, family).select("x", F.struct("entity", *words).alias("m"))
    met = pairs_within_groups(held, ["x"], "m", block)

    def agree(k: int) -> Column:
        masks = [(1 << max(0, min(WORD, k - WORD * w))) - 1 for w in range(len(words))]
        return sum((F.bit_count(F.col(f"id1.{w}").bitwiseAND(F.col(f"id2.{w}")).bitwiseAND(F.lit(mask).cast("long")))
                    for w, mask in zip(words, masks) if mask), F.lit(0))

    names = [f"m{i}" for i in range(len(k_values))]
    counts = met.select(F.col("id1.entity").alias("id1"), F.col("id2.entity").alias("id2"),
                        *[agree(int(k)).cast("int").alias(m) for k, m in zip(k_values, names)])
    return counts.repartition("id1", "id2").groupBy("id1", "id2").agg(*[F.sum(m).cast("int").alias(m) for m in names])


def estimate_pairs(pairs: DataFrame, sigs: DataFrame, k: int,
                   family: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """pairs + ``estimate`` = matching signature positions among the first k / k.

    Without ``family`` both signatures are joined to each pair, which is for few
    pairs (candidates).  For as many pairs as overlap at all give the hash
    ``family``: agreement is then counted by ``shared_minima``.
    """
    if family is not None:
        found = shared_minima(sigs, [k], family)
        return (pairs.join(found, ["id1", "id2"], "left")
                .withColumn("estimate", F.coalesce(F.col("m0"), F.lit(0)) / F.lit(k)).drop("m0"))
    j = with_signatures(pairs, sigs)
    return j.withColumn("estimate", matches(F.col("sig1"), F.col("sig2"), k) / F.lit(k)).drop(
        "sig1", "sig2")


def _below(bound: int):
    return lambda c: c < bound


def error_by_k(exact: DataFrame, sigs: DataFrame, n_entities, k_values: Sequence[int],
               family: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Mean |estimate_k - exact| over all n(n-1)/2 pairs for each k.

    With a != 0 mod p each hash is a bijection on [0, p), so equal minima
    mean a shared element: pairs without overlap estimate 0 and err 0.  The
    sum therefore runs over the overlapping pairs (``exact``) only and is
    divided by the full pair count.  Every k has a row, also without any
    overlapping pair.  With the hash ``family`` agreement is counted by
    ``shared_minima`` (see ``estimate_pairs``).
    """
    pairs = exact.select("id1", "id2", "jaccard")
    if family is not None:
        j = pairs.join(shared_minima(sigs, k_values, family), ["id1", "id2"], "left")
        agreed = [F.coalesce(F.col(f"m{i}"), F.lit(0)) for i in range(len(k_values))]
    else:
        # signatures are compared once; what agrees among the first k has a code below k * 2^31
        j = with_signatures(pairs, sigs).select("jaccard", F.array_intersect("sig1", "sig2").alias("same"))
        agreed = [F.size(F.filter("same", _below(int(k) * CODE_SHIFT))) for k in k_values]

    sums = j.agg(*[F.struct(F.lit(int(k)).alias("k"),
                            F.coalesce(F.sum(F.abs(same / int(k) - F.col("jaccard"))), F.lit(0.0)).alias("_sum"),
                            F.count(F.lit(1)).alias("overlapping_pairs")).alias(f"k{i}")
                   for i, (k, same) in enumerate(zip(k_values, agreed))])
    n_pairs = (n_entities * (n_entities - 1) / 2)
    return (sums.select(F.inline(F.array(*[f"k{i}" for i in range(len(k_values))])))
            .select("k", F.round(F.col("_sum") / n_pairs, 6).alias("mean_error"),
                    F.round(1.0 / F.sqrt(F.col("k")), 6).alias("theoretical_error"),
                    "overlapping_pairs"))


def error_report(est: DataFrame) -> DataFrame:
    """n, MAE, RMSE, max error and Pearson r (0 when n <= 1) of
    ``estimate`` vs ``jaccard`` over the given pairs."""
    e = F.col("estimate") - F.col("jaccard")
    r = F.corr("estimate", "jaccard")
    return est.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                   F.sqrt(F.avg(e * e)).alias("rmse"), F.max(F.abs(e)).alias("max_error"),
                   r.alias("r")).select(
        "n", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"),
        F.round("max_error", 6).alias("max_error"),
        F.round(F.when(F.col("n") > 1, F.coalesce(F.col("r"), F.lit(0.0))).otherwise(0.0), 6).alias("pearson_r"))


def error_by_entity(est: DataFrame, n_entities, entities: DataFrame | None = None) -> DataFrame:
    """Mean error per entity over its n-1 pairs (pairs outside ``est`` have
    error 0, see ``error_by_k``).  With ``entities`` (entity) those without any
    overlap have a row too, of error 0."""
    e = F.abs(F.col("estimate") - F.col("jaccard"))
    per = est.select(F.explode(F.array("id1", "id2")).alias("entity"), e.alias("_e"))
    if entities is not None:
        per = per.unionByName(entities.select("entity", F.lit(None).cast("double").alias("_e")))
    return per.groupBy("entity").agg(
        F.round(F.coalesce(F.sum("_e"), F.lit(0.0)) / F.greatest(n_entities - 1, F.lit(1)), 6).alias("mean_error"),
        F.count("_e").alias("overlapping_pairs"))
