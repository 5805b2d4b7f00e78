"""Ranked search, the Merkle manifest and fingerprints against brute force and odd rows."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import chunk_fingerprints, merkle, ranked_search
from affinity.llm.oracle import ORACLE_SQL

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, item_id long, leaf string, score string, rank string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    texts = [(1, None), (2, ""), (3, ""), (4, "Hello World"), (5, "hello, world!"), (6, "--- !!! \n"), (7, "Éa éA 数字 数字 x1"),
             (8, "hello " * 300), (4, "Hello World"), (4, "other world"), (None, "hello nobody"), (None, None), (None, "hello nobody"),
             (9, "long " + "very unusual sentence number 7; " * 4000), (10, "world " + " ".join(f"w{i}" for i in range(500))),
             (-3, "A-B_C hello"), (11, "😀 hello 😀")]
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else "ab"[k % 2], None if k % 3 else 5, 1, "x", "y", "z")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_search(docs, items, top):
    held = [collections.Counter(TERM.findall((d.text or "").translate(LOWER))) for d in docs]
    n_docs, n_terms = sum(1 for c in held if c), sum(sum(c.values()) for c in held)
    df = collections.Counter(t for c in held for t in c)
    asked = collections.defaultdict(set)
    for i in items:
        asked[i.item_id] |= set(TERM.findall((i.text or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scored = []
        for d, c in zip(docs, held):
            n, score = sum(c.values()), 0
            for t in terms:
                if c[t]:
                    m = 50 + 50 * n * n_docs // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, d.doc_id is None, d.doc_id or 0))
        out += [(item, k + 1, None if z else i, -s) for k, (s, z, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,share", [(1024, 0.25), (2, 0.25), (1, 0.0), (3, 100.0)])
def test_ranked_search(spark, odd, monkeypatch, window, share):
    """Long and short lists, many windows; the functions run here, not in workers, so
    that the small limits hold."""
    items = spark.createDataFrame([(1, "Hello world"), (2, "nothing of it"), (3, None), (None, "HELLO"), (4, "world, hello w3 数字"),
                                   (1, "unusual x1"), (5, "long number hello very hello")], "item_id long, text string")
    docs = odd.unionByName(spark.createDataFrame(
        [(100 + i, f"w{i % 7} hello " * (1 + i % 5) + "x " * (i % 11)) for i in range(60)], "doc_id long, text string"), allowMissingColumns=True)
    rows, asked = docs.collect(), items.collect()
    got = ranked_search.search(docs, items, 5)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(rows, asked, 5)
    # the same on the driver, block by block, with the limits of this case
    monkeypatch.setattr(ranked_search, "WINDOW", window)
    monkeypatch.setattr(ranked_search, "SHORT_SHARE", share)
    index = ranked_search.build_index(docs)
    queries = ranked_search.weighed_items(items, index).collect()
    found = {q.item_id: ranked_search._Best(5) for q in queries}
    for r in index.collect():
        block = ranked_search._Block(r.asDict(), queries[0].n_docs, queries[0].n_terms)
        place = {t: k for k, t in enumerate(r.terms)}
        for q in queries:
            ranked_search.search_block(block, [place[t] for t in q.terms if t in place],
                                       [w for t, w in zip(q.terms, q.weights) if t in place], found[q.item_id])
    out = [(i, k + 1, None if z else d, s) for i, b in found.items()
           for k, (s, d, z) in enumerate(zip(b.scores.tolist(), b.ids.tolist(), b.no_id.tolist()))]
    assert sorted(out, key=repr) == brute_search(rows, asked, 5)


def test_ranked_search_in_many_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "GROUP", 3)
    docs, items = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    index = ranked_search.build_index(docs.repartition(5), 20_000)
    queries = ranked_search.weighed_items(items, index)
    assert index.count() > 10 and queries.select("query_group").distinct().count() > 3
    got = collections.defaultdict(list)
    for r in ranked_search.found_in_tasks(index, queries, 7).collect():
        got[r.item_id].append((-r.score, r.doc_id))
    want = collections.defaultdict(list)
    for item, _, doc, score in brute_search(docs.collect(), items.collect(), 7):
        want[item].append((-score, doc))
    assert {i: sorted(v)[:7] for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}


def test_ranked_search_holds_few_blocks(spark, monkeypatch):
    """Texts come in small batches, and two blocks at most are written or read together."""
    import pyarrow.parquet as pq

    seen, whole = [], ranked_search.materialize

    def noted(df, name, **options):
        seen.append((name, spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))
        return whole(df, name, **options)

    monkeypatch.setattr(ranked_search, "materialize", noted)
    docs = spark.createDataFrame([(i, f"w{i} hello " * 50) for i in range(60)], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "hello w7")], "item_id long, text string")
    index = ranked_search.build_index(docs, 2000)
    files = [f.removeprefix("file://") for f in index.inputFiles()]
    assert index.count() > 10
    assert all(m.row_group(i).num_rows <= 2 for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups))
    found = ranked_search.found_in_tasks(index, ranked_search.weighed_items(items, index)).orderBy("score").collect()
    assert found[-1].doc_id == 7 and len(found) >= 50
    assert [(n, b) for n, b in seen if n != "queries"] == [(n, str(ranked_search.BATCH_BYTES)) for n in ("postings", "found")]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != str(ranked_search.BATCH_BYTES)


def test_ranked_search_of_nothing(odd, empty):
    assert ranked_search.search(empty, odd).count() == 0 and ranked_search.search(odd, empty).count() == 0
    assert ranked_search.search(odd.filter("doc_id < 4 and doc_id > 0"), odd).count() == 0


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(docs, fanout):
    """Leaf by leaf, with lists of lists."""
    def leaf(r, text):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][k:k + fanout]) for k in range(0, len(out[-1]), fanout)])
        return out

    def climb(tree, at, folded):
        proof = []
        for nodes in tree[:-1]:
            lo = at - at % fanout
            left, right = nodes[lo:at], nodes[at + 1:lo + fanout]
            folded, at, proof = digest(*left, folded, *right), at // fanout, proof + left + right
        return folded, proof

    sources = collections.defaultdict(list)
    for r in docs:
        bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        sources[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), leaf(r, r.text.translate(LOWER)) if bad and r.text else leaf(r, r.text)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[2] for x in sorted(sources[s])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for at, (has, i, leaf_, found) in enumerate(sorted(sources[s])):
            folded, proof = climb(trees[k], at, found)
            folded, more = climb(top, k, folded)
            out.append((i if has else None, leaf_, trees[k][-1][0], top[-1][0], digest(*proof, *more), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_merkle(odd, spark, fanout):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    for rows in (odd, docs, docs.filter("source = 'src0'") if fanout == 3 else docs.limit(1), docs.limit(1).unionByName(docs.limit(1))):
        got = merkle.manifest_digest(rows, fanout)
        assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == brute_manifest(rows.collect(), fanout)


def test_merkle_of_nothing_and_of_altered_rows(odd, empty):
    assert merkle.manifest_digest(empty).count() == 0
    rows = merkle.leaves(odd, F.col("doc_id") == 4)
    nodes, roots = merkle.manifest(rows)
    got = merkle.verified(rows, nodes, roots).collect()
    # of doc_id 4 all have upper-case letters but one
    assert [r.doc_id for r in got if not r.verified] == [4, 4]
    # nodes name their parents
    held = {(r.tree, r.level, r.place): r for r in nodes.collect()}
    for (tree, level, place), r in held.items():
        assert r.parent is None if r.size == 1 else bytes(r.hash) in bytes(held[tree, level + 1, r.parent].children)


def brute_ends(data):
    """Boundaries by the rolling hash, byte by byte."""
    c, ends, lo = chunk_fingerprints, [], 0
    while lo < len(data):
        cut = min(lo + c.MOST, len(data))
        for e in range(lo + c.LEAST, cut + 1):
            h = sum(int(c.GEAR[data[e - 1 - k]]) << k for k in range(min(c.REACH, e))) & 0xFFFFFFFF
            if h >> (32 - (c.STRICT_BITS if e - lo <= c.NORMAL else c.LOOSE_BITS)) == 0:
                cut = e
                break
        ends.append(cut)
        lo = cut
    return ends


def test_chunks_follow_the_content():
    rng = np.random.default_rng(8)
    texts = [bytes(rng.choice(list(b"abcdefgh \n\x00\xc3\xa9"), n).tolist()) for n in (0, 1, 15, 16, 17, 48, 49, 192, 193, 700, 3000, 0, 5)]
    assert chunk_fingerprints.chunk_ends(texts) == [brute_ends(t) for t in texts]
    text = bytes(rng.choice(list(b"abcdefghijklmnopqrstuvwxyz "), 6000).tolist())
    plain, moved, cut = chunk_fingerprints.fingerprints([text, b"some words before " + text, text[:3000] + b"!" + text[3001:]])
    assert chunk_fingerprints.containment(plain, moved) > 0.95 and chunk_fingerprints.containment(plain, cut) > 0.93
    assert 30 < 6000 / len(plain) < 90


def test_fingerprints(odd, empty, spark):
    c = chunk_fingerprints
    many = spark.read.parquet(f"{DIR}/documents.parquet")
    one = spark.createDataFrame([(5, "a single text of some length, followed by itself")], "doc_id long, text string")
    for docs in (many, one, odd.filter("doc_id <> 4")):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: -r[0])
        want = []
        for k, (i, t) in enumerate(rows):
            following = rows[(k + 1) % len(rows)][1]
            half = len(t) // 2
            new = t[:len(t) - half] + following[:half]
            own, other, nxt = c.fingerprints([t.encode(), new.encode(), following.encode()])
            want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), c.written(own), c.written(other),
                         c.containment(own, other), c.containment(own, nxt)))
        got = c.fingerprinted(docs.repartition(3))
        assert sorted(map(tuple, got.collect())) == sorted(want)
    got = c.fingerprinted(odd).collect()
    assert len(got) == odd.count() and sum(r.doc_id is None for r in got) == 3
    assert c.fingerprinted(empty).count() == 0
    # half of a long text is replaced, and the next one is another text
    rows = [r for r in c.fingerprinted(many).collect() if r.n_chars > 500]
    assert np.mean([r.near_edited for r in rows]) > 0.45 and np.mean([r.near_next for r in rows]) < 0.05


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_merkle"])
def test_query_matches_sql(spark, name):
    from affinity.llm.catalog import QUERIES

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    df = QUERIES[name](spark, DIR)
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
