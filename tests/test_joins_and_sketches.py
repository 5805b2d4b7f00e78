"""Threshold joins, sweeps, vectors, sketches, samples and checked scans against
brute force on small inputs."""

import itertools
import math
import random

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from affinity.operators import clean, distributions, lsh, minhash, pairs, prefix_join, profile, rules, sampling, sets, sketches, skew, vectors
from affinity.params import DEFAULTS, PROFILES, profile as named_profile
from affinity.session import materialize
from affinity.sources import csv


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def families(seed, n, hot=True):
    """{entity: elements} with near copies, a hot element and single ones."""
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        base = set(rng.sample(range(120), rng.randint(1, 25)))
        if i % 4 == 3:
            base = set(out[i - 1]) ^ set(rng.sample(range(120), rng.randint(0, 4)))
        out[i] = (base | ({500} if hot else set()) | ({1000 + i} if i % 2 else set())) or {7}
    return out


def frame(spark, fam):
    return spark.createDataFrame([(e, x) for e, s in fam.items() for x in s], "entity long, element long")


def brute_pairs(fam, least):
    return sorted((a, b, len(fam[a] & fam[b]), len(fam[a] | fam[b])) for a, b in itertools.combinations(sorted(fam), 2)
                  if fam[a] & fam[b] and len(fam[a] & fam[b]) >= least * len(fam[a] | fam[b]) - 1e-12)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_by_key_with_a_hot_key(spark, how, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_SHARE", 5)
    df = spark.createDataFrame([(None if i % 7 == 0 else 1 if i % 2 else i, i) for i in range(100)], "k long, v long")
    table = spark.createDataFrame([(1, "one"), (4, "four"), (400, "none")], "k long, name string")
    counts = skew.key_counts(df, ["k"])
    got = skew.join_by_key(df, table, ["k"], counts, "n", how)
    assert rows_of(got, "k", "v", "name") == rows_of(df.join(table, "k", how), "k", "v", "name")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("broadcast") >= 2
    many = skew.with_key_counts(df.filter("k is not null"), ["k"], "c", 2)
    assert {(r.k, r.c) for r in many.collect()} == {(1, df.filter("k = 1").count())}


@pytest.mark.parametrize("cell", [4, 65536])
def test_positions_are_ranks_by_rarity(spark, cell):
    fam = families(1, 40)
    held = {}
    for s in fam.values():
        for x in s:
            held[x] = held.get(x, 0) + 1
    got = {}
    for r in prefix_join.positions(frame(spark, fam), cell).collect():
        assert r.n == held[r.element] and r["size"] == len(fam[r.entity])
        got.setdefault(r.entity, {})[r.pos] = (r.n, r.element)
    for e, s in fam.items():
        assert sorted(got[e]) == list(range(1, len(s) + 1))
        assert [got[e][p][0] for p in sorted(got[e])] == sorted(held[x] for x in s)
    # one order of elements for all sets
    before = {}
    for placed in got.values():
        order = [placed[p][1] for p in sorted(placed)]
        for a, b in itertools.combinations(order, 2):
            assert before.setdefault((a, b), True) and (b, a) not in before


@pytest.mark.parametrize("least", [0.05, 0.3, 0.5, 0.8, 1.0])
def test_prefix_join_finds_all_pairs(spark, least):
    fam = families(2, 60)
    got = prefix_join.jaccard_at_least(frame(spark, fam), least, block=4)
    assert rows_of(got, "id1", "id2", "inter", "union") == sorted(brute_pairs(fam, least), key=repr)


def test_prefix_join_at_the_boundary_and_of_nothing(spark):
    fam = {1: set(range(7)), 2: set(range(4, 10)), 3: {99}}  # 3 of 10 shared
    assert rows_of(prefix_join.jaccard_at_least(frame(spark, fam), 0.3), "id1", "id2") == [(1, 2)]
    assert prefix_join.jaccard_at_least(frame(spark, {}), 0.3).count() == 0
    assert prefix_join.top_jaccard(frame(spark, {}), 3).count() == 0
    with pytest.raises(ValueError):
        prefix_join.jaccard_at_least(frame(spark, fam), 0.0)


def test_prefix_join_joins_fewer_rows(spark):
    """A hot element stands last in every set: it isn't in the prefixes."""
    fam = families(3, 150)
    m = frame(spark, fam)
    every = pairs.pairs_within_groups(m, ["element"], "entity").count()
    prefix = prefix_join.prefixes(prefix_join.positions(m), 0.5)
    assert pairs.pairs_within_groups(prefix, ["element"], "entity").count() < every / 4
    assert prefix.filter("element = 500").join(m.groupBy("entity").count().filter("count > 3"), "entity").count() == 0
    overlapping = sets.overlap_counts(m).count()
    assert prefix_join.prefix_pairs(prefix, 0.5).count() < overlapping / 5


@pytest.mark.parametrize("k,rarest", [(1, 2), (5, 2), (30, 8), (10_000, 4)])
def test_top_pairs_by_a_rising_threshold(spark, k, rarest):
    fam = families(4, 50)
    want = sorted((round(-i / u, 9), a, b) for a, b, i, u in brute_pairs(fam, 0))[:k]
    got = prefix_join.top_jaccard(frame(spark, fam), k, rarest).collect()
    assert sorted((round(-r.jaccard, 9), r.id1, r.id2) for r in got) == want


def test_jaccard_in_rows(spark):
    fam = families(5, 20)
    m = frame(spark, fam)
    every = sets.overlap_counts(m).select("id1", "id2")
    columns = "id1", "id2", "inter", "union", "jaccard"
    assert rows_of(sets.jaccard_in_rows(every, m), *columns) == rows_of(sets.jaccard_of_pairs(every, m), *columns)


@pytest.mark.parametrize("k,configs", [(12, [(6, 2), (4, 3), (3, 4), (2, 6), (1, 12)]), (6, [(6, 1), (2, 3)]), (35, [(7, 5), (5, 7)]),
                                       (130, [(65, 2), (10, 13)])])
def test_sweep_reads_all_configurations_from_shared_runs(spark, k, configs):
    rng = random.Random(6)
    sigs = []
    for i in range(60):
        v = [rng.randint(0, 2) for _ in range(k)]
        if i % 3:
            v = [x if rng.random() < 0.8 else rng.randint(0, 2) for x in sigs[-1]]
        sigs.append(v)
    df = spark.createDataFrame([(i, [h * minhash.CODE_SHIFT + x for h, x in enumerate(v)]) for i, v in enumerate(sigs)],
                               "entity long, sig array<long>")
    got = {(r.id1, r.id2): r for r in lsh.sweep_pairs(df, k, configs).collect()}
    for c, (b, r) in enumerate(configs):
        want = {(i, j) for i, j in itertools.combinations(range(60), 2)
                if any(sigs[i][x * r:x * r + r] == sigs[j][x * r:x * r + r] for x in range(b))}
        assert {p for p, row in got.items() if row[f"c{c}"]} == want
        assert {tuple(x) for x in lsh.lsh_candidates(df, b, r).collect()} == want


def test_verified_neighbours_lose_no_likely_pair(spark):
    fam = families(7, 80, hot=False)
    m = frame(spark, fam)
    sigs = minhash.signature_arrays(minhash.signatures_long(m, 200))
    got = rows_of(lsh.similar_pairs(sigs, m, 100, 2, 200, 0.3), "id1", "id2", "inter", "union")
    want = sorted(brute_pairs(fam, 0.3), key=repr)
    assert set(got) <= set(want) and len(got) >= 0.98 * len(want)
    cand = minhash.with_signatures(lsh.lsh_candidates(sigs, 100, 2), sigs)
    test = lsh.still_possible(F.col("sig1"), F.col("sig2"), 200, 0.6)
    kept = {(r.id1, r.id2) for r in cand.filter(test).collect()}
    assert len(kept) < cand.count() / 2  # it does stop pairs
    assert {(a, b) for a, b, *_ in brute_pairs(fam, 0.6)} & {(r.id1, r.id2) for r in cand.collect()} <= kept


def test_errors_by_k_and_entity(spark):
    fam = {1: {1, 2, 3}, 2: {2, 3, 4}, 3: {9}}
    m = frame(spark, fam)
    sigs = minhash.signature_arrays(minhash.signatures_long(m, 20))
    exact = sets.jaccard_pairs(m)
    codes = {r.entity: r.sig for r in sigs.collect()}
    got = {r.k: r for r in minhash.error_by_k(exact, sigs, F.lit(3), [5, 20]).collect()}
    for k in (5, 20):
        same = sum(a == b for a, b in zip(codes[1][:k], codes[2][:k]))
        assert got[k].mean_error == pytest.approx(abs(same / k - 0.5) / 3, abs=1e-6) and got[k].overlapping_pairs == 1
    est = minhash.estimate_pairs(exact.select("id1", "id2", "jaccard"), sigs, 20)
    per = {r.entity: r for r in minhash.error_by_entity(est, F.lit(3), m.select("entity").distinct()).collect()}
    assert set(per) == {1, 2, 3} and per[3].mean_error == 0 and per[3].overlapping_pairs == 0


def test_mllib_pairs_carry_no_vectors_through_the_tables(spark, monkeypatch):
    fam = families(5, 60)
    stored = {}

    def store(df, name):
        stored[name] = df
        return materialize(df, name)

    monkeypatch.setattr(lsh, "materialize", store)
    # 60 tables miss a pair at the threshold less than once in a billion times
    found = lsh.mllib_similar_pairs(frame(spark, fam), tables=60, max_distance=0.7, block=16)
    want = [(a, b, round(inter / union, 6)) for a, b, inter, union in brute_pairs(fam, 0.3)]
    assert sorted(tuple(r) for r in found.collect()) == want and want
    for name in ("tables", "marks", "met"):
        assert not any("vector" in t or "array" in t for _, t in stored[name].dtypes), name
    # sets far apart are left out where they meet, not stored as pairs
    assert stored["met"].count() < len(fam) * (len(fam) - 1) / 2
    plan = stored["met"]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_least_agreement_keeps_pairs_at_the_threshold():
    least = lsh.least_agreement(128, 0.3, 1e-12)
    assert 0 < least < 0.3 * 128
    chance = [math.comb(128, m) * 0.3 ** m * 0.7 ** (128 - m) for m in range(least + 1)]
    assert sum(chance[:least]) <= 1e-12 < sum(chance)


def test_feature_vectors(spark):
    m = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (3, None), (4, "b")], "entity long, element string")
    got = {r.entity: r.features for r in vectors.feature_vectors(m).collect()}
    assert got == {1: SparseVector(3, [0, 1], [1, 1]), 2: SparseVector(3, [2], [1]), 4: SparseVector(3, [1], [1])}
    many = spark.range(5000).select((F.col("id") * 7 % 3001).alias("element"))
    index = vectors.dense_index(many.repartition(9)).collect()
    assert [r["index"] for r in sorted(index, key=lambda r: r.element)] == list(range(3001))
    assert vectors.feature_vectors(m.limit(0)).count() == 0


def test_distinct_sketches_roll_up(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("g"), (F.col("id") % 7000).alias("x"))
    by_group = sketches.distinct_sketches(df, ["g"], "x")
    total = sketches.distinct_estimates(sketches.rolled_up(by_group)).first()[0]
    assert abs(total - 7000) <= 4 * sketches.distinct_error() * 7000
    # the union of parts is the sketch of all
    assert total == sketches.distinct_estimates(sketches.distinct_sketches(df, [], "x")).first()[0]
    report = sketches.distinct_report(df, "g", "x").collect()
    assert sorted((r.g is None, r.g, r.exact) for r in report if r.g is not None) == [(False, g, 1400) for g in range(5)]
    assert all(r.within_bound for r in report) and [r.exact for r in report if r.g is None] == [7000]


def test_distinct_report_deals_rows_into_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(sketches, "ROWS_A_TASK", 100)
    rows = [(g, x) for g in ("a", "b", None) for x in range(150)] * 2 + [("a", None), ("b", 7)]
    report = sketches.distinct_report(spark.createDataFrame(rows, "g string, x long"), "g", "x")
    # 901 rows with a value, 100 to a task
    assert ", 10), REPARTITION_BY_NUM" in report._jdf.queryExecution().executedPlan().toString()
    got = [(r.g, r.exact, r.within_bound) for r in report.collect()]
    assert {(g, n) for g, n, ok in got if ok} == {("a", 150), ("b", 150), (None, 150)}


def test_quantile_sketches_merge(spark):
    df = spark.range(50_000).select((F.col("id") % 4).alias("g"), ((F.col("id") * 7919) % 50_000).alias("x"))
    merged = sketches.merged_quantiles(sketches.quantile_sketches(df, ["g"], "x"))
    for r in sketches.quantiles(merged, [0.1, 0.5, 0.99]).collect():
        assert abs(r.value / 50_000 - r.share) < 2 * sketches.RANK_ERROR
    for r in sketches.ranks(merged, [5000, 25_000]).collect():
        assert abs(r["rank"] - r.value / 50_000) < 2 * sketches.RANK_ERROR
    report = sketches.quantile_report(df, "g", "x", [0.25, 0.9]).collect()
    assert len(report) == 10 and all(r.within_bound for r in report) and {r.n for r in report if r.g is None} == {50_000}


def test_stratified_sample(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 900, "hot").when(F.col("id") < 995, "mid").alias("s"))
    take = lambda d, k=20: sampling.stratified_sample(d, "s", "id", k)
    got = take(df)
    assert {(r.s, r["count"]) for r in got.groupBy("s").count().collect()} == {("hot", 20), ("mid", 20), (None, 5)}
    assert got.columns == df.columns and rows_of(got, "id") == rows_of(take(df.repartition(13)), "id")
    parts = take(df.filter("id % 2 = 0")).unionByName(take(df.filter("id % 2 = 1")))
    assert rows_of(take(parts), "id") == rows_of(got, "id")  # samples merge
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_largest_distance(spark):
    full = spark.createDataFrame([(x,) for x in (1, 1, 2, 3, 4, None)], "v int")
    sample = spark.createDataFrame([(x,) for x in (1, 4)], "v int")
    assert tuple(sampling.largest_distance(full, sample, "v").first()) == (5, 2, 0.3)
    assert tuple(sampling.largest_distance(full, full, "v").first()) == (5, 5, 0.0)
    assert tuple(sampling.largest_distance(full, sample.limit(0), "v").first()) == (5, 0, 0.0)


def test_hexagons_hold_their_nearest(spark):
    rng = random.Random(9)
    points = [(10 ** rng.uniform(0, 4), rng.uniform(0.5, 5)) for _ in range(300)]
    df = spark.createDataFrame(points, "num_ratings double, avg_rating double")
    got = distributions.density_hex(df, grid=9).collect()
    assert sum(r["count"] for r in got) == 300
    x = [math.log10(p[0]) for p in points]
    y = [p[1] for p in points]
    sx, sy = (max(x) - min(x)) / 9, (max(y) - min(y)) / 5
    centers = [(i / 2, j / 2) for i in range(20) for j in range(12) if (i + j) % 2 == 0 and (i % 2 == 0) == (j % 2 == 0)]
    want = {}
    for a, b in zip(x, y):
        u, v = (a - min(x)) / sx, (b - min(y)) / sy
        c = min(centers, key=lambda c: (u - c[0]) ** 2 + 3 * (v - c[1]) ** 2)
        want[(round(2 * c[0]), round(2 * c[1]))] = want.get((round(2 * c[0]), round(2 * c[1])), 0) + 1
    assert {(r.cell_x, r.cell_y): r["count"] for r in got} == want
    one = distributions.density_hex(spark.createDataFrame([(5.0, 3.0)] * 4, "num_ratings double, avg_rating double")).collect()
    assert [(r.cell_x, r.cell_y, r["count"]) for r in one] == [(0, 0, 4)]


def test_bitmaps_count_baskets(spark):
    rng = random.Random(10)
    baskets = [(i, sorted(rng.sample("abcdef", rng.randint(2, 5)))) for i in range(70_000, 70_400)]
    df = spark.createDataFrame(baskets, "basket_id long, items array<string>")
    found = rules.frequent_itemsets(rules.fpgrowth(df, 0.05, 0.1), 400)
    got = rules.bitmap_supports(found, rules.basket_bitmaps(df)).collect()
    assert max(r["size"] for r in got) > 2
    for r in got:
        assert r.freq == r.bitmap_freq == sum(set(r["items"]) <= set(b) for _, b in baskets)
    none = spark.createDataFrame([(["a", "zz"],)], "items array<string>")
    assert rules.bitmap_supports(none, rules.basket_bitmaps(df)).first().bitmap_freq == 0


def test_checked_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,10\n1,x,3.5,10\n2,3,4\n2,3,4,5,6\n,3,4,5\n7,8,,9\n\"9\",9,1.0,1\n")
    checked = csv.read_checked(spark, str(tmp_path / "r.csv"), csv.get_schemas()[0])
    assert rows_of(csv.good_rows(checked), "user_id", "item_id", "rating", "ts") == [(1, 2, 3.5, 10), (9, 9, 1.0, 1)]
    assert rows_of(csv.rejected_rows(checked), "record", "reason") == sorted([
        ("1,x,3.5,10", "malformed"), ("2,3,4", "malformed"), ("2,3,4,5,6", "malformed"), (",3,4.0,5", "missing user_id"),
        ("7,8,,9", "missing rating")], key=repr)
    assert {(r.reason, r.rows) for r in csv.reject_report(checked).collect()} == {
        ("good", 2), ("malformed", 3), ("missing user_id", 1), ("missing rating", 1)}


def test_reports_in_one_pass(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 2.0), (1, 1, None), (None, 1, 3.0), (2, 1, None), (2, 2, 1.0)], "u int, i int, r double")
    got = {r.step: (r.rows_before, r.rows_after, r.removed) for r in clean.clean_report(df, ["u", "i"]).collect()}
    assert got == {"nulls": (6, 3, 3), "duplicates": (3, 2, 1)}
    got = {r.step: (r.rows_before, r.rows_after) for r in clean.clean_report(df).collect()}
    assert got == {"nulls": (6, 3), "duplicates": (3, 2)}
    assert [r.rows_before for r in clean.clean_report(df.limit(0), ["u"]).collect()] == [0, 0]
    s = profile.sparsity(df, "u", "i").first()
    assert (s.num_users, s.num_items, s.num_ratings) == (2, 2, 6)


def test_sets_of_users_and_tags(spark):
    inter = spark.createDataFrame([(5, 1, 4.0), (6, 1, 1.0), (5, 2, 4.0)], "user_id long, item_id long, rating double")
    tags = spark.createDataFrame([(5, 1, "5"), (9, 3, "x"), (5, 1, "5")], "user_id long, item_id long, tag string")
    got = sets.mixed_members(inter, tags, 3.5)
    assert rows_of(got, "entity", "element") == [(1, "t:5"), (1, "u:5"), (2, "u:5"), (3, "t:x")]


def test_profiles():
    assert named_profile() is DEFAULTS and set(PROFILES) == {"quick", "full"}
    assert named_profile("quick")["k_values"] == (400,) and named_profile("full")["rating_threshold"] == 3.5
    for name in PROFILES:
        p = named_profile(name)
        assert all(b * r == p["k_values"][-1] for b, r in p["lsh_configs"])
    with pytest.raises(ValueError):
        named_profile("none")


def test_signatures_move_sets_and_not_hashes(spark, monkeypatch):
    """No row per (element, hash), cells of large sets, sets of nulls."""
    monkeypatch.setattr(minhash, "CHUNK", 16)
    fam = {1: set(range(100)), 2: {3, 2**40, -5}, 3: {7}}
    m = frame(spark, fam).unionByName(spark.createDataFrame([(4, None)], "entity long, element long"))
    got = minhash.signatures_long(m, 20)
    coefficients = minhash.hash_family(20)
    want = {(e, h): min((a * (x % minhash.MERSENNE_P) + b) % minhash.MERSENNE_P for x in s)
            for e, s in fam.items() for h, (a, b) in enumerate(coefficients)}
    rows = got.collect()
    assert {(r.entity, r.h): r.v for r in rows} == want | {(4, h): None for h in range(20)} and len(rows) == 80
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "sequence(0, 19" not in plan


def test_estimates_of_all_overlaps_carry_no_signatures(spark):
    fam = families(8, 40)
    m = frame(spark, fam)
    sigs = minhash.signature_arrays(minhash.signatures_long(m, 130))
    exact = sets.jaccard_pairs(m)
    family = minhash.hash_family(130)
    by_join, by_minima = (minhash.estimate_pairs(exact, sigs, 130, f) for f in (None, family))
    assert rows_of(by_join, *by_join.columns) == rows_of(by_minima, *by_join.columns)
    for k in ([5, 60, 61, 130], [1]):
        assert minhash.error_by_k(exact, sigs, F.lit(40), k).collect() == minhash.error_by_k(exact, sigs, F.lit(40), k, family).collect()
    plan = by_minima._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" not in plan


@pytest.mark.parametrize("limit", [0, 10**6])
def test_overlaps_are_counted_where_they_are_few(spark, monkeypatch, limit):
    """Both ways find the same pairs; the counting one joins no candidates again."""
    monkeypatch.setattr(prefix_join, "PAIRS_PER_MEMBER", limit)
    again = []
    monkeypatch.setattr(prefix_join, "jaccard_of_pairs", lambda *x: again.append(1) or sets.jaccard_of_pairs(*x))
    fam = families(9, 40)
    got = prefix_join.jaccard_at_least(frame(spark, fam), 0.1, block=4)
    assert rows_of(got, "id1", "id2", "inter", "union") == sorted(brute_pairs(fam, 0.1), key=repr)
    best = prefix_join.top_jaccard(frame(spark, fam), 5, 2).collect()
    assert sorted((round(-r.jaccard, 9), r.id1, r.id2) for r in best) == sorted(
        (round(-i / u, 9), a, b) for a, b, i, u in brute_pairs(fam, 0))[:5]
    assert bool(again) == (limit == 0)


def test_trees_are_grown_once(spark):
    """Itemsets and rules read the stored model; no plan of theirs has the fit's rows."""
    rng = random.Random(11)
    baskets = [(i, sorted(rng.sample("abcdefg", rng.randint(2, 6)))) for i in range(300)]
    df = spark.createDataFrame(baskets, "basket_id long, items array<string>")
    model = rules.fpgrowth(df, 0.1, 0.2)
    for found in (model.freqItemsets, rules.frequent_itemsets(model, 300)):
        assert "fp-growth-" in "".join(found.inputFiles())
    held = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect()}
    want = {c: n for k in range(1, 8) for c in itertools.combinations("abcdefg", k)
            if (n := sum(set(c) <= set(b) for _, b in baskets)) >= 30}
    assert held == want
    for r in model.associationRules.collect():
        both = tuple(sorted([*r.antecedent, *r.consequent]))
        assert r.confidence == pytest.approx(want[both] / want[tuple(sorted(r.antecedent))])
        assert r.lift == pytest.approx(r.confidence * 300 / want[tuple(r.consequent)])


def near_copies(seed, n):
    """Families of near copies and equal sets: their pairs share most elements."""
    rng = random.Random(seed)
    base = [set(rng.sample(range(10_000), 60)) for _ in range(3)]
    out = {}
    for i in range(n):
        out[i] = set(base[i % 3]) - set(rng.sample(sorted(base[i % 3]), rng.choice([0, 0, 2, 5, 30]))) | {i % 5}
    return out


@pytest.mark.parametrize("block", [4, 1024])
def test_linked_pairs_are_those_of_all_groups(spark, block, monkeypatch):
    for fam in (families(12, 50), near_copies(13, 40)):
        m = frame(spark, fam).repartition(2)
        want = rows_of(pairs.pairs_within_groups(m, ["element"], "entity").select("id1", "id2").distinct(), "id1", "id2")
        assert rows_of(pairs.linked_pairs(m, ["element"], "entity", block), "id1", "id2") == want
    # before they are made distinct, pairs of near copies are few
    monkeypatch.setattr(type(m), "distinct", lambda df: df)
    met = pairs.linked_pairs(m, ["element"], "entity", block).count()
    assert met < pairs.pairs_within_groups(m, ["element"], "entity").count() / 3


@pytest.mark.parametrize("least,cell", [(0.05, 2), (0.3, 256), (1.0, 2)])
def test_similar_entities_of_sets_in_rows(spark, least, cell, monkeypatch):
    monkeypatch.setattr(sets, "CELL_SETS", cell)
    fam = {**families(14, 30), **{1000 + k: s for k, s in near_copies(15, 30).items()}}
    rows = [(k, sorted(s)) for k, s in fam.items()] + [(None, sorted(fam[1]))]
    arrays = spark.createDataFrame(rows, "entity long, elements array<long>")
    got = prefix_join.similar_entities(arrays, least, block=8)
    assert rows_of(got, "id1", "id2", "inter", "union") == sorted(brute_pairs(fam, least), key=repr)
    assert all(r.jaccard == r.inter / r.union for r in got.collect())
    assert prefix_join.similar_entities(arrays.limit(0), least).count() == 0


def test_likely_pairs_pass_the_sequential_test(spark):
    fam = families(16, 40)
    sigs = minhash.signature_arrays(minhash.signatures_long(frame(spark, fam), 200))
    every = sets.overlap_counts(frame(spark, fam)).select("id1", "id2")
    want = minhash.with_signatures(every, sigs).filter(lsh.still_possible(F.col("sig1"), F.col("sig2"), 200, 0.4))
    got = lsh.likely_pairs(every, sigs, 200, 0.4)
    assert rows_of(got, "id1", "id2") == rows_of(want, "id1", "id2") and 0 < got.count() < every.count()


def test_document_sets_in_rows(spark, tmp_path):
    """Odd rows: null and short texts, doc_ids that repeat or are null."""
    from affinity import sources

    rows = [(1, "a b c d a b c"), (1, "x y z"), (2, None), (3, "a b"), (4, ""), (None, "A b  c\nd e"), (None, "q r s"), (5, " a b c ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    arrays = sources.doc_arrays(spark, str(tmp_path))
    got = [(r.doc_id, x) for r in arrays.collect() for x in r.elements]
    want = [tuple(r) for r in sources.doc_members(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) == 12
    assert all(list(r.elements) == sorted(r.elements) for r in arrays.collect())
    assert "Generate" not in arrays._jdf.queryExecution().optimizedPlan().toString()  # no row per shingle


@pytest.mark.parametrize("block", [1024, 4])
def test_sweep_counts_pairs_where_they_meet(spark, block, monkeypatch):
    """Counts of all entities from representatives, one home in many tiles; no pair is
    shuffled or stored but true ones."""
    stored = {}
    monkeypatch.setattr(lsh, "materialize", lambda df, name, f=lsh.materialize: stored.setdefault(name, f(df, name)))
    fam = families(11, 60)
    fam |= {100 + e: s for e, s in fam.items() if e % 4 == 0} | {200 + e: s for e, s in fam.items() if e % 8 == 0}
    arrays = frame(spark, fam).groupBy("entity").agg(F.sort_array(F.collect_list("element")).alias("elements"))
    classes, reps = sets.representatives(arrays)
    assert reps.count() < len(fam) and classes.count() == len(fam)
    k, configs = 20, [(10, 2), (4, 5), (5, 4), (3, 3), (1, 20)]
    truth = prefix_join.similar_sets(reps, 0.5, block)
    got = lsh.lsh_sweep(minhash.signatures_from_arrays(reps, "entity", "elements", k), truth, F.lit(len(fam)), k, configs, block,
                        lsh.copies_of(classes)).collect()
    sigs = {r.entity: r.sig for r in minhash.signatures_from_arrays(arrays, "entity", "elements", k).collect()}
    true = {(a, b) for a, b, i, u in brute_pairs(fam, 0.5)}
    assert [r.pos for r in got] == [0, 1, 2, 4]
    for r in got:
        want = {(a, b) for a, b in itertools.combinations(sorted(sigs), 2)
                if any(sigs[a][x * r.r:x * r.r + r.r] == sigs[b][x * r.r:x * r.r + r.r] for x in range(r.b))}
        assert (r.candidates, r.tp, r.fp, r.fn) == (len(want), len(want & true), len(want - true), len(true - want))
    assert set(stored) == {"shared-runs", "homes", "truth-met", "candidates", "true"}
    assert stored["candidates"].count() == 1 and set(stored["shared-runs"].columns) == {"entity", "runs", "copies"}


def test_confusion_and_error_of_representatives(spark):
    p = spark.createDataFrame([(1, 2, 0.5), (1, 5, 0.4)], "id1 long, id2 long, estimate double")
    t = spark.createDataFrame([(1, 2, 0.6), (2, 5, 0.3)], "id1 long, id2 long, jaccard double")
    copies = spark.createDataFrame([(1, 3), (2, 2), (5, 1)], "entity long, copies long")
    r = lsh.confusion(p, t, copies).first()
    assert (r.tp, r.fp, r.fn) == (6 + 3 + 1, 3, 2)
    e = lsh.similarity_error(p, t, copies).first()
    assert (e.n, e.mae, e.rmse) == (10, 0.06, round((0.01 * 6 / 10) ** 0.5, 6))
    none = lsh.similarity_error(p.limit(0), t).first()
    assert (none.n, none.mae, none.rmse) == (0, None, None)


def test_least_hash_values_by_wrapping(spark):
    """Values at the ends of [0, p), and sets longer than a piece."""
    p, rng = minhash.MERSENNE_P, random.Random(3)
    family = [(1, 0), (1, p - 1), (p - 1, 0), (p - 1, p - 1), (2, 1), *minhash.hash_family(40)]
    least = minhash.minima_of(family)
    for n in (1, 2, 64, 65, 2049, 5000):
        x = [rng.choice([0, 1, p - 1, p, -1, rng.randint(-2 ** 62, 2 ** 62)]) if n < 99 else rng.randint(0, 2 ** 60) for _ in range(n)]
        assert least(x).tolist() == [min((a * v + b) % p for v in x) for a, b in family]


def test_only_sets_in_pairs_move(spark):
    arrays = spark.createDataFrame([(i, [i, i + 1, 1000 + i % 3]) for i in range(50)], "entity long, elements array<long>")
    found = sets.jaccard_in_cells(spark.createDataFrame([(1, 2), (7, 8)], "id1 long, id2 long"), arrays)
    assert {tuple(r) for r in found.select("id1", "id2", "inter", "union").collect()} == {(1, 2, 1, 5), (7, 8, 1, 5)}
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_document_sets_do_not_move(spark, tmp_path):
    """Only sets of rows that repeat a doc_id are brought together."""
    from affinity import sources

    spark.createDataFrame([(1, "a b c d"), (2, "b c d"), (2, "x y z"), (None, "q r s")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    arrays = sources.doc_arrays(spark, str(tmp_path))
    assert {(r.doc_id, len(r.elements)) for r in arrays.collect()} == {(1, 2), (2, 2), (None, 1)}
    assert "LeftAnti" in arrays._jdf.queryExecution().optimizedPlan().toString()


def test_signatures_are_made_once(spark):
    arrays = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None), (4, [9])], "entity long, elements array<long>")
    sigs = minhash.signatures_from_arrays(arrays, "entity", "elements", 8)
    assert {(r.entity, len(r.sig)) for r in sigs.collect()} == {(1, 8), (4, 8)}
    assert sigs._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
