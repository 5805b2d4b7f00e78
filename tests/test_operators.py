"""Hand-made cases: nulls, zero denominators, thresholds, ties, duplicates."""

import math

import pytest
from pyspark.sql import functions as F

from affinity.operators import clean, distributions, lsh, minhash, pairs, profile, rules, sets


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_null_counts_and_drop(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, 3, None), (4, 5, 6.0)], "a int, b int, c double")
    assert rows(clean.null_counts(df)) == [(1, 1, 1)]
    assert rows(clean.drop_nulls(df)) == [(4, 5, 6.0)]


def test_dedupe_keeps_latest_then_highest(spark):
    df = spark.createDataFrame(
        [(1, 10, 3.0, 100), (1, 10, 4.0, 200), (1, 10, 5.0, 200), (2, 10, 1.0, 5), (2, 10, 1.0, 5)],
        "user_id long, item_id long, rating double, ts long")
    out = clean.dedupe(df, ["user_id", "item_id"], prefer=["ts", "rating"])
    assert out.columns == df.columns
    assert rows(out) == [(1, 10, 5.0, 200), (2, 10, 1.0, 5)]
    assert clean.dedupe(df).count() == 4


def test_clean_report(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 1), (1, 1, 2.0, 2), (2, 2, None, 3)],
                               "user_id long, item_id long, rating double, ts long")
    rep = {r.step: r for r in clean.clean_report(df, ["user_id", "item_id"]).collect()}
    assert (rep["nulls"].rows_before, rep["nulls"].rows_after, rep["nulls"].removed) == (3, 2, 1)
    assert (rep["duplicates"].rows_before, rep["duplicates"].rows_after) == (2, 1)


def test_binarize_threshold_and_null(spark):
    df = spark.createDataFrame([(3.5,), (3.4,), (None,)], "rating double")
    assert [r.binary_rating for r in clean.binarize(df).collect()] == [1, 0, 0]


def test_like_summary_empty_and_format(spark):
    df = spark.createDataFrame([(1,), (1,), (0,)], "binary_rating int")
    r = clean.like_summary(df).collect()[0]
    assert (r.total, r.likes, r.dislikes) == (3, 2, 1)
    assert r.likes_label == "2 (66.67%)"
    empty = spark.createDataFrame([], "binary_rating int")
    e = clean.like_summary(empty).collect()[0]
    assert (e.total, e.likes, e.like_pct) == (0, 0, 0.0)


def test_category_keys_and_canonical(spark):
    items = spark.createDataFrame(
        [(1, "Sci-Fi|Drama"), (2, "SciFi|Drama"), (3, "sci-fi"), (4, "Sci-Fi|Science Fiction"),
         (5, "(no genres listed)"), (6, ""), (7, " Drama ")], "item_id long, genres string")
    m = {r.raw: (r.key, r.canonical) for r in clean.canonical_map(items).collect()}
    assert m["Sci-Fi"][0] == m["SciFi"][0] == m["sci-fi"][0] == "scifi"
    assert m["Sci-Fi"][1] == "Sci-Fi"                     # most frequent spelling
    assert m["Science Fiction"][0] == "scienc fiction"    # a different key
    assert m["(no genres listed)"][0] == "unknown" and m[""][0] == "unknown"
    assert m[" Drama "][1] == "Drama"
    norm = {r.item_id: r.genres for r in clean.normalize_categories(items, clean.canonical_map(items)).collect()}
    assert norm[2] == "Drama|Sci-Fi"
    assert norm[6] == ""                                   # blank returned as is
    assert norm[7] == "Drama"


def test_stem_rules(spark):
    from affinity.functions.text import category_key
    df = spark.createDataFrame([("Comedies",), ("Comedy",), ("Thrillers",), ("Bus",), ("Classes",)], "g string")
    keys = [r[0] for r in df.select(category_key(F.col("g"))).collect()]
    assert keys == ["comedi", "comedi", "thriller", "bus", "class"]


def test_jaccard_boundary_and_identity(spark):
    a = [(1, x) for x in range(7)]
    b = [(2, x) for x in (0, 1, 2, 10, 11, 12)]
    m = spark.createDataFrame(a + b, "entity long, element long")
    j = sets.jaccard_pairs(m).collect()[0]
    assert (j.inter, j.union) == (3, 10) and j.jaccard == pytest.approx(0.3)
    assert sets.jaccard_pairs(m, 0.3).count() == 1          # boundary kept (>=)
    m2 = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2), (3, 3)],
                               "entity long, element long")
    got = {(r.id1, r.id2): r.jaccard for r in sets.jaccard_pairs(m2).collect()}
    assert got == {(1, 2): 1.0, (1, 3): 0.75, (2, 3): 0.75}


def test_pairs_within_hot_group_tiles_every_pair_once(spark):
    members = spark.createDataFrame([(0, i) for i in range(300)] + [(1, 5), (1, 7)], "g long, id long")
    p = pairs.pairs_within_groups(members, ["g"], "id", block=16)
    assert p.count() == 300 * 299 // 2 + 1
    assert p.select("g", "id1", "id2").distinct().count() == p.count()
    assert p.filter(F.col("id1") >= F.col("id2")).count() == 0


def test_minhash_identical_sets_and_estimates(spark):
    m = spark.createDataFrame([(1, x) for x in range(50)] + [(2, x) for x in range(50)] +
                              [(3, x) for x in range(25, 75)], "entity long, element long")
    sig_long = minhash.signatures_long(m, 64)
    sig = minhash.signature_arrays(sig_long)
    est = {(r.id1, r.id2): r.estimate for r in
           minhash.estimate_pairs(spark.createDataFrame([(1, 2), (1, 3)], "id1 long, id2 long"), sig, 64).collect()}
    assert est[(1, 2)] == 1.0
    assert 0.1 < est[(1, 3)] < 0.6                         # true value 1/3
    # per-row (numpy) signatures equal the long-form ones
    arrays = sets.set_arrays(m)
    sig2 = minhash.signatures_from_arrays(arrays, "entity", "elements", 64)
    a = {r.entity: list(r.sig) for r in sig.collect()}
    b = {r.entity: list(r.sig) for r in sig2.collect()}
    assert a == b


def test_lsh_candidates_contain_identical_sets(spark):
    m = spark.createDataFrame([(1, x) for x in range(30)] + [(2, x) for x in range(30)] +
                              [(3, x) for x in range(100, 130)], "entity long, element long")
    sig = minhash.signature_arrays(minhash.signatures_long(m, 20))
    cand = {(r.id1, r.id2) for r in lsh.lsh_candidates(sig, 5, 4).collect()}
    assert (1, 2) in cand and (1, 3) not in cand


def test_confusion_zero_denominators(spark):
    empty = spark.createDataFrame([], "id1 long, id2 long")
    r = lsh.confusion(empty, empty).collect()[0]
    assert (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_rules_hand_made(spark):
    b = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b", "c"]), (3, ["a", "c"])], "basket_id long, items array<string>")
    model = rules.fpgrowth(b, 0.3, 0.1)
    fi = rules.frequent_itemsets(model, 3)
    r = rules.rules_with_lift(rules.association_rules(model).drop("lift"), fi)
    got = {(tuple(x.antecedent), tuple(x.consequent)): x for x in r.collect()}
    ab = got[(("a",), ("b",))]
    assert ab.confidence == pytest.approx(2 / 3) and ab.lift == pytest.approx(1.0)
    assert ab.support == pytest.approx(2 / 3)
    cb = got[(("c",), ("b",))]
    assert cb.confidence == pytest.approx(0.5) and cb.lift == pytest.approx(0.75)
    assert cb.support == pytest.approx(1 / 3)


def test_strength_labels(spark):
    df = spark.createDataFrame([(1.6,), (1.3,), (1.1,), (1.0,)], "lift double")
    assert [r.strength for r in rules.strength_label(df).collect()] == ["very strong", "strong", "moderate", "weak"]


def test_baskets_size_guard_and_dups(spark):
    df = spark.createDataFrame([(1, "x", 4.0), (1, "x", 5.0), (1, "y", 4.0), (2, "x", 4.0), (3, "z", 1.0)],
                               "user_id long, item_id string, rating double")
    out = {r.basket_id: list(r.items) for r in rules.baskets(df, max_size=220).collect()}
    assert out == {1: ["x", "y"]}


def test_titles_fallback_and_sequels(spark):
    r = spark.createDataFrame([(["1"], ["2"], 0.5, 1.3), (["1"], ["3"], 0.5, 1.2)],
                              "antecedent array<string>, consequent array<string>, confidence double, lift double")
    titles = spark.createDataFrame([("1", "Toy Story 1"), ("2", "Toy Story 2")], "item_id string, title string")
    named = {tuple(x.consequent): x for x in rules.attach_titles(r, titles).collect()}
    assert named[("3",)].consequent_titles == ["ID:3"]
    kept = rules.without_sequels(rules.attach_titles(r, titles), 0.85).collect()
    assert [tuple(x.consequent) for x in kept] == [("3",)]


def test_top_share_and_histogram(spark):
    act = spark.createDataFrame([(i, n) for i, n in enumerate([10, 5, 5, 1, 1, 1, 1, 1, 1, 1])],
                                "user_id long, num_ratings long")
    r = distributions.top_share(act).collect()[0]
    # n=10 -> index 2 -> first 3 users hold 20 of 27
    assert r.top_users == 3 and r.top_share_pct == pytest.approx(100 * 20 / 27, abs=1e-6)
    h = distributions.equal_width_histogram(act, "num_ratings", 3).collect()
    assert [x["count"] for x in sorted(h, key=lambda x: x.bin)] == [7, 2, 1]


def test_sparsity(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "user_id long, item_id long")
    r = profile.sparsity(df).collect()[0]
    assert (r.num_users, r.num_items, r.possible) == (2, 2, 4)
    assert r.density_pct == 75.0 and math.isclose(r.sparsity_pct, 25.0)


def test_normalize_categories_keeps_blank_and_repeated_rows(spark):
    from affinity.operators import clean

    items = spark.createDataFrame([(1, "a", "X|x"), (1, "a", "X|x"), (2, "b", ""), (3, "c", None)],
                                  "item_id long, title string, genres string")
    mapping = spark.createDataFrame([("X", "X"), ("x", "X")], "raw string, canonical string")
    rows = sorted(clean.normalize_categories(items, mapping).collect(), key=lambda r: (r.item_id, r.title))
    assert [(r.item_id, r.genres) for r in rows] == [(1, "X"), (1, "X"), (2, ""), (3, None)]


def test_titles_of_ids_that_hold_the_separator(spark):
    from affinity.operators import rules

    r = spark.createDataFrame([(["a|b"], ["c"]), (["a", "b"], ["c"])],
                              "antecedent array<string>, consequent array<string>")
    titles = spark.createDataFrame([("a", "A"), ("b", "B"), ("a|b", "AB"), ("c", "C")], "item_id string, title string")
    got = {tuple(x.antecedent): x.antecedent_titles for x in rules.attach_titles(r, titles).collect()}
    assert got == {("a|b",): ["AB"], ("a", "b"): ["A", "B"]}


def test_minhash_of_ids_above_32_bits(spark):
    from affinity.functions.hashing import hash_family, hash_sample_predicate
    from affinity.operators import minhash
    from affinity.params import MERSENNE_P
    from pyspark.sql import functions as F

    ids = [5_000_000_007, 10**12, 7, 2**60 - 1]
    want = [min((a * x + b) % MERSENNE_P for x in ids) for a, b in hash_family(8)]
    members = spark.createDataFrame([(1, x) for x in ids], "entity long, element long")
    got = minhash.signatures_long(members, k=8).orderBy("h").collect()
    assert [r.v for r in got] == want
    arrays = members.groupBy("entity").agg(F.collect_list("element").alias("elements"))
    flat = minhash.signatures_to_long(minhash.signatures_from_arrays(arrays, "entity", "elements", k=8))
    assert [r.v for r in flat.orderBy("h").collect()] == want
    members.filter(hash_sample_predicate(F.col("element"), 0.5)).count()


def test_components(spark):
    from affinity.operators.components import connected_components

    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 5), (9, 8), (8, 7), (7, 6), (1, 1), (None, 2)], "id1 long, id2 long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 6: 6, 7: 6, 8: 6, 9: 6}
    assert connected_components(edges.limit(0)).count() == 0


def test_error_by_k_has_a_row_per_k_without_overlap(spark):
    from affinity.operators.minhash import error_by_k
    exact = spark.createDataFrame([], "id1 int, id2 int, jaccard double")
    sigs = spark.createDataFrame([(1, [1, 2]), (2, [3, 4])], "entity int, sig array<bigint>")
    rows = error_by_k(exact, sigs, F.lit(2), [1, 2]).orderBy("k").collect()
    assert [(r.k, r.mean_error, r.overlapping_pairs) for r in rows] == [(1, 0.0, 0), (2, 0.0, 0)]
