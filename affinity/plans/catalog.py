"""Every implemented operator as a query over the fixture tables.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame whose columns
are named exactly as in the SQL twin (``oracle.py``).  Arrays are returned
as '|'-joined strings of the sorted items, doubles rounded to 6 digits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources as src
from ..functions.hashing import hash_family
from ..operators import (clean, distributions as dist, lsh, minhash, prefix_join, profile, rules, sampling, sets,
                         sketches, vectors)
from ..params import DEFAULTS, profile as named_profile
from ..session import checkpoint_root, materialize

P = DEFAULTS
K = P["k_values"][-1]                 # 200 hashes
LSH_B, LSH_R = 50, 4                  # the configuration used for candidates
DOC_THRESHOLD = P["similarity_threshold"]
RULE_SUPPORT = 0.2                    # customer x brand baskets (see FIXTURES.md)


# ---------------------------------------------------------------- inputs
def clean_interactions(spark, sf):
    return clean.dedupe(clean.drop_nulls(src.interactions(spark, sf)), ["user_id", "item_id"],
                        prefer=["ts", "rating"])


def liked_members(spark, sf):
    """item x customer sets from positive interactions."""
    return sets.set_members(src.interactions(spark, sf), "item_id", "user_id", "rating",
                            P["rating_threshold"])


def doc_members(spark, sf):
    return src.doc_members(spark, sf).withColumnRenamed("doc_id", "entity")


def saved_doc_arrays(spark, sf):
    """documents' sets in rows (entity, elements), written once to the shared
    checkpoint folder: the shingling runs once and every branch (signatures,
    exact truth, counts) reads the saved table."""
    return materialize(src.doc_arrays(spark, sf).withColumnRenamed("doc_id", "entity"), "doc-arrays")


def representatives(arrays):
    """(entity, rep) of equal sets, stored, and the sets of the representatives."""
    return sets.representatives(arrays)


def _n_entities(members: DataFrame):
    return members.select(F.count_distinct("entity")).scalar()


def brand_baskets(spark, sf, max_size=None):
    bi = src.brand_interactions(spark, sf)
    return rules.baskets(bi, "user_id", "brand", "rating", P["rating_threshold"],
                         P["basket_min"], max_size)


def _model(spark, sf):
    # counted, and read several times by the fit
    b = materialize(brand_baskets(spark, sf), "baskets")
    n = b.select(F.count(F.lit(1))).scalar()
    model = rules.fpgrowth(b, RULE_SUPPORT, P["min_confidence"])
    return model, n


def brand_rules(spark, sf):
    model, n = _model(spark, sf)
    itemsets = rules.frequent_itemsets(model, n)
    return rules.rules_with_lift(rules.association_rules(model).drop("lift"), itemsets)


def _join(c):
    return F.array_join(c, "|")


def _rule_cols(df, *more):
    return df.select(_join("antecedent").alias("antecedent"), _join("consequent").alias("consequent"),
                     F.round("confidence", 6).alias("confidence"), F.round("lift", 6).alias("lift"),
                     F.round("support", 6).alias("support"), *more)


def brand_titles(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return part.groupBy(F.col("p_brand").alias("item_id")).agg(F.min("p_name").alias("title"))


# ---------------------------------------------------------------- A: scans
def q_scan_interactions(spark, sf):
    return src.interactions(spark, sf)


def q_scan_items(spark, sf):
    return src.items(spark, sf)


def q_scan_tags(spark, sf):
    return src.tags(spark, sf)


def q_preview(spark, sf):
    return profile.top_k(src.interactions(spark, sf), 20, "user_id", "item_id", "ts", "rating")


# ---------------------------------------------------------------- B: cleaning
def q_null_counts(spark, sf):
    return clean.null_counts(src.raw_interactions(spark, sf))


def q_drop_nulls(spark, sf):
    return clean.drop_nulls(src.raw_interactions(spark, sf))


def q_dedupe_keys(spark, sf):
    return clean_interactions(spark, sf)


def q_dedupe_rows(spark, sf):
    return clean.dedupe(src.raw_interactions(spark, sf))


def q_clean_report(spark, sf):
    return clean.clean_report(src.raw_interactions(spark, sf), ["user_id", "item_id"],
                              prefer=["ts", "rating"])


def _binary(spark, sf):
    return clean.binarize(clean_interactions(spark, sf), "rating", P["rating_threshold"])


def q_binarize(spark, sf):
    return _binary(spark, sf)


def q_binary_distribution(spark, sf):
    return clean.binary_distribution(_binary(spark, sf))


def q_like_summary(spark, sf):
    return clean.like_summary(_binary(spark, sf))


def q_liked(spark, sf):
    return clean.liked(clean_interactions(spark, sf), "rating", P["rating_threshold"])


def q_explode_genres(spark, sf):
    return clean.explode_categories(src.items(spark, sf))


def q_canonical_map(spark, sf):
    return clean.canonical_map(src.items_with_variants(spark, sf))


def _normalized(spark, sf):
    raw = src.items_with_variants(spark, sf)
    return clean.normalize_categories(raw, clean.canonical_map(raw))


def q_normalize_genres(spark, sf):
    return _normalized(spark, sf)


def q_genre_report(spark, sf):
    return clean.category_report(src.items_with_variants(spark, sf), _normalized(spark, sf))


def q_contains_filter(spark, sf):
    return clean.contains_any(_normalized(spark, sf), "genres", ["ring", "Ring"])


def _genre_activity(spark, sf):
    return profile.category_activity(clean_interactions(spark, sf), src.items(spark, sf))


def q_genre_niches(spark, sf):
    return profile.category_niches(_genre_activity(spark, sf), P["niche_min_ratings"],
                                   P["niche_bubble_scale"])


# ---------------------------------------------------------------- D: aggregates
def _user_activity(spark, sf):
    return profile.user_activity(clean_interactions(spark, sf))


def _item_activity(spark, sf):
    return profile.item_activity(clean_interactions(spark, sf), src.items(spark, sf)).withColumn(
        "avg_rating", F.round("avg_rating", 6))


def q_user_activity(spark, sf):
    return _user_activity(spark, sf)


def q_item_activity(spark, sf):
    return _item_activity(spark, sf)


def q_user_activity_stats(spark, sf):
    return profile.describe_counts(_user_activity(spark, sf))


def q_item_activity_stats(spark, sf):
    return profile.describe_counts(_item_activity(spark, sf))


def q_rating_stats(spark, sf):
    return profile.rating_stats(clean_interactions(spark, sf))


def q_rating_distribution(spark, sf):
    return profile.rating_distribution(clean_interactions(spark, sf))


def _quality(spark, sf, min_ratings=0):
    return profile.item_quality(_binary(spark, sf), src.items(spark, sf), min_ratings=min_ratings)


def q_item_quality(spark, sf):
    return _quality(spark, sf)


def q_item_quality_min50(spark, sf):
    return _quality(spark, sf, P["quality_min_ratings"])


def q_genre_supply(spark, sf):
    return profile.category_supply(src.items(spark, sf))


def q_genre_activity(spark, sf):
    return _genre_activity(spark, sf)


def q_sparsity(spark, sf):
    return profile.sparsity(clean_interactions(spark, sf))


def q_item_counts_topk(spark, sf):
    return profile.item_counts_topk(clean_interactions(spark, sf), P["top_k"])


def q_pareto_curve(spark, sf):
    return dist.concentration_curve(_user_activity(spark, sf))


def q_pareto_top20(spark, sf):
    return dist.top_share(_user_activity(spark, sf), share=P["pareto_share"])


def q_histogram(spark, sf):
    return dist.equal_width_histogram(_user_activity(spark, sf), "num_ratings", P["histogram_bins"])


def _item_set_sizes(spark, sf):
    return sets.set_sizes(liked_members(spark, sf))


def q_log_histogram(spark, sf):
    return dist.log_histogram(_item_set_sizes(spark, sf), "set_size", P["log_bins"])


def q_sample_fidelity(spark, sf):
    full = _item_set_sizes(spark, sf)
    sample = profile.hash_sample(full, "entity", P["sample_fraction"], P["sample_seed"])
    return dist.sample_fidelity(full, sample, "set_size", P["log_bins"])


def q_boxplot_stats(spark, sf):
    return dist.boxplot_stats(_user_activity(spark, sf))


def q_density_2d(spark, sf):
    return dist.density_2d(_item_activity(spark, sf), grid=P["density_grid"])


# ---------------------------------------------------------------- E: top-k, sampling
def q_top_items_sql(spark, sf):
    return profile.top_items_sql(clean_interactions(spark, sf), src.items(spark, sf), P["top_k"])


def q_top_users(spark, sf):
    return profile.top_k(_user_activity(spark, sf), 10, F.col("num_ratings").desc(), "user_id")


def q_top_items(spark, sf):
    return profile.top_k(_item_activity(spark, sf), 10, F.col("num_ratings").desc(), "item_id")


def q_bottom_items(spark, sf):
    return profile.top_k(_item_activity(spark, sf), 10, F.col("num_ratings").asc(), "item_id")


def q_top_quality(spark, sf):
    return profile.top_k(_quality(spark, sf), P["quality_top_k"], F.col("approval_pct").desc(),
                         F.col("total_ratings").desc(), "item_id")


def q_top_genres_demand(spark, sf):
    return profile.top_k(_genre_activity(spark, sf), 10, F.col("num_ratings").desc(), "genre")


def q_top_genres_supply(spark, sf):
    return profile.top_k(profile.category_supply(src.items(spark, sf)), 10,
                         F.col("num_items").desc(), "genre")


def q_hash_sample(spark, sf):
    return profile.hash_sample(_item_set_sizes(spark, sf), "entity", P["sample_fraction"],
                               P["sample_seed"])


# ---------------------------------------------------------------- G: similarity
def q_item_sets(spark, sf):
    it = src.items(spark, sf).select(F.col("item_id").alias("entity"), "title")
    return _item_set_sizes(spark, sf).join(it, "entity", "left").select(
        F.col("entity").alias("item_id"), "title", "set_size")


def q_user_sets(spark, sf):
    m = sets.set_members(src.interactions(spark, sf), "user_id", "item_id", "rating",
                         P["rating_threshold"])
    return sets.set_sizes(m).select(F.col("entity").alias("user_id"), "set_size")


def q_tag_sets(spark, sf):
    m = sets.set_members(src.tags(spark, sf), "item_id", "tag")
    return sets.set_sizes(m).select(F.col("entity").alias("item_id"), "set_size")


def _jaccard_out(df):
    return df.select("id1", "id2", "inter", "union", F.round("jaccard", 6).alias("jaccard"))


def q_jaccard_pairs(spark, sf):
    return _jaccard_out(sets.jaccard_pairs(liked_members(spark, sf)))


def q_top_jaccard(spark, sf):
    return sets.top_pairs(prefix_join.top_jaccard(liked_members(spark, sf), 20), src.items(spark, sf), 20)


def _item_sigs(spark, sf):
    return minhash.signatures_long(liked_members(spark, sf), K, P["hash_seed"])


def q_minhash_signatures(spark, sf):
    return _item_sigs(spark, sf)


def q_item_lsh_candidates(spark, sf):
    """banded candidates of the item x customer sets (long-form signatures)."""
    return lsh.lsh_candidates(minhash.signature_arrays(_item_sigs(spark, sf)), LSH_B, LSH_R)


def _item_estimates(spark, sf):
    m = liked_members(spark, sf)
    sig = minhash.signature_arrays(minhash.signatures_long(m, K, P["hash_seed"]))
    return minhash.estimate_pairs(sets.jaccard_pairs(m).select("id1", "id2", "jaccard"), sig, K, hash_family(K, P["hash_seed"]))


def q_minhash_estimate(spark, sf):
    return _item_estimates(spark, sf).select("id1", "id2", F.round("jaccard", 6).alias("jaccard"),
                                             F.round("estimate", 6).alias("estimate"))


def q_minhash_error_by_k(spark, sf):
    m = liked_members(spark, sf)
    sig = minhash.signature_arrays(minhash.signatures_long(m, K, P["hash_seed"]))
    return minhash.error_by_k(sets.jaccard_pairs(m), sig, _n_entities(m), P["k_values"], hash_family(K, P["hash_seed"]))


def q_minhash_report(spark, sf):
    return minhash.error_report(_item_estimates(spark, sf))


def q_minhash_error_hist(spark, sf):
    e = _item_estimates(spark, sf).select(F.abs(F.col("estimate") - F.col("jaccard")).alias("error"))
    return dist.equal_width_histogram(e, "error", 20)


def q_minhash_error_by_entity(spark, sf):
    m = liked_members(spark, sf)
    return minhash.error_by_entity(_item_estimates(spark, sf), _n_entities(m), m.select("entity").distinct())


def q_doc_sets(spark, sf):
    return sets.set_sizes(doc_members(spark, sf)).select(F.col("entity").alias("doc_id"), "set_size")


def _doc_study(spark, sf, threshold=DOC_THRESHOLD):
    """Documents' sets, those of representatives of equal sets, how many documents
    these stand for, and their true pairs.  Copies bring no pairs here, only weights."""
    m = saved_doc_arrays(spark, sf)
    classes, reps = representatives(m)
    # pairs that share a common shingle grow with the square of the documents: prefixes leave them out
    truth = materialize(prefix_join.similar_sets(reps, threshold).select("id1", "id2", "jaccard"), "truth")
    return m, reps, materialize(lsh.copies_of(classes), "copies"), truth


def q_doc_similar_pairs(spark, sf):
    return _jaccard_out(prefix_join.similar_entities(saved_doc_arrays(spark, sf), DOC_THRESHOLD))


def doc_sigs(m, k=K):
    """document signatures: each document's shingle ids in one row (a set
    bounded by the text length), hashed there by numpy."""
    arrays = m if "elements" in m.columns else sets.set_arrays(m)
    return minhash.signatures_from_arrays(arrays, "entity", "elements", k, P["hash_seed"])


def q_doc_signatures(spark, sf):
    return minhash.signatures_to_long(doc_sigs(saved_doc_arrays(spark, sf)))


def q_lsh_candidates(spark, sf):
    classes, reps = representatives(saved_doc_arrays(spark, sf))
    return sets.of_all_entities(lsh.lsh_candidates(materialize(doc_sigs(reps), "signatures"), LSH_B, LSH_R), classes)


def _sweep(spark, sf, p=P):
    m, reps, copies, truth = _doc_study(spark, sf, p["similarity_threshold"])
    k = p["k_values"][-1]
    return lsh.lsh_sweep(doc_sigs(reps, k), truth, _n_entities(m), k, p["lsh_configs"], copies=copies)


def q_lsh_sweep(spark, sf):
    return _sweep(spark, sf)


def q_lsh_best(spark, sf):
    return lsh.best_config(_sweep(spark, sf))


def _predicted(reps):
    return lsh.predicted_pairs(materialize(doc_sigs(reps), "signatures"), LSH_B, LSH_R, K, DOC_THRESHOLD)


def q_lsh_confusion(spark, sf):
    _, reps, copies, truth = _doc_study(spark, sf)
    return lsh.confusion(_predicted(reps), truth, copies)


def q_similarity_error(spark, sf):
    _, reps, copies, truth = _doc_study(spark, sf)
    return lsh.similarity_error(_predicted(reps), truth, copies)


def q_similar_items(spark, sf):
    classes, reps = representatives(saved_doc_arrays(spark, sf))
    found = lsh.similar_pairs(materialize(doc_sigs(reps), "signatures"), reps, LSH_B, LSH_R, K, DOC_THRESHOLD)
    return _jaccard_out(sets.of_all_entities(found, classes, prefix_join.own_values(reps)))


def q_mllib_similar_pairs(spark, sf):
    classes, reps = representatives(saved_doc_arrays(spark, sf))
    found = lsh.mllib_similar_pairs(reps, P["mllib_tables"], P["mllib_distance"], P["hash_seed"])
    same = reps.select(F.col("entity").alias("rep"), F.lit(1.0).alias("jaccard"))
    return sets.of_all_entities(found, classes, same)


# ---------------------------------------------------------------- H: rules
def q_baskets(spark, sf):
    return brand_baskets(spark, sf).select("basket_id", _join("items").alias("items"), "n_items")


def q_baskets_guarded(spark, sf):
    return (brand_baskets(spark, sf, P["basket_guard"])
            .select("basket_id", _join("items").alias("items"), "n_items"))


def q_user_funnel(spark, sf):
    return rules.user_funnel(src.brand_interactions(spark, sf), "user_id", "brand", "rating",
                             P["rating_threshold"], P["basket_min"], P["basket_max"])


def q_frequent_itemsets(spark, sf):
    model, n = _model(spark, sf)
    fi = rules.frequent_itemsets(model, n)
    return fi.select(_join("items").alias("items"), "size", "freq",
                     F.round("support", 6).alias("support"))


def q_association_rules(spark, sf):
    model, _ = _model(spark, sf)
    return _rule_cols(rules.association_rules(model))


def q_rules_lift(spark, sf):
    return _rule_cols(brand_rules(spark, sf), F.round("consequent_support", 6).alias("consequent_support"))


def _relevant(spark, sf):
    return rules.relevant_rules(brand_rules(spark, sf), P["relevant_confidence"], P["relevant_lift"])


def q_top_rules(spark, sf):
    return _rule_cols(rules.top_rules(_relevant(spark, sf), 10))


def q_rules_without_sequels(spark, sf):
    titles = spark.read.parquet(f"{sf}/part.parquet").select(
        F.col("p_brand").alias("item_id"), F.col("p_brand").alias("title")).distinct()
    named = rules.attach_titles(_relevant(spark, sf), titles)
    kept = rules.without_sequels(named, P["sequel_similarity"])
    return _rule_cols(rules.top_rules(kept, 10), "max_title_similarity")


def q_rule_titles(spark, sf):
    named = rules.attach_titles(brand_rules(spark, sf), brand_titles(spark, sf))
    return named.select(_join("antecedent").alias("antecedent"), _join("consequent").alias("consequent"),
                        _join("antecedent_titles").alias("antecedent_titles"),
                        _join("consequent_titles").alias("consequent_titles"))


def q_rule_strength(spark, sf):
    return _rule_cols(rules.strength_label(brand_rules(spark, sf)), "strength")


def q_recommendations(spark, sf):
    r = rules.recommendations(brand_rules(spark, sf), 5)
    return r.select("item", "recommended", F.round("confidence", 6).alias("confidence"),
                    F.round("lift", 6).alias("lift"), "rank")


def q_rule_stats(spark, sf):
    return rules.rule_stats(brand_rules(spark, sf))


def q_rule_graph_edges(spark, sf):
    return rules.rule_graph_edges(_relevant(spark, sf))


def q_rule_graph_strong(spark, sf):
    """Edges of the rules that the graph cells draw."""
    return rules.rule_graph_edges(rules.relevant_rules(brand_rules(spark, sf), P["relevant_confidence"], P["graph_lift"]))


def q_itemset_bitmaps(spark, sf):
    """Itemsets with their frequency by FP-growth and by basket bitmaps."""
    baskets = materialize(brand_baskets(spark, sf), "baskets")
    n = baskets.select(F.count(F.lit(1))).scalar()
    found = rules.frequent_itemsets(rules.fpgrowth(baskets, RULE_SUPPORT, P["min_confidence"]), n)
    return rules.bitmap_supports(found, rules.basket_bitmaps(baskets)).select(
        _join("items").alias("items"), "size", "freq", "bitmap_freq")


def q_order_itemsets(spark, sf):
    """Brands that are ordered together, at the support of the defaults."""
    baskets = materialize(rules.baskets(src.order_baskets(spark, sf), "order_id", "brand", None, None, P["basket_min"]), "baskets")
    n = baskets.select(F.count(F.lit(1))).scalar()
    found = rules.frequent_itemsets(rules.fpgrowth(baskets, P["min_support"], P["min_confidence"]), n)
    return found.select(_join("items").alias("items"), "size", "freq", F.round("support", 6).alias("support"))


# ---------------------------------------------------------------- checked scans, sketches, samples
def q_csv_rejects(spark, sf):
    """Interactions written as CSV lines, some broken, and read with a check."""
    folder = f"{checkpoint_root(spark)}/affinity-{spark.sparkContext.applicationId}/lines-{uuid.uuid4().hex}"
    src.interaction_lines(spark, sf).write.text(folder)
    return src.reject_report(src.read_checked(spark, folder, src.get_schemas()[0], header=False))


def _rated_genres(spark, sf):
    return clean_interactions(spark, sf).join(clean.explode_categories(src.items(spark, sf)), "item_id").select(
        "genre", "user_id", "rating")


def q_distinct_users(spark, sf):
    """Distinct users per genre and in all, and whether the sketches agree."""
    return sketches.distinct_report(_rated_genres(spark, sf), "genre", "user_id")


def q_activity_quantiles(spark, sf):
    """Quantiles of set sizes per tenth of the items, and of all by merged sketches."""
    rows = _item_set_sizes(spark, sf).withColumn("part", (F.col("entity") % 10).cast("int"))
    return sketches.quantile_report(rows, "part", "set_size", [0.05, 0.25, 0.5, 0.75, 0.95])


def _sampled_items(spark, sf):
    rows = _item_activity(spark, sf).join(src.items(spark, sf).select("item_id", F.get(F.split("genres", "\\|"), 0).alias("stratum")), "item_id")
    return rows.select("item_id", "stratum", "num_ratings")


def q_stratified_sample(spark, sf):
    return sampling.stratified_sample(_sampled_items(spark, sf), "stratum", "item_id", P["top_k"], P["sample_seed"])


def q_sample_distance(spark, sf):
    rows = _sampled_items(spark, sf)
    sample = sampling.stratified_sample(rows, "stratum", "item_id", P["top_k"], P["sample_seed"])
    return sampling.largest_distance(rows, sample, "num_ratings")


def q_density_hex(spark, sf):
    return dist.density_hex(_item_activity(spark, sf), grid=P["density_grid"])


def q_item_quality_few(spark, sf):
    return _quality(spark, sf, P["quality_few_ratings"])


# ---------------------------------------------------------------- thresholded joins, vectors, profiles
#: Similarity of items that share customers; none of the fixtures' reach 0.3.
ITEM_THRESHOLD = 0.1


def q_jaccard_at_least(spark, sf):
    return _jaccard_out(prefix_join.jaccard_at_least(liked_members(spark, sf), ITEM_THRESHOLD))


def q_feature_vectors(spark, sf):
    """Sparse vectors of the tags' sets, as text."""
    m = sets.set_members(src.tags(spark, sf), "user_id", "item_id")
    return vectors.feature_vectors(m).select("entity", F.col("features").cast("string").alias("features"))


def q_user_tag_sets(spark, sf):
    """Sets of users and tags together, each as an element of its own kind."""
    return sets.set_sizes(sets.mixed_members(src.interactions(spark, sf), src.tags(spark, sf), P["rating_threshold"])).select(
        F.col("entity").alias("item_id"), "set_size")


def q_lsh_sweep_quick(spark, sf):
    return _sweep(spark, sf, named_profile("quick"))


def q_lsh_sweep_full(spark, sf):
    return _sweep(spark, sf, named_profile("full"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_top_items_sql(spark, sf_dir)
