"""Baskets, frequent itemsets (MLlib FP-Growth), association rules and their
reports.

Baskets are sets (an item appears once).  Their size is guarded before any
array is built: sizes come from a distinct count per basket, so only baskets
within [min_size, max_size] are ever collected into arrays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import title_similarity
from ..session import checkpoint_root, materialize

#: Groups of items that FP-growth deals trees by (the analysed project's number).  A
#: basket goes to each group it has items of, up to the last of them, so more groups
#: are more copies of the baskets but hardly smaller trees.
TREE_PARTITIONS = 4


def baskets(df: DataFrame, user: str = "user_id", item: str = "item_id",
            rating: str | None = "rating", threshold: float | None = 3.5,
            min_size: int = 2, max_size: int | None = None) -> DataFrame:
    """(basket_id, items array, n_items) of positive interactions per user, of
    min_size items or more.  ``max_size`` is a guard that drops larger baskets;
    without it none is dropped."""
    if rating is not None and threshold is not None:
        df = df.filter(F.col(rating) >= threshold)
    pairs = df.select(F.col(user).alias("basket_id"), F.col(item).alias("item")).filter(
        F.col("item").isNotNull())
    if max_size is None:
        return (pairs.groupBy("basket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
                .withColumn("n_items", F.size("items")).filter(F.col("n_items") >= min_size))
    pairs = pairs.distinct()
    sizes = (pairs.groupBy("basket_id").agg(F.count(F.lit(1)).alias("n_items"))
             .filter(F.col("n_items") >= min_size))
    if max_size is not None:
        sizes = sizes.filter(F.col("n_items") <= max_size)
    kept = pairs.join(sizes.select("basket_id"), "basket_id", "left_semi")
    return kept.groupBy("basket_id").agg(F.array_sort(F.collect_list("item")).alias("items")).withColumn(
        "n_items", F.size("items"))


def user_funnel(df: DataFrame, user: str = "user_id", item: str = "item_id",
                rating: str = "rating", threshold: float = 3.5,
                min_size: int = 2, max_size: int = 220) -> DataFrame:
    """Users kept at each step towards usable baskets: all users, users with
    a positive interaction, size > 1, size <= max_size; users lost per step
    and percent lost (0 when the previous step is empty)."""
    per_user = df.groupBy(user).agg(
        F.count_distinct(F.when(F.col(rating) >= threshold, F.col(item))).alias("_pos"))
    c = per_user.agg(
        F.count(F.lit(1)).alias("s1"),
        F.count(F.when(F.col("_pos") >= 1, 1)).alias("s2"),
        F.count(F.when(F.col("_pos") >= min_size, 1)).alias("s3"),
        F.count(F.when(F.col("_pos").between(min_size, max_size), 1)).alias("s4"))
    steps = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("all users").alias("stage"), F.col("s1").alias("users"),
                 F.col("s1").alias("_prev")),
        F.struct(F.lit(2).alias("step"), F.lit("with positive interactions").alias("stage"),
                 F.col("s2").alias("users"), F.col("s1").alias("_prev")),
        F.struct(F.lit(3).alias("step"), F.lit(f"basket size >= {min_size}").alias("stage"),
                 F.col("s3").alias("users"), F.col("s2").alias("_prev")),
        F.struct(F.lit(4).alias("step"), F.lit(f"basket size <= {max_size}").alias("stage"),
                 F.col("s4").alias("users"), F.col("s3").alias("_prev")))
    out = c.select(F.inline(steps))
    lost = F.col("_prev") - F.col("users")
    return out.select("step", "stage", "users", lost.alias("lost"),
                      F.round(F.when(F.col("_prev") > 0, 100.0 * lost / F.col("_prev")).otherwise(0.0), 6)
                      .alias("pct_lost"))


def fpgrowth(basket_df: DataFrame, min_support: float = 0.03, min_confidence: float = 0.1,
             num_partitions: int = TREE_PARTITIONS):
    """Fit MLlib FP-Growth (parallel FP-growth on the executors); stored.

    A fitted model is lazy: each use of its itemsets (by itself, and twice by its
    rules) would grow all trees again.  So it is written to the shared
    checkpoint folder once and read back.
    """
    from pyspark.ml.fpm import FPGrowth, FPGrowthModel

    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                     numPartitions=num_partitions).fit(basket_df.select("items"))
    spark = basket_df.sparkSession
    path = f"{checkpoint_root(spark)}/affinity-{spark.sparkContext.applicationId}/fp-growth-{uuid.uuid4().hex}"
    model.write().save(path)
    return FPGrowthModel.load(path)


def frequent_itemsets(model, n_baskets) -> DataFrame:
    """(items sorted array, size, freq, support)."""
    fi = model.freqItemsets
    return fi.select(F.array_sort("items").alias("items"), F.size("items").alias("size"),
                     F.col("freq"), (F.col("freq") / n_baskets).alias("support"))


def association_rules(model) -> DataFrame:
    """(antecedent sorted array, consequent array, confidence, lift, support)
    with MLlib's exact rule support."""
    r = model.associationRules
    return r.select(F.array_sort("antecedent").alias("antecedent"),
                    F.array_sort("consequent").alias("consequent"),
                    "confidence", "lift", "support")


def rules_with_lift(rules: DataFrame, itemsets: DataFrame) -> DataFrame:
    """Rules + support of the consequent item and lift recomputed from it
    (lift = confidence / consequent support)."""
    single = itemsets.filter(F.col("size") == 1).select(
        F.col("items")[0].alias("_c"), F.col("support").alias("consequent_support"))
    r = rules.withColumn("_c", F.col("consequent")[0])
    return (r.join(single, "_c", "left")
            .withColumn("lift", F.col("confidence") / F.col("consequent_support"))
            .drop("_c"))


def relevant_rules(rules: DataFrame, min_confidence: float = 0.2, min_lift: float = 1.0) -> DataFrame:
    return rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") > min_lift))


def basket_bitmaps(basket_df: DataFrame) -> DataFrame:
    """(item, bucket, bits): which baskets hold an item, as bitmaps of 32,768
    baskets each.  Baskets are numbered densely by range partitions, so the
    bitmaps of a bucket belong to neighbouring baskets; stored."""
    from .vectors import dense_index

    numbered = basket_df.join(dense_index(basket_df, "basket_id").withColumnRenamed("element", "basket_id"), "basket_id")
    rows = numbered.select(F.explode("items").alias("item"), "index")
    return materialize(rows.groupBy("item", F.bitmap_bucket_number(F.col("index")).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("index"))).alias("bits")), "bitmaps")


def bitmap_supports(itemsets: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``itemsets`` with ``bitmap_freq``: the baskets that hold all their items, by
    the intersection of the items' bitmaps, bucket by bucket."""
    keyed = itemsets.withColumn("_set", F.array_join(F.col("items").cast("array<string>"), "\x1f"))
    met = (keyed.select("_set", F.size("items").alias("_n"), F.explode("items").alias("item")).join(bitmaps, "item")
           .groupBy("_set", "_n", "bucket").agg(F.count(F.lit(1)).alias("_k"), F.bitmap_and_agg("bits").alias("bits"))
           .filter("_k = _n"))  # an item without a bitmap here is in none of the bucket's baskets
    found = met.groupBy("_set").agg(F.sum(F.bitmap_count("bits")).alias("bitmap_freq"))
    return keyed.join(found, "_set", "left").na.fill(0, ["bitmap_freq"]).drop("_set")


def _key(c):
    return F.array_join(c.cast("array<string>"), "|")


def top_rules(rules: DataFrame, k: int = 10) -> DataFrame:
    """Global top-k by lift (ties: confidence, then the item lists)."""
    return rules.orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                         _key(F.col("antecedent")), _key(F.col("consequent"))).limit(k)


def strength_label(rules: DataFrame) -> DataFrame:
    """Lift band: > 1.5 very strong, > 1.2 strong, > 1.0 moderate, else weak."""
    lift = F.col("lift")
    label = (F.when(lift > 1.5, "very strong").when(lift > 1.2, "strong")
             .when(lift > 1.0, "moderate").otherwise("weak"))
    return rules.withColumn("strength", label)


def attach_titles(rules: DataFrame, titles: DataFrame, id_col: str = "item_id",
                  title: str = "title") -> DataFrame:
    """Rules with ``antecedent_titles`` / ``consequent_titles`` arrays in
    item order; ids without a title show as 'ID:<id>'.  Titles are joined
    per exploded item (a left join with the dimension), not looked up in a
    driver dictionary."""
    t = titles.select(F.col(id_col).cast("string").alias("_item"), F.col(title).alias("_title"))
    # a rule is identified by its item lists (rules are unique by them)
    r = rules.withColumn("_rid", F.struct("antecedent", "consequent"))
    out = r
    for side in ("antecedent", "consequent"):
        ex = (r.select("_rid", F.posexplode(side).alias("_pos", "_item"))
              .withColumn("_item", F.col("_item").cast("string"))
              .join(t, "_item", "left")
              .withColumn("_t", F.coalesce("_title", F.concat(F.lit("ID:"), F.col("_item")))))
        named = ex.groupBy("_rid").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_t"))), lambda s: s["_t"])
            .alias(f"{side}_titles"))
        out = out.join(named, "_rid", "left")
    return out.drop("_rid")


def without_sequels(rules: DataFrame, max_similarity: float = 0.85) -> DataFrame:
    """Drop rules where any antecedent/consequent title pair is more similar
    than ``max_similarity`` (1 - normalised edit distance).  Needs
    ``antecedent_titles`` / ``consequent_titles`` (see ``attach_titles``)."""
    sims = F.transform(
        F.col("antecedent_titles"),
        lambda a: F.array_max(F.transform(F.col("consequent_titles"), lambda c: title_similarity(a, c))))
    return (rules.withColumn("max_title_similarity", F.round(F.array_max(sims), 6))
            .filter(F.col("max_title_similarity") <= max_similarity))


def recommendations(rules: DataFrame, n: int = 5) -> DataFrame:
    """Top-n consequents per single antecedent item by lift, confidence,
    item (a window per antecedent: its size is the rule count of one item)."""
    single = rules.filter(F.size("antecedent") == 1).select(
        F.col("antecedent")[0].alias("item"), F.col("consequent")[0].alias("recommended"),
        "confidence", "lift", "support")
    w = Window.partitionBy("item").orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                                           F.col("recommended"))
    return single.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def rule_stats(rules: DataFrame) -> DataFrame:
    """n and mean / min / max of confidence, lift and support over all rules."""
    aggs = [F.count(F.lit(1)).alias("n_rules")]
    for c in ("confidence", "lift", "support"):
        aggs += [F.round(F.avg(c), 6).alias(f"mean_{c}"), F.round(F.min(c), 6).alias(f"min_{c}"),
                 F.round(F.max(c), 6).alias(f"max_{c}")]
    return rules.agg(*aggs)


def rule_graph_edges(rules: DataFrame) -> DataFrame:
    """Edges first antecedent -> first consequent, weight = lift (the largest
    when several rules give the same edge)."""
    return (rules.select(F.col("antecedent")[0].alias("src"), F.col("consequent")[0].alias("dst"), "lift")
            .groupBy("src", "dst").agg(F.round(F.max("lift"), 6).alias("weight")))
