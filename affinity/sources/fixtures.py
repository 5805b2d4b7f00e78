"""Logical tables derived from the provided parquet fixtures.

interactions(user_id, item_id, rating, ts)   orders x lineitem
items(item_id, title, genres)                part
tags(user_id, item_id, tag, ts)              events
documents -> (doc_id, element)               3-word shingles of the whole text

Only the needed columns are selected, so the parquet scans read just those
(``ReadSchema`` in the plan).  Every function is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import element_hash
from ..session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(c: Column) -> Column:
    """Seconds since 1970 of a timestamp_ntz (session time zone plays no part)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, c.cast("timestamp_ntz"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id = o_custkey, item_id = l_partkey,
    rating = ceil(l_quantity / 5) / 2 (ten half-star values), ts = o_orderdate."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
                    epoch_seconds(F.col("o_orderdate")).alias("ts")))


def raw_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """interactions with injected nulls and a re-sent duplicate.

    rating is null on line 3 of each order, ts is null on line 7; every
    order's line 2 appears twice (an exact re-sent row), so null and
    duplicate cleaning both have work to do.
    """
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                  "l_linenumber")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    base = (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("item_id"),
                    F.when(F.col("l_linenumber") != 3,
                           F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
                    F.when(F.col("l_linenumber") != 7,
                           epoch_seconds(F.col("o_orderdate"))).alias("ts"),
                    F.col("l_linenumber")))
    resent = base.filter(F.col("l_linenumber") == 2)
    return base.unionByName(resent).drop("l_linenumber")


def interaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): interactions as lines of a CSV file, some of them broken by line
    number: 3 has a word for its rating, 5 lacks its last field, 6 has an empty
    item, 7 one field too many."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    od = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    number = F.col("l_linenumber")
    fields = [F.col("o_custkey"), F.when(number == 6, "").otherwise(F.col("l_partkey").cast("string")),
              F.when(number == 3, "good").otherwise((F.ceil(F.col("l_quantity") / 5) / 2).cast("string")),
              F.when(number != 5, epoch_seconds(F.col("o_orderdate"))), F.when(number == 7, "more")]
    return li.join(od, li.l_orderkey == od.o_orderkey).select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))


def order_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, brand): the brands of each order."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select(F.col("l_orderkey").alias("order_id"), F.col("p_brand").alias("brand"))


def _genres(first: Column) -> Column:
    words = F.split(F.col("p_name"), " ")
    return F.concat_ws("|", first, F.get(words, 0), F.get(words, 1))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id = p_partkey, title = p_name, genres = 'p_type|word1|word2'."""
    return (_table(spark, sf_dir, "part")
            .select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                    _genres(F.col("p_type")).alias("genres")))


def items_with_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """items whose category spellings vary (case, punctuation, plural), driven
    by p_size, so canonicalisation has work to do."""
    p_type = F.col("p_type")
    size = F.col("p_size")
    variant = (F.when(size > 45, F.lower(p_type))
               .when(size < 5, F.concat(p_type, F.lit("-")))
               .when(size.between(20, 22), F.initcap(p_type))
               .otherwise(p_type))
    words = F.split(F.col("p_name"), " ")
    second = F.when(size == 33, F.concat(F.get(words, 1), F.lit("s"))).otherwise(F.get(words, 1))
    return (_table(spark, sf_dir, "part")
            .select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                    F.concat_ws("|", variant, F.get(words, 0), second).alias("genres")))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, item_id = props.k, tag = event_type, ts."""
    return (_table(spark, sf_dir, "events")
            .select(F.col("user_id"),
                    F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
                    F.col("event_type").alias("tag"),
                    epoch_seconds(F.col("ts")).alias("ts")))


def brand_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """interactions joined with part's brand: (user_id, item_id, rating, brand)."""
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"),
                                                F.col("p_brand").alias("brand"))
    return interactions(spark, sf_dir).join(part, "item_id")


def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def doc_members(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """(doc_id, element): distinct n-word shingle ids of every whole document.

    Text is lower-cased and split on one space; a shingle is n consecutive
    words joined by one space; its id is the first 60 bits of its md5.

    The shingle strings are exploded and hashed per row (exploding an array
    built by a nested lambda re-evaluates it per element in Spark 4.1, which
    is quadratic in the text length)."""
    from ..functions.text import shingles, words_of
    docs = documents_table(spark, sf_dir).select("doc_id", words_of(F.col("text")).alias("words"))
    return (docs.select("doc_id", F.explode(shingles(F.col("words"), n)).alias("shingle"))
            .select("doc_id", element_hash(F.col("shingle")).alias("element"))
            .distinct())


def doc_arrays(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """(doc_id, elements): the set of ``doc_members`` in one row, sorted.

    Shingles are made and hashed inside the text's row.  Only sets of rows that repeat
    a doc_id move, to come together; which these are is stored first."""
    from ..functions.text import bound, words_of

    def ids(words: Column) -> Column:
        # words one by one: a slice in a lambda copies the whole array first
        made = F.transform(F.sequence(F.lit(0), F.size(words) - n),
                           lambda i: element_hash(F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)])))
        return F.when(F.size(words) >= n, made)

    docs = documents_table(spark, sf_dir)
    repeated = materialize(docs.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_id"), "repeated")
    # a condition on the set itself would have it made once more
    docs = docs.filter(F.size(words_of(F.col("text"))) >= n)
    made = F.array_distinct(bound(words_of(F.col("text")), ids))
    alone = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["_id"]), "left_anti").select("doc_id", F.sort_array(made).alias("elements"))
    together = (docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["_id"]), "left_semi").select("doc_id", made.alias("own"))
                .groupBy("doc_id").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("own")))).alias("elements")))
    return alone.unionByName(together)
