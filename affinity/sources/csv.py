"""Headered CSV scans with explicit schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def get_schemas() -> tuple[T.StructType, T.StructType, T.StructType]:
    """Schemas of the three logical inputs, in the logical column names."""
    interactions = T.StructType([
        T.StructField("user_id", T.LongType(), False),
        T.StructField("item_id", T.LongType(), False),
        T.StructField("rating", T.DoubleType(), False),
        T.StructField("ts", T.LongType(), False),
    ])
    items = T.StructType([
        T.StructField("item_id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("genres", T.StringType(), False),
    ])
    tags = T.StructType([
        T.StructField("user_id", T.LongType(), False),
        T.StructField("item_id", T.LongType(), False),
        T.StructField("tag", T.StringType(), False),
        T.StructField("ts", T.LongType(), False),
    ])
    return interactions, items, tags


#: Holds the text of a record that doesn't fit its schema.
RECORD = "_record"


def read_checked(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The schema's columns, ``_record`` and ``_reason``.

    A record with too few or too many fields, or a value of the wrong type, is
    "malformed", and ``_record`` has its text; one without a value that the schema
    requires is "missing <column>", the first of them.  Good records have no
    reason.
    """
    whole = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema], T.StructField(RECORD, T.StringType(), True)])
    rows = spark.read.csv(path, header=header, schema=whole, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
    reason = F.when(F.col(RECORD).isNotNull(), "malformed")
    for f in schema:
        if not f.nullable:
            reason = reason.when(F.col(f.name).isNull(), f"missing {f.name}")
    return rows.withColumn("_reason", reason)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("_reason is null").drop(RECORD, "_reason")


def rejected_rows(checked: DataFrame) -> DataFrame:
    """(record, reason); the record of a row with missing values is written anew."""
    columns = [c for c in checked.columns if c not in (RECORD, "_reason")]
    return checked.filter("_reason is not null").select(
        F.coalesce(RECORD, F.to_csv(F.struct(*columns))).alias("record"), F.col("_reason").alias("reason"))


def reject_report(checked: DataFrame) -> DataFrame:
    """(reason, rows), good rows as "good"; they add up to the file."""
    return checked.groupBy(F.coalesce("_reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # The CSV scan makes every field nullable whatever the declaration says,
    # so null handling downstream stays necessary.
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def read_interactions(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, get_schemas()[0])


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, get_schemas()[1])


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, get_schemas()[2])


def load_datasets(spark: SparkSession, base: str, interactions_file: str = "ratings.csv",
                  items_file: str = "movies.csv", tags_file: str = "tags.csv"):
    """Lazy (interactions, items, tags) from one folder of headered CSV files.

    The files use the original column names (userId, movieId, rating,
    timestamp / movieId, title, genres / userId, movieId, tag, timestamp); the
    header is skipped and columns are taken by position, so the logical names
    apply.
    """
    return (read_interactions(spark, f"{base}/{interactions_file}"),
            read_items(spark, f"{base}/{items_file}"),
            read_tags(spark, f"{base}/{tags_file}"))
