"""Column expressions that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: One word, and the white space between words (ASCII only).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once per row.

    An expression named inside a lambda is evaluated anew for every element;
    a bound lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def salt_of(key: str, salts: int) -> Column:
    """A salt in [0, salts) from a row's key, the same on every rerun."""
    return F.pmod(F.xxhash64(F.lit("salt"), F.col(key)), F.lit(salts)).cast("int")


def spread(salts: int) -> Column:
    """A salt in [0, salts) from a row's place in its input, so that rows with
    one key, or with none, get different ones.  For joins with ``salted`` rows and
    for sums by salt, which come out alike whatever the salt."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")


def salted(df: DataFrame, salts: int) -> DataFrame:
    """One copy of each row per salt: the small side of a join on a hot key."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1
