"""One query per operator, over the whole intended tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinity.llm import chunk_fingerprints, language, merkle, quality, quality_rules, ranked_search, secrets
from affinity.llm.common import benchmark, documents, labels
from affinity.llm.exact_dedup import dedup_exact
from affinity.llm.line_dedup import line_dedup_digest
from affinity.llm.mixing import mix_digest
from affinity.llm.near_dedup import near_components
from affinity.llm.packing import pack_documents
from affinity.llm.token_output import round_trip


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.classify(docs, quality.fit(docs, labels(spark, sf_dir)))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(documents(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit(docs))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rules_digest(documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(documents(spark, sf_dir))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_fingerprints.fingerprinted(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_quality, op3_token_output, op4_packing, op5_secrets, op6_language, op7_quality_rules,
        op8_line_dedup, op9_near_dedup, op10_mixing, op11_ranked_search, op12_merkle, op13_fingerprints)
}
