"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from affinity.llm.common import documents, labels
from affinity.llm.line_dedup import dedup_lines
from affinity.llm.mixing import mixed
from affinity.llm.near_dedup import dedup_near
from affinity.llm.packing import CAPACITY, pack_documents
from affinity.llm.quality import keep_good
from affinity.session import materialize


#: Words a shingle and Jaccard similarity of near-duplicates; op9 has its own.
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8
#: Documents, and attention cost as a share of a full sequence of one document's,
#: in a sequence that several share.
SEQUENCE_DOCUMENTS, SEQUENCE_COST = 32, 0.75


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return keep_good(docs, labels(spark, sf_dir))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents share."""
    return dedup_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return dedup_near(docs, NEAR_WORDS, NEAR_SIMILARITY)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return pack_documents(docs, max_docs=SEQUENCE_DOCUMENTS, max_cost=SEQUENCE_COST * CAPACITY ** 2)


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", without_shared_lines),
    ("near_dedup", one_of_each),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: SQL can't express the classifier, the join by trees and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
