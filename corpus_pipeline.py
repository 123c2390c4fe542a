"""The corpus pipeline: quality classifier, exact dedup, n-gram Jaccard join, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's documents. All stages but the last
return rows of documents, whole, with the columns that they had.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from envtrack.llm import curve_packing, exact_dedup, ngram_join, quality
from envtrack.llm.common import staged, table
from envtrack.llm.queries import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 7), learned from ``labels``, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id (operator 1)."""
    return exact_dedup.without_copies(docs)


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, five words and 0.8 (operator 6)."""
    return ngram_join.one_of_each_class(docs, threshold=0.8, words=5)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens (operator 2)."""
    return curve_packing.piece_digests(curve_packing.pack_along_curve(docs, VOCABULARY, end_id=1, length=2048))


STAGES: list[tuple[str, Stage]] = [("quality", good_documents), ("exact_dedup", distinct_documents),
                                   ("ngram_join", different_documents), ("packing", packed_documents)]

#: SQL cannot express the trained classifier and the hashed stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
