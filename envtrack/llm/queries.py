"""Registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envtrack.llm import curve_packing, divergence, encoding, exact_dedup, graph_search, lm_scoring, ngram_join, quality, sharding, token_matrix, topk, url_filter, variants
from envtrack.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SHARD_BYTES = 1 << 20


def op8_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.round_trip_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = curve_packing.pack_along_curve(table(spark, sf_dir, "documents"), VOCABULARY, end_id=1, length=2048)
    return curve_packing.piece_digests(pieces)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), url_filter.RULES)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8, words=5)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrix.pack_matrix(table(spark, sf_dir, "documents"), VOCABULARY)


def op11_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least=30, most=50)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_curve_packing": op2_curve_packing,
    "op3_top_k": op3_top_k,
    "op4_sharding": op4_sharding,
    "op5_url_filter": op5_url_filter,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality": op7_quality,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_token_matrix": op10_token_matrix,
    "op8_bpe_encoding": op8_bpe_encoding,
    "op11_graph_search": op11_graph_search,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op3_top_k": topk.ORACLE,
    "op4_sharding": sharding.oracle(SHARD_BYTES),
    "op5_url_filter": url_filter.ORACLE,
    "op12_divergence_audit": divergence.ORACLE,
}
