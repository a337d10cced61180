"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, clustering, cross_polytope, exact_dedup, language_id, licenses, minhash, mixing, pii, product_codes, quality, sharding, substring_dedup


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find_personal_data(docs, pii.fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "rested")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleaved_shards(documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir), licenses.known_digests(spark))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.learned(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "rejected", "entropy")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(embeddings(spark, sf_dir))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_codes.compressed(embeddings(spark, sf_dir))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(embeddings(spark, sf_dir))


#: In the order of the list they are numbered by.
OPERATORS = (
    op1_byte_bpe, op2_mixing, op3_substring_dedup, op4_pii, op5_quality_rules, op6_exact_dedup, op7_minhash, op8_sharding, op9_license_scan, op10_language_id,
    op11_embedding_near_dedup, op12_vector_codes, op13_centroid_clustering,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_quality_rules": quality.ORACLE_SQL, "op6_exact_dedup": exact_dedup.ORACLE_SQL, "op9_license_scan": licenses.ORACLE_SQL, "op11_embedding_near_dedup": cross_polytope.ORACLE_SQL,
        "op12_vector_codes": product_codes.oracle_sql(), "op13_centroid_clustering": clustering.oracle_sql(),
    }
