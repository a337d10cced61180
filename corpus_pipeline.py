"""A corpus pipeline: language, exact copies, near copies, mixture, tokens.

Each stage takes all rows that its predecessor kept. All but the last return the columns of
``documents``; the last returns token counts and digests. SQL cannot express the models and
encodings, so the stages are tested against brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import bpe, exact_dedup, language_id, minhash, mixing
from ledgerline.llm.common import settled


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; text without a letter and text unlike any language goes."""
    return language_id.keep_identified(docs, language_id.learned(docs.filter(~language_id.held_out())))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row of smallest doc_id."""
    return minhash.drop_near_duplicates(docs)


def to_target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics meet flattened shares."""
    return mixing.sample_mixture(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", known_language),
    ("exact_dedup", without_exact_copies),
    ("near_dedup", without_near_copies),
    ("mixing", to_target_mixture),
    ("tokens", to_tokens),
]

#: Cross-entropies, signatures and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
