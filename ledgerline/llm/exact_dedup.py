"""Exact duplicates by skew-safe combining.

Copies are first combined inside each input partition, then per (digest, salt), then the salt
winners per digest. All three are grouped aggregations whose key holds the whole normalised text,
so texts are compared in full at every stage and two texts of one digest are never taken for equal.
The first two are one aggregation in Spark: its map side is the local stage. A group that holds a
third of all rows reaches the last stage as at most ``salts`` rows. Only the answer travels back to the
rows by SHA-256 alone, so that no text is shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import columns_numbered, lower_ascii, text_or_empty


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row per distinct normalised text: digest, keep_id, group_size.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. keep_id is the
    largest id (null only if all ids are null). An empty table gives no rows.
    """
    norm = docs.select(F.col(id_col).alias("id"), lower_ascii(text_or_empty(text_col)).alias("norm"))
    keyed = norm.select("id", "norm", F.sha2("norm", 256).alias("digest"), F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    salted = keyed.groupBy("digest", "salt", "norm").agg(F.max("id").alias("id"), F.count("*").alias("n"))
    whole = salted.groupBy("digest", "norm").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
    return whole.select("digest", "keep_id", "group_size")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Only ids and digests travel in the join back, no text; its large side is an ordinary join input,
    so that adaptive execution can split a hot digest. Rows that repeat the winning id are all kept:
    the id decides, and such rows are the same document. Columns other than the two named are ignored.
    """
    groups = duplicate_groups(docs, id_col, text_col, salts)
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(lower_ascii(text_or_empty(text_col)), 256).alias("digest"))
    out = rows.join(groups, "digest")
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    Of equal texts the rows of the largest id stay: one, or all that repeat both id and text.
    """
    keep = duplicate_groups(docs, id_col, text_col, salts).select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep_id"))
    numbered, name = columns_numbered(docs)
    digest = F.sha2(lower_ascii(text_or_empty(name[text_col])), 256)
    stays = (digest == F.col("__digest")) & F.col(name[id_col]).eqNullSafe(F.col("__keep_id"))
    return numbered.join(keep, stays, "left_semi").toDF(*docs.columns)


ORACLE_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
