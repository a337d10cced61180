"""Proportional stratified interleaving: shards that all hold the mixture of the sources.

Rows are shuffled by a seeded hash and ranked within their source; the fractional rank
(rank - 1 + u) / size of the source, u a seeded number in [0, 1) of the source, spreads every source
evenly over [0, 1), and many small sources over different places. Cutting the order by
fractional rank into equal runs gives every shard each source in proportion, one row more or less.

Neither rank is taken over a whole source or table in one task: a fixed number of buckets of the
sort key is counted first, the running totals of these counts are the offsets, and rows are ranked
only inside their bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of either sort key; fixed, so the running totals stay small at any size.
BUCKETS = 4096


def _ranked(rows: DataFrame, keys: DataFrame, group: list[str], bucket: str, order: list[str], rank: str, total: str) -> DataFrame:
    """``rows`` with ``rank`` (from 1, in ``order`` within ``group``) and ``total`` (rows of the group).

    ``keys`` holds the columns ``group`` and ``bucket`` of the same rows; buckets follow ``order``.
    """
    counts = keys.groupBy(*group, bucket).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, bucket, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy(*group)).alias(total))
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    return rows.join(offsets, [*group, bucket]).withColumn(rank, F.col("__before") + F.row_number().over(inside)).drop("__before")


def interleaved_shards(docs: DataFrame, shards: int = 16, seed: str = "shard-0", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: shard sizes differ by at most one row. size is the UTF-8 length of the text plus 1;
    a null text counts as empty, a null source is a source of its own, null ids hash as ''. slot counts
    from 0 without gaps inside a shard. Repeated rows are ranked one after the other. grown_shard is
    null, as only the law ``key`` defines it. Text itself is never shuffled.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h = F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string")))
    rows = docs.select(
        F.col(id_col).alias("__id"), F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("__source"), h.alias("__h"),
        F.substring(h, 1, 3).alias("__b"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )
    by_source = ["__source"]
    ranked = _ranked(rows, rows.select("__source", "__b"), by_source, "__b", ["__h", "__id", "text_crc32", "size"], "__rank", "__of")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("__source"))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    spread = ranked.withColumn("__part", (F.col("__rank") - 1 + offset) / F.col("__of")).withColumn("__c", F.floor(F.col("__part") * BUCKETS).cast("int")).withColumn("__all", F.lit(0))
    placed = _ranked(spread, spread.select("__all", "__c"), ["__all"], "__c", ["__part", "__source", "__h", "__id", "text_crc32", "size"], "__at", "__rows")
    exact = placed.select("*", F.expr(f"(__at - 1) * {shards} div __rows").cast("int").alias("shard"))
    return exact.select(
        F.col("__id").alias(id_col), F.expr("nullif(substring(__source, 2), '')").alias(source_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"(__at - 1) - (cast(shard as bigint) * __rows + {shards - 1}) div {shards}").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


#: text_crc32 has no DuckDB counterpart; the query is held against this SQL without it, in tests.
PLACES_SQL = """
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS s, md5(concat_ws('|', 'shard-0', CAST(doc_id AS VARCHAR))) AS h, strlen(coalesce(text, '')) + 1 AS size FROM documents),
r AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY h, doc_id) - 1 + CAST('0x' || substring(md5('shard-0|' || s), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE) / (count(*) OVER (PARTITION BY s)) AS part FROM d),
g AS (SELECT *, row_number() OVER (ORDER BY part, s, h, doc_id) - 1 AS pos, count(*) OVER () AS n FROM r)
SELECT doc_id, size, 'rows' AS law, CAST(pos * 16 // n AS INTEGER) AS shard, pos - ((pos * 16 // n) * n + 15) // 16 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM g
"""
