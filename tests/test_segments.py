"""Scans in segments against plain windows, on hot keys, nulls, ties in the segment, empty segments."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import joins, latest
from ledgerline.operators.segments import blocks, scanned


@pytest.fixture(scope="module")
def log(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(4000):
        key = None if i % 401 == 0 else int(rng.integers(0, 9)) if i % 3 else 5
        rows.append((key, i if i % 7 else i * 3 + 20_001, None if i % 11 == 0 else int(rng.integers(0, 5)), None if i % 5 else f"v{i}"))
    return spark.createDataFrame(rows + [(4, None, 1, "first"), (77, 3, None, None)], "k int, seq int, n int, v string")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [1, 50, 700, 10**6])
def test_segments_give_what_a_window_gives(log, size):
    w = Window.partitionBy("k").orderBy("seq")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = log.select("k", "seq", "n", "v", F.row_number().over(w).cast("long").alias("place"), F.sum(F.coalesce("n", F.lit(0))).over(before).alias("total"), F.lag("n").over(w).alias("was"), F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("known"))
    got = scanned(log, ["k"], ["seq"], blocks(F.col("seq"), size), number="place", sums={"total": F.col("n")}, previous={"was": F.col("n")}, known={"known": F.col("v")})
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_operators_agree_with_and_without_segments(spark, log):
    at = blocks(F.col("seq"), 100)
    counts = F.coalesce(F.col("n") == 2, F.lit(False))
    assert rows_of(latest.running_cap(log, "k", "seq", counts, 6, segment=at)) == rows_of(latest.running_cap(log, "k", "seq", counts, 6))
    assert rows_of(latest.continuity(log, "k", "seq", "v", "v", "START", at).select("k", "seq", "expected", "continuous")) == rows_of(latest.continuity(log, "k", "seq", "v", "v", "START").select("k", "seq", "expected", "continuous"))
    columns = ["k", "seq", "version", "previous"]
    assert rows_of(latest.version_chain(log, "k", ["seq"], "v", at).select(columns)) == rows_of(latest.version_chain(log, "k", ["seq"], "v").select(columns))
    versions = log.filter("seq % 40 = 0").select("k", F.col("seq").alias("since"), F.col("n").alias("price"))
    facts = log.filter("seq % 40 <> 0").select("k", "seq", "v")
    plain = joins.as_of(facts, versions, "k", "seq", "since", ["price"], ["seq"])
    assert rows_of(joins.as_of(facts, versions, "k", "seq", "since", ["price"], ["seq"], lambda t: blocks(t, 300))) == rows_of(plain)


def test_a_hot_key_is_spread_over_tasks(spark):
    hot = spark.range(60_000).select(F.when(F.col("id") % 50 == 0, F.col("id") % 40).otherwise(5).alias("k"), "id")
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = scanned(hot, ["k"], ["id"], blocks(F.col("id"), 300), number="n")
        tasks = sorted(r["count"] for r in out.filter("n > 0").groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert len(tasks) == 4 and tasks[-1] <= 2 * tasks[0]


def test_an_empty_table_has_an_empty_scan(log):
    assert scanned(log.limit(0), ["k"], ["seq"], blocks(F.col("seq"), 9), number="n", known={"x": F.col("v")}).count() == 0
