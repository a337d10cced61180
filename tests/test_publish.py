"""Publishing once per batch, and loads that count while they read."""

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import publish, scan, sinks
from ledgerline.streaming import logs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_batch_is_published_once_and_whole(spark, tmp_path):
    table = str(tmp_path / "t")
    one, two = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(1, "c")], "k int, v string")
    assert rows(publish.published(spark, table, one.schema)) == []
    assert publish.publish(one, table, 0) and not publish.publish(two, table, 0) and publish.publish(two, table, 1)
    assert rows(publish.published(spark, table, one.schema)) == [(1, "a", 0), (1, "c", 1), (2, "b", 0)]
    assert rows(publish.newest_batch(spark, table, one.schema)) == [(1, "c")]


def test_a_broken_post_condition_publishes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(publish.PostConditionFailed):
        publish.publish(twice, table, 0, publish.repeated_keys(["k"]))
    with pytest.raises(publish.PostConditionFailed):
        publish.publish(twice, table, 0, publish.outside("v", ["a"]))
    assert rows(publish.published(spark, table, twice.schema)) == []
    assert publish.publish(twice, table, 0, publish.outside("v", ["a", "b"]))


def test_latest_of_keys_by_load_then_batch_then_content(spark):
    df = spark.createDataFrame([(1, 5, "a", 0), (1, 5, "b", 1), (1, 4, "z", 2), (2, None, "x", 0), (2, 1, "y", 0), (None, 1, "n", 0), (3, 7, "p", 0), (3, 7, "q", 0)], "k int, loaded int, v string, batch bigint")
    assert sorted((tuple(r) for r in publish.latest_of_keys(df, ["k"], "loaded").collect()), key=str) == sorted([(1, 5, "b"), (2, 1, "y"), (None, 1, "n"), (3, 7, "q")], key=str)


def test_a_backfill_that_leaves_two_current_rows_is_refused(spark, tmp_path):
    old = spark.createDataFrame([(1, 10, 1, True), (1, 11, 2, True), (2, 12, 1, True), (3, 13, 1, False)], "k int, v int, created int, vigente boolean")
    new = spark.createDataFrame([(1, 20, 9), (1, 21, 8), (3, 23, 9)], "k int, v int, created int")
    assert sinks.publish_backfill(old, new, ["k"], "created", str(tmp_path / "t"), 1)
    assert not sinks.publish_backfill(old, new.limit(0), ["k"], "created", str(tmp_path / "t"), 1)
    got = rows(publish.newest_batch(spark, str(tmp_path / "t"), old.schema))
    assert got == [(1, 10, 1, False), (1, 11, 2, False), (1, 20, 9, True), (2, 12, 1, True), (3, 13, 1, False), (3, 23, 9, True)]


def test_a_stream_run_from_the_start_again_publishes_nothing_new(spark, tmp_path):
    inbox = str(tmp_path / "in")
    spark.range(10).withColumn("v", F.col("id") * 2).coalesce(1).write.parquet(inbox)
    schema = spark.read.parquet(inbox).schema
    table = str(tmp_path / "t")
    for k in range(2):
        publish.publish_stream(logs.file_stream(spark, inbox, schema, "*.parquet"), table, lambda df: df.filter("id > 3"), str(tmp_path / f"marks{k}"))
    assert [r[0] for r in rows(publish.published(spark, table, schema))] == [4, 5, 6, 7, 8, 9]


def test_a_scoped_load_counts_in_its_one_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "in"))
    fact = spark.read.parquet(str(tmp_path / "in"))
    kept, seen = scan.scoped_load(fact, [("low", F.col("id") < 10), ("even", F.col("id") % 2 == 0), ("never", F.lit(None).cast("boolean"))])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    assert kept.count() == 45
    assert rows(scan.load_counts(spark, seen)) == [("aceito", 45), ("even", 45), ("low", 10)]


def test_a_stream_load_counts_each_batch(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: logs.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, "*.parquet", 1)
    for _ in range(2):
        kept, counts = logs.stream_load(stream(), [("even", F.col("id") % 2 == 0)], "load", str(tmp_path / "out"))
        assert kept.count() == 15 and rows(counts.groupBy("motivo").agg(F.sum("n"))) == [("aceito", 15), ("even", 15)]
        assert counts.select("batch").distinct().count() == 3
