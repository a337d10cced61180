"""Tables that runs leave behind, published batch by batch; each batch here is run twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.shared import shared_path
from ledgerline.queries.registry import Tables, query
from ledgerline.sources import publish, sinks
from ledgerline.streaming.logs import file_stream


def _twice(table: str, batches: list[DataFrame], broken=None) -> DataFrame:
    """The table of some batches, each of which was published and then run again."""
    for n, rows in enumerate(batches):
        publish.publish(rows, table, n, broken)
        publish.publish(rows, table, n, broken)
    return publish.published(batches[0].sparkSession, table, batches[0].schema)


@query("""
SELECT event_type AS run, 'v1' AS "version", CASE WHEN count(*) FILTER (value < 0) = 0 THEN 'concluida' ELSE 'com_erros' END AS status,
  to_json({event_type: event_type, lidos: count(*), baixos: count(*) FILTER (value < 10), usuarios: count(DISTINCT user_id)})::VARCHAR AS totals, 0::BIGINT AS batch FROM events GROUP BY event_type""")
def run_totals(t: Tables) -> DataFrame:
    """Run headers with their totals (S14); a repeated batch changes nothing."""
    totals = t.events.groupBy("event_type").agg(F.count("*").alias("lidos"), F.count_if(F.col("value") < 10).alias("baixos"), F.count_distinct("user_id").alias("usuarios"), F.count_if(F.col("value") < 0).alias("negativos"))
    status = F.when(F.col("negativos") == 0, "concluida").otherwise("com_erros")
    rows = sinks.run_row(totals, F.col("event_type"), "v1", status).withColumn("totals", F.regexp_replace("totals", ',"negativos":[0-9]+', ""))
    return _twice(shared_path(t.spark, "runs"), [rows], publish.repeated_keys(["run"]))


_KIND = "CASE o_orderstatus WHEN 'F' THEN 'decisao' WHEN 'O' THEN 'requerimento' WHEN 'P' THEN 'publicacao' END"


@query(f"""
WITH d AS (SELECT o_orderkey, o_custkey % 2 AS batch, CASE WHEN o_orderkey % 7 = 0 THEN 'outro' ELSE {_KIND} END AS marco, CAST(o_orderdate AS DATE) AS dia FROM orders)
SELECT o_orderkey, marco, dia, batch FROM d WHERE marco IN ('decisao', 'requerimento', 'publicacao')""")
def timeline_rows(t: Tables) -> DataFrame:
    """A timeline with a closed vocabulary, what is outside of it rejected."""
    kind = F.when(F.col("o_orderkey") % 7 == 0, "outro").otherwise(F.expr(_KIND))
    d = t.orders.select("o_orderkey", "o_custkey", kind.alias("marco"), F.to_date("o_orderdate").alias("dia"))
    accepted, _ = sinks.timeline(d, "marco")
    batches = [accepted.filter(F.col("o_custkey") % 2 == n).select("o_orderkey", "marco", "dia") for n in (0, 1)]
    return _twice(shared_path(t.spark, "timeline"), batches, publish.outside("marco", sinks.MILESTONES))


@query(f"""
WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'outro' ELSE {_KIND} END AS marco FROM orders) SELECT marco, count(*) AS n FROM d WHERE marco = 'outro' OR marco IS NULL GROUP BY marco""")
def timeline_rejected(t: Tables) -> DataFrame:
    """What a timeline rejects, by its value."""
    kind = F.when(F.col("o_orderkey") % 7 == 0, "outro").otherwise(F.expr(_KIND))
    return sinks.timeline(t.orders.select("o_orderkey", kind.alias("marco")), "marco")[1].groupBy("marco").agg(F.count("*").alias("n"))


@query("""
SELECT o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderpriority <> '5-LOW' DESC, o_totalprice DESC) = 1""")
def detail_table(t: Tables) -> DataFrame:
    """A detail table by natural key, the row loaded last (S16): two loads, each run twice."""
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", (F.col("o_orderpriority") != "5-LOW").alias("novo"))
    loads = [rows.filter(~F.col("novo")).drop("novo"), rows.filter("novo").drop("novo")]
    table = _twice(shared_path(t.spark, "details"), loads)
    return publish.latest_of_keys(table, ["o_custkey", "o_orderstatus"], "o_orderdate")


@query("""
WITH old AS (SELECT o_custkey AS k, o_orderkey AS v, o_orderdate AS created, o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) AS vigente FROM orders WHERE o_custkey % 3 <> 0),
new AS (SELECT o_custkey AS k, -o_orderkey AS v, o_orderdate AS created FROM orders WHERE o_custkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, -o_orderkey) = 1)
SELECT k, v, created, vigente AND k NOT IN (SELECT k FROM new) AS vigente FROM old UNION ALL SELECT k, v, created, true FROM new""")
def backfilled_versions(t: Tables) -> DataFrame:
    """A backfill of versions, verified before it takes effect (S12); the second run changes nothing."""
    o = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderdate").alias("created"))
    some = o.filter("k % 3 <> 0")
    top = some.groupBy("k").agg(F.max("v").alias("__top"))
    old = some.join(top, "k").withColumn("vigente", F.col("v") == F.col("__top")).drop("__top")
    new = o.filter("k % 2 = 0").withColumn("v", -F.col("v"))
    table = shared_path(t.spark, "versions")
    for _ in range(2):
        sinks.publish_backfill(old, new, ["k"], "created", table, 1)
    return publish.newest_batch(t.spark, table, old.schema)


@query("""
SELECT 'run' AS run, url, CAST(CASE WHEN page_id % 5 = 0 THEN 503 ELSE 200 END AS INTEGER) AS http_status, CASE WHEN page_id % 5 = 0 THEN 'falha' ELSE 'ok' END AS result,
  CASE WHEN page_id % 5 = 0 THEN 'gave up after ' || page_id || ' tries' ELSE '' END AS erro, to_json({page_id: page_id, bytes: length(html)})::VARCHAR AS contexto FROM pages""")
def fetch_rows(t: Tables) -> DataFrame:
    """Fetch records as log rows."""
    failed = F.col("page_id") % 5 == 0
    rows = t.pages.select("page_id", "url", F.when(failed, 503).otherwise(200).alias("http_status"), F.when(failed, F.concat(F.lit("gave up after\n "), F.col("page_id").cast("string"), F.lit("  tries"))).alias("erro"), F.length("html").alias("bytes"))
    return sinks.fetch_log(rows, "run", ["page_id", "bytes"])


@query("""
SELECT event_id, user_id, value, event_type FROM events WHERE value >= 10""")
def streamed_details(t: Tables) -> DataFrame:
    """A stream whose batches are published under their numbers; the stream is run twice over, from the start."""
    table = shared_path(t.spark, "streamed")
    rows = lambda df: df.select("event_id", "user_id", "value", "event_type").filter("value >= 10")
    stream = file_stream(t.spark, t.folder, t.events.schema, "events.parquet")
    for k in range(2):
        publish.publish_stream(stream, table, rows, f"{table}-marks-{k}", publish.all_hold(F.col("value") >= 10))
    return publish.published(t.spark, table, rows(t.events).schema).drop("batch")
