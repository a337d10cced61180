"""Stream twins of batch operators, over the events table read as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.queries.registry import Tables, query
from ledgerline.streaming import logs


def _events(t: Tables) -> DataFrame:
    return logs.file_stream(t.spark, t.folder, t.events.schema, "events.parquet")


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def stream_new_inputs(t: Tables) -> DataFrame:
    """Rows whose key and content were not seen before."""
    return logs.run_to_table(logs.new_or_changed(_events(t).select("user_id", "event_type"), ["user_id"], ["event_type"]).select("user_id", "event_type"), "new")


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'erro' WHEN value < 10 THEN 'valor' ELSE 'aceito' END AS motivo, count(*) AS n FROM events GROUP BY 1""")
def stream_load_counts(t: Tables) -> DataFrame:
    """Counters of a stream's load, observed while its rows are written."""
    rules = [("erro", F.col("event_type") == "error"), ("valor", F.col("value") < 10)]
    return logs.stream_load(_events(t), rules, "load")[1].groupBy("motivo").agg(F.sum("n").alias("n"))


_ALLOWED = (("SEM_FLUXO", "signup"), ("signup", "view"), ("view", "click"), ("click", "purchase"), ("purchase", "view"), ("click", "error"), ("error", "view"))


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
r(a, b) AS (VALUES ('SEM_FLUXO', 'signup'), ('signup', 'view'), ('view', 'click'), ('click', 'purchase'), ('purchase', 'view'), ('click', 'error'), ('error', 'view')),
w AS (SELECT user_id, event_id, n, 'SEM_FLUXO' AS state, event_type AS wanted, EXISTS (SELECT 1 FROM r WHERE a = 'SEM_FLUXO' AND b = event_type) AS accepted FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.n, CASE WHEN w.accepted THEN w.wanted ELSE w.state END, e.event_type, coalesce(r.a IS NOT NULL, false)
  FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1 LEFT JOIN r ON r.a = CASE WHEN w.accepted THEN w.wanted ELSE w.state END AND r.b = e.event_type)
SELECT user_id, event_id, state, wanted, accepted FROM w""")
def stream_state(t: Tables) -> DataFrame:
    """State machine per key that ignores rejected rows."""
    return logs.run_to_table(logs.stream_states(_events(t), "user_id", "event_id", "de", "event_type", _ALLOWED, "SEM_FLUXO"), "states")


@query("""
WITH d AS (SELECT user_id, event_id, event_type AS now, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS was FROM events) SELECT user_id, event_id, was, now FROM d WHERE was IS NULL OR was <> now""")
def stream_delta(t: Tables) -> DataFrame:
    """Changes of a key's fingerprint."""
    return logs.run_to_table(logs.stream_deltas(_events(t), "user_id", "event_id", "event_type"), "deltas")


@query("""SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def stream_counters(t: Tables) -> DataFrame:
    """Running counters (T4)."""
    return logs.run_to_table(logs.stream_counters(_events(t), "event_type"), "counters", "complete")


@query("""
WITH d AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS used_before FROM events WHERE event_type = 'error') SELECT *, used_before < 6 AS admitted FROM d""")
def stream_cap(t: Tables) -> DataFrame:
    """A cap per key with its counter as state (T5)."""
    return logs.run_to_table(logs.stream_cap(_events(t), "user_id", "event_id", F.col("event_type") == "error", 6), "cap")


@query("""
WITH v AS (SELECT user_id, max(ts) AS made FROM events WHERE event_type = 'signup' GROUP BY 1) SELECT e.user_id, e.event_id FROM events e JOIN v ON e.user_id = v.user_id WHERE event_type = 'error' AND ts > made""")
def stream_late_changes(t: Tables) -> DataFrame:
    """Changes that come after a version was made."""
    versions = t.events.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("made_at"))
    return logs.run_to_table(logs.late_changes(_events(t).filter("event_type = 'error'"), versions, "user_id", "ts", "made_at").select("user_id", "event_id"), "late")


@query("""
SELECT DISTINCT v.user_id, v.event_id FROM events v JOIN events c ON c.user_id = v.user_id AND c.ts > v.ts WHERE v.event_type = 'purchase' AND c.event_type = 'error'""")
def stream_stale_versions(t: Tables) -> DataFrame:
    """Versions that a later change makes stale, both as streams."""
    versions, changes = _events(t).filter("event_type = 'purchase'"), _events(t).filter("event_type = 'error'")
    return logs.run_to_table(logs.stale_versions(versions, changes, "user_id", "ts", "ts", "event_id"), "stale")
