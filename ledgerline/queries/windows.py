"""Latest rows, states, version chains and caps over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators import latest, segments
from ledgerline.plans.calls import dossier_evidence
from ledgerline.queries.registry import Tables, query

#: Events of a segment of a key.
BLOCK = 4096


@query("""
WITH l AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS inicio, CASE o_orderstatus WHEN 'F' THEN '2001-01-01' WHEN 'P' THEN '  ' END AS fim FROM orders)
SELECT o_custkey, o_orderkey, inicio FROM l WHERE trim(coalesce(fim, '')) = '' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY inicio DESC NULLS FIRST, o_orderkey) = 1""")
def latest_valid(t: Tables) -> DataFrame:
    """The open link of latest start per key; a null start wins."""
    start = F.when(F.col("o_orderkey") % 17 != 0, F.to_date("o_orderdate").cast("string"))
    end = F.when(F.col("o_orderstatus") == "F", "2001-01-01").when(F.col("o_orderstatus") == "P", "  ")
    links = t.orders.select("o_custkey", "o_orderkey", start.alias("inicio"), end.alias("fim"))
    return latest.currently_valid(links, "o_custkey", "inicio", "fim", "o_orderkey").drop("fim")


@query("""
SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'signup' THEN NULL ELSE event_type = 'purchase' END DESC NULLS LAST, ts DESC NULLS LAST, event_id DESC) = 1""")
def current_score_row(t: Tables) -> DataFrame:
    """The score row that counts: current first, newest next, nulls last."""
    e = t.events.withColumn("vigente", F.when(F.col("event_type") != "signup", F.col("event_type") == "purchase"))
    return latest.current_score(e, "user_id", "vigente", "ts", "event_id").select("user_id", "event_id", "event_type")


@query("""SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders QUALIFY n <= 5""")
def last_five(t: Tables) -> DataFrame:
    """The last five of each key."""
    return latest.latest_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5, "n").select("o_custkey", "o_orderkey", "n")


@query("""SELECT user_id, arg_max(event_type, event_id) AS state, arg_max(ts, event_id) AS since, count(*) AS steps FROM events GROUP BY user_id""")
def state_of_key(t: Tables) -> DataFrame:
    """State per key: the last transition."""
    return latest.state_of_key(t.events, "user_id", "event_id", "event_type", "ts")


@query("""
WITH d AS (SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN event_type ELSE lag(event_type, 1, 'SEM_FLUXO') OVER (PARTITION BY user_id ORDER BY event_id) END AS de, event_type AS para FROM events),
e AS (SELECT *, lag(para, 1, 'SEM_FLUXO') OVER (PARTITION BY user_id ORDER BY event_id) AS expected FROM d)
SELECT event_id, user_id, de, para, expected, de IS NOT DISTINCT FROM expected AS continuous FROM e""")
def continuity(t: Tables) -> DataFrame:
    """Whether each row starts where the one before ended."""
    before = F.lag("event_type", 1, "SEM_FLUXO").over(Window.partitionBy("user_id").orderBy("event_id"))
    log = t.events.select("event_id", "user_id", F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise(before).alias("de"), F.col("event_type").alias("para"))
    return latest.continuity(log, "user_id", "event_id", "de", "para", "SEM_FLUXO", segments.blocks(F.col("event_id"), BLOCK))


@query("""SELECT o_orderkey, o_custkey, CAST(row_number() OVER w AS INTEGER) AS version, lag(o_orderkey) OVER w AS previous FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def version_chain(t: Tables) -> DataFrame:
    """Version numbers and the version before."""
    return latest.version_chain(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey", F.date_trunc("year", "o_orderdate")).drop("o_orderdate")


@query("""
WITH d AS (SELECT user_id, event_type, arg_max(value, event_id) AS v FROM events GROUP BY user_id, event_type) SELECT user_id, event_type, v FROM d WHERE v > 50""")
def last_decision_per_field(t: Tables) -> DataFrame:
    """The latest decision of each field, then those that are confirmed."""
    d = latest.latest_per_key(t.events, ["user_id", "event_type"], [F.col("event_id").desc()])
    return d.select("user_id", "event_type", F.col("value").alias("v")).filter("v > 50")


@query("""SELECT o_orderkey, o_custkey, o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey) AS is_newest FROM orders""")
def newest_flag(t: Tables) -> DataFrame:
    """Whether a version is still its key's newest."""
    return latest.newest_flag(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate").drop("o_orderdate")


@query("""
SELECT o_orderkey, coalesce((SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') > o_orderdate + INTERVAL 60 DAY, false) AS stale FROM orders""")
def changed_after(t: Tables) -> DataFrame:
    """Versions that a later change makes stale."""
    v = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("made"))
    out = latest.changed_after(v, t.lineitem.filter("l_returnflag = 'R'"), "l_orderkey", "made", "l_shipdate", "l_orderkey")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), "stale")


@query("""
WITH d AS (SELECT event_id, user_id, event_type = 'error' AS counts, coalesce(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used_before FROM events)
SELECT event_id, user_id, used_before, NOT counts OR used_before < 6 AS admitted FROM d""")
def running_cap(t: Tables) -> DataFrame:
    """A running ceiling per key."""
    return latest.running_cap(t.events.select("event_id", "user_id", "event_type"), "user_id", "event_id", F.col("event_type") == "error", 6, segment=segments.blocks(F.col("event_id"), BLOCK)).drop("event_type")


@query("""
WITH l AS (SELECT *, lag(o_orderstatus) OVER w AS was FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
c AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM l WHERE was IS NULL OR was <> o_orderstatus)
SELECT o_custkey, o_orderkey, o_orderstatus, CAST(row_number() OVER w AS INTEGER) AS version, lead(1) OVER w IS NULL AS is_current FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def version_rotation(t: Tables) -> DataFrame:
    """Score versions, repeats skipped (V1)."""
    log = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return latest.rotated_versions(log, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"]).drop("o_orderdate")


@query("""SELECT o_custkey, o_orderkey, CAST(row_number() OVER w AS INTEGER) AS version, lead(1) OVER w IS NULL AS is_current FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def version_all(t: Tables) -> DataFrame:
    """Score versions, none skipped (V2)."""
    return latest.all_versions(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT n_nationkey, n_regionkey, n_nationkey = (SELECT n_nationkey FROM nation ORDER BY n_regionkey DESC, n_nationkey DESC LIMIT 1) AS is_current FROM nation""")
def parameter_version(t: Tables) -> DataFrame:
    """Exactly one current parameter version (V5)."""
    return latest.current_parameters(t.nation.select("n_nationkey", "n_regionkey"), "n_regionkey", "n_nationkey")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 'REVISAR' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def relabel(t: Tables) -> DataFrame:
    """A bulk relabel (V6)."""
    return latest.relabelled(t.orders, "o_orderstatus", F.col("o_totalprice") > 250000, "REVISAR").select("o_orderkey", "o_orderstatus")


@query("""
WITH m AS (SELECT c_custkey AS o, c_custkey + 700 AS n FROM customer WHERE c_custkey % 4 = 0)
SELECT CASE WHEN m.n IS NULL THEN c.c_custkey WHEN x.c_custkey IS NOT NULL THEN c.c_custkey ELSE m.n END AS c_custkey, c.c_name,
  CASE WHEN m.n IS NULL THEN 'mantido' WHEN x.c_custkey IS NOT NULL THEN 'conflito' ELSE 'migrado' END AS outcome
FROM customer c LEFT JOIN m ON c.c_custkey = m.o LEFT JOIN customer x ON x.c_custkey = m.n""")
def id_migration(t: Tables) -> DataFrame:
    """Provisional ids replaced by real ones (V4)."""
    m = t.customer.filter("c_custkey % 4 = 0").select(F.col("c_custkey").alias("o"), (F.col("c_custkey") + 700).alias("n"))
    return latest.migrated_ids(t.customer.select("c_custkey", "c_name"), m, "c_custkey", "o", "n")


@query("""
WITH one AS (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN role = 'assistant' THEN 0 ELSE 1 END, turn, role, text) AS n FROM one)
SELECT conv_id, CAST(n AS INTEGER) AS n, role, substring(text, 1, 700) AS text FROM r WHERE n <= 12""")
def dossier_top_evidence(t: Tables) -> DataFrame:
    """Numbered evidence: earliest of equals, priority fields first, cut."""
    return dossier_evidence(t.conversations, "conv_id", "role", "text", "turn", ["assistant"])
