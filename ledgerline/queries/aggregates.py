"""Counters, totals, distributions and case aggregates over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.operators import counters, joins
from ledgerline.plans.checklist import completeness, module_checklist
from ledgerline.plans.flagship import triage_queue
from ledgerline.queries.registry import Tables, query

CUT = "TIMESTAMP '1998-06-01'"


@query(r"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN lower(p_type) LIKE '%promo%' OR lower(p_type) LIKE '%economy%' THEN sha256(l_orderkey || '|familia:economy|promo')
  ELSE sha256(concat_ws('|', CAST(l_suppkey AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR), coalesce(CAST(NULL AS VARCHAR), 'None'), p_brand)) END AS caso
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT caso, count(*) AS size, min(l_orderkey * 10 + l_linenumber) AS first_line, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM a GROUP BY caso""")
def consolidate_cases(t: Tables) -> DataFrame:
    """Lines grouped by the first key rule that applies (A1, K1-K3)."""
    a = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand"), "l_partkey")
    key = keys.case_key(F.col("l_orderkey"), F.col("p_type"), F.to_date("l_shipdate"), F.col("l_suppkey"), F.lit(None), F.col("p_brand"), F.lit(None).cast("string"), [("promo", "economy")])
    c = a.select(key.alias("caso"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), F.col("l_quantity").cast("long").alias("q"))
    # Members stay in the acts table: a case may hold any share of the lines.
    return c.groupBy("caso").agg(F.count("*").alias("size"), F.min("line").alias("first_line"), F.sum("q").alias("qty"))


@query("""SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT n_name)), '; ') AS places, bool_or(n_regionkey = 2) AS in_state FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY l_orderkey""")
def place_summary(t: Tables) -> DataFrame:
    """Sorted distinct places of a key and whether one is in a state (A2)."""
    links = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey")), "l_suppkey").select("l_orderkey", "n_nationkey")
    return joins.place_summary(links, t.nation.withColumn("uf", F.col("n_regionkey").cast("string")), "l_orderkey", "n_nationkey", "n_name", "uf", "2")


@query("""SELECT l_orderkey, bool_or(l_quantity > 45) AS grande, bool_or(l_discount > 0.08) AS desconto, bool_or(l_returnflag = 'R') AS devolvido FROM lineitem GROUP BY l_orderkey""")
def flags_or(t: Tables) -> DataFrame:
    """Signals of a case: any act has them (A3)."""
    d = t.lineitem.select("l_orderkey", (F.col("l_quantity") > 45).alias("grande"), (F.col("l_discount") > 0.08).alias("desconto"), (F.col("l_returnflag") == "R").alias("devolvido"))
    return counters.flags_or(d, "l_orderkey", ["grande", "desconto", "devolvido"])


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderdate DESC, o_orderkey DESC) = 1""")
def best_member(t: Tables) -> DataFrame:
    """The member that stands for a case (A4, A5)."""
    place = -F.substring("o_orderpriority", 1, 1).cast("int")
    return counters.best_member(t.orders, "o_custkey", [place, F.col("o_totalprice"), F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderkey", "o_orderpriority"])


@query("""SELECT l_suppkey, count(DISTINCT l_orderkey) AS processes, count(DISTINCT l_partkey) AS places, max(l_shipdate) AS last_day FROM lineitem GROUP BY l_suppkey""")
def case_extent(t: Tables) -> DataFrame:
    """Distinct processes and places, latest day."""
    return counters.case_extent(t.lineitem, "l_suppkey", "l_orderkey", "l_partkey", "l_shipdate")


@query(f"""
WITH d AS (SELECT CASE WHEN o_totalprice < 20000 THEN 'descartados' WHEN o_orderstatus = 'F' THEN 'identicos' WHEN o_orderdate < {CUT} THEN 'atualizados' WHEN o_orderpriority = '5-LOW' THEN 'duplicados' ELSE 'novos' END AS o FROM orders)
SELECT count(*) AS analysed, count(*) FILTER (o = 'identicos') AS identicos, count(*) FILTER (o = 'atualizados') AS atualizados, count(*) FILTER (o = 'novos') AS novos, count(*) FILTER (o = 'duplicados') AS duplicados,
  count(*) FILTER (o = 'descartados') AS descartados, true AS adds_up FROM d""")
def run_counters(t: Tables) -> DataFrame:
    """Disjoint run counters that add up."""
    o = F.when(F.col("o_totalprice") < 20000, "descartados").when(F.col("o_orderstatus") == "F", "identicos").when(F.col("o_orderdate") < F.lit("1998-06-01").cast("timestamp"), "atualizados").when(F.col("o_orderpriority") == "5-LOW", "duplicados").otherwise("novos")
    return counters.run_counters(t.orders, o, ["identicos", "atualizados", "novos", "duplicados", "descartados"])


@query("""
WITH d AS (SELECT coalesce(CASE WHEN event_type = 'view' THEN 'registro_identico' WHEN value < 5 THEN 'fora_de_escopo' END, 'elegivel') AS reason FROM events)
SELECT reason, count(*) AS n FROM d GROUP BY reason UNION ALL SELECT 'total', count(*) FROM d""")
def dismissal_counts(t: Tables) -> DataFrame:
    """Dismissals per reason, eligible and total."""
    return counters.dismissal_counts(t.events, F.when(F.col("event_type") == "view", "registro_identico").when(F.col("value") < 5, "fora_de_escopo"))


@query("""SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'TODOS' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderpriority))""")
def level_distribution_sets(t: Tables) -> DataFrame:
    """Level distribution per module and overall."""
    return counters.distribution_sets(t.orders, "o_orderstatus", "o_orderpriority")


@query("""
SELECT o_orderstatus, substring(o_orderpriority, 1, 1) || '->' || CASE WHEN o_totalprice >= 400000 THEN '1' WHEN o_totalprice >= 200000 THEN '3' ELSE '5' END AS change, count(*) AS n FROM orders GROUP BY 1, 2""")
def transition_matrix(t: Tables) -> DataFrame:
    """Priority before against after (A10)."""
    after = F.when(F.col("o_totalprice") >= 400000, "1").when(F.col("o_totalprice") >= 200000, "3").otherwise("5")
    return counters.transition_matrix(t.orders, "o_orderstatus", F.substring("o_orderpriority", 1, 1), after)


@query("""
WITH g AS (SELECT event_type || ':' || CAST(user_id AS VARCHAR) || '; ' || CASE WHEN value > 50 THEN 'alto:1' ELSE '' END AS tags FROM events),
x AS (SELECT trim(unnest(string_split(tags, ';'))) AS t FROM g) SELECT split_part(t, ':', 1) AS tag, count(*) AS n FROM x WHERE t <> '' GROUP BY 1""")
def review_tag_groups(t: Tables) -> DataFrame:
    """Review tags grouped by prefix."""
    tags = F.concat("event_type", F.lit(":"), F.col("user_id").cast("string"), F.lit("; "), F.when(F.col("value") > 50, "alto:1").otherwise(""))
    return counters.tag_groups(t.events.select(tags.alias("tags")), "tags")


@query("""
SELECT user_id, count(*) AS calls, count(*) FILTER (event_type = 'purchase') AS successes, count(*) FILTER (event_type <> 'purchase') AS failures, count(DISTINCT CASE WHEN event_type = 'purchase' THEN event_id // 100 END) AS events_served,
  CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN event_id END), 0) AS BIGINT) AS tokens, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18, 2)) END), 0) AS DOUBLE) AS cost FROM events GROUP BY user_id""")
def call_totals(t: Tables) -> DataFrame:
    """Totals of a run's calls."""
    e = t.events.select("user_id", "event_type", F.expr("event_id div 100").alias("lot"), "event_id", F.col("value").cast("decimal(18,2)").alias("cost"))
    return counters.call_totals(e, "user_id", "event_type", "lot", "cost", "event_id", "purchase").withColumn("cost", F.col("cost").cast("double"))


@query("""SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END, o_totalprice * 2) AS base FROM orders""")
def kept_base(t: Tables) -> DataFrame:
    """A base of totals set once."""
    d = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).alias("base"), (F.col("o_totalprice") * 2).alias("current"))
    return counters.kept_base(d, "base", "current").drop("current")


@query("""
WITH e AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag <> 'N' THEN 2 ELSE 1 END) AS q FROM lineitem GROUP BY 1), d AS (SELECT doc_id % 500 AS k, count(*) AS n FROM documents GROUP BY 1)
SELECT o_orderkey, CAST(coalesce(e.q, 0) + coalesce(d.n, 0) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS evidence_quality FROM orders LEFT JOIN e ON o_orderkey = l_orderkey LEFT JOIN d ON o_orderkey = d.k""")
def evidence_quality(t: Tables) -> DataFrame:
    """Evidence quality from two child tables, without fan-out."""
    ev = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "x").otherwise("").alias("url"))
    e = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_returnflag") != "N", "x").alias("trecho"))
    return counters.evidence_quality(ev, e, t.documents.select((F.col("doc_id") % 500).alias("o_orderkey")), "o_orderkey", "trecho", "url").drop("url")


@query("""SELECT user_id, max(ts) AS last_change FROM events WHERE event_type = 'error' GROUP BY user_id""")
def last_material_change(t: Tables) -> DataFrame:
    """Last material change per key."""
    return counters.last_material_change(t.events, "user_id", "event_type", "ts", "error")


@query("""WITH e AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, CAST(sum(n) AS BIGINT) AS calls, max(n) AS most_of_one_event FROM e GROUP BY user_id""")
def calls_per_lot(t: Tables) -> DataFrame:
    """Calls per lot and per event in it."""
    return counters.calls_per_lot(t.events, "user_id", "event_type")


@query("""
SELECT user_id, CAST(coalesce(sum(CASE WHEN date_trunc('day', ts) = TIMESTAMP '2024-01-15' THEN CAST(value AS DECIMAL(18, 2)) END), 0) AS DOUBLE) AS day_cost,
  CAST(coalesce(sum(CASE WHEN date_trunc('month', ts) = TIMESTAMP '2024-01-01' THEN CAST(value AS DECIMAL(18, 2)) END), 0) AS DOUBLE) AS month_cost FROM events GROUP BY user_id""")
def spend_limits(t: Tables) -> DataFrame:
    """Spending of the day and month per tenant."""
    e = t.events.select("user_id", "ts", F.col("value").cast("decimal(18,2)").alias("value"))
    return counters.consumption(e, "user_id", "ts", "value", F.lit("2024-01-15 12:00:00").cast("timestamp")).withColumns({c: F.col(c).cast("double") for c in ("day_cost", "month_cost")})


@query("""
WITH a AS (SELECT c_custkey, (CASE WHEN c_name <> '' THEN 1 ELSE 0 END) + (CASE WHEN c_acctbal > 2000 THEN 1 ELSE 0 END) + (CASE WHEN c_acctbal > 4000 THEN 1 ELSE 0 END) + (CASE WHEN c_mktsegment <> '' THEN 1 ELSE 0 END)
  + (CASE WHEN c_nationkey % 2 = 0 THEN 1 ELSE 0 END) + 4 AS n FROM customer)
SELECT c_custkey, CAST(n AS BIGINT) AS confirmadas, n / 12.0::DOUBLE AS share, CASE WHEN n / 12.0::DOUBLE >= 0.75 THEN 'Alta' WHEN n / 12.0::DOUBLE >= 0.5 THEN 'Media' ELSE 'Baixa' END AS grau FROM a""")
def completeness_grade(t: Tables) -> DataFrame:
    """Completeness of a twelve-question checklist."""
    b, k = F.col("c_acctbal"), F.col("c_custkey").cast("string")
    d = t.customer.select("c_custkey", F.col("c_name").alias("titular"), F.when(b > 2000, "x").alias("evento"), F.when(b > 4000, "x").alias("data_evento"), F.col("c_mktsegment").alias("municipio"), F.when(F.col("c_nationkey") % 2 == 0, "x").alias("processo"), k.alias("substancia"), k.alias("fase"), k.alias("orgao"), k.alias("url_oficial"))
    return completeness(module_checklist(d, "c_custkey", "atos"), "c_custkey")


@query("""SELECT user_id, event_type, count(*) AS attempts, arg_max(value, event_id) AS last_status FROM events GROUP BY user_id, event_type""")
def retry_counter(t: Tables) -> DataFrame:
    """Attempts and last status per key."""
    return counters.retries(t.events, ["user_id", "event_type"], "event_id", "value")


@query(r"""
WITH cur AS (SELECT o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC NULLS FIRST, o_orderkey) = 1),
a AS (SELECT CASE WHEN regexp_matches(lower(p_type), 'economy|standard') THEN sha256(l_orderkey || '|familia:economy|standard')
    ELSE sha256(concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), 'None'), CAST(CAST(l_shipdate AS DATE) AS VARCHAR), coalesce(p_brand, 'None'), CAST(l_suppkey AS VARCHAR))) END AS caso, CAST(l_shipdate AS DATE) AS dia,
    l_quantity > 40 AS g, l_returnflag = 'R' AS d, l_extendedprice > 60000 AS c, l_discount >= 0.05 AS x, coalesce(o_orderpriority = '1-URGENT', false) AS u, cur.o_orderkey IS NOT NULL AS v
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = orders.o_orderkey LEFT JOIN cur ON l_orderkey = cur.o_orderkey
  WHERE CAST(l_shipdate AS DATE) >= DATE '1996-01-01' AND NOT coalesce(contains(lower(p_type), 'promo'), false)),
b AS (SELECT caso, bool_or(g) AS g, bool_or(d) AS d, bool_or(c) AS c, bool_or(x) AS x, bool_or(u) AS u, bool_or(v) AS v, count(*) AS atos, max(dia) AS ultimo_dia FROM a GROUP BY caso),
s AS (SELECT *, greatest(least(g::INT * 4 + d::INT * 3 + c::INT * 3 + u::INT * 2 + v::INT, 10) - x::INT * 2, 0) AS s0 FROM b),
z AS (SELECT caso, atos, ultimo_dia, CAST(CASE WHEN g AND d AND c THEN greatest(s0, 8) ELSE s0 END AS DOUBLE) AS score FROM s)
SELECT *, CASE WHEN score >= 8 THEN 'A' WHEN score >= 5 THEN 'B' WHEN score >= 2 THEN 'C' ELSE 'D' END AS faixa FROM z ORDER BY score DESC, ultimo_dia DESC, caso LIMIT 20""")
def flagship(t: Tables) -> DataFrame:
    """The end-to-end query of ``entry``."""
    return triage_queue(t.spark, t.folder)
