"""Scoping, joins, set operations and change capture over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import dates, keys
from ledgerline.operators import audit, joins, scope
from ledgerline.operators.latest import latest_per_key
from ledgerline.operators.segments import blocks
from ledgerline.operators.shared import written
from ledgerline.queries.registry import Tables, query
from ledgerline.sources.scan import load_counts, scoped_load

REF = "2001-11-05"


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, p_type, o_custkey, o_orderstatus, c_name, n_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def enrich_fact(t: Tables) -> DataFrame:
    """Fact with five dimensions, pruned."""
    fact = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice").withColumnsRenamed({"l_partkey": "p_partkey", "l_orderkey": "o_orderkey"})
    out = joins.enriched(fact, [(t.part, "p_partkey", ["p_type"]), (t.orders, "o_orderkey", ["o_custkey", "o_orderstatus"])])
    out = joins.enriched(out.withColumnRenamed("o_custkey", "c_custkey"), [(t.customer, "c_custkey", ["c_name", "c_nationkey"])])
    out = joins.enriched(out.withColumnRenamed("c_nationkey", "n_nationkey"), [(t.nation, "n_nationkey", ["n_name"])])
    return out.drop("n_nationkey").withColumnsRenamed({"p_partkey": "l_partkey", "o_orderkey": "l_orderkey", "c_custkey": "o_custkey"})


_RULES_SQL = """CASE WHEN l_shipdate < TIMESTAMP '1997-01-01' THEN 'data' WHEN o_orderkey IS NULL OR o_orderstatus <> 'F' THEN 'chave' WHEN p_type = 'PROMO' THEN 'familia' END"""


def _rules() -> list:
    return [("data", F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp")), ("chave", F.coalesce(F.col("o_orderstatus") != "F", F.lit(True))), ("familia", F.coalesce(F.col("p_type") == "PROMO", F.lit(False)))]


def _fact(t: Tables) -> DataFrame:
    f = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey", "left")
    return f.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey", "left")


@query(f"""
WITH d AS (SELECT coalesce({_RULES_SQL}, 'aceito') AS motivo FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)
SELECT motivo, count(*) AS n FROM d GROUP BY motivo""")
def scoped_load_counts(t: Tables) -> DataFrame:
    """Rejection counters of a scoped load, observed while its rows are written."""
    kept, seen = scoped_load(_fact(t), _rules())
    written(kept, "scoped")
    return load_counts(t.spark, seen)


@query(f"""
SELECT l_orderkey, l_linenumber, l_shipdate, p_type FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey WHERE {_RULES_SQL} IS NULL""")
def scoped_load_rows(t: Tables) -> DataFrame:
    """The rows of a scoped load."""
    return scoped_load(_fact(t), _rules())[0].select("l_orderkey", "l_linenumber", "l_shipdate", "p_type")


@query(f"""
WITH d AS (SELECT {_RULES_SQL} AS why FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)
SELECT count(*) AS "read", count(*) FILTER (why = 'data') AS data, count(*) FILTER (why = 'chave') AS chave, count(*) FILTER (why = 'familia') AS familia, count(*) FILTER (why IS NULL) AS kept FROM d""")
def reject_counters(t: Tables) -> DataFrame:
    """Disjoint rejection counters in one pass."""
    return scope.reject_counters(_fact(t), _rules())


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 0)""")
def territory_semi(t: Tables) -> DataFrame:
    """Orders with a supplier of one region among others (F1)."""
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("uf"))
    places = t.lineitem.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("o_orderkey"), "uf")
    return scope.with_presence(t.orders.select("o_orderkey", "o_custkey"), places, "o_orderkey", "uf", "r0")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE lower(p_type) LIKE '%promo%' OR lower(p_type) LIKE '%eco%')""")
def family_anti(t: Tables) -> DataFrame:
    """Rows whose type is in no excluded family, judged in the dictionary (F2)."""
    return scope.without_families(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), t.part.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "p_type", ["Promo", "ECO"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT p_partkey, p_type FROM part WHERE NOT lower(p_type) LIKE '%standard%'""")
def family_text(t: Tables) -> DataFrame:
    """The same by the row's own text."""
    return scope.without_family_text(t.part.select("p_partkey", "p_type"), "p_type", ["standard"])


@query("""
SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 1) AND NOT lower(c_mktsegment) LIKE '%building%'""")
def scope_composite(t: Tables) -> DataFrame:
    """Presence, then family text."""
    places = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("string").alias("uf"))
    return scope.scoped(t.customer, places, "c_nationkey", "uf", "1", "c_mktsegment", ["building"]).select("c_custkey", "c_mktsegment")


@query("""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-06-01'""")
def date_floor(t: Tables) -> DataFrame:
    """Rows from a day on."""
    d = t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))
    return scope.from_day(d, F.col("day"), F.lit("2000-06-01").cast("date"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders
WHERE o_orderkey % 7 = 0 OR CAST(o_orderdate AS DATE) >= DATE '2001-11-05' - 1095""")
def date_window_kept(t: Tables) -> DataFrame:
    """A window that keeps undated rows."""
    day = F.when(F.col("o_orderkey") % 7 != 0, F.to_date("o_orderdate"))
    d = t.orders.select("o_orderkey", day.alias("day"))
    return scope.from_day(d, F.col("day"), dates.window_floor(F.lit(REF).cast("date"), 1095), keep_undated=True)


@query("""SELECT count(*) FILTER (o_orderkey % 11 = 0 OR o_custkey % 13 = 0) AS dropped, count(*) AS total FROM orders""")
def incomplete_rows(t: Tables) -> DataFrame:
    """Rows without key or date, counted (F8)."""
    d = t.orders.select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey")).alias("k"), F.when(F.col("o_custkey") % 13 != 0, F.col("o_orderdate")).alias("d"))
    return scope.complete_rows(d, ["k", "d"])[1]


@query("""
SELECT c_custkey, c_mktsegment = 'BUILDING' AND c_nationkey = 3 AS ok, array_to_string(list_filter([CASE WHEN c_nationkey <> 3 THEN 'nation' END, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'segment' END], lambda x: x IS NOT NULL), ',') AS missing FROM customer""")
def portfolio_criteria(t: Tables) -> DataFrame:
    """Criteria given as a map."""
    wanted = F.create_map(F.lit("segment"), F.lit("Building"), F.lit("nation"), F.lit(" 3 "))
    ok, missing = scope.criteria_met({"segment": F.col("c_mktsegment"), "nation": F.col("c_nationkey")}, wanted)
    return t.customer.select("c_custkey", ok.alias("ok"), F.array_join(missing, ",").alias("missing"))


@query(r"""
SELECT page_id, CASE WHEN NOT regexp_matches(lower(url), '^https?://') THEN 'esquema'
  WHEN NOT regexp_matches(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)), '(^|\.)(example\.com|example\.org)$') THEN 'dominio'
  WHEN NOT regexp_matches(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '^/(en|de)') THEN 'caminho' END AS refused FROM pages""")
def url_allow(t: Tables) -> DataFrame:
    """Allow-list of hosts and paths."""
    return t.pages.select("page_id", scope.url_allowed(F.col("url"), ["example.com", "example.org"], ["/en", "/de"]).alias("refused"))


@query("""SELECT page_id, contains(lower(substring(html, 1, 200000)), 'class="ad"') OR contains(lower(substring(html, 1, 200000)), 'captcha') AS barrier FROM pages""")
def page_barrier(t: Tables) -> DataFrame:
    """Signature of a barrier in a page."""
    return t.pages.select("page_id", scope.barrier_in(F.col("html"), ['class="AD"', "captcha"]).alias("barrier"))


@query("""SELECT o_orderpriority, count(*) AS dismissed FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority""")
def level_floor_counts(t: Tables) -> DataFrame:
    """Rows below a level floor, counted."""
    return scope.level_floor(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])[1]


@query("""
WITH c AS (SELECT n_nationkey AS id, n_nationkey % 4 <> 0 AS ativa, 80 + n_nationkey % 3 * 15 AS a, 60 AS b, 40 + n_nationkey % 5 * 6 AS c FROM nation),
w AS (SELECT c_nationkey AS id, min(c_acctbal + 900) AS low FROM customer GROUP BY 1), s AS (SELECT DISTINCT s_nationkey AS id FROM supplier WHERE s_acctbal > 5000)
SELECT c.id AS carteira_id, array_to_string(list_filter([CASE WHEN NOT ativa THEN 'inativa' END, CASE WHEN s.id IS NULL THEN 'sem_fonte_de_coleta' END, CASE WHEN a > 100 OR b > 100 OR c > 100 THEN 'banda_fora_de_0_100' END,
  CASE WHEN NOT (a >= b AND b >= c) THEN 'bandas_fora_de_ordem' END, CASE WHEN low < 0 THEN 'peso_negativo' END], lambda x: x IS NOT NULL), ',') AS violations
FROM c LEFT JOIN w ON c.id = w.id LEFT JOIN s ON c.id = s.id""")
def config_checks(t: Tables) -> DataFrame:
    """Validation of portfolio configurations."""
    n = F.col("n_nationkey")
    p = t.nation.select(n.alias("carteira_id"), (n % 4 != 0).alias("ativa"), (80 + n % 3 * 15).alias("banda_a"), F.lit(60).alias("banda_b"), (40 + n % 5 * 6).alias("banda_c"))
    w = t.customer.select(F.col("c_nationkey").alias("carteira_id"), (F.col("c_acctbal") + 900).alias("peso"))
    s = t.supplier.select(F.col("s_nationkey").alias("carteira_id"), (F.col("s_acctbal") > 5000).alias("coleta"))
    return scope.config_violations(p, w, s).withColumn("violations", F.array_join("violations", ","))


@query("""
SELECT o_custkey, count(DISTINCT o_orderpriority) AS candidates, CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN 'ambiguo' ELSE 'ok' END AS status,
  CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN max(o_orderpriority) END AS o_orderpriority FROM orders GROUP BY o_custkey""")
def scope_resolution(t: Tables) -> DataFrame:
    """Exactly one value per key, or why not."""
    return scope.resolved_scope(t.orders, "o_custkey", "o_orderstatus", "o_orderpriority")


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 0)""")
def tenant_visibility(t: Tables) -> DataFrame:
    """Rows of tenants with an active link."""
    links = t.customer.select(F.col("c_custkey").alias("empresa_id"), F.col("c_mktsegment").alias("usuario_id"), (F.col("c_acctbal") > 0).alias("ativo"))
    ev = t.orders.select("o_orderkey", F.col("o_custkey").alias("empresa_id"))
    return scope.visible(ev, links, "MACHINERY", False).withColumnRenamed("empresa_id", "o_custkey")


@query("""SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN props END AS props FROM events""")
def masked_history(t: Tables) -> DataFrame:
    """Texts of successful calls only."""
    return scope.masked_history(t.events, ["event_id", "event_type"], "props", "event_type", "purchase")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def known_keys_semi(t: Tables) -> DataFrame:
    """Semi-join reduction by known keys."""
    known = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("key"))
    return joins.only_known(t.lineitem.select("l_orderkey", "l_linenumber"), known, "l_orderkey")


@query("""
SELECT c_custkey, c_name FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')
  AND c_name NOT IN (SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderpriority = '5-LOW')""")
def not_processed(t: Tables) -> DataFrame:
    """Items known under neither form of their key."""
    c = t.customer.select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    done = joins.known_keys([(t.orders.filter("o_orderstatus = 'F'"), [F.col("o_custkey")]), (t.orders.filter("o_orderpriority = '5-LOW'").join(c, F.col("o_custkey").cast("string") == F.col("id")), [F.col("c_name")])])
    return joins.not_processed(c, done, ["id", "c_name"]).select(F.col("id").cast("long").alias("c_custkey"), "c_name")


@query("""SELECT DISTINCT trim(w) AS key FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE trim(w) <> ''""")
def listed_keys(t: Tables) -> DataFrame:
    """Keys of a column that lists several."""
    return joins.split_keys(t.part, "p_name", " ")


@query("""
WITH b AS (SELECT o_orderkey, md5(concat_ws('|', o_orderstatus, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderpriority END)) AS h FROM orders WHERE o_orderkey % 9 <> 0)
SELECT o.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'novo' WHEN md5(concat_ws('|', o_orderstatus, o_orderpriority)) <> b.h THEN 'alterado' ELSE 'identico' END AS status FROM orders o LEFT JOIN b ON o.o_orderkey = b.o_orderkey""")
def inventory_diff(t: Tables) -> DataFrame:
    """New, changed and identical items against the run before."""
    h = lambda p: F.md5(F.concat_ws("|", "o_orderstatus", p)).alias("h")
    before = t.orders.filter("o_orderkey % 9 <> 0").select("o_orderkey", h(F.when(F.col("o_orderkey") % 10 == 0, F.lit("X")).otherwise(F.col("o_orderpriority"))))
    return joins.inventory_diff(t.orders.select("o_orderkey", h(F.col("o_orderpriority"))), before, "o_orderkey", "h").select("o_orderkey", "status")


@query("""
WITH e AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders WHERE o_custkey IS NOT NULL)
SELECT a.o_custkey, a.o_orderkey, count(*) AS others, min(b.o_orderkey) AS first_other, max(b.o_orderkey) AS last_other FROM e a JOIN e b ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey GROUP BY a.o_custkey, a.o_orderkey""")
def antecedents(t: Tables) -> DataFrame:
    """Other items of the same holder, without pairing them."""
    return joins.antecedents(t.orders, "o_custkey", "o_orderkey")


@query("""
WITH e AS (SELECT DISTINCT p_partkey AS i, 'p_brand' AS c, p_brand AS v FROM part UNION SELECT DISTINCT p_partkey, 'p_name', p_name FROM part),
f AS (SELECT i AS origem, lag(i) OVER (PARTITION BY c, v ORDER BY i) AS relacionado, c AS criterio, v AS value FROM e)
SELECT * FROM f WHERE relacionado IS NOT NULL""")
def antecedent_edges(t: Tables) -> DataFrame:
    """Edges among items that share a value."""
    return joins.antecedent_edges(t.part, "p_partkey", ["p_brand", "p_name"], lambda item: blocks(item, 4096))


@query("""
WITH u AS (SELECT s_nationkey AS origem, s_suppkey AS relacionado, 'velho' AS via, 0 AS age FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_nationkey, s_suppkey, 'novo', 1 FROM supplier WHERE s_suppkey % 3 = 0)
SELECT origem, relacionado, via FROM u QUALIFY row_number() OVER (PARTITION BY origem, relacionado ORDER BY age) = 1""")
def edge_upsert(t: Tables) -> DataFrame:
    """Edges merged, the older staying."""
    edge = lambda m, via: t.supplier.filter(f"s_suppkey % {m} = 0").select(F.col("s_nationkey").alias("origem"), F.col("s_suppkey").alias("relacionado"), F.lit(via).alias("via"))
    return joins.upserted_edges(edge(2, "velho"), edge(3, "novo"), ["origem", "relacionado"])


@query("""
WITH v AS (SELECT l_partkey AS k, l_shipdate AS since, max(CAST(l_extendedprice AS DECIMAL(18, 2))) AS price FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CAST(price AS DOUBLE) AS price FROM (SELECT * FROM lineitem WHERE l_linenumber > 1) f ASOF LEFT JOIN v ON f.l_partkey = v.k AND f.l_shipdate >= v.since""")
def asof_price(t: Tables) -> DataFrame:
    """The price version in force at each fact's time."""
    v = t.lineitem.filter("l_linenumber = 1").groupBy("l_partkey", F.col("l_shipdate").alias("since")).agg(F.max("l_extendedprice").alias("price"))
    f = t.lineitem.filter("l_linenumber > 1").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return joins.as_of(f, v, "l_partkey", "l_shipdate", "since", ["price"], ["l_orderkey"], lambda at: F.date_trunc("year", at))


@query("""
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'so_antigo' WHEN a.k IS NULL THEN 'so_novo' ELSE 'ambos' END AS presence
FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority = '5-LOW') b ON a.k = b.k""")
def matched_cases(t: Tables) -> DataFrame:
    """Existing against incoming keys."""
    k = F.col("o_custkey").alias("k")
    return joins.matched_cases(t.orders.filter("o_orderstatus = 'F'").select(k), t.orders.filter("o_orderpriority = '5-LOW'").select(k), ["k"])


@query("""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""")
def missing_parents(t: Tables) -> DataFrame:
    """Violations of an existence check."""
    parents = t.supplier.filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return joins.unmatched(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), parents, ["l_suppkey"])


@query("""
WITH r AS (SELECT p_type, CASE WHEN p_size % 2 = 0 THEN p_brand END AS sub, max(p_partkey) AS version FROM part GROUP BY 1, 2)
SELECT p.p_partkey, r.version AS rule_part FROM part p LEFT JOIN r ON p.p_type = r.p_type AND r.sub IS NOT DISTINCT FROM (CASE WHEN p.p_size % 3 = 0 THEN p.p_brand END)""")
def rule_lookup(t: Tables) -> DataFrame:
    """Newest rule by type and null-aware subtype."""
    sub = lambda m: F.when(F.col("p_size") % m == 0, F.col("p_brand")).alias("sub")
    rules = t.part.select("p_type", sub(2), "p_partkey", F.col("p_partkey").alias("rule_part"))
    return joins.rule_lookup(t.part.select("p_partkey", "p_type", sub(3)), rules.withColumnRenamed("p_partkey", "version"), ["p_type"], ["sub"], "version", ["rule_part"], "p_partkey").select("p_partkey", "rule_part")


@query("""SELECT o_orderkey, o_custkey, o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) AS is_latest FROM orders""")
def latest_proposals(t: Tables) -> DataFrame:
    """Whether a proposal is made on its key's latest version."""
    o = t.orders.select("o_orderkey", "o_custkey")
    return joins.is_latest(o, o, "o_custkey", "o_orderkey")


_OLD = "SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_orderkey % 5 <> 0"
_NEW = "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN 'Z' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 8 = 0 THEN '9' ELSE o_orderpriority END AS priority FROM orders WHERE o_orderkey % 4 <> 0"


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    old = t.orders.filter(k % 5 != 0).select(k.alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    new = t.orders.filter(k % 4 != 0).select(k.alias("k"), F.when(k % 6 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("status"), F.when(k % 7 == 0, None).when(k % 8 == 0, "9").otherwise(F.col("o_orderpriority")).alias("priority"))
    return old, new


@query(f"""
WITH o AS ({_OLD}), n AS ({_NEW})
SELECT o.k, 'status' AS campo, o.status AS antes, n.status AS depois FROM o JOIN n ON o.k = n.k WHERE n.status IS NOT NULL AND o.status IS DISTINCT FROM n.status
UNION ALL SELECT o.k, 'priority', o.priority, n.priority FROM o JOIN n ON o.k = n.k WHERE n.priority IS NOT NULL AND o.priority IS DISTINCT FROM n.priority""")
def field_audit(t: Tables) -> DataFrame:
    """Field-level diffs of an upsert."""
    return audit.field_diffs(*_snapshots(t), ["k"], ["status", "priority"])


@query(f"""
WITH o AS ({_OLD}), n AS ({_NEW})
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN n.status ELSE o.status END AS status, CASE WHEN o.k IS NULL THEN n.priority ELSE coalesce(n.priority, o.priority) END AS priority,
  CASE WHEN o.k IS NULL THEN 'inserido' WHEN n.k IS NOT NULL AND n.priority IS NOT NULL AND n.priority IS DISTINCT FROM o.priority THEN 'atualizado' ELSE 'inalterado' END AS acao FROM o FULL JOIN n ON o.k = n.k""")
def upsert_protected(t: Tables) -> DataFrame:
    """Upsert that leaves a human-owned field alone."""
    return audit.upserted(*_snapshots(t), ["k"], ["status", "priority"], ["status"])


@query("""
WITH log AS (SELECT user_id, event_type, value, event_id FROM events WHERE event_id % 3 = 0), l AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
n AS (SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT n.user_id, n.event_type FROM n LEFT JOIN l ON n.user_id = l.user_id WHERE l.user_id IS NULL OR n.event_type IS DISTINCT FROM l.event_type""")
def changed_decisions_only(t: Tables) -> DataFrame:
    """Decisions that differ from the last one logged."""
    now = latest_per_key(t.events, ["user_id"], [F.col("event_id").desc()]).select("user_id", "event_type")
    return audit.changed_decisions(now, t.events.filter("event_id % 3 = 0").select("user_id", "event_type", "event_id"), "user_id", ["event_type"], "event_id")


@query(f"""
WITH o AS ({_OLD}), n AS ({_NEW})
SELECT o.k, o.status IS DISTINCT FROM n.status OR o.priority IS DISTINCT FROM n.priority AS changed FROM o JOIN n ON o.k = n.k""")
def material_changes(t: Tables) -> DataFrame:
    """Null-safe change test over several fields (C4)."""
    old, new = _snapshots(t)
    s = lambda df, n: df.select("k", F.struct("status", "priority").alias(n))
    return s(old, "a").join(s(new, "b"), "k").select("k", audit.material_change("a", "b", ["status", "priority"]).alias("changed"))


@query("""SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def common_keys(t: Tables) -> DataFrame:
    """Keys of both."""
    return audit.common(t.orders.filter("o_orderstatus = 'F'"), t.orders.filter("o_orderstatus = 'O'"), "o_custkey")


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def difference_by_key(t: Tables) -> DataFrame:
    """Rows whose key the other table has not."""
    return audit.difference(t.customer.select("c_custkey"), t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""SELECT c_custkey AS id, c_name AS nome, NULL::VARCHAR AS tipo FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier UNION ALL SELECT p_partkey, p_name, p_type FROM part""")
def united_modules(t: Tables) -> DataFrame:
    """One table of several modules."""
    c, s = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome")), t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"))
    return audit.united([c, s, t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("nome"), F.col("p_type").alias("tipo"))])


@query("""SELECT text, min(conv_id * 1000 + turn) AS place FROM conversations GROUP BY text""")
def first_of_each_text(t: Tables) -> DataFrame:
    """De-duplication, the first of each kept."""
    c = t.conversations.select("text", (F.col("conv_id") * 1000 + F.col("turn")).alias("place"))
    return audit.first_of_each(c, ["text"], "place")


@query(r"""
WITH d AS (SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9_\s]', ' ', 'g') AS n, p_size FROM part)
SELECT DISTINCT sha256(concat_ws('|', CAST(p_size AS VARCHAR), trim(regexp_replace(n, '\s+', ' ', 'g')), '2001-01-01')) AS ato FROM d""")
def act_identities(t: Tables) -> DataFrame:
    """Distinct acts by the hash of process, normal form and day (D3)."""
    return t.part.select(keys.act_key(F.col("p_size"), F.col("p_name"), F.lit("2001-01-01")).alias("ato")).dropDuplicates()
