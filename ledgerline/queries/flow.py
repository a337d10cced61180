"""The workflow log, rankings of any size, dossiers and drafts over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.latest import ranked_in_parts
from ledgerline.operators.segments import blocks
from ledgerline.operators.shared import written
from ledgerline.plans import queue, workflow
from ledgerline.queries.decisions import _queue
from ledgerline.queries.registry import ORACLES, Tables, query

_BLOCK = 4096


@query("""
WITH r AS (SELECT *, user_id AS k, event_id AS seq, CASE WHEN event_type = 'view' THEN 'versao' ELSE 'transicao' END AS tipo FROM events),
e AS (SELECT *, last_value(CASE WHEN event_type IN ('signup', 'purchase') THEN event_id END IGNORE NULLS) OVER w AS solto, lag(event_id) OVER w AS antes, lag(tipo) OVER w AS tipo_antes,
  last_value(CASE WHEN tipo = 'transicao' THEN event_id END IGNORE NULLS) OVER w AS ultima, last_value(CASE WHEN tipo = 'transicao' THEN event_type END IGNORE NULLS) OVER w AS ultimo_tipo FROM r WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
v AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN -1 ELSE solto END AS lib, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS outro, lead(CASE WHEN event_type = 'click' AND event_id % 13 <> 0 THEN 1 END) OVER (PARTITION BY user_id ORDER BY event_id) = 1 AS segue FROM e),
b AS (SELECT *, coalesce(ultimo_tipo IN ('signup', 'purchase') AND ultima = lib, false) AS ok FROM v),
c AS (SELECT *, CASE WHEN tipo = 'versao' THEN list_filter([CASE WHEN NOT ok THEN 'geracao_sem_liberacao_valida' END, CASE WHEN ok AND outro = 1 THEN 'versao_exige_o_dossie_liberado' END,
    CASE WHEN ok AND (CASE WHEN outro = 1 THEN 'h1' ELSE 'h0' END) <> (CASE WHEN ultima % 5 = 0 THEN 'h9' ELSE 'h0' END) THEN 'liberacao_hash_dossie_diverge' END, CASE WHEN NOT coalesce(segue, false) THEN 'versao_sem_transicao' END], lambda x: x IS NOT NULL) END AS bad FROM b),
d AS (SELECT *, CASE WHEN tipo = 'versao' THEN bad WHEN event_type <> 'click' THEN [] WHEN NOT coalesce(tipo_antes = 'versao' AND event_id % 13 <> 0, false) THEN ['transicao_sem_versao'] WHEN len(lag(bad) OVER (PARTITION BY user_id ORDER BY event_id)) > 0 THEN ['versao_recusada'] ELSE [] END AS violations FROM c)
SELECT user_id, event_id, tipo, CASE WHEN tipo = 'versao' AND len(violations) = 0 THEN count(*) FILTER (tipo = 'versao' AND len(violations) = 0) OVER (PARTITION BY user_id ORDER BY event_id) END AS versao,
  CASE WHEN tipo = 'versao' AND len(violations) = 0 THEN CASE WHEN event_id % 3 = 0 THEN 'reprovada' ELSE 'aprovada' END END AS status_validacao, array_to_string(violations, ',') AS violations, len(violations) = 0 AS admitted FROM d""")
def paired_versions(t: Tables) -> DataFrame:
    """Versions and the transitions they make, admitted in pairs from one log."""
    k = F.col("event_id")
    w = Window.partitionBy("user_id").orderBy("event_id")
    released = F.last(F.when(F.col("event_type").isin("signup", "purchase"), k), ignorenulls=True).over(w)
    version, release = F.col("event_type") == "view", F.col("event_type").isin("signup", "purchase")
    log = t.events.select(
        "user_id", "event_id", k.alias("id"), F.when(version, "versao").otherwise("transicao").alias("tipo"), F.when(F.col("event_type") == "click", "GERAR_PRE_RELEASE").when(release, "LIBERAR_PRE_RELEASE").otherwise("OUTRA").alias("acao"),
        F.when(release, "PRE_RELEASE_LIBERADO").otherwise("OUTRO").alias("para"), (F.col("user_id") * 10 + F.when(version & (k % 7 == 0), 1).otherwise(0)).alias("dossie_id"), F.when(release, F.when(k % 5 == 0, "h9").otherwise("h0")).alias("hash_dossie"),
        F.when(k % 11 == 0, -1).otherwise(released).alias("liberacao_id"), F.when(k % 3 == 0, 2).otherwise(0).alias("bloqueantes"), F.when(k % 13 != 0, F.lag("event_id").over(w)).alias("versao_id"),
    )
    dossiers = t.events.select("user_id").distinct().select(F.explode(F.array(F.lit(0), F.lit(1))).alias("n"), F.col("user_id").alias("event_id")).select((F.col("event_id") * 10 + F.col("n")).alias("id"), "event_id", F.concat(F.lit("h"), F.col("n").cast("string")).alias("hash"))
    out = workflow.paired_log(log, dossiers, blocks(k, _BLOCK), "user_id", "event_id")
    return out.select("user_id", "event_id", "tipo", "versao", "status_validacao", F.array_join("violations", ",").alias("violations"), "admitted")


@query(f"""
WITH r AS ({ORACLES["queue_rank"]}) SELECT empresa_id, (ordem - 1) // 50 AS parte, count(*) AS n,
  sha256('[' || string_agg('{{"ordem":' || ordem || ',"id":' || id || ',"prioridade":"' || prioridade || '"}}', ',' ORDER BY ordem) || ']') AS hash FROM r GROUP BY 1, 2""")
def queue_pages(t: Tables) -> DataFrame:
    """Each tenant's whole queue as ordered parts."""
    pages = queue.queue_pages(queue.ranked_queue(_queue(t)), ["id", "prioridade"], size=50)
    return pages.select("empresa_id", "parte", F.size("itens").cast("long").alias("n"), F.sha2(F.to_json("itens"), 256).alias("hash"))


def _frozen(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All orders of a status as one lot, by price: three lots of any size."""
    o = t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice")
    leading = [(F.floor(F.col("o_totalprice") / 1000), True)]
    ranked = ranked_in_parts(o, ["o_orderstatus"], leading, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "n")
    return workflow.frozen_lots(written(ranked.select("o_orderstatus", "n", "o_orderkey"), "ranked"), "o_orderstatus", "n", "o_orderkey", 5000, 500)


_CHUNKS = """c AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders),
p AS (SELECT o_orderstatus, (n - 1) // 500 AS parte, count(*) AS n, sha256('[' || string_agg('{"n":' || n || ',"o_orderkey":' || o_orderkey || '}', ',' ORDER BY n) || ']') AS hash FROM c GROUP BY 1, 2)"""


@query(f"WITH {_CHUNKS} SELECT o_orderstatus, parte, n, hash FROM p")
def ranking_chunks(t: Tables) -> DataFrame:
    """A frozen ranking of any size in chunks."""
    return _frozen(t)[0].select("o_orderstatus", "parte", F.size("itens").cast("long").alias("n"), "hash")


@query(f"""
WITH {_CHUNKS} SELECT o_orderstatus, sum(n)::BIGINT AS n, count(*) AS partes, sha256(string_agg(hash, chr(10) ORDER BY parte)) AS hash, sum(n) <= 5000 AS dentro_do_teto FROM p GROUP BY 1""")
def ranking_lots(t: Tables) -> DataFrame:
    """Lots of any size with the hash of their chunks' hashes (V7)."""
    return _frozen(t)[1]
