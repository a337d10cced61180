"""Dossiers, claims, versions and drafts of the workflow over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.latest import version_chain
from ledgerline.operators.shared import written
from ledgerline.plans import queue, workflow
from ledgerline.queries.registry import Tables, query

_STATES = ("confirmado", "nao_localizado", "aguardando_contraditorio", "nao_aplicavel", "outro", "confirmado")
_CLASSES = ("FATO_PRINCIPAL", "ATRIBUICAO", "GRAVIDADE", "PERIFERICA", "X")


def _pick(values, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))


def _sql_pick(values, at: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][{at} % {len(values)} + 1]"


def _evidence(t: Tables) -> DataFrame:
    return t.orders.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderkey").alias("event_id"))


def _dossiers(t: Tables, column: str = "matriz") -> DataFrame:
    """A dossier per order: its lines as the items of a matrix, or as claims (``afirmacoes``)."""
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    own = F.concat(F.lit("o"), (F.col("l_orderkey") + F.when(supplier % 9 == 0, 1).otherwise(0)).cast("string"))
    none = part % 6 == 5
    item = F.struct(
        F.when(part % 17 == 0, "").otherwise(F.concat(F.lit("c"), F.col("l_linenumber").cast("string"))).alias("codigo"), _pick(_STATES, part).alias("estado"), (F.col("l_quantity") > 25).alias("critico"), _pick(_CLASSES, supplier).alias("classe_impacto"),
        (F.col("l_linenumber") == 1).alias("fonte_primaria"), F.when(none, F.array().cast("array<string>")).otherwise(F.array(own)).alias("evidencia_ids"), F.when(F.col("l_tax") > 0.04, "x").alias("observacao"),
        F.when(F.col("l_discount") > 0.05, True).when(F.col("l_discount") >= 0.02, False).alias("risco_reputacional"), F.when(F.col("l_linestatus") == "O", "j").alias("justificativa_sem_risco"),
    )
    claim = F.struct(
        F.when(part % 13 == 0, " ").otherwise(F.concat(F.lit("a"), F.col("l_linenumber").cast("string"))).alias("id"), F.when(part % 11 != 0, "t").alias("texto"), _pick(_STATES, part).alias("status"),
        F.when(none, F.array().cast("array<struct<evidencia_id:string>>")).otherwise(F.array(F.struct(own.alias("evidencia_id")))).alias("evidencias"),
    )
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_extendedprice")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), (item if column == "matriz" else claim).alias("i")))).alias("l"))
    made = lines.select(F.col("l_orderkey").alias("o_orderkey"), F.to_json(F.transform("l", lambda x: x["i"])).alias(column))
    return written(t.orders.select("o_orderkey").join(made, "o_orderkey", "left").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("event_id"), column), "dossiers")


_LINES = f"""i AS (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_linestatus, l_extendedprice) AS p, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln,
  CASE WHEN l_partkey % 17 = 0 THEN '' ELSE 'c' || l_linenumber END AS codigo, {_sql_pick(_STATES, "l_partkey")} AS estado, {_sql_pick(_CLASSES, "l_suppkey")} AS classe, l_quantity > 25 AS critico, l_partkey % 6 = 5 AS nada, l_tax > 0.04 AS obs,
  CASE WHEN l_discount > 0.05 THEN true WHEN l_discount >= 0.02 THEN false END AS risco, l_linestatus = 'O' AS just FROM lineitem)"""


@query(f"""
WITH {_LINES}, c AS (SELECT k, p, codigo, unnest(list_filter([CASE WHEN codigo = '' THEN 'sem_codigo' END, CASE WHEN estado = 'outro' THEN 'estado' END, CASE WHEN classe = 'X' THEN 'classe_impacto' END, CASE WHEN critico AND classe = 'PERIFERICA' THEN 'critico_periferico' END,
  CASE WHEN estado = 'confirmado' AND nada THEN 'confirmado_sem_evidencia' END, CASE WHEN estado = 'nao_localizado' AND NOT obs THEN 'nao_localizado_sem_observacao' END, CASE WHEN estado = 'aguardando_contraditorio' AND risco = false AND NOT just THEN 'sem_risco_sem_justificativa' END,
  CASE WHEN NOT nada AND sk % 9 = 0 THEN 'evidencia_de_outro_evento' END], lambda x: x IS NOT NULL)) AS code FROM i),
g AS (SELECT k, string_agg(codigo || ':' || code, ',' ORDER BY p, code, codigo) AS v FROM c GROUP BY k)
SELECT o_orderkey AS id, CASE WHEN o_orderkey NOT IN (SELECT k FROM i) THEN 'matriz_invalida' ELSE coalesce(v, '') END AS violations FROM orders LEFT JOIN g ON k = o_orderkey""")
def matrix_checks(t: Tables) -> DataFrame:
    """Evidence matrices and what is wrong with them."""
    return workflow.matrix_violations(_dossiers(t), _evidence(t)).select("id", F.array_join("violations", ",").alias("violations"))


@query(f"""
WITH {_LINES}, a AS (SELECT *, CASE WHEN pk % 13 = 0 THEN ' ' ELSE 'a' || ln END AS aid FROM i),
c AS (SELECT k, p, aid, unnest(list_filter([CASE WHEN aid = ' ' OR pk % 11 = 0 THEN 'sem_id_ou_texto' END, CASE WHEN estado = 'outro' THEN 'status' END, CASE WHEN estado = 'confirmado' AND nada THEN 'confirmada_sem_evidencia' END, CASE WHEN NOT nada AND sk % 9 = 0 THEN 'evidencia_de_outro_evento' END], lambda x: x IS NOT NULL)) AS code FROM a),
g AS (SELECT k, string_agg(aid || ':' || code, ',' ORDER BY p, code, aid) AS v FROM c GROUP BY k)
SELECT o_orderkey AS id, CASE WHEN o_orderkey NOT IN (SELECT k FROM i) THEN 'afirmacoes_invalidas' ELSE coalesce(v, '') END AS violations FROM orders LEFT JOIN g ON k = o_orderkey""")
def claim_checks(t: Tables) -> DataFrame:
    """Claims and what is wrong with them."""
    return workflow.claim_violations(_dossiers(t, "afirmacoes"), _evidence(t)).select("id", F.array_join("violations", ",").alias("violations"))


@query(f"""
WITH {_LINES}, m AS (SELECT k, bool_or(ln = 1 AND estado <> 'confirmado') AS fonte, bool_or((estado NOT IN ('confirmado', 'nao_aplicavel') AND classe <> 'PERIFERICA') OR (estado = 'aguardando_contraditorio' AND coalesce(risco, true))) AS lacuna FROM i GROUP BY k),
v AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, row_number() OVER w AS n, count(*) OVER (PARTITION BY o_custkey) AS de FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_orderkey AS id, array_to_string(list_filter([CASE WHEN o_orderkey % 2 = 1 OR coalesce(fonte, false) OR o_orderkey % 5 = 0 THEN 'B1' END, CASE WHEN coalesce(lacuna, false) THEN 'B2' END, CASE WHEN o_orderstatus = 'F' THEN 'B3' END, CASE WHEN n < de THEN 'B4' END,
  CASE WHEN (o_custkey % 3 = 0 AND o_orderdate < TIMESTAMP '1998-01-01') OR o_custkey % 7 = 0 THEN 'B5' END], lambda x: x IS NOT NULL), ',') AS blocks FROM v LEFT JOIN m ON k = o_orderkey""")
def publication_checks(t: Tables) -> DataFrame:
    """What keeps draft versions from being published."""
    k = F.col("o_orderkey")
    o = t.orders.select(k.alias("id"), F.col("o_custkey").alias("event_id"), "o_orderstatus", "o_orderdate")
    numbered = version_chain(o, "event_id", ["id"], "id").withColumnRenamed("version", "versao")
    review = F.to_json(F.struct(F.when(F.col("id") % 2 == 0, "localizada_e_legivel").alias("fonte_primaria"), F.lit("confirmada").alias("identidade_evento"), F.lit("pedido").alias("natureza_ato"), F.lit("nao").alias("duplicidade")))
    versions = numbered.select("id", "event_id", "versao", F.col("id").alias("dossie_id"), F.when(F.col("o_orderstatus") == "F", "reprovada").otherwise("aprovada").alias("status_validacao"), review.alias("review"), F.col("o_orderdate").alias("created_at"))
    alerts = F.to_json(F.struct((F.col("id") % 5 == 0).alias("chaves_conflitantes")))
    dossiers = _dossiers(t).select("id", "matriz").join(numbered.select("id", "event_id", "versao"), "id").withColumn("alertas", alerts)
    c = F.col("c_custkey")
    checks = t.customer.select(c.alias("event_id"), F.when(c % 3 == 0, "mudanca_material").otherwise("sem_mudanca").alias("resultado"), F.lit("1998-01-01").cast("timestamp").alias("criado_em"))
    states = t.customer.select(c.alias("event_id"), F.when(c % 7 == 0, "ATUALIZADO").otherwise("MONITORADO").alias("state"))
    return workflow.publication_pending(versions, dossiers, checks, states).select("id", F.array_join("blocks", ",").alias("blocks"))


_TEMPLATE = {"M8": (("c1", True, "FATO_PRINCIPAL"), ("c2", False, "PERIFERICA"), ("c9", True, "GRAVIDADE")), "M9A": (("c1", True, "FATO_PRINCIPAL"), ("c3", True, "ATRIBUICAO"))}
_TEMPLATE_ROWS = ", ".join(f"('{m}', '{c}', {str(k).lower()}, '{i}')" for m, items in _TEMPLATE.items() for c, k, i in items)


@query(f"""
WITH {_LINES}, t(modulo, codigo, critico, classe_impacto) AS (VALUES {_TEMPLATE_ROWS}), d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'M8' ELSE 'M9A' END AS modulo FROM orders)
SELECT id, t.codigo, t.critico, t.classe_impacto FROM d JOIN t USING (modulo) WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.k = d.id AND i.codigo = t.codigo)""")
def template_checks(t: Tables) -> DataFrame:
    """Items of a module's template that a dossier's matrix lacks."""
    rows = [F.struct(F.lit(m).alias("modulo"), F.to_json(F.array(*[F.struct(F.lit(c).alias("codigo"), F.lit(k).alias("critico"), F.lit(i).alias("classe_impacto")) for c, k, i in items])).alias("itens")) for m, items in _TEMPLATE.items()]
    templates = t.spark.range(1).select(F.inline(F.array(*rows)))
    return workflow.template_gaps(templates, _dossiers(t).withColumn("modulo", F.when(F.col("id") % 2 == 0, "M8").otherwise("M9A")))


_MATRICES = ('[{"codigo":"a","estado":"confirmado","classe_impacto":"GRAVIDADE","evidencia_ids":["o1"]}]', '[{"codigo":"","estado":"nao_aplicavel","classe_impacto":"PERIFERICA"}]', "x")
_CLAIMS = ("[]", '[{"id":"f","texto":"t","status":"outro"}]')


@query(f"""
WITH d AS (SELECT o_orderkey AS id, o_custkey AS event_id, {_sql_pick(_MATRICES, "o_orderkey")} AS m, {_sql_pick(_CLAIMS, "o_orderkey")} AS a, o_orderdate FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate, id) AS versao FROM d)
SELECT id, c_nationkey AS empresa_id, CAST(versao AS INTEGER) AS versao, sha256('{{"event_id":' || event_id || ',"matriz":' || to_json(m)::VARCHAR || ',"afirmacoes":' || to_json(a)::VARCHAR || '}}') AS hash,
  array_to_string(list_filter([CASE WHEN c_custkey IS NULL THEN 'evento_inexistente' END, CASE WHEN id % 4 = 0 THEN 'execucao_de_outro_evento' END, CASE WHEN id % 3 = 0 AND event_id <> 1 THEN 'a:evidencia_de_outro_evento' END, CASE WHEN id % 3 = 1 THEN ':sem_codigo' END,
  CASE WHEN id % 3 = 2 THEN 'matriz_invalida' END, CASE WHEN id % 2 = 1 THEN 'f:status' END], lambda x: x IS NOT NULL), ',') AS violations FROM n LEFT JOIN customer ON c_custkey = event_id AND c_custkey % 10 <> 0""")
def dossier_admission(t: Tables) -> DataFrame:
    """Dossiers with tenant, version, content hash and violations."""
    k = F.col("o_orderkey")
    dossiers = t.orders.select(k.alias("id"), F.col("o_custkey").alias("event_id"), _pick(_MATRICES, k).alias("matriz"), _pick(_CLAIMS, k).alias("afirmacoes"), F.col("o_orderdate").alias("criado_em"), k.alias("execucao_id"))
    events = t.customer.filter("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("empresa_id"))
    evidence = t.customer.select(F.concat(F.lit("o"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_custkey").alias("event_id"))
    calls = t.orders.select(k.alias("id"), F.when(k % 4 == 0, -1).otherwise(F.col("o_custkey")).alias("event_id"))
    out = workflow.admitted_dossiers(dossiers, events, evidence, calls)
    return out.select("id", "empresa_id", "versao", "hash", F.array_join("violations", ",").alias("violations"))


def _drafts(t: Tables) -> DataFrame:
    c = F.col("c_custkey")
    events = t.customer.select(c.alias("id"), F.when(c % 3 == 0, "texto antigo").alias("pre_release"))
    k = F.col("o_orderkey")
    answer = F.when(k % 7 == 0, "{").when(k % 5 == 0, '{"pre_release": " "}').otherwise(F.concat(F.lit('{"pre_release": "r'), k.cast("string"), F.lit('"}')))
    calls = t.orders.select(k.alias("id"), F.col("o_custkey").alias("event_id"), F.when(F.col("o_orderstatus") != "P", "sucesso").otherwise("falha").alias("status"), F.col("o_orderdate").alias("created_at"), answer.alias("resposta"))
    return queue.draft_status(events, calls, F.col("id") % 11 == 0)


_DRAFTS = """l AS (SELECT o_custkey AS k, max_by(o_orderkey, {'a': o_orderdate, 'b': o_orderkey}) AS o FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1),
d AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'texto antigo' END AS pre, o, CASE WHEN o % 7 = 0 OR o % 5 = 0 THEN NULL ELSE 'r' || o END AS rascunho FROM customer LEFT JOIN l ON k = c_custkey),
s AS (SELECT *, CASE WHEN o IS NULL THEN 'sem_analise' WHEN rascunho IS NULL THEN 'sem_rascunho' WHEN id % 11 = 0 THEN 'bloqueado' ELSE 'aplicavel' END AS sit FROM d)"""


@query(f"WITH {_DRAFTS} SELECT id, rascunho, o AS rascunho_chamada, sit AS rascunho_situacao FROM s")
def draft_states(t: Tables) -> DataFrame:
    """Drafts from the latest successful analyses."""
    return _drafts(t).select("id", "rascunho", "rascunho_chamada", "rascunho_situacao")


@query(f"""
WITH {_DRAFTS}, r AS (SELECT o_orderkey AS pedido, o_custkey + 1 AS alvo, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -1 END AS chamada, o_orderkey % 4 < 2 AS sub FROM orders),
q AS (SELECT pedido, CASE WHEN l2.o IS NOT NULL AND pedido % 3 = 0 THEN l2.o ELSE chamada END AS chamada, alvo, sub FROM r LEFT JOIN l l2 ON l2.k = alvo)
SELECT pedido, CASE WHEN id IS NULL THEN 'evento_inexistente' WHEN sit <> 'aplicavel' THEN sit WHEN chamada IS DISTINCT FROM o THEN 'rascunho_superado' WHEN pre IS NOT NULL AND NOT sub THEN 'ja_tem_pre_release' ELSE 'aplicado' END AS resultado,
  pre AS antes, CASE WHEN id IS NOT NULL AND sit = 'aplicavel' AND chamada IS NOT DISTINCT FROM o AND (pre IS NULL OR sub) THEN rascunho ELSE pre END AS depois FROM q LEFT JOIN s ON id = alvo""")
def draft_applications(t: Tables) -> DataFrame:
    """Requests to apply drafts and what came of them."""
    k = F.col("o_orderkey")
    drafts = written(_drafts(t), "drafts")
    newest = t.orders.filter("o_orderstatus <> 'P'").groupBy(F.col("o_custkey").alias("event_id")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("__o"))
    asked = t.orders.select(k.alias("pedido"), (F.col("o_custkey") + 1).alias("event_id"), F.when(k % 2 == 0, k).otherwise(-1).alias("chamada"), (k % 4 < 2).alias("substituir"))
    requests = asked.join(newest, "event_id", "left").withColumn("chamada", F.when(F.col("__o").isNotNull() & (F.col("pedido") % 3 == 0), F.col("__o")).otherwise(F.col("chamada"))).drop("__o")
    return queue.applied_drafts(requests, drafts).select("pedido", "resultado", "antes", "depois")


@query("""
WITH d AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'em_apuracao' ELSE 'pronto_para_publicar' END AS de, CASE o_orderkey % 4 WHEN 0 THEN 'pronto_para_publicar' WHEN 1 THEN 'publicado' ELSE 'arquivado' END AS para, o_orderkey % 5 = 0 AS vazio, o_orderpriority = '5-LOW' AS pend FROM orders),
b AS (SELECT *, CASE WHEN para = de OR para = 'arquivado' THEN [] ELSE list_filter([CASE WHEN vazio THEN 'sem pré-release' END, CASE WHEN para = 'publicado' AND de <> 'pronto_para_publicar' THEN 'aprove antes (Pronto p/ publicar)' END, CASE WHEN para = 'publicado' AND pend THEN 'revisão humana pendente' END], lambda x: x IS NOT NULL) END AS l FROM d)
SELECT id, array_to_string(l, ';') AS bloqueios, len(l) = 0 AS aceita FROM b""")
def status_advances(t: Tables) -> DataFrame:
    """Changes of status that their blocks do not allow."""
    k = F.col("o_orderkey")
    old, new = F.when(k % 3 == 0, "em_apuracao").otherwise("pronto_para_publicar"), F.when(k % 4 == 0, "pronto_para_publicar").when(k % 4 == 1, "publicado").otherwise("arquivado")
    blocks = lambda action: queue.publication_blocks(F.when(k % 5 != 0, "texto"), old, F.when(F.col("o_orderpriority") == "5-LOW", "Pendente").otherwise("Feita"), action, F.lit("NA_SELECAO"), F.lit(50.0), F.try_parse_json(F.lit("{}")))
    d = t.orders.select(k.alias("id"), old.alias("de"), new.alias("para"), blocks("pronto_para_publicar").alias("b1"), blocks("publicado").alias("b2"))
    return queue.illegal_advances(d, "de", "para", {"pronto_para_publicar": "b1", "publicado": "b2"}).select("id", F.array_join("bloqueios", ";").alias("bloqueios"), "aceita")


_PLACES = ("NA_SELECAO", "FORA_DA_SELECAO", "PENDENTE_DE_SCORE", "SCORE_PROVISORIO")


@query(f"""
WITH d AS (SELECT c_custkey, {_sql_pick(_PLACES, "c_custkey")} AS p, {_sql_pick("ABCD", "c_nationkey")} AS c FROM customer)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN p = 'FORA_DA_SELECAO' THEN p END, CASE WHEN p = 'PENDENTE_DE_SCORE' THEN p END, CASE WHEN c IN ('C', 'D') THEN 'PRIORIDADE_' || c END], lambda x: x IS NOT NULL), ',') AS motivos,
  p NOT IN ('FORA_DA_SELECAO', 'PENDENTE_DE_SCORE') AND c NOT IN ('C', 'D') AS pode, p NOT IN ('FORA_DA_SELECAO', 'PENDENTE_DE_SCORE') AS elegivel FROM d""")
def generation_permission(t: Tables) -> DataFrame:
    """Whether the queue lets a paid call be made, in both forms."""
    place, code = _pick(_PLACES, F.col("c_custkey")), _pick("ABCD", F.col("c_nationkey"))
    allowed, reasons = queue.generation_allowed(place, code, priorities=("C", "D"))
    return t.customer.select("c_custkey", F.array_join(reasons, ",").alias("motivos"), allowed.alias("pode"), queue.simple_eligibility(place).alias("elegivel"))

