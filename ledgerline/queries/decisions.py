"""Scores, criticality, selection, queue, calls and workflow over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import keys
from ledgerline.functions.numbers import call_cost
from ledgerline.operators import joins, segments
from ledgerline.operators.rules import active_weights, banded, capped_score, cascade, listed
from ledgerline.operators.shared import written
from ledgerline.plans import calls, criticality, queue, scores, workflow
from ledgerline.plans import vocabulary as V
from ledgerline.queries.registry import Tables, query

REF = "2001-11-05"
WEIGHTS = {"grande": 4, "devolvido": 3, "cheio": 3, "barato": 2, "taxa": 2}


def _flags() -> dict:
    return {"grande": F.col("l_quantity") > 40, "devolvido": F.col("l_returnflag") == "R", "cheio": F.col("l_extendedprice") > 60000, "barato": F.col("l_discount") >= 0.05, "taxa": F.col("l_tax") >= 0.04, "aberto": F.col("l_linestatus") == "O"}


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity > 40 AS g, l_returnflag = 'R' AS d, l_extendedprice > 60000 AS c, l_discount >= 0.05 AS b, l_tax >= 0.04 AS x, l_linestatus = 'O' AS o FROM lineitem),
s AS (SELECT *, greatest(least(g::INT * 4 + d::INT * 3 + c::INT * 3 + b::INT * 2 + x::INT * 2, 10) - o::INT * 3, 0) AS s0 FROM f),
s1 AS (SELECT *, CASE WHEN o THEN least(s0, 4) ELSE s0 END AS c1 FROM s), s2 AS (SELECT *, CASE WHEN g AND d AND c THEN greatest(c1, 8) ELSE c1 END AS p FROM s1)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(p AS DOUBLE) AS score, CASE WHEN p >= 8 THEN 'A' WHEN p >= 5 THEN 'B' WHEN p >= 2 THEN 'C' ELSE 'D' END AS band,
  array_to_string(list_filter([CASE WHEN g THEN 'grande' END, CASE WHEN d THEN 'devolvido' END, CASE WHEN c THEN 'cheio' END, CASE WHEN b THEN 'barato' END, CASE WHEN x THEN 'taxa' END], lambda v: v IS NOT NULL), ',') AS triggers FROM s2""")
def capped_score_bands(t: Tables) -> DataFrame:
    """Capped score with reducer, cap and floor, band, active triggers."""
    f = _flags()
    s = capped_score(f, WEIGHTS, 10, {"aberto": -3}, [(f["aberto"], 4)], [(f["grande"] & f["devolvido"] & f["cheio"], 8)])
    names = F.array_join(F.filter(F.array(*[F.lit(k) for k in WEIGHTS]), lambda k: F.map_contains_key(active_weights(f, WEIGHTS), k)), ",")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", s.alias("score"), banded(s, [(8, "A"), (5, "B"), (2, "C")], "D").alias("band"), names.alias("triggers"))


@query("""
WITH w(c, w) AS (VALUES ('status', 1.0::DOUBLE), ('preco', 2.0), ('prioridade', 1.0)),
x AS (SELECT o_orderkey, 'status' AS c, CASE o_orderstatus WHEN 'F' THEN 100.0::DOUBLE ELSE 25.0 END AS v FROM orders UNION ALL SELECT o_orderkey, 'preco', CASE WHEN o_totalprice > 250000 THEN 75.0 ELSE 50.0 END FROM orders
  UNION ALL SELECT o_orderkey, 'prioridade', CASE WHEN o_orderpriority = '1-URGENT' THEN 100.0 ELSE 0.0 END FROM orders WHERE o_orderpriority <> '5-LOW'),
g AS (SELECT o_orderkey, sum(v * w) / 4.0 AS m, count(*) AS n FROM x JOIN w ON x.c = w.c GROUP BY 1),
s AS (SELECT o_orderkey, CASE WHEN n = 3 THEN m ELSE 60.0 END AS score, CASE WHEN n = 3 THEN '' ELSE 'prioridade' END AS missing FROM g)
SELECT *, CASE WHEN score >= 80 THEN 'A' WHEN score >= 60 THEN 'B' WHEN score >= 40 THEN 'C' ELSE 'D' END AS band FROM s""")
def weighted_bands(t: Tables) -> DataFrame:
    """Portfolio score: weighted mean or base with the missing names, then a band."""
    o = t.orders
    w = t.spark.range(1).select(F.inline(F.array(*[F.struct(F.lit("P").alias("carteira"), F.lit(n).alias("componente"), F.lit(x).alias("peso")) for n, x in (("status", 1.0), ("preco", 2.0), ("prioridade", 1.0))])))
    part = lambda n, v: F.struct(F.lit(n).alias("componente"), v.cast("double").alias("valor"))
    cells = F.array(part("status", F.when(F.col("o_orderstatus") == "F", 100.0).otherwise(25.0)), part("preco", F.when(F.col("o_totalprice") > 250000, 75.0).otherwise(50.0)), part("prioridade", F.when(F.col("o_orderpriority") == "1-URGENT", 100.0).when(F.col("o_orderpriority") != "5-LOW", 0.0)))
    c = o.select("o_orderkey", F.inline(cells)).filter("valor is not null")
    base = o.select("o_orderkey", F.lit("P").alias("carteira"), F.lit(60.0).alias("base"))
    s = scores.weighted_portfolio(base, c, w, "o_orderkey", "carteira")
    return s.select("o_orderkey", "score", F.array_join("missing", ",").alias("missing"), scores.portfolio_band(F.col("score"), F.lit(80), F.lit(60), F.lit(40)).alias("band"))


@query("""
WITH c AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS s, 15 + p_size % 5 AS a, CASE WHEN p_size > 45 THEN 20 WHEN p_size > 20 THEN 15 ELSE 5 END AS b, p_size > 40 AS presumed, p_size % 3 = 0 AS undecided FROM part),
x AS (SELECT *, CASE WHEN a > 20 THEN 1 ELSE 0 END AS bad, a + b + 15 + 15 + 10 + 10 + 3 + 2 - CASE WHEN p_partkey % 4 = 0 THEN 10.5 ELSE 0 END AS less FROM c),
y AS (SELECT *, CASE WHEN undecided THEN least(less, 79) ELSE less END AS f FROM x), z AS (SELECT *, greatest(least(CASE WHEN presumed THEN least(f, 59) ELSE f END, 100), 0) AS score FROM y)
SELECT p_partkey, CAST(score AS DOUBLE) AS score, CASE WHEN score BETWEEN 80 AND 100 THEN 'A' WHEN score BETWEEN 60 AND 79 THEN 'B' WHEN score BETWEEN 35 AND 59 THEN 'C' ELSE 'D' END AS faixa FROM z""")
def component_score(t: Tables) -> DataFrame:
    """Bounded components, reducer, caps, bands with gaps."""
    z, k = F.col("p_size"), list(V.PERMIT_MAXIMA)
    parts = dict(zip(k, [(15 + z % 5), F.when(z > 45, 20).when(z > 20, 15).otherwise(5), F.lit(15), F.lit(15), F.lit(10), F.lit(10), F.lit(3), F.lit(2)]))
    s = scores.permit_score(parts, z > 40, z % 3 == 0, F.when(F.col("p_partkey") % 4 == 0, 10.5).otherwise(0.0), F.lit(False))
    return t.part.select("p_partkey", s.alias("s")).select("p_partkey", "s.score", "s.faixa")


@query(f"""
WITH b AS (SELECT o_orderkey, CASE WHEN o_totalprice >= 400000 THEN 4 WHEN o_totalprice >= 250000 THEN 3 WHEN o_totalprice >= 120000 THEN 2 WHEN o_totalprice >= 50000 THEN 1 ELSE 0 END AS l,
  CASE WHEN o_orderkey % 10 <> 0 THEN date_diff('day', CAST(o_orderdate AS DATE), DATE '{REF}') END AS age FROM orders),
s AS (SELECT *, CASE WHEN l <= 1 THEN l WHEN age IS NULL THEN 1 ELSE CASE WHEN l = 4 AND age <= 180 THEN 4 WHEN l >= 3 AND age <= 365 THEN 3 WHEN age <= 1095 THEN 2 ELSE 1 END END AS r FROM b)
SELECT o_orderkey, ['ROTINA', 'BAIXA', 'MEDIA', 'ALTA', 'CRITICO'][r + 1] AS nivel, CASE WHEN l <= 1 THEN 0 WHEN age IS NULL THEN 1 ELSE l - r END AS steps FROM s""")
def age_cascade(t: Tables) -> DataFrame:
    """Levels that step down with age; undated ones have a ceiling."""
    p = F.col("o_totalprice")
    level = F.when(p >= 400000, "CRITICO").when(p >= 250000, "ALTA").when(p >= 120000, "MEDIA").when(p >= 50000, "BAIXA").otherwise("ROTINA")
    age = F.when(F.col("o_orderkey") % 10 != 0, F.datediff(F.lit(REF).cast("date"), F.to_date("o_orderdate")))
    out, why = cascade(level, age, V.ACT_AGE_LIMITS, V.LEVELS, "BAIXA", "BAIXA")
    return t.orders.select("o_orderkey", out.alias("nivel"), F.size(why).alias("steps"))


def _acts(t: Tables) -> DataFrame:
    """Orders seen as process acts: every third has no official type, every fifth no evidence, every tenth no date."""
    k, h = F.col("o_orderkey"), F.col("o_custkey") % 12
    kinds = ("CONC LAV/DECAIMENTO INSTAURADO PUBL", "AUT PESQ/CESSAO TOTAL APROVADA PUBL", "AUT PESQ/TAH - PAGAMENTO EFETUADO", "GUIA DE UTILIZACAO AUTORIZADA PUBL", "RENUNCIA PROTOC", "PENHORA AVERBADA", "ALVARA DE PESQUISA INDEFERIDA PUBL", "RELATORIO APROVADO PUBL", "SERVIDAO PUBL", "EDITAL", "CADUCIDADE", "OUTRO ATO")
    kind = F.element_at(F.array(*[F.lit(x) for x in kinds]), (h + 1).cast("int"))
    return t.orders.select(
        k.alias("id_evento"), F.when(k % 3 != 0, kind).alias("tipo_scm"), F.when(k % 33 != 0, kind).alias("tipo_texto"), F.when(k % 10 != 0, F.to_date("o_orderdate").cast("string")).alias("data_ato"),
        F.when(F.col("o_orderstatus") == "F", "VALE S.A.").otherwise("OUTRA").alias("titular"), F.when(F.col("o_orderpriority") == "1-URGENT", "MINÉRIO DE FERRO").otherwise("GRANITO").alias("substancia"),
        F.floor(F.col("o_totalprice") / 250).cast("string").alias("area_ha"), (k % 4).cast("int").alias("n_municipios"), (k % 5 != 0).alias("tem_evidencia"),
    )


_ACTS_SQL = """
k AS (SELECT o_orderkey AS id_evento, ['CONC LAV/DECAIMENTO INSTAURADO PUBL', 'AUT PESQ/CESSAO TOTAL APROVADA PUBL', 'AUT PESQ/TAH - PAGAMENTO EFETUADO', 'GUIA DE UTILIZACAO AUTORIZADA PUBL', 'RENUNCIA PROTOC', 'PENHORA AVERBADA',
  'ALVARA DE PESQUISA INDEFERIDA PUBL', 'RELATORIO APROVADO PUBL', 'SERVIDAO PUBL', 'EDITAL', 'CADUCIDADE', 'OUTRO ATO'][o_custkey % 12 + 1] AS tipo, o_custkey % 12 AS h,
  o_orderkey % 3 = 0 AS livre, o_orderkey % 33 = 0 AS vazio, CASE WHEN o_orderkey % 10 <> 0 THEN date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-11-05') END AS idade,
  o_orderstatus = 'F' AS emp, o_orderpriority = '1-URGENT' AS est, floor(o_totalprice / 250) AS area, o_orderkey % 4 AS mun, o_orderkey % 5 <> 0 AS ev FROM orders),
q AS (SELECT *, CASE h WHEN 4 THEN 'pedido' WHEN 6 THEN 'negativa' WHEN 11 THEN 'indefinida' WHEN 9 THEN 'indefinida' WHEN 10 THEN 'indefinida'
    WHEN 0 THEN 'efetiva' WHEN 1 THEN 'efetiva' WHEN 3 THEN 'efetiva' WHEN 5 THEN CASE WHEN livre THEN 'indefinida' ELSE 'efetiva' END WHEN 7 THEN 'efetiva' WHEN 8 THEN CASE WHEN livre THEN 'indefinida' ELSE 'efetiva' END END AS fase,
  CASE h WHEN 0 THEN 'perda_titulo' WHEN 1 THEN 'cessao' WHEN 3 THEN 'autorizacao_extracao' WHEN 4 THEN 'renuncia' WHEN 5 THEN 'gravame' WHEN 6 THEN 'alvara_outorga' WHEN 7 THEN 'relatorio_aprovado' WHEN 8 THEN 'servidao' WHEN 9 THEN 'edital_disponibilidade' WHEN 10 THEN 'perda_titulo' ELSE 'outro' END AS objeto FROM k),
r AS (SELECT *, CASE WHEN fase IN ('pedido', 'negativa') THEN 1 WHEN objeto = 'perda_titulo' THEN CASE WHEN h = 0 THEN 4 ELSE 3 END WHEN objeto = 'gravame' THEN CASE WHEN emp OR est THEN 3 ELSE 2 END
    WHEN objeto = 'cessao' THEN CASE WHEN (emp AND est) OR (est AND area >= 1000) THEN 3 WHEN emp OR est OR area >= 500 THEN 2 ELSE 1 END WHEN objeto = 'autorizacao_extracao' THEN CASE WHEN emp OR est OR area >= 500 THEN 3 ELSE 2 END
    WHEN objeto = 'relatorio_aprovado' THEN CASE WHEN emp OR est OR area >= 500 THEN 2 ELSE 1 END WHEN objeto = 'servidao' THEN CASE WHEN emp THEN 2 ELSE 1 END ELSE 1 END AS raw FROM q),
s AS (SELECT *, CASE WHEN fase = 'indefinida' THEN least(raw, 2) ELSE raw END AS b4 FROM r),
u AS (SELECT *, CASE WHEN b4 <= 1 THEN b4 WHEN idade IS NULL THEN 1 WHEN b4 = 4 AND idade <= 180 THEN 4 WHEN b4 >= 3 AND idade <= 365 THEN 3 WHEN idade <= 1095 THEN 2 ELSE 1 END AS aged FROM s),
c AS (SELECT id_evento, idade, CASE WHEN h = 2 AND NOT (vazio AND livre) THEN 'ROTINA' WHEN vazio AND livre THEN 'NAO_AVALIAVEL' WHEN NOT ev AND aged = 4 THEN 'POTENCIAL_CRITICO_PENDENTE_EVIDENCIA' WHEN NOT ev AND aged = 3 THEN 'POTENCIAL_ALTA_PENDENTE_EVIDENCIA'
    ELSE ['ROTINA', 'BAIXA', 'MEDIA', 'ALTA', 'CRITICO'][aged + 1] END AS nivel, h = 2 AND NOT (vazio AND livre) AS rot, vazio AND livre AS desc_, livre, ev, objeto, fase, aged,
    CAST((emp::INT + est::INT + (area >= 500)::INT + (mun >= 2)::INT) * 25 AS DOUBLE) AS pts FROM u),
f AS (SELECT id_evento, nivel, CASE nivel WHEN 'CRITICO' THEN 'A' WHEN 'ALTA' THEN 'B' WHEN 'MEDIA' THEN 'C' WHEN 'BAIXA' THEN 'D' WHEN 'ROTINA' THEN 'D' END AS prioridade, CASE WHEN rot OR desc_ THEN 0.0::DOUBLE ELSE pts END AS pontuacao,
    CASE WHEN rot THEN 'rotina' WHEN desc_ THEN 'desconhecido' ELSE objeto END AS objeto, CASE WHEN NOT rot AND NOT desc_ THEN fase END AS fase, NOT rot AND NOT desc_ AND livre AS provisoria, rot OR desc_ OR ev AS suficiente, idade, desc_ FROM c),
x AS (SELECT *, array_to_string(list_filter([CASE WHEN desc_ THEN 'nao_avaliavel' END, CASE WHEN nivel LIKE 'POTENCIAL%' THEN 'pendente_de_evidencia' END, CASE WHEN nivel IN ('BAIXA', 'ROTINA') THEN 'abaixo_do_piso' END,
    CASE WHEN NOT suficiente AND NOT nivel LIKE 'POTENCIAL%' THEN 'evidencia_insuficiente' END, CASE WHEN provisoria THEN 'classificacao_provisoria' END], lambda v: v IS NOT NULL), ',') AS bloqueios FROM f)"""


def _classified(t: Tables) -> DataFrame:
    return written(criticality.classified_acts(_acts(t), F.lit(REF).cast("date")), "acts")


@query(f"""WITH {_ACTS_SQL} SELECT id_evento, nivel, prioridade, pontuacao, objeto, fase, provisoria, bloqueios FROM x""")
def criticality_acts(t: Tables) -> DataFrame:
    """Criticality of process acts with priority and blocks."""
    return _classified(t).select("id_evento", "nivel", "prioridade", "pontuacao", "objeto", "fase", "provisoria", F.array_join("bloqueios", ",").alias("bloqueios"))


_STATUS = "CASE WHEN id_evento % 6 = 0 THEN 'publicado' WHEN id_evento % 6 = 1 THEN 'em_revisao' ELSE 'pendente' END"
_GROUP = f"""CASE WHEN nivel = 'NAO_AVALIAVEL' THEN 'NAO_AVALIAVEL' WHEN id_evento % 14 = 0 THEN 'FORA_DA_SELECAO' WHEN {_STATUS} <> 'pendente' THEN 'FORA_DA_SELECAO'
  WHEN nivel LIKE 'POTENCIAL%' OR (nivel IN ('MEDIA', 'ALTA', 'CRITICO') AND (provisoria OR NOT suficiente)) THEN 'PENDENTE_DE_EVIDENCIA' WHEN nivel IN ('MEDIA', 'ALTA', 'CRITICO') THEN 'SELECIONAVEL_AGORA' ELSE 'FORA_DA_SELECAO' END"""


def _grouped(t: Tables) -> DataFrame:
    k = F.col("id_evento")
    status = F.when(k % 6 == 0, "publicado").when(k % 6 == 1, "em_revisao").otherwise("pendente")
    d = _classified(t).withColumn("qualidade_evidencia", (k % 3).cast("int"))
    return d.withColumn("grupo", criticality.selection_group(F.col("nivel"), F.col("avaliavel"), F.col("evidencia_suficiente"), F.col("provisoria"), F.col("bloqueios"), status, k % 14 == 0))


@query(f"""WITH {_ACTS_SQL} SELECT id_evento, {_GROUP} AS grupo FROM x""")
def selection_groups(t: Tables) -> DataFrame:
    """Selection groups in seven ordered steps."""
    return _grouped(t).select("id_evento", "grupo")


_ORDER = "list_position(['ROTINA', 'BAIXA', 'MEDIA', 'ALTA', 'CRITICO'], CASE nivel WHEN 'POTENCIAL_CRITICO_PENDENTE_EVIDENCIA' THEN 'CRITICO' WHEN 'POTENCIAL_ALTA_PENDENTE_EVIDENCIA' THEN 'ALTA' ELSE nivel END) DESC NULLS LAST, coalesce(prioridade, 'E'), pontuacao DESC, coalesce(idade, 1000000000), id_evento % 3 DESC, id_evento"


@query(f"""
WITH {_ACTS_SQL}, g AS (SELECT *, {_GROUP} = 'SELECIONAVEL_AGORA' AS ok FROM x), p AS (SELECT id_evento, ok, CASE WHEN ok THEN row_number() OVER (PARTITION BY ok ORDER BY {_ORDER}) END AS n FROM g)
SELECT id_evento, CASE WHEN n <= 20 THEN CAST(n AS INTEGER) END AS posicao, CASE WHEN NOT ok THEN 'abaixo_do_piso' WHEN n <= 20 THEN 'escolhido' ELSE 'cortado_por_limite' END AS resultado FROM p""")
def select_top_n(t: Tables) -> DataFrame:
    """Top N above the floor; the others cut or below it."""
    d = _grouped(t)
    return criticality.selected(d, F.col("grupo") == "SELECIONAVEL_AGORA", criticality.selection_order(), 20).select("id_evento", "posicao", "resultado")


@query(f"""
WITH {_ACTS_SQL} SELECT id_evento, {_GROUP} AS grupo, CAST(row_number() OVER (PARTITION BY {_GROUP} ORDER BY {_ORDER}) AS INTEGER) AS posicao_no_grupo,
  {_GROUP} = 'SELECIONAVEL_AGORA' AND row_number() OVER (PARTITION BY {_GROUP} ORDER BY {_ORDER}) <= 20 AS dentro_do_teto,
  CASE WHEN instr('DCBA', coalesce(prioridade, '-')) > instr('DCBA', ['A', 'B', 'C', 'D'][id_evento % 4 + 1]) THEN 'subiu' WHEN instr('DCBA', coalesce(prioridade, '-')) < instr('DCBA', ['A', 'B', 'C', 'D'][id_evento % 4 + 1]) THEN 'desceu' ELSE 'igual' END AS movimento,
  coalesce(id_evento % 4 <= 1 AND prioridade = 'D', false) AS ab_para_d FROM x""")
def rule_simulation(t: Tables) -> DataFrame:
    """What-if simulation of the rules over all events."""
    d = _grouped(t).withColumn("antes", F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.col("id_evento") % 4 + 1).cast("int")))
    return criticality.simulated(d, "antes", [], 20).select("id_evento", "grupo", "posicao_no_grupo", "dentro_do_teto", "movimento", "ab_para_d")


@query(f"""
WITH {_ACTS_SQL}, b AS (SELECT *, ['A', 'B', 'C', 'D'][id_evento % 4 + 1] AS antes FROM x), n AS (SELECT *, instr('DCBA', antes) AS w, instr('DCBA', coalesce(prioridade, '-')) AS v, antes || '->' || coalesce(prioridade, '-') AS m FROM b)
SELECT id_evento, array_to_string(list_filter([CASE WHEN v > 0 AND v < w THEN 'superestimado:' || m END, CASE WHEN v > 0 AND v > w THEN 'subestimado:' || m END, CASE WHEN v > 0 AND abs(v - w) >= 2 THEN 'mudou_2_ou_mais:' || m END,
  CASE WHEN fase = 'indefinida' THEN 'ambiguo:fase_indefinida' END, CASE WHEN nivel LIKE 'POTENCIAL%' THEN 'pendente:evidencia' END], lambda y: y IS NOT NULL), ';') AS tags FROM n""")
def review_tags(t: Tables) -> DataFrame:
    """Review tags of a simulation."""
    before = F.element_at(F.array(*[F.lit(x) for x in "ABCD"]), (F.col("id_evento") % 4 + 1).cast("int"))
    return _classified(t).select("id_evento", criticality.review_tags(before, F.col("prioridade"), F.col("fase") == "indefinida", F.startswith("nivel", F.lit("POTENCIAL"))).alias("tags"))


@query(f"""
WITH {_ACTS_SQL} SELECT nivel, id_evento, CAST(n AS INTEGER) AS posicao FROM (SELECT nivel, id_evento, row_number() OVER (PARTITION BY nivel ORDER BY {_ORDER}) AS n FROM x WHERE nivel IN ('BAIXA', 'ROTINA')) WHERE n <= 10""")
def just_below_floor(t: Tables) -> DataFrame:
    """The best below the floor per level."""
    d = _classified(t).withColumn("qualidade_evidencia", (F.col("id_evento") % 3).cast("int"))
    return criticality.just_below(d, ["nivel"], F.col("nivel").isin("BAIXA", "ROTINA"), criticality.selection_order(), 10).select("nivel", "id_evento", "posicao")


@query("""SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100""")
def lot_page(t: Tables) -> DataFrame:
    """A resumable lot of an order."""
    return criticality.page(t.orders, [F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 100, 50).select("o_orderkey", "o_totalprice")


@query(f"""
WITH {_ACTS_SQL}, j AS (SELECT o_custkey, x.* FROM x JOIN orders ON o_orderkey = id_evento)
SELECT o_custkey, id_evento, nivel, pontuacao FROM j QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(list_position(['ROTINA', 'BAIXA', 'MEDIA', 'ALTA', 'CRITICO'], nivel), 0) DESC, pontuacao DESC, coalesce(idade, 1000000000), id_evento DESC) = 1""")
def best_act_of_case(t: Tables) -> DataFrame:
    """The classified act that stands for a case (A4)."""
    d = _classified(t).join(t.orders.select(F.col("o_orderkey").alias("id_evento"), "o_custkey"), "id_evento").select("o_custkey", "id_evento", "nivel", "pontuacao", "idade_dias")
    return criticality.best_of_case(d, "o_custkey", ["id_evento"]).drop("idade_dias")


@query("""
WITH n AS (SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS idade, event_type AS e, value, event_id % 7 AS m FROM events),
b AS (SELECT *, CASE WHEN m = 0 THEN 'x' WHEN m = 1 THEN 'contextual' WHEN m = 2 THEN 'provavel' ELSE 'confirmado' END AS v, CASE WHEN e = 'error' THEN 4 WHEN e = 'purchase' THEN 3 WHEN e = 'view' THEN 2 ELSE 1 END AS raw FROM n),
c AS (SELECT *, CASE WHEN v = 'provavel' THEN least(raw, 2) ELSE raw END AS b4 FROM b),
d AS (SELECT *, CASE WHEN b4 <= 1 THEN b4 WHEN b4 = 4 AND idade <= 15 THEN 4 WHEN b4 >= 3 AND idade <= 30 THEN 3 WHEN idade <= 90 THEN 2 ELSE 1 END AS aged FROM c)
SELECT event_id, CASE WHEN v = 'x' THEN 'NAO_AVALIAVEL' WHEN v = 'contextual' THEN 'ROTINA' ELSE ['ROTINA', 'BAIXA', 'MEDIA', 'ALTA', 'CRITICO'][aged + 1] END AS nivel, v NOT IN ('x', 'contextual') AND e = 'view' AND aged = 2 AS provisoria FROM d""")
def criticality_notices(t: Tables) -> DataFrame:
    """Criticality of notices."""
    e, m = F.col("event_type"), F.col("event_id") % 7
    d = t.events.select(
        "event_id", F.when(m == 0, "falha_extracao").otherwise("processado").alias("status_processamento"), F.when(m == 1, "contextual").when(m == 2, "provavel").otherwise("confirmado").alias("faixa_vinculo"),
        F.to_date("ts").cast("string").alias("data_ocorrencia"), F.create_map(F.lit("vitimas"), e == "error", F.lit("atingiu_curso_agua"), e == "purchase").alias("confirmados"), F.create_map(F.lit("rejeito"), e == "view").alias("sinais_textuais"),
        (F.col("value") / 100).alias("score_gravidade"), F.lit(True).alias("tem_evidencia"), F.lit(None).cast("string").alias("motivo_falha"),
    )
    return criticality.classified_notices(d, F.lit("2024-02-01").cast("date")).select("event_id", "nivel", "provisoria")


@query("""
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 100 END AS rel, CASE WHEN o_orderkey % 9 <> 0 THEN floor(o_totalprice / 5000) END AS calc, CASE WHEN o_orderstatus = 'F' THEN 'final' ELSE 'preliminar' END AS est,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICO' WHEN '2-HIGH' THEN 'ALTA' ELSE 'MEDIA' END AS crit, CASE WHEN o_orderkey % 5 = 0 THEN 'publicado' ELSE 'pendente' END AS st FROM orders),
d AS (SELECT *, coalesce(rel, calc) AS v, rel IS NOT NULL OR (calc IS NOT NULL AND est = 'final') AS dec FROM s)
SELECT o_orderkey, CAST(v AS DOUBLE) AS valor, dec AS decisorio, CASE WHEN v IS NULL THEN 'PENDENTE_DE_SCORE' WHEN NOT dec THEN 'SCORE_PROVISORIO' WHEN v >= 40 THEN 'NA_SELECAO' WHEN crit IN ('CRITICO', 'ALTA') THEN 'SCORE_BAIXO_COM_GATILHO_FORTE'
  WHEN st = 'publicado' THEN 'FORA_DA_SELECAO_MANTIDO_POR_TRAVA' ELSE 'FORA_DA_SELECAO' END AS situacao FROM d""")
def score_decision(t: Tables) -> DataFrame:
    """Decision by relevance, final and preliminary scores."""
    k = F.col("o_orderkey")
    d = queue.score_decision(F.when(k % 4 == 0, (F.col("o_custkey") % 100).cast("double")), F.when(k % 9 != 0, F.floor(F.col("o_totalprice") / 5000).cast("double")), F.when(F.col("o_orderstatus") == "F", "final").otherwise("preliminar"), F.when(F.col("o_orderpriority") == "1-URGENT", "CRITICO").when(F.col("o_orderpriority") == "2-HIGH", "ALTA").otherwise("MEDIA"), F.when(k % 5 == 0, "publicado").otherwise("pendente"))
    return t.orders.select("o_orderkey", d.alias("d")).select("o_orderkey", "d.valor", "d.decisorio", "d.situacao")


def _queue(t: Tables) -> DataFrame:
    """Orders as events of a tenant per nation; lines as evidence; documents by key."""
    k = F.col("o_orderkey")
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("empresa_id")), "o_custkey")
    ev = o.select(k.alias("id"), "empresa_id", F.when(k % 11 == 0, "publicado").otherwise("pendente").alias("status_editorial"), F.lit("Pendente").alias("revisao_humana"), F.when(k % 2 == 0, "texto").alias("pre_release"), F.when(k % 3 == 0, "u").alias("url_oficial"), F.to_date("o_orderdate").alias("data_evento"), F.lit(None).cast("timestamp").alias("data_publicacao"), F.col("o_orderdate").alias("created_at"))
    crit = F.when(F.col("o_orderpriority") == "1-URGENT", "CRITICO").when(F.col("o_orderpriority") == "2-HIGH", "ALTA").when(F.col("o_orderpriority") == "5-LOW", "BAIXA").otherwise("MEDIA")
    comp = F.try_parse_json(F.concat(F.lit('{"criticidade": "'), crit, F.lit('", "publicado_antes": '), F.when(k % 13 == 0, "true").when(k % 13 == 1, '"true"').otherwise("false"), F.lit("}")))
    sc = t.orders.select(k.alias("id"), k.alias("event_id"), F.lit(True).alias("vigente"), F.when(F.col("o_orderstatus") == "F", "final").otherwise("preliminar").alias("estagio"), F.floor(F.col("o_totalprice") / 5000).cast("double").alias("score_bruto"), F.lit(None).cast("double").alias("score_normalizado"), F.when(k % 4 == 0, (F.col("o_custkey") % 100).cast("double")).alias("score_relevancia"), F.lit("v").alias("versao_score"), comp.alias("componentes"), F.col("o_orderdate").alias("created_at"))
    evid = t.lineitem.select(F.col("l_orderkey").alias("event_id"), F.when(F.col("l_returnflag") != "N", "x").alias("trecho_literal"))
    return queue.queue_items(ev, sc, evid, t.documents.select((F.col("doc_id") % 500).alias("event_id")), F.lit("2001-11-05 00:00:00").cast("timestamp"))


@query("""
WITH e AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag <> 'N' THEN 2 ELSE 1 END) AS q FROM lineitem GROUP BY 1), n AS (SELECT doc_id % 500 AS k, count(*) AS n FROM documents GROUP BY 1),
s AS (SELECT o_orderkey AS id, c_nationkey AS empresa_id, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 100 END AS rel, floor(o_totalprice / 5000) AS calc, o_orderstatus = 'F' AS fin,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CRITICO' WHEN '2-HIGH' THEN 'ALTA' WHEN '5-LOW' THEN 'BAIXA' ELSE 'MEDIA' END AS crit, o_orderkey % 11 = 0 AS pub, o_orderkey % 13 = 0 AS antes, o_orderdate,
  coalesce(q, 0) + coalesce(n, 0) + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS qual FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN e ON l_orderkey = o_orderkey LEFT JOIN n ON n.k = o_orderkey),
d AS (SELECT *, coalesce(rel, calc) AS v, rel IS NOT NULL OR fin AS dec, NOT (pub OR antes) AS inedito, date_diff('second', date_trunc('day', o_orderdate), TIMESTAMP '2001-11-05') / 86400.0 <= 90 AS atual FROM s),
g AS (SELECT *, CASE WHEN NOT dec THEN 'SCORE_PROVISORIO' WHEN v >= 40 THEN 'NA_SELECAO' WHEN crit IN ('CRITICO', 'ALTA') THEN 'SCORE_BAIXO_COM_GATILHO_FORTE' WHEN pub THEN 'FORA_DA_SELECAO_MANTIDO_POR_TRAVA' ELSE 'FORA_DA_SELECAO' END AS situacao, CASE WHEN dec THEN v END AS w FROM d),
p AS (SELECT *, CASE WHEN NOT inedito THEN 'D' WHEN crit = 'CRITICO' AND situacao <> 'SCORE_BAIXO_COM_GATILHO_FORTE' THEN 'A' WHEN w >= 80 AND crit IN ('CRITICO', 'ALTA') AND qual >= 2 THEN 'A' WHEN situacao LIKE 'FORA%' THEN 'D' WHEN crit = 'BAIXA' THEN 'D'
  WHEN situacao = 'SCORE_BAIXO_COM_GATILHO_FORTE' THEN 'C' WHEN w IS NULL THEN 'PENDENTE' WHEN crit = 'ALTA' AND w >= 40 THEN 'B' WHEN w >= 60 AND atual THEN 'B' WHEN w >= 40 THEN 'C' ELSE 'D' END AS prioridade FROM g)
SELECT id, empresa_id, prioridade, situacao, CAST(qual AS BIGINT) AS qualidade_evidencia, inedito, CAST(row_number() OVER (PARTITION BY empresa_id ORDER BY CASE prioridade WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'PENDENTE' THEN 1 ELSE 0 END DESC,
  CASE crit WHEN 'CRITICO' THEN 5 WHEN 'ALTA' THEN 4 WHEN 'MEDIA' THEN 3 ELSE 2 END DESC, date_trunc('day', o_orderdate) DESC, inedito DESC, coalesce(w, -1e18) DESC, qual DESC, id DESC) AS INTEGER) AS ordem FROM p""")
def queue_rank(t: Tables) -> DataFrame:
    """The ranked queue per tenant."""
    return queue.ranked_queue(_queue(t)).select("id", "empresa_id", "prioridade", "situacao", "qualidade_evidencia", "inedito", "ordem")


@query("""
WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 100 END AS rel, floor(o_totalprice / 5000) AS calc, o_orderstatus = 'F' AS fin, o_orderpriority IN ('1-URGENT', '2-HIGH') AS forte, o_orderkey % 11 = 0 AS pub FROM orders),
d AS (SELECT *, (rel IS NOT NULL OR fin) AND coalesce(rel, calc) < 40 AND NOT forte AND NOT pub AS fora FROM s)
SELECT id, array_to_string(list_filter([CASE WHEN id % 2 <> 0 THEN 'sem pré-release' END, CASE WHEN fora THEN 'score decisório < 40 (fora da seleção)' END, 'aprove antes (Pronto p/ publicar)', 'revisão humana pendente'], lambda x: x IS NOT NULL), ';') AS bloqueios FROM d""")
def blocks(t: Tables) -> DataFrame:
    """What blocks publication, in order."""
    return _queue(t).select("id", F.array_join("bloqueios_publicado", ";").alias("bloqueios"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'registro_identico' WHEN value < 5 THEN 'fora_de_escopo' WHEN event_type = 'signup' THEN 'descartado_por_regra_deterministica' WHEN user_id % 10 = 0 THEN 'enriquecimento_ja_concluido' END AS dispensa FROM events""")
def first_dismissal(t: Tables) -> DataFrame:
    """The first dismissal reason in the fixed order."""
    f = {"enriquecimento_ja_concluido": F.col("user_id") % 10 == 0, "fora_de_escopo": F.col("value") < 5, "registro_identico": F.col("event_type") == "view", "descartado_por_regra_deterministica": F.col("event_type") == "signup"}
    return t.events.select("event_id", calls.first_dismissal(f).alias("dispensa"))


@query("""
WITH h AS (SELECT event_id, sha256(concat_ws('|', event_type, CAST(user_id % 20 AS VARCHAR), '')) AS h, event_type <> 'error' AND event_id % 2 = 0 AS ok FROM events),
g AS (SELECT h, max(event_id) AS reutilizado FROM h WHERE ok GROUP BY h) SELECT event_id, g.reutilizado FROM h LEFT JOIN g ON h.h = g.h""")
def call_hash_reuse(t: Tables) -> DataFrame:
    """Reuse of the latest success of the same call hash (K6, K7)."""
    h = keys.call_hash(F.col("event_type"), F.col("user_id") % 20, F.lit(None))
    d = t.events.select("event_id", h.alias("hash_chamada"), "event_type")
    done = d.select(F.col("event_id").alias("id"), "hash_chamada", F.when((F.col("event_type") != "error") & (F.col("event_id") % 2 == 0), "sucesso").otherwise("falha").alias("status"), F.col("event_id").alias("created_at"))
    return calls.reused(d, done).select("event_id", "reutilizado")


@query("""
WITH b AS (SELECT event_id, user_id AS lote, CASE WHEN event_type = 'view' THEN 'dispensada:registro_identico' WHEN event_id % 19 = 0 THEN 'sem_preco' WHEN event_id % 7 = 0 THEN 'reutilizada' END AS s, value FROM events),
n AS (SELECT *, sum(CASE WHEN s IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY lote ORDER BY event_id) AS k FROM b)
SELECT event_id, lote, coalesce(s, CASE WHEN k > 30 THEN 'teto_do_lote' WHEN value > 90 THEN 'limite:limite_por_chamada' ELSE 'executar' END) AS situacao FROM n""")
def call_gating(t: Tables) -> DataFrame:
    """The order of gates before a paid call."""
    k = F.col("event_id")
    d = t.events.select(
        "event_id", F.col("user_id").alias("lote"), k.alias("seq"), F.when(F.col("event_type") == "view", "registro_identico").alias("dispensa"), F.lit(True).alias("ligada"), F.lit(False).alias("limite_zero"), F.lit(True).alias("configurada"), F.when(k % 19 != 0, F.lit(1.0)).alias("preco"),
        F.when(k % 7 == 0, k).alias("reutilizado"), F.lit(False).alias("ja_analisado"), calls.limit_violations(F.col("value"), F.lit(0.0), F.lit(0.0), F.lit(1e9), F.lit(1e9), F.lit(90.0)).alias("violacoes"),
    )
    return calls.gated_calls(d, 30, segment=segments.blocks(F.col("seq"), 4096)).select("event_id", "lote", "situacao")


@query("""SELECT l_orderkey, l_linenumber, l_quantity / 1000000.0::DOUBLE * 3.0::DOUBLE + l_linenumber / 1000000.0::DOUBLE * 15.0::DOUBLE AS cost FROM lineitem""")
def call_costs(t: Tables) -> DataFrame:
    """Cost of calls by tokens and prices."""
    return t.lineitem.select("l_orderkey", "l_linenumber", call_cost(F.col("l_quantity"), F.col("l_linenumber"), F.lit(3.0), F.lit(15.0)).alias("cost"))


@query("""
WITH h AS (SELECT event_id, sha256(concat_ws('|', event_type, CAST(user_id % 20 AS VARCHAR), '')) AS h, event_type <> 'error' AND event_id % 2 = 0 AS ok FROM events),
g AS (SELECT h, max(event_id) AS reutilizado FROM h WHERE ok GROUP BY h) SELECT event_id, g.reutilizado FROM h LEFT JOIN g ON h.h = g.h""")
def call_hash_reuse_all(t: Tables) -> DataFrame:
    """Reuse of the latest success of the same call hash, for every event (K6, K7)."""
    h = keys.call_hash(F.col("event_type"), F.col("user_id") % 20, F.lit(None))
    d = t.events.select("event_id", h.alias("hash_chamada"), "event_type")
    done = d.select(F.col("event_id").alias("id"), "hash_chamada", F.when((F.col("event_type") != "error") & (F.col("event_id") % 2 == 0), "sucesso").otherwise("falha").alias("status"), F.col("event_id").alias("created_at"))
    return calls.reused(d, done).select("event_id", "reutilizado")


_PAIRS = (("view", "click"), ("click", "purchase"), ("signup", "view"), ("SEM_FLUXO", "signup"), ("SEM_FLUXO", "view"), ("purchase", "error"), ("error", "view"), ("click", "view"))


@query("""
WITH d AS (SELECT event_id, user_id, event_type AS para, lag(event_type, 1, 'SEM_FLUXO') OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events),
e AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN 'view' ELSE prev END AS de FROM d),
r(de, para) AS (VALUES ('view', 'click'), ('click', 'purchase'), ('signup', 'view'), ('SEM_FLUXO', 'signup'), ('SEM_FLUXO', 'view'), ('purchase', 'error'), ('error', 'view'), ('click', 'view'))
SELECT event_id, array_to_string(list_filter([CASE WHEN e.de <> prev THEN 'estado_divergente' END, CASE WHEN r.de IS NULL THEN 'transicao_proibida' END, CASE WHEN event_id % 6 = 0 THEN 'usuario_obrigatorio' END], lambda x: x IS NOT NULL), ',') AS violations
FROM e LEFT JOIN r ON e.de = r.de AND e.para = r.para""")
def transition_violations(t: Tables) -> DataFrame:
    """Workflow log checked against a transition table, batch form."""
    k = F.col("event_id")
    before = F.lag("event_type", 1, "SEM_FLUXO").over(Window.partitionBy("user_id").orderBy("event_id"))
    log = t.events.select(k, F.col("user_id").alias("u"), F.lit("IR").alias("acao"), F.when(k % 5 == 0, "view").otherwise(before).alias("de"), F.col("event_type").alias("para"), F.when(k % 6 != 0, "p").alias("usuario_id"), F.lit(None).cast("string").alias("motivo"), F.lit("{}").alias("payload"))
    rules = workflow.transition_table(t.spark, [("IR", a, b) for a, b in _PAIRS])
    return workflow.transition_violations(log, rules, "u", "event_id", segment=segments.blocks(F.col("event_id"), 4096)).select("event_id", F.array_join("violations", ",").alias("violations"))


@query("""
WITH c AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
SELECT o_custkey, count(*) AS n, sha256('[' || string_agg('{"n":' || n || ',"o_orderkey":' || o_orderkey || '}', ',' ORDER BY n) || ']') AS hash, count(*) <= 5 AS dentro_do_teto FROM c GROUP BY o_custkey""")
def ranking_freeze(t: Tables) -> DataFrame:
    """A frozen ranking per lot with its hash (V7)."""
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    c = t.orders.withColumn("n", F.row_number().over(w))
    return workflow.frozen_ranking(c, "o_custkey", "n", "o_orderkey", 5).drop("itens")


@query("""
WITH c AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
SELECT o_custkey, count(*) AS n, sha256('[' || string_agg('{"n":' || n || ',"o_orderkey":' || o_orderkey || '}', ',' ORDER BY n) || ']') AS hash, count(*) <= 5 AS dentro_do_teto FROM c GROUP BY o_custkey""")
def ranking_freeze_all(t: Tables) -> DataFrame:
    """A frozen ranking of every item of a lot with its hash; the cap is a flag (V7)."""
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return workflow.frozen_ranking(t.orders.withColumn("n", F.row_number().over(w)), "o_custkey", "n", "o_orderkey", 5).drop("itens")


@query("""SELECT event_id, user_id, event_type FROM events WHERE event_id % 50 = 0""")
def lost_log_rows(t: Tables) -> DataFrame:
    """Rows that a later snapshot of an append-only log lacks."""
    e = t.events.select("event_id", "user_id", "event_type")
    return workflow.lost_rows(e, e.filter("event_id % 50 <> 0"))


@query("""
WITH j AS (SELECT event_id, event_type, value, props FROM events)
SELECT event_id, CASE WHEN event_type = 'error' THEN array_to_string(list_filter([CASE WHEN event_id % 2 = 0 THEN 'mudanca_incompleta' END, CASE WHEN value < 10 THEN 'mudanca_sem_diferenca' END], lambda x: x IS NOT NULL), ',') ELSE CASE WHEN event_id % 2 <> 0 THEN 'sem_mudanca_com_delta' ELSE '' END END AS violations FROM j""")
def monitoring_shape(t: Tables) -> DataFrame:
    """Shape of monitoring rows."""
    d = t.events.select("event_id", F.when(F.col("event_type") == "error", "mudanca_material").otherwise("sem_mudanca").alias("resultado"), F.when(F.col("event_id") % 2 != 0, "d").alias("delta"), F.when(F.col("event_id") % 2 != 0, F.col("ts")).alias("data_mudanca"), F.col("props").alias("impressao"), F.when(F.col("value") < 10, F.col("props")).otherwise("y").alias("impressao_anterior"))
    return workflow.monitoring_violations(d).select("event_id", F.array_join("violations", ",").alias("violations"))


@query("""
SELECT event_id, array_to_string(list_filter([CASE WHEN event_type <> 'view' THEN 'G1' END, CASE WHEN value > 50 THEN 'G2' END, CASE WHEN user_id % 2 = 0 THEN 'G3' END], lambda x: x IS NOT NULL), ',') AS blocks FROM events""")
def generation_blocks(t: Tables) -> DataFrame:
    """Generation blocks of dossiers."""
    review = F.to_json(F.struct(F.when(F.col("event_type") == "view", "localizada_e_legivel").alias("fonte_primaria"), F.lit("confirmada").alias("identidade_evento"), F.when(F.col("user_id") % 2 != 0, "pedido").alias("natureza_ato"), F.lit("nao").alias("duplicidade")))
    alerts = F.to_json(F.struct((F.col("value") > 50).alias("chaves_conflitantes")))
    return t.events.select("event_id", F.array_join(workflow.generation_blocks(F.lit(None).cast(workflow.MATRIX), review, alerts), ",").alias("blocks"))


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN l_quantity > 40 THEN 'grande' END, CASE WHEN l_tax > 0.05 THEN 'taxa' END], lambda x: x IS NOT NULL), ',') AS reasons FROM lineitem""")
def ordered_reasons(t: Tables) -> DataFrame:
    """Reason lists that keep the order of their rules."""
    return t.lineitem.select("l_orderkey", "l_linenumber", F.array_join(listed([(F.col("l_quantity") > 40, "grande"), (F.col("l_tax") > 0.05, "taxa")]), ",").alias("reasons"))


@query("""
WITH v AS (SELECT c_custkey, c_acctbal FROM customer), m AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1)
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'falha_extracao' WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'descartado' ELSE 'mantido' END WHEN c_custkey % 5 = 1 THEN 'contextual' WHEN c_acctbal < 1000 THEN CASE WHEN c_custkey % 2 = 0 THEN 'arquivado' ELSE 'mantido' END ELSE 'pontuado' END AS acao FROM customer""")
def notice_routing(t: Tables) -> DataFrame:
    """What becomes of each item."""
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    band = F.when(k % 5 == 0, "descartado").when(k % 5 == 1, "contextual").otherwise("confirmado")
    act = scores.notice_route(b < 0, band, F.array().cast("array<string>"), F.lit(True), F.when(b < 1000, "D").otherwise("B"), k % 2 == 0)
    return t.customer.select("c_custkey", act.alias("acao"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'descartado' WHEN p_size % 4 = 1 OR p_type = 'PROMO' THEN 'requer_revisao' WHEN p_size % 4 = 2 THEN 'aguardando_score' ELSE 'pontuado' END AS acao FROM part""")
def permit_routing(t: Tables) -> DataFrame:
    """What becomes of each permit act."""
    z = F.col("p_size") % 4
    link = F.when(z == 0, "nao_mineral_confirmado").when(z == 1, "indeterminado").otherwise("confirmado")
    return t.part.select("p_partkey", scores.permit_route(F.when(F.col("p_type") == "PROMO", "indeterminado").otherwise("suspensao"), link, F.when(z == 3, 1.0)).alias("acao"))


@query("""
WITH v AS (SELECT l_partkey AS k, max(l_shipdate) AS d FROM lineitem GROUP BY 1) SELECT p_partkey, CASE WHEN d IS NULL THEN 'so_novo' ELSE 'ambos' END AS presence FROM part LEFT JOIN v ON p_partkey = k""")
def diagnostic_join(t: Tables) -> DataFrame:
    """Stored ids against known ones (J14); ``diagnostic_ids`` goes on to their current rows."""
    stored = t.lineitem.select(F.col("l_partkey").alias("p_partkey"))
    return joins.matched_cases(stored, t.part.select("p_partkey"), ["p_partkey"])
