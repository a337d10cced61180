"""Notices over the given tables: their signals, scores, queue and routes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import notice_cases as plan
from ledgerline.plans import scores
from ledgerline.queries.registry import Tables, query

#: Texts with what is known of each: link signals (material, mode, input, product, road) and severity signals (water, outside,
#: hazardous, structure, victims), before a direct signal takes those of road and product away.
_TEXTS = (
    ("Derrame de minério na lavra, atingiu o córrego", "110001", "10000"), ("Tombamento de carreta, sem minério algum espalhado pela pista", "000010", "00000"), ("Rompimento de barragem com rejeito fora da contenção, uma vítima", "101000", "01111"),
    ("Queda de pigmento na via após tombamento", "000110", "00000"), ("Nenhum rejeito foi visto ali, mas a sirene tocou", "001000", "00010"), ("Vazamento de óleo", "000000", "00000"), ("Turbidez no ribeirão pela cava, bloqueio da captação", "101000", "10001"),
)
_PICK = f"CASE o_orderkey % {len(_TEXTS)} " + " ".join(f"WHEN {i} THEN '{{}}'" for i in range(len(_TEXTS))) + " END"


def _notices(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    text = F.element_at(F.array(*[F.lit(x[0]) for x in _TEXTS]), (k % len(_TEXTS) + 1).cast("int"))
    return t.orders.select(
        "o_orderkey", text.alias("texto"), F.col("o_orderpriority").alias("titulo"), F.when(k % 3 == 0, "Nova Lima").when(k % 3 == 1, "Outro").alias("municipio"), (k % 500).alias("atraso_minutos"),
        F.when(k % 11 == 0, "limite:limite de 200 requisições").when(k % 11 == 1, "documento não abre").alias("motivo_falha"), (F.col("o_custkey") % 2 == 0).alias("criado"),
    )


_BITS = lambda j, at: _PICK.format(*[x[j][at] for x in _TEXTS])
_SIGNALS = f"""n AS (SELECT *, {_BITS(1, 0)} = '1' AS mat, {_BITS(1, 1)} = '1' AS modo, {_BITS(1, 2)} = '1' AS ins, {_BITS(1, 3)} = '1' AS prod0, {_BITS(1, 4)} = '1' AS road0, o_orderkey % 3 = 0 AS mun,
  {_BITS(2, 0)}::INT * 3 + {_BITS(2, 1)}::INT * 2 + {_BITS(2, 2)}::INT * 2 + {_BITS(2, 3)}::INT * 2 + {_BITS(2, 4)}::INT + (o_orderkey % 500 > 360)::INT AS grav0,
  CASE o_orderkey % 11 WHEN 0 THEN 'limite' WHEN 1 THEN 'falha' END AS falha, o_custkey % 2 = 0 AS criado FROM orders),
d AS (SELECT *, mat OR modo OR ins AS direto FROM n),
s AS (SELECT *, CASE WHEN falha IS NOT NULL THEN 0 ELSE least(mat::INT * 5 + modo::INT * 4 + ins::INT * 2 + (mun AND direto)::INT, 10) - CASE WHEN direto THEN 0 ELSE prod0::INT * 4 + road0::INT * 3 END END AS sv FROM d),
f AS (SELECT *, CASE WHEN falha IS NOT NULL THEN 'contextual' WHEN sv >= 8 THEN 'confirmado' WHEN sv >= 5 THEN 'provavel' WHEN sv >= 2 THEN 'contextual' ELSE 'descartado' END AS faixa FROM s),
g AS (SELECT *, falha IS NULL AND faixa IN ('confirmado', 'provavel') AS lig FROM f),
h AS (SELECT *, CASE WHEN lig THEN grav0 END AS sg, CASE WHEN lig THEN round(grav0 / 11.0 * 100, 2) END AS sc FROM g)"""


@query(f"""
WITH {_SIGNALS} SELECT o_orderkey, CAST(sv AS DOUBLE) AS score_vinculo, faixa AS faixa_vinculo, CAST(sg AS DOUBLE) AS score_gravidade,
  CASE WHEN sg >= 7 THEN 'alerta_imediato' WHEN sg >= 4 THEN 'pauta_apuracao' WHEN sg >= 1 THEN 'registro_acompanhamento' WHEN sg IS NOT NULL THEN 'arquivo_contextual' END AS nivel_gravidade FROM h""")
def notice_scores(t: Tables) -> DataFrame:
    """Link and severity of notices from their text."""
    return plan.routed_notices(_notices(t), {"dano_risco": 1.0}, F.create_map().cast("map<string,string>")).select("o_orderkey", "score_vinculo", "faixa_vinculo", "score_gravidade", "nivel_gravidade")


@query(f"""
WITH {_SIGNALS}, q AS (SELECT *, CASE WHEN sc >= 80 THEN 'A' WHEN sc >= 60 THEN 'B' WHEN sc >= 40 THEN 'C' WHEN sc IS NOT NULL THEN 'D' END AS prio FROM h),
m AS (SELECT *, CASE WHEN falha IS NOT NULL OR faixa = 'descartado' THEN NULL WHEN faixa = 'contextual' THEN 'vinculo_contextual' WHEN o_orderkey % 3 <> 0 THEN 'criterio_da_carteira_nao_atendido:municipio' WHEN prio NOT IN ('A', 'B') THEN 'abaixo_das_bandas_A_B_da_carteira'
  ELSE 'prioridade_A_B_pelas_bandas_da_carteira' END AS motivo_fila FROM q),
a AS (SELECT *, coalesce(motivo_fila = 'prioridade_A_B_pelas_bandas_da_carteira', false) AS sel FROM m),
r AS (SELECT *, CASE WHEN falha = 'limite' THEN 'adiado_por_limite' WHEN falha IS NOT NULL THEN 'falha_extracao' WHEN faixa IN ('descartado', 'contextual') THEN faixa WHEN sel THEN 'processado' ELSE 'arquivado' END AS acao FROM a)
SELECT o_orderkey, CAST(sc AS DOUBLE) AS score_carteira, prio AS prioridade, motivo_fila, sel AS selecionavel, acao, CASE WHEN criado AND acao <> 'adiado_por_limite' THEN CASE WHEN acao = 'descartado' THEN 'descartado' WHEN acao IN ('contextual', 'arquivado') THEN 'arquivado' ELSE 'em_apuracao' END END AS status FROM r""")
def notice_routes(t: Tables) -> DataFrame:
    """What becomes of each notice, fetch failures and deferred ones too."""
    found = plan.routed_notices(_notices(t), {"score_dano_risco": 2.0, "score_gravidade": 1.0}, F.create_map(F.lit("municipio"), F.lit("nova lima")))
    return found.select("o_orderkey", "score_carteira", "prioridade", "motivo_fila", "selecionavel", "acao", "status")


@query(f"""
WITH {_SIGNALS} SELECT o_orderkey, array_to_string(list_filter([CASE WHEN ins THEN 'insumo_estrutura_vinculada:2' END, CASE WHEN mat THEN 'material_mineral:5' END, CASE WHEN modo THEN 'modalidade_mineracao:4' END, CASE WHEN mun THEN 'municipio_minerador:1' END], lambda x: x IS NOT NULL), ',') AS gatilhos,
  array_to_string(list_filter([CASE WHEN road0 AND NOT direto THEN 'acidente_rodoviario_comum:-3' END, CASE WHEN prod0 AND NOT direto THEN 'produto_causa_nao_mineraria:-4' END], lambda x: x IS NOT NULL), ',') AS redutores FROM h WHERE falha IS NULL""")
def link_memory(t: Tables) -> DataFrame:
    """Calculation memory of links."""
    found = plan.routed_notices(_notices(t), {}, F.create_map().cast("map<string,string>")).filter("motivo_falha is null")
    listed = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("int").cast("string")))), ",")
    return found.select("o_orderkey", listed("gatilhos_vinculo").alias("gatilhos"), listed("redutores_vinculo").alias("redutores"))


@query("""
WITH d AS (SELECT c_custkey, ['provavel', 'confirmado', 'contextual', NULL][c_custkey % 4 + 1] AS f, ['A', 'B', 'C', 'D', NULL][c_custkey % 5 + 1] AS p FROM customer)
SELECT c_custkey, CASE WHEN f NOT IN ('provavel', 'confirmado') OR f IS NULL THEN 'vinculo_nao_suficiente' WHEN p NOT IN ('A', 'B') OR p IS NULL THEN 'abaixo_das_bandas_A_B_da_carteira' ELSE 'prioridade_A_B_com_gravidade_de_pauta' END AS m8,
  CASE WHEN p IN ('A', 'B') THEN 'prioridade_A_B_pela_regua_editorial' ELSE 'abaixo_do_piso_editorial_m9a' END AS m9a FROM d""")
def queue_eligibility(t: Tables) -> DataFrame:
    """Queue eligibility by module (F16)."""
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (F.col("c_custkey") % len(values)).cast("int"))
    link, band = pick(["provavel", "confirmado", "contextual", None]), pick(["A", "B", "C", "D", None])
    return t.customer.select("c_custkey", plan.notice_eligibility(link, band)["motivo"].alias("m8"), plan.act_eligibility(band)["motivo"].alias("m9a"))


@query("""
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity > 25 AS mm, l_discount > 0.05 AS gu, l_linenumber = 1 AS ap, l_tax > 0.04 AS rm, l_linestatus = 'O' AS ro, l_returnflag = 'A' AS pl FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string(list_filter([CASE WHEN mm THEN 'mudanca_material_direito' END, CASE WHEN gu THEN 'autorizacao_extracao' END], lambda x: x IS NOT NULL), ',') AS gatilhos, CASE WHEN ro THEN 'rotina' ELSE '' END AS redutores,
  CASE WHEN pl THEN 8.0::DOUBLE END AS piso, CASE WHEN ro THEN 1.0::DOUBLE END AS teto FROM f""")
def act_memories(t: Tables) -> DataFrame:
    """Calculation memory of acts: weights and reducers that hold, highest floor, lowest cap."""
    on = {"mudanca_material_direito": F.col("l_quantity") > 25, "autorizacao_extracao": F.col("l_discount") > 0.05, "rotina": F.col("l_linestatus") == "O", "perda_de_lavra": F.col("l_returnflag") == "A"}
    memory = scores.act_memory({k: on.get(k, F.lit(False)) for k in scores.ACT_FLAGS})
    names = lambda c: F.array_join(F.map_keys(c), ",")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", memory.alias("m")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", names("m.gatilhos").alias("gatilhos"), names("m.redutores").alias("redutores"), "m.piso", "m.teto")


_KINDS = ("CONC LAV/DECAIMENTO INSTAURADO PUBL", "AUT PESQ/CESSÃO TOTAL APROVADA", "PAGAMENTO DE TAH", None)


@query("""SELECT p_partkey, p_partkey % 4 IN (0, 1) AS material FROM part""")
def material_events(t: Tables) -> DataFrame:
    """Whether an act's type names a material change of right."""
    kind = F.get(F.array(*[F.lit(k) for k in _KINDS]), (F.col("p_partkey") % 4).cast("int"))
    return t.part.select("p_partkey", scores.material_event(kind).alias("material"))


@query("""
WITH d AS (SELECT o_orderkey, o_totalprice, o_custkey % 3 <> 0 AS ok, o_custkey % 4 <> 0 AS cp, CASE WHEN o_totalprice >= 300000 THEN 'A' WHEN o_totalprice >= 200000 THEN 'B' ELSE 'C' END AS band FROM orders)
SELECT o_orderkey, row_number() OVER (ORDER BY ok DESC, cp DESC, band IN ('A', 'B') DESC, o_totalprice DESC, o_orderkey) AS n FROM d ORDER BY n LIMIT 100 OFFSET 50""")
def lot_by_portfolio(t: Tables) -> DataFrame:
    """A lot of cases in the order of their portfolio."""
    d = t.orders.select("o_orderkey", F.col("o_totalprice").alias("score"), (F.col("o_custkey") % 3 != 0).alias("ok"), (F.col("o_custkey") % 4 != 0).alias("cp"), F.when(F.col("o_totalprice") >= 300000, "A").when(F.col("o_totalprice") >= 200000, "B").otherwise("C").alias("band"))
    page = d.orderBy(*scores.lot_order("ok", "cp", "band", "score", "o_orderkey")).offset(50).limit(100)
    # A page is as long as a lot, so it may be one array.
    rank = F.struct("ok", "cp", F.col("band").isin("A", "B").alias("ab"), "score", (-F.col("o_orderkey")).alias("k"))
    placed = page.agg(F.sort_array(F.collect_list(rank), asc=False).alias("l")).select(F.posexplode("l").alias("p", "r"))
    return placed.select((-F.col("r.k")).alias("o_orderkey"), (F.col("p") + 51).cast("long").alias("n"))
