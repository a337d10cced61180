"""Pending scores, stored rows as rule inputs, shared-value classes, notices and small rules of cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import normalised
from ledgerline.operators import joins
from ledgerline.operators.shared import written
from ledgerline.plans import analysis, cases, checklist, criticality, notices, recalculation, scores
from ledgerline.plans import vocabulary as V
from ledgerline.queries.decisions import _ACTS_SQL, REF, _acts
from ledgerline.queries.registry import Tables, query
from ledgerline.queries.texts import _ACC

_OLD_SQL = _ACTS_SQL.replace("o_orderkey % 5 <> 0 AS ev", "false AS ev")


def _stored(t: Tables) -> DataFrame:
    """Score rows as they were before any evidence came; every seventh is retired, every eleventh of another rule."""
    old = written(criticality.classified_acts(_acts(t).withColumn("tem_evidencia", F.lit(False)), F.lit(REF).cast("date")), "acts")
    k = F.col("id_evento")
    parts = F.to_json(F.struct(F.lit("M9A").alias("modulo"), F.col("nivel").alias("criticidade"), "pontuacao", "provisoria", "evidencia_suficiente"))
    return old.select(k.alias("event_id"), (k % 7 != 0).alias("vigente"), F.when(k % 11 == 0, "V1").otherwise("CRIT-V1.2").alias("versao_score"), parts.alias("componentes"))


_PENDING = "id_evento % 7 <> 0 AND id_evento % 11 <> 0 AND (provisoria OR nivel LIKE 'POTENCIAL%' OR NOT suficiente)"


@query(f"WITH {_OLD_SQL} SELECT id_evento AS event_id FROM x WHERE {_PENDING}")
def pending_scores(t: Tables) -> DataFrame:
    """Current rows that wait for evidence or an official type."""
    return recalculation.pending(_stored(t)).select("event_id")


@query(f"""
WITH old AS (WITH {_OLD_SQL} SELECT * FROM x WHERE {_PENDING}), new AS (WITH {_ACTS_SQL} SELECT * FROM x)
SELECT old.id_evento AS event_id, new.nivel, new.pontuacao, new.provisoria, CASE WHEN new.nivel = old.nivel AND new.pontuacao = old.pontuacao AND new.provisoria = old.provisoria THEN 'inalterado' ELSE 'gravado' END AS resultado
FROM old JOIN new ON old.id_evento = new.id_evento""")
def recalculated_scores(t: Tables) -> DataFrame:
    """Pending scores calculated anew once evidence has come (V3)."""
    return recalculation.recalculated(_stored(t), _acts(t).withColumnRenamed("id_evento", "event_id"), F.lit(REF).cast("date"))


@query("""
WITH e AS (SELECT l_orderkey, ['descricao_tipo_evento', 'titular', 'substancia', 'area_ha', 'outro'][l_partkey % 5 + 1] AS campo, CASE WHEN l_partkey % 5 = 3 THEN CAST(l_quantity AS INTEGER)::VARCHAR ELSE l_linestatus END AS trecho, l_linenumber AS seq FROM lineitem WHERE l_returnflag <> 'R'),
g AS (SELECT l_orderkey, count(*) AS n, list_distinct(list(trecho) FILTER (campo = 'descricao_tipo_evento' AND trecho <> '')) AS tipos, (min({'s': seq, 't': trecho}) FILTER (campo = 'titular' AND trecho <> '')).t AS tit, (min({'s': seq, 't': trecho}) FILTER (campo = 'substancia' AND trecho <> '')).t AS sub, (min({'s': seq, 't': trecho}) FILTER (campo = 'area_ha' AND trecho <> '')).t AS area FROM e GROUP BY 1),
j AS (SELECT o.*, g.*, unnest(CASE WHEN len(coalesce(tipos, [])) = 0 THEN [NULL] ELSE tipos END) AS tipo FROM orders o LEFT JOIN g ON o_orderkey = l_orderkey)
SELECT o_orderkey AS event_id, tipo AS tipo_scm, o_orderpriority || ' ' || o_orderstatus AS tipo_texto, coalesce(tit, 'C' || o_custkey) AS titular, coalesce(sub, o_orderpriority || ' ' || o_orderstatus) AS substancia,
  area AS area_ha, CAST(o_orderkey % 3 AS INTEGER) AS n_municipios, coalesce(n, 0) > 0 AS tem_evidencia FROM j""")
def act_inputs(t: Tables) -> DataFrame:
    """Stored events and evidence as inputs of the classification."""
    o, k = t.orders, F.col("o_orderkey")
    events = o.select(
        k.alias("event_id"), F.col("o_orderpriority").alias("tipo_evento"), F.col("o_orderstatus").alias("decisao"), F.to_date("o_orderdate").alias("data_evento"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("empresa"),
        F.col("o_orderpriority").alias("atividade"), F.col("o_orderstatus").alias("palavras_chave"), F.lit("").alias("titulo_fato"), F.lit(None).cast("string").alias("impacto_dimensionado"), F.when(k % 3 == 0, " ; ").when(k % 3 == 1, "A; ").otherwise("A/B").alias("municipio"),
    )
    n = (F.col("l_partkey") % 5).cast("int")
    field = F.element_at(F.array(*[F.lit(x) for x in ("descricao_tipo_evento", "titular", "substancia", "area_ha", "outro")]), n + 1)
    excerpt = F.when(n == 3, F.col("l_quantity").cast("int").cast("string")).otherwise(F.col("l_linestatus"))
    evidence = t.lineitem.select(F.col("l_orderkey").alias("event_id"), field.alias("campo_sustentado"), excerpt.alias("trecho_literal"), (F.col("l_returnflag") == "R").alias("superseded"), F.col("l_linenumber").alias("seq"))
    return recalculation.act_inputs(events, evidence).drop("data_ato")


@query("""
WITH v AS (SELECT DISTINCT p_partkey AS item, 'p_brand' AS criterio, p_brand AS value FROM part UNION SELECT DISTINCT p_partkey, 'p_name', p_name FROM part)
SELECT item, criterio, value, min(item) OVER w AS class_id, count(*) OVER w - 1 AS links FROM v WINDOW w AS (PARTITION BY criterio, value) QUALIFY count(*) OVER w > 1""")
def antecedent_classes(t: Tables) -> DataFrame:
    """Items that share a value, as classes with the number of each item's links: no link is lost and none is expanded."""
    return joins.shared_value_classes(t.part, "p_partkey", ["p_brand", "p_name"])


@query("""
WITH c AS (SELECT o_orderkey AS k, max_by(l_partkey, l_linenumber::BIGINT * 1000000000 + l_partkey) AS processo FROM orders JOIN (SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM lineitem) ON o_orderkey = l_orderkey WHERE l_returnflag = 'N' GROUP BY 1)
SELECT o_orderkey, processo, CASE WHEN o_orderkey % 5 = 0 THEN 'nao_armazenado' WHEN processo IS NULL THEN 'sem_score_vigente' WHEN p_partkey IS NULL THEN 'processo_desconhecido' ELSE 'ok' END AS situacao
FROM orders LEFT JOIN (SELECT * FROM c WHERE k % 5 <> 0) c ON o_orderkey = k LEFT JOIN part ON processo = p_partkey AND p_size > 10""")
def diagnostic_ids(t: Tables) -> DataFrame:
    """Stored ids, their current score row and the process that it names."""
    asked, stored = t.orders.select("o_orderkey"), t.orders.filter("o_orderkey % 5 <> 0").select("o_orderkey")
    rows = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("processo"), (F.col("l_returnflag") == "N").alias("vigente"), F.col("l_linenumber").alias("seq"))
    known = t.part.filter("p_size > 10").select(F.col("p_partkey").alias("processo"))
    return joins.diagnosed(asked, stored, rows, known, "o_orderkey", "processo", "vigente", "seq")


def _notice_text() -> Column:
    """Labelled notices in the layouts in which they come."""
    k = F.col("o_orderkey")
    even, none = k % 2 == 0, F.when(k % 4 == 0, "n/a").otherwise("diesel")
    return F.concat(
        F.lit("Nº Protocolo: "), k.cast("string"), F.lit("\nMODALIDADE DO ACIDENTE: "), F.col("o_orderpriority"), F.lit("\nLOCAL; "), F.when(k % 3 == 0, "Não informado").otherwise(F.concat(F.lit("BR-040,  km 12,5\nsentido "), F.col("o_orderstatus"))),
        F.lit("\nMUNICÍPIO: X\nDATA/HORA DA OCORRÊNCIA: 01/02/2001 - 10:00\nDATA/HORA DO COMUNICADO AO NEA: 01/02/2001 - 12:00\nFONTE(S) DE INFORMAÇÕES: rádio\nBREVE DESCRIÇÃO DA OCORRÊNCIA: Clerk "), F.col("o_custkey").cast("string"),
        F.lit("\nPRODUTO: "), none, F.lit("\nNÚMERO ONU: "), F.when(even, "ONU 1202").otherwise("--"), F.lit("\nCLASSE DE RISCO: "), F.when(even, "3 - inflamável").otherwise("nd"), F.lit("\nNúcleo de Prevenção e Emergência Ambiental\nRua A"),
    )


_NOTICE_COLUMNS = ("o_orderkey", "protocolo", "modalidade", "local", "descricao", "produto", "rodovia", "km", "onu", "classe")
_NOTICE_SQL = """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS protocolo, o_orderpriority AS modalidade, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'BR-040, km 12,5 sentido ' || o_orderstatus END AS local, 'Clerk ' || o_custkey AS descricao,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'diesel' END AS produto, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'BR-040' END AS rodovia, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '12.5' END AS km,
  CASE WHEN o_orderkey % 2 = 0 THEN '1202' END AS onu, CASE WHEN o_orderkey % 2 = 0 THEN '3' END AS classe FROM orders"""


@query(_NOTICE_SQL)
def notice_fields(t: Tables) -> DataFrame:
    """Labelled notices in the layouts in which they come: fields, road, numbers."""
    return notices.notice_details(t.orders.select("o_orderkey", _notice_text().alias("text")), "o_orderkey", "text").select(*_NOTICE_COLUMNS)


@query(_NOTICE_SQL)
def notice_blanks(t: Tables) -> DataFrame:
    """The same notices with the no-break and thin spaces of printed documents."""
    blank = F.when(F.col("o_orderkey") % 2 == 0, "\u00a0").otherwise("\u202f")
    return notices.notice_details(t.orders.select("o_orderkey", F.replace(_notice_text(), F.lit(" "), blank).alias("text")), "o_orderkey", "text").select(*_NOTICE_COLUMNS)


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'm8' WHEN 1 THEN 'm9a' WHEN 2 THEN 'm6' END AS modulo, CASE c_custkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS qualidade FROM customer""")
def module_names(t: Tables) -> DataFrame:
    """Short names of modules and grades of evidence."""
    z = F.col("c_custkey") % 4
    name = F.when(z == 0, "M8_acidentes_ambientais").when(z == 1, "M9A_anm_movimentacoes").when(z == 2, "M6_outorgas").otherwise(F.col("c_mktsegment"))
    grade = F.when(z == 0, "Alta").when(z == 1, "Media").when(z == 2, "Baixa")
    return t.customer.select("c_custkey", recalculation.module_short_name(name).alias("modulo"), recalculation.evidence_grade(grade).alias("qualidade"))


_CODES = "[" + ", ".join(f"'{c}'" for c in V.INDUSTRY_CODES) + "]"


@query(f"""
WITH d AS (SELECT s_suppkey, {_CODES}[s_suppkey % {len(V.INDUSTRY_CODES) + 1} + 1] AS p FROM supplier)
SELECT s_suppkey, list_filter({_CODES}, lambda c: starts_with(regexp_replace(coalesce(p, '99') || '.1-0', '[^0-9]', '', 'g'), c))[1] AS codigo FROM d""")
def industry_codes(t: Tables) -> DataFrame:
    """Industry codes by prefix of their digits."""
    code = F.coalesce(F.get(F.array(*[F.lit(c) for c in V.INDUSTRY_CODES]), (F.col("s_suppkey") % (len(V.INDUSTRY_CODES) + 1)).cast("int")), F.lit("99"))
    return t.supplier.select("s_suppkey", recalculation.industry_code(F.concat(code, F.lit(".1-0"))).alias("codigo"))


_BARE = f"regexp_replace(translate(lower({{}}), {_ACC}), '[^\\x00-\\x7F]', '', 'g')"
_VERB = "CASE " + " ".join(f"WHEN regexp_matches(v, '{p}') THEN '{k}'" for p, k in V.PERMIT_VERBS) + " ELSE 'indeterminado' END"
_MINERAL = " OR ".join(r"regexp_matches(u, '\bmina\b')" if w == "mina" else f"contains(u, '{w}')" for w in V.PERMIT_MINERAL)
_OTHER_USE = " OR ".join(f"contains(u, '{w}')" for w in V.PERMIT_OTHER_USE)


@query(f"""
WITH t AS (SELECT doc_id, {_BARE.format("coalesce(text, '')")} AS v, {_BARE.format("coalesce(lang, '') || ' ' || coalesce(source, '') || ' ' || coalesce(text, '')")} AS u FROM documents)
SELECT doc_id, {_VERB} AS verbo, CASE WHEN {_MINERAL} THEN 'confirmado' WHEN {_OTHER_USE} THEN 'nao_mineral_confirmado' ELSE 'indeterminado' END AS vinculo FROM t""")
def permit_verbs(t: Tables) -> DataFrame:
    """Decision verbs and mineral link of texts by the permit vocabularies."""
    d = F.col("text")
    return t.documents.select("doc_id", scores.permit_verb(F.coalesce(F.lower(d), F.lit(""))).alias("verbo"), scores.permit_link(F.col("lang"), F.col("source"), F.lower(d)).alias("vinculo"))


_KINDS = ("CONC LAV/DECAIMENTO INSTAURADO PUBL", "AUT PESQ/CESSAO TOTAL APROVADA PUBL", "AUT PESQ/PAGAMENTO DE TAH EFETUADO", "RENUNCIA PROTOC", "PENHORA AVERBADA", "EXIGENCIA PUBL", "RETIFICACAO DE ALVARA DE PESQUISA", "OUTRO ATO")
_KIND_LIST = "[" + ", ".join(f"'{k}'" for k in _KINDS) + "]"
_HAS = {k: " OR ".join(f"contains(n, '{normalised(t)}')" for t in terms) for k, terms in V.ACT_TERMS.items()}


def _case_acts(t: Tables) -> DataFrame:
    """Lines as acts of the case of their order."""
    s = F.col("l_suppkey")
    return t.lineitem.select(
        "l_orderkey", F.col("l_partkey").cast("string").alias("processo"), F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("l_partkey") % len(_KINDS) + 1).cast("int")).alias("descricao"), F.lit(None).cast("string").alias("narrativa"),
        F.when(s % 3 == 0, "VALE S.A.").otherwise(F.concat(F.lit("OUTRA "), s.cast("string"))).alias("empresa"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_linestatus")).alias("municipio"), F.to_date("l_shipdate").alias("data_evento"),
        F.when(F.col("l_returnflag") == "R", "MINÉRIO DE FERRO").otherwise("GRANITO").alias("substancia"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("int").cast("string")).otherwise("").alias("area_ha"), "l_linenumber",
    )


_CASE_CTES = f"""a AS (SELECT l_orderkey, l_partkey::VARCHAR AS processo, {_KIND_LIST}[l_partkey % {len(_KINDS)} + 1] AS d, CASE WHEN l_suppkey % 3 = 0 THEN 'VALE S.A.' ELSE 'OUTRA ' || l_suppkey END AS empresa, CASE WHEN l_partkey % 5 <> 0 THEN l_linestatus END AS mun,
    CAST(l_shipdate AS DATE) AS dia, l_returnflag = 'R' AS est, l_linenumber % 2 = 0 AND CAST(l_quantity AS INTEGER) <> 0 AS dim, l_linenumber AS ln FROM lineitem),
n AS (SELECT *, trim(regexp_replace(' ' || lower(regexp_replace(d, '[^A-Z0-9]+', ' ', 'g')) || ' ', ' de ', ' ', 'g')) AS n FROM a),
f AS (SELECT *, {", ".join(f"({v}) AS {k}" for k, v in _HAS.items())}, empresa LIKE 'VALE%' AS emp FROM n),
c AS (SELECT l_orderkey, count(*) AS atos, count(DISTINCT processo) AS processos, count(DISTINCT mun) AS municipios, min({{'o': ln, 'p': processo, 'd': d, 'e': empresa, 'm': coalesce(mun, ''), 't': dia}}) AS p,
    bool_or(mudanca_material_direito) AS mm, bool_or(perda_de_lavra) AS pl, bool_or(alvara_comum_pesquisa) AS al, bool_or(reserva_ou_substancia) AS rs, bool_or(rotina) AS ro, bool_or(exigencia_generica) AS ex, bool_or(retificacao_formal) AS re, bool_or(dim) AS dim, bool_or(emp) AS emp, bool_or(est) AS est FROM f GROUP BY 1),
s AS (SELECT *, greatest(least(mm::INT * 4 + al::INT * 2 + dim::INT * 2 + emp::INT * 2 + est::INT * 2 + rs::INT + (municipios >= 2)::INT, 10) - ro::INT * 5 - ex::INT * 3 - re::INT * 2, 0) AS s0 FROM c),
t AS (SELECT *, least(s0, CASE WHEN ro THEN 1 ELSE 10 END, CASE WHEN ex THEN 4 ELSE 10 END, CASE WHEN al AND NOT (mm OR dim OR emp OR est OR rs OR municipios >= 2) THEN 4 ELSE 10 END, CASE WHEN rs AND NOT dim THEN 7 ELSE 10 END) AS s1 FROM s),
u AS (SELECT *, CASE WHEN pl THEN greatest(s1, 8) ELSE s1 END AS score FROM t),
v AS (SELECT *, CASE WHEN score >= 8 THEN 'A' WHEN score >= 5 THEN 'B' WHEN score >= 2 THEN 'C' ELSE 'D' END AS faixa, count(*) OVER (PARTITION BY p.e) - 1 AS antecedentes FROM u)"""


@query(f"""WITH {_CASE_CTES}
SELECT l_orderkey, atos, processos, CAST(score AS DOUBLE) AS score, faixa, p.e = 'VALE S.A.' AS criterio_ok, CASE WHEN p.e <> 'VALE S.A.' THEN 'criterios:empresa' WHEN faixa NOT IN ('A', 'B') THEN 'banda_' || faixa END AS motivo_fila, antecedentes,
  CASE WHEN 5 + (p.m <> '')::INT + (processos > 1 OR antecedentes > 0)::INT >= 6 THEN 'Media' ELSE 'Baixa' END AS grau FROM v""")
def case_assembly(t: Tables) -> DataFrame:
    """Acts assembled to scored cases with their queue reason, antecedents and completeness."""
    acts = _case_acts(t)
    order = F.struct("l_linenumber", "processo", "descricao", "empresa", F.coalesce("municipio", F.lit("")).alias("m"), "data_evento")
    found = cases.assembled(acts, "l_orderkey", order, {"score_m9a": 1.0}, F.create_map(F.lit("empresa"), F.lit("vale s.a.")))
    return found.select("l_orderkey", "atos", "processos", "score", "faixa", "criterio_ok", "motivo_fila", "antecedentes", "grau")


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey % 7 = 0 AS x, c_custkey % 5 = 0 AS y, c_acctbal > 0 AS z, c_nationkey % 2 = 0 AS w FROM customer),
a AS (SELECT 'atos' AS modulo, k, list_transform(['S', CASE WHEN x THEN 'N' ELSE 'S' END, CASE WHEN z THEN 'S' ELSE 'N' END, 'S', 'A', CASE WHEN w THEN 'S' ELSE 'N' END, CASE WHEN y THEN 'S' WHEN x THEN 'N' ELSE 'A' END, CASE WHEN w THEN 'S' ELSE 'N' END, 'A', 'A', CASE WHEN z THEN 'S' ELSE 'N' END, 'A'], lambda q: q) AS r FROM c
  UNION ALL SELECT 'comunicados', k, list_transform(['S', CASE WHEN x THEN 'N' ELSE 'S' END, CASE WHEN z OR w THEN 'S' ELSE 'N' END, 'S', CASE WHEN w THEN 'S' ELSE 'N' END, CASE WHEN w THEN 'S' ELSE 'N' END, CASE WHEN x THEN 'X' WHEN z THEN 'S' ELSE 'A' END, 'X', 'X', 'A', CASE WHEN w THEN 'S' ELSE 'N' END, 'A'], lambda q: CASE WHEN y THEN 'A' ELSE q END) FROM c
  UNION ALL SELECT 'outorgas', k, list_transform(['S', CASE WHEN x THEN 'N' ELSE 'S' END, CASE WHEN z THEN 'S' ELSE 'N' END, 'S', CASE WHEN w THEN 'S' ELSE 'N' END, CASE WHEN w OR z THEN 'S' ELSE 'N' END, CASE WHEN z THEN 'S' ELSE 'A' END, 'S', CASE WHEN x THEN 'A' ELSE 'S' END, 'A', CASE WHEN w THEN 'S' ELSE 'N' END, 'A'], lambda q: CASE WHEN y THEN 'X' WHEN x THEN 'A' ELSE q END) FROM c)
SELECT k AS c_custkey, modulo, array_to_string(r, '') AS respostas FROM a""")
def module_checklists(t: Tables) -> DataFrame:
    """The twelve answers of each module's rules."""
    k = F.col("c_custkey")
    x, y, z, w = k % 7 == 0, k % 5 == 0, F.col("c_acctbal") > 0, F.col("c_nationkey") % 2 == 0
    filled = lambda condition: F.when(condition, "x")
    day = F.lit("2001-01-01")
    answers = {
        "atos": checklist.act_answers({"titular": filled(~x), "municipio": filled(z), "data_evento": day, "descricao": filled(w)}, F.when(y, "comprovado").when(x, "nao_comprovado").otherwise("provavel"), z),
        "comunicados": checklist.notice_answers({"empresa": filled(~x), "local": filled(z), "municipio": filled(w), "data_ocorrencia": day, "volume": F.when(w, 1.5), "descricao": filled(w), "modalidade": F.lit("")}, y, F.when(x, "descartado").otherwise("confirmado"), z, w),
        "outorgas": checklist.permit_answers({"titular": filled(~x), "municipio": filled(z), "data_decisao": day, "finalidade": filled(w), "portaria": filled(z)}, y, F.when(x, "indeterminado").otherwise("suspensao"), w, z, w, F.when(~x, z)),
    }
    letter = F.create_map(*[F.lit(v) for kv in {"confirmado": "S", "nao_localizado": "N", "nao_aplicavel": "X", "requer_apuracao_humana": "A"}.items() for v in kv])
    rows = [checklist.answered(t.customer, "c_custkey", a).groupBy("c_custkey").agg(F.array_sort(F.collect_list(F.struct("pergunta", F.element_at(letter, F.col("resposta")).alias("r")))).alias("q")).select("c_custkey", F.lit(m).alias("modulo"), F.array_join(F.transform("q", lambda q: q["r"]), "").alias("respostas")) for m, a in answers.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("""
WITH c AS (SELECT o_orderkey AS k, o_orderkey % 13 AS z FROM orders)
SELECT k AS o_orderkey, CASE z WHEN 0 THEN 'json_invalido' WHEN 1 THEN 'secoes_diferentes_do_schema(faltam:-;sobram:outra)' WHEN 2 THEN 'fato_confirmado_vazio' WHEN 3 THEN 'fato_confirmado_citacao_inexistente(9),fato_confirmado_sem_citacao' WHEN 4 THEN 'numero_nao_encontrado_no_dossie(fato_confirmado:98765)'
    WHEN 6 THEN 'perguntas_redacao_itens_demais' WHEN 7 THEN 'atribui_score_ou_prioridade' WHEN 8 THEN 'libera_publicacao' WHEN 9 THEN 'hipotese_apuracao_estrutura_invalida,hipotese_apuracao_nao_e_texto' WHEN 10 THEN 'lacunas_sem_itens' WHEN 11 THEN 'numero_nao_encontrado_no_dossie(rascunho_pre_release:11.222.333)' ELSE '' END AS erros,
  CASE WHEN z IN (0, 1) THEN '' WHEN z = 12 THEN 'contexto_documental_sem_citacao,numero_fora_do_dossie(avaliacao_editorial:4567)' ELSE 'contexto_documental_sem_citacao' END AS avisos FROM c""")
def analysis_audit(t: Tables) -> DataFrame:
    """Stored analyses held against their dossiers (R32): both date forms of the day of the order are good, other numbers are not."""
    z, day = F.col("o_orderkey") % 13, F.to_date("o_orderdate")
    at = lambda n, bad, good: F.when(z == n, bad).otherwise(good)
    fact = F.when(z == 2, F.lit("curto")).when(z == 4, F.lit("Foram 98765 toneladas, segundo o auto")).when(z == 7, F.lit("O fato recebe nota final: 9 na escala")).when(z == 8, F.lit("O texto pode ser publicado assim, sem mais")).otherwise(F.concat(F.lit("O ato foi publicado em "), F.date_format(day, "dd/MM/yyyy"), F.lit(" no diário")))
    cites = at(3, F.array(F.lit(9)), F.array(F.lit(1), F.lit(2)))
    draft = at(11, F.lit("Em 11.222.333 casos"), F.when(z == 5, F.date_format(day, "yyyy-MM-dd")))
    shape = F.struct(
        F.struct(fact.alias("texto"), cites.alias("citacoes")).alias("fato_confirmado"), F.struct(F.lit("contexto").alias("texto"), F.array().cast("array<int>").alias("citacoes")).alias("contexto_documental"),
        F.struct(at(12, F.lit("Prazo de 4567 dias úteis"), F.lit("relevante ao setor")).alias("texto")).alias("avaliacao_editorial"), F.struct(F.lit("verificar a origem").alias("texto"), at(9, F.lit("x"), F.lit(None).cast("string")).alias("extra")).alias("hipotese_apuracao"),
        at(10, F.array().cast("array<string>"), F.array(F.lit("data"))).alias("lacunas"), at(6, F.array_repeat(F.lit("por quê?"), 7), F.array(F.lit("quem?"))).alias("perguntas_redacao"),
        F.struct(F.lit("ouvir os dois lados").alias("texto"), F.coalesce(draft, F.lit("x")).alias("rascunho_pre_release")).alias("proposta_abordagem"), at(1, F.lit(1), F.lit(None).cast("int")).alias("outra"),
    )
    d = t.orders.select("o_orderkey", F.when(z == 0, "{").otherwise(F.to_json(shape)).alias("resposta"), F.concat(F.lit("Publicado em "), F.date_format(day, "yyyy-MM-dd")).alias("dossie"), F.lit(2).alias("n"))
    found = analysis.audited_analyses(d, "resposta", "dossie", "n")
    return found.select("o_orderkey", F.array_join(F.array_sort("erros"), ",").alias("erros"), F.array_join("avisos", ",").alias("avisos"))


_GOOD = ('{"fato_confirmado":{"texto":"O ato foi publicado no diário","citacoes":[1]},"contexto_documental":{"texto":"c","citacoes":[2]},"avaliacao_editorial":{"texto":"relevante ao setor"},"hipotese_apuracao":{"texto":"verificar a origem"},'
         '"lacunas":["data"],"perguntas_redacao":["quem?"],"proposta_abordagem":{"texto":"ouvir os dois lados","rascunho_pre_release":null}}')
#: What is put in place of a part of a good analysis, and the errors it should give.
_SPOILT = (
    ('"rascunho_pre_release":null', '"rascunho_pre_release":""', "rascunho_pre_release_vazio"), ('"rascunho_pre_release":null', '"rascunho_pre_release":5', "rascunho_pre_release_nao_e_texto"), ('["data"]', '["data",5]', "lacunas[1]_invalido"),
    ('"citacoes":[1]', '"citacoes":["1"]', "fato_confirmado_citacao_inexistente(1),fato_confirmado_sem_citacao"), ('["quem?"]', '["  "," x "]', "perguntas_redacao[0]_invalido"), ('"citacoes":[1]', '"citacoes":[1.5,1.0,true]', "fato_confirmado_citacao_inexistente(1.5),fato_confirmado_citacao_inexistente(true)"),
    ('"citacoes":[1]', '"citacoes":{}', "fato_confirmado_citacoes_nao_e_lista"), ('"ouvir os dois lados"', '7', "proposta_abordagem_nao_e_texto"), ('"data"', '"prioridade A"', "atribui_score_ou_prioridade"), ('"data"', '"LIBERADA para a publicacao"', "libera_publicacao"),
    ('["data"]', '"data"', "lacunas_nao_e_lista"), ('"c"', '"\u00a0 "', "contexto_documental_vazio"), ('{"fato', '[{"fato', "json_invalido"), ("x", "x", ""),
)


@query(f"""
SELECT o_orderkey, CASE o_orderkey % {len(_SPOILT)} {" ".join(f"WHEN {i} THEN '{e}'" for i, (_, _, e) in enumerate(_SPOILT))} END AS erros, '' AS avisos FROM orders""")
def analysis_types(t: Tables) -> DataFrame:
    """Analyses whose parts are of a wrong type or empty."""
    z = F.col("o_orderkey") % len(_SPOILT)
    answer = F.lit(None).cast("string")
    for i, (old, new, _) in enumerate(_SPOILT):
        answer = F.when(z == i, F.replace(F.lit(_GOOD), F.lit(old), F.lit(new))).otherwise(answer)
    d = t.orders.select("o_orderkey", answer.alias("resposta"), F.lit("sem números").alias("dossie"), F.lit(2).alias("n"))
    found = analysis.audited_analyses(d, "resposta", "dossie", "n")
    return found.select("o_orderkey", F.array_join("erros", ",").alias("erros"), F.array_join("avisos", ",").alias("avisos"))
