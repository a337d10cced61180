"""Triage, eligibility, flags, decisions, dumps and small text operators over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import dates, text
from ledgerline.operators import counters
from ledgerline.operators.shared import shared_path
from ledgerline.plans import calls, checklist, notices, queue, triage
from ledgerline.queries.registry import Tables, query
from ledgerline.sources import pages, scan, sinks

_REF = "2001-11-05"
#: Sector text, fiscal text, and what triage finds: result, environment, social, excerpt, both.
_TEXTS = (
    ("A mina", "Vistoria. Houve contaminação do solo na área. Os pescadores pararam.", "CLASSIFICAR_AGORA", "contaminação do solo", "pescadores", "Houve contaminação do solo na área.", "false"), ("Uma escola", "Sem dados.", "FORA_DO_ESCOPO", "", "", "", "false"),
    ("", "", "NAO_AVALIAVEL", "", "", "", "false"), ("mina de ouro", "Vistoria feita.", "PENDENTE_DE_EVIDENCIA", "", "", "", "false"),
    ("mina e bauxita, ouro", "A cisterna e o CÓRREGO secaram\nRuptura vista.", "CLASSIFICAR_AGORA", "córrego", "cisterna", "A cisterna e o CÓRREGO secaram", "true"),
)
_GATES = {"P1_DANO": ("contaminação",), "P2_RUPTURA": ("ruptura",)}


def _sql(j: int) -> str:
    return "[" + ", ".join("'" + x[j] + "'" for x in _TEXTS) + f"][o_orderkey % {len(_TEXTS)} + 1]"


_AUDIT = f"""d AS (SELECT *, CAST(o_orderdate AS DATE) AS dia, ['Federal', 'MG', 'Outra', NULL][o_custkey % 4 + 1] AS jur, o_orderkey % 3 = 0 AS inercia, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) - INTERVAL 2 YEAR END::DATE AS marco FROM orders),
a AS (SELECT *, CASE WHEN dia <= DATE '{_REF}' THEN date_diff('day', dia, DATE '{_REF}') END AS idle, greatest((year(marco + INTERVAL 5 YEAR) - 2001) * 12 + month(marco + INTERVAL 5 YEAR) - 11 + CASE WHEN day(marco + INTERVAL 5 YEAR) > 5 THEN 1 ELSE 0 END, 0) AS resta FROM d),
x AS (SELECT *, CASE WHEN marco IS NOT NULL AND (jur = 'Federal' OR (jur = 'MG' AND inercia)) THEN resta END AS meses, CASE jur WHEN 'Federal' THEN CASE WHEN idle >= 1095 THEN 'parado_ha_tres_anos' WHEN marco IS NOT NULL THEN 'prazo_desde_o_marco' ELSE 'sem_dados' END
  WHEN 'MG' THEN CASE WHEN marco IS NOT NULL AND inercia THEN 'estimativa_condicional' ELSE 'marco_ou_inercia_nao_confirmados' END ELSE 'sem_dados' END AS alerta FROM a)"""


def _events(t: Tables) -> DataFrame:
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    pick = lambda j: F.element_at(F.array(*[F.lit(x[j]) for x in _TEXTS]), (k % len(_TEXTS) + 1).cast("int"))
    return t.orders.select(
        "o_orderkey", F.lit("").alias("titulo"), pick(0).alias("texto_setorial"), pick(1).alias("texto_fiscal"), F.when(k % 9 == 0, "07.10-3/01").alias("cnae"), F.when(k % 2 == 0, "http://x").alias("fonte_url"),
        F.get(F.array(F.lit("Federal"), F.lit("MG"), F.lit("Outra"), F.lit(None)), (F.col("o_custkey") % 4).cast("int")).alias("jurisdicao"), day.alias("data_ultima_movimentacao"),
        F.when(k % 7 != 0, F.add_months(day, -24)).alias("marco_inicial_prescricao"), (k % 3 == 0).alias("inercia_exclusiva_estado"),
    )


@query(f"WITH {_AUDIT} SELECT o_orderkey, CAST(idle AS INTEGER) AS dias_parado, CAST(meses AS INTEGER) AS meses_limite, CASE jur WHEN 'Federal' THEN 'federal' WHEN 'MG' THEN 'estadual' END AS regra, alerta FROM x")
def limitation_audits(t: Tables) -> DataFrame:
    """Limitation periods by jurisdiction."""
    a = triage.limitation_audit(F.col("jurisdicao"), F.col("data_ultima_movimentacao"), F.col("marco_inicial_prescricao"), F.col("inercia_exclusiva_estado"), F.lit(_REF).cast("date"))
    return _events(t).select("o_orderkey", a.alias("a")).select("o_orderkey", "a.*")


@query(f"""
WITH {_AUDIT}, r AS (SELECT *, CASE WHEN o_orderkey % 9 = 0 AND {_sql(2)} = 'FORA_DO_ESCOPO' THEN 'PENDENTE_DE_EVIDENCIA' ELSE {_sql(2)} END AS res FROM x)
SELECT o_orderkey, res AS resultado, CASE WHEN res = 'CLASSIFICAR_AGORA' THEN 'candidato_fila_editor' WHEN res = 'FORA_DO_ESCOPO' THEN 'descartado' ELSE 'em_revisao' END AS status_triagem, {_sql(3)} AS evidencias_ambientais, {_sql(4)} AS evidencias_sociais, {_sql(5)} AS trecho, {_sql(6)} = 'true' AS cobre_os_dois_nexos,
  CASE o_orderkey % 5 WHEN 3 THEN 'ouro' WHEN 4 THEN 'bauxita' END AS atividade_direta, CASE WHEN o_orderkey % 9 = 0 THEN '07103' END AS cnae_enquadrado, CASE WHEN coalesce(idle >= 365, false) OR coalesce(meses <= 12, false) THEN 'ALTA_RELEVANCIA_ALERTA_VERMELHO' ELSE 'EXPOSICAO_PADRAO' END AS prioridade_exposicao,
  CASE WHEN res <> 'FORA_DO_ESCOPO' THEN 'pendente' END AS revisao_humana FROM r""")
def triage_rows(t: Tables) -> DataFrame:
    """Impact triage records."""
    r = triage.triage_records(_events(t), "o_orderkey", F.lit(_REF).cast("date"), gates=_GATES, sector=("mina",))
    listed = [F.array_join(c, ",").alias(c) for c in ("evidencias_ambientais", "evidencias_sociais")]
    return r.select("o_orderkey", "resultado", "status_triagem", *listed, F.coalesce("trecho", F.lit("")).alias("trecho"), "cobre_os_dois_nexos", "atividade_direta", "cnae_enquadrado", "prioridade_exposicao", "revisao_humana")


@query("""
WITH s AS (SELECT l_orderkey AS k, l_linenumber, l_linestatus = 'O' AS vig, l_quantity, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus = 'O' DESC, l_shipdate DESC, l_linenumber * 1000000 + l_partkey DESC, l_extendedprice DESC) AS rn FROM lineitem),
c AS (SELECT * FROM s WHERE rn = 1), e AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE k END AS k, l_quantity, l_returnflag FROM orders LEFT JOIN c ON k = o_orderkey),
v AS (SELECT *, CASE WHEN k IS NULL THEN NULL WHEN l_returnflag = 'R' THEN l_quantity + 30 ELSE l_quantity END AS valor, l_returnflag IN ('R', 'A') AND k IS NOT NULL AS dec FROM e)
SELECT o_orderkey AS id, CAST(valor AS DOUBLE) AS valor, dec AS decisorio, CASE WHEN valor IS NULL THEN 'PENDENTE_DE_SCORE' WHEN NOT dec THEN 'SCORE_PROVISORIO' WHEN valor >= 40 THEN 'NA_SELECAO' WHEN o_orderstatus = 'P' THEN 'FORA_DA_SELECAO_MANTIDO_POR_TRAVA' ELSE 'FORA_DA_SELECAO' END AS situacao FROM v""")
def decision_rows(t: Tables) -> DataFrame:
    """Each event with the decision on its current score, as a join."""
    events = t.orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "P", "publicado").otherwise("em_apuracao").alias("status_editorial"))
    flag, q = F.col("l_returnflag"), F.col("l_quantity").cast("double")
    # Prices break what ties are left.
    lines = t.lineitem.filter("l_orderkey % 5 <> 0").select(F.col("l_orderkey").alias("event_id"), (F.col("l_linestatus") == "O").alias("vigente"), F.col("l_shipdate").alias("created_at"), F.struct((F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("a"), F.col("l_extendedprice").alias("b")).alias("id"),
        F.when(flag == "A", "final").otherwise("preliminar").alias("estagio"), q.alias("score_bruto"), F.when(flag == "R", q + 30).alias("score_relevancia"), F.lit("MEDIA").alias("criticidade"))
    return queue.decision_view(events, lines).select("id", "decisao.valor", "decisao.decisorio", "decisao.situacao")


@query("""
WITH c AS (SELECT c_custkey AS k, c_acctbal < 0 AS falha, ['provavel', 'contextual', 'descartado'][c_custkey % 3 + 1] AS faixa, c_custkey % 5 = 0 AS igual, c_custkey % 7 = 0 AS feito, c_custkey % 2 = 0 AS amb FROM customer),
n AS (SELECT k, 'comunicado' AS modulo, CASE WHEN igual THEN 'registro_identico' WHEN NOT falha AND NOT (faixa = 'provavel' OR (faixa = 'contextual' AND amb)) THEN 'descartado_por_regra_deterministica' WHEN feito THEN 'enriquecimento_ja_concluido' WHEN falha THEN 'bloqueado_por_falta_de_documento' END AS d FROM c),
m AS (SELECT k, 'monitorado', CASE WHEN igual THEN 'registro_identico' WHEN feito THEN 'descartado_por_regra_deterministica' WHEN amb OR NOT falha THEN 'continuidade_sem_mudanca_material' END FROM c)
SELECT k AS c_custkey, modulo, d AS dispensa FROM n UNION ALL SELECT * FROM m""")
def module_dismissals(t: Tables) -> DataFrame:
    """Flags of each module and the first dismissal that they give."""
    k = F.col("c_custkey")
    same, done, both, failed = k % 5 == 0, k % 7 == 0, k % 2 == 0, F.col("c_acctbal") < 0
    band = F.element_at(F.array(F.lit("provavel"), F.lit("contextual"), F.lit("descartado")), (k % 3 + 1).cast("int"))
    notices = calls.notice_flags(failed, band, F.lit("h"), F.when(same, "h").otherwise("g"), done, both)
    watched = calls.monitored_flags(same, both, done, failed)
    rows = [t.customer.select("c_custkey", F.lit(n).alias("modulo"), calls.first_dismissal(f).alias("dispensa")) for n, f in (("comunicado", notices), ("monitorado", watched))]
    return rows[0].unionByName(rows[1])


@query("""
WITH e AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
d AS (SELECT o_orderkey, coalesce(n, 0) AS n, o_orderkey % 4 = 0 OR o_orderpriority = '5-LOW' AS det, o_custkey % 3 = 0 AND o_orderstatus = 'F' AS feito FROM orders LEFT JOIN e ON k = o_orderkey)
SELECT o_orderkey AS event_id, n AS evidencias, array_to_string(list_filter([CASE WHEN n = 0 THEN 'bloqueado_por_falta_de_documento' END, CASE WHEN det THEN 'descartado_por_regra_deterministica' END, CASE WHEN feito THEN 'enriquecimento_ja_concluido' END], lambda x: x IS NOT NULL), ',') AS flags,
  CASE WHEN det THEN 'descartado_por_regra_deterministica' WHEN feito THEN 'enriquecimento_ja_concluido' WHEN n = 0 THEN 'bloqueado_por_falta_de_documento' END AS dispensa FROM d""")
def eligibility_rows(t: Tables) -> DataFrame:
    """Whether stored events may be enriched, and why not."""
    k = F.col("o_orderkey")
    events = t.orders.select(k.alias("id"))
    evidence = t.lineitem.select(F.col("l_orderkey").alias("event_id"), (F.col("l_returnflag") == "R").alias("superseded"), F.lit("12").alias("trecho_literal"))
    details = t.orders.select(k.alias("event_id"), F.when(k % 4 == 0, "contextual").otherwise("confirmado").alias("faixa_vinculo"))
    levels = t.orders.select(k.alias("event_id"), F.when(F.col("o_orderpriority") == "5-LOW", "ROTINA").otherwise("ALTA").alias("nivel"))
    done = t.orders.filter("o_custkey % 3 = 0").select(k.alias("event_id"), F.when(F.col("o_orderstatus") == "F", "sucesso").otherwise("falha").alias("status"))
    found = calls.event_eligibility(events, evidence, details, levels, done)
    return found.select("event_id", "evidencias", F.array_join(F.array_sort(F.map_keys("flags")), ",").alias("flags"), "dispensa")


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT o_custkey, count(*) AS size, min(o_orderkey) FILTER (rn = 1) AS first, string_agg(o_orderkey::VARCHAR, ',' ORDER BY rn) FILTER (rn <= 3) AS members FROM o GROUP BY 1""")
def consolidated_members(t: Tables) -> DataFrame:
    """Cases with their size, first member and a bounded number of members (A1)."""
    c = counters.consolidated(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderdate", "o_orderkey"], keep=3)
    return c.select("o_custkey", "size", F.col("first.o_orderkey").alias("first"), F.array_join(F.transform("members", lambda m: m["o_orderkey"].cast("string")), ",").alias("members"))


@query("""
WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<li>\\s*<a href="([^"]*)">(.*?)</a>', 1)) AS h, unnest(regexp_extract_all(html, '<li>\\s*<a href="([^"]*)">(.*?)</a>', 2)) AS x, generate_subscripts(regexp_extract_all(html, '<li>\\s*<a href="([^"]*)">(.*?)</a>', 1), 1) - 1 AS p, url FROM pages),
d AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || h AS link, min(p) AS position FROM a WHERE contains(lower(strip_accents(x)), 'en') GROUP BY 1, 2)
SELECT page_id, link, CAST(position AS INTEGER) AS position, CAST(row_number() OVER (PARTITION BY page_id ORDER BY position) AS INTEGER) AS n FROM d QUALIFY n <= 5""")
def document_candidates(t: Tables) -> DataFrame:
    """Candidate documents of pages by a word of the link's text, the first five."""
    return pages.document_links(pages.page_links(t.pages), ["en"], ["pdf"])


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS codigo, n_name AS nome, CASE WHEN n_regionkey <> 0 THEN CAST(n_regionkey AS VARCHAR) END AS regiao FROM nation""")
def report_scan(t: Tables) -> DataFrame:
    """A report written as delimited files and read back as text by position; spellings of missing values are null."""
    path = shared_path(t.spark, "report")
    sinks.write_report(t.nation.select("n_nationkey", "n_name", F.when(F.col("n_regionkey") == 0, "NULL").otherwise(F.col("n_regionkey").cast("string"))), path)
    return scan.text_scan(t.spark, path, ["codigo", "nome", "regiao"], encoding="UTF-8")


@query("""SELECT least(1000, count(*) FILTER (l_quantity > 10)) AS n, 0::BIGINT AS rejeitadas FROM lineitem""")
def sampled_load(t: Tables) -> DataFrame:
    """A sample of a load: as many rows as asked, none that a rule rejects."""
    kept = scan.scoped_load(t.lineitem, [("pouco", F.col("l_quantity") <= 10)], sample=1000)[0]
    return kept.agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") <= 10).alias("rejeitadas"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate END AS momento, CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 2 THEN 'x' ELSE o_orderkey::VARCHAR END AS texto FROM orders""")
def safe_values(t: Tables) -> DataFrame:
    """Timestamps that cannot be read, and blank texts, as null."""
    k = F.col("o_orderkey")
    stamp = F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).when(k % 4 == 1, "2001-13-45").when(k % 4 == 2, "")
    said = F.when(k % 4 == 3, "   ").when(k % 4 == 2, " x ").otherwise(k.cast("string"))
    return t.orders.select("o_orderkey", dates.safe_moment(stamp).alias("momento"), text.blank_to_null(said).alias("texto"))


@query("""
WITH d AS (SELECT o_orderkey, o_orderkey % 900000 AS k, 2000 + o_orderkey % 30 AS y FROM orders) SELECT o_orderkey, CASE WHEN k % 3 <> 0 THEN CAST(k AS INTEGER) END AS protocol, CASE WHEN k % 3 <> 0 THEN CAST(y AS INTEGER) END AS "year",
  CASE WHEN k % 2 = 0 THEN 'Caeté' END AS place, CASE WHEN k % 2 = 0 THEN 'MG' END AS state, make_date(y::INTEGER, 10, 4) AS dia FROM d""")
def named_protocols(t: Tables) -> DataFrame:
    """Protocols of file names whose year the text confirms, and the parts of titles."""
    k = F.col("o_orderkey") % 900000
    year = (2000 + F.col("o_orderkey") % 30).cast("string")
    name, said = F.concat(F.lit("doc "), k.cast("string"), F.lit("_"), year, F.lit(".pdf")), F.when(k % 3 == 0, "sem ano").otherwise(F.concat(F.lit("ano "), year))
    title = F.concat(F.when(k % 2 == 0, "Caeté/MG").otherwise("sem lugar"), F.lit(" - 04/10/"), year)
    d = t.orders.select("o_orderkey", pages.protocol_year(name, said).alias("p"), pages.title_parts(title).alias("t"))
    return d.select("o_orderkey", "p.protocol", "p.year", "t.place", "t.state", F.col("t.day").alias("dia"))


@query("""SELECT c_custkey, 'titular' || CASE WHEN c_custkey % 2 = 0 THEN '   , CPF  ' ELSE '  ' || c_name || ', CNPJ  ' END || ' fim' AS texto FROM customer""")
def bare_names(t: Tables) -> DataFrame:
    """Texts without their holder's name and tax numbers."""
    k = F.col("c_custkey")
    said = F.concat(F.lit("titular"), F.lit("  "), F.col("c_name"), F.when(k % 2 == 0, ", CPF 123.456.789-00").otherwise(", CNPJ 12.345.678/0001-90"), F.lit(" fim"))
    return t.customer.select("c_custkey", text.without_names(said, F.when(k % 2 == 0, F.col("c_name"))).alias("texto"))


@query("""
WITH e AS (SELECT l_orderkey, l_shipdate, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem),
g AS (SELECT l_orderkey AS k, string_agg('[' || n || '] ' || 'fase: ' || l_returnflag, chr(10) ORDER BY n) AS t FROM e GROUP BY 1)
SELECT o_orderkey, 'Pedido: ' || o_orderkey || chr(10) || CASE WHEN o_orderkey % 2 = 0 THEN 'Prioridade: ' || o_orderpriority || chr(10) ELSE '' END || t AS dossie FROM orders JOIN g ON k = o_orderkey""")
def dossier_texts(t: Tables) -> DataFrame:
    """Dossiers as labelled lines with numbered evidence."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*order, "l_returnflag"))).alias("l"))
    numbered = F.transform("l", lambda x, i: F.struct((i + 1).alias("n"), F.lit("fase").alias("campo"), x["l_returnflag"].alias("trecho")))
    d = t.orders.join(rows.select(F.col("l_orderkey").alias("o_orderkey"), numbered.alias("e")), "o_orderkey")
    head = [("Pedido", F.col("o_orderkey")), ("Prioridade", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise(" "))]
    return d.select("o_orderkey", calls.dossier_text(head, F.col("e")).alias("dossie"))


def _one_file(df: DataFrame, folder: str, name: str) -> None:
    """A table as one delimited file of a given name, as dumps have it."""
    spark = df.sparkSession
    made = f"{folder}-{name}"
    df.coalesce(1).write.csv(made, sep=";", header=True)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    part = next(s.getPath() for s in files.listStatus(path(made)) if s.getPath().getName().startswith("part-"))
    files.rename(part, path(f"{folder}/{name}"))


@query("""
SELECT * FROM (VALUES ('nation.txt', 3, 3, 'ok'), ('region.txt', 3, 2, 'erro_colunas'), ('customer.txt', 5, 5, 'aviso_nomes'), ('supplier.txt', NULL, 4, 'ausente')) v(arquivo, colunas, esperadas, situacao) WHERE (SELECT count(*) FROM nation) > 0""")
def header_checks(t: Tables) -> DataFrame:
    """Headers of dumped tables held against their contract."""
    folder = shared_path(t.spark, "dump")
    _one_file(t.nation, folder, "nation.txt")
    _one_file(t.region.withColumn("extra", F.lit(1)), folder, "region.txt")
    _one_file(t.customer.withColumnRenamed("c_name", "nome"), folder, "customer.txt")
    wanted = {"nation": t.nation.columns, "region": t.region.columns, "customer": [c.upper() for c in t.customer.columns], "supplier": t.supplier.columns}
    return scan.header_contract(t.spark, folder, {k: [c.lower() for c in v] for k, v in wanted.items()})


@query("""
WITH d AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_shipdate AS d, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS b FROM lineitem)
SELECT k AS l_orderkey, b AS block, p::VARCHAR AS numero, CAST(d AS DATE) AS data, CASE WHEN p % 3 <> 0 THEN 'Titular ' || s END AS requerente, 'Município ' || n AS "município" FROM d""")
def headed_bulletins(t: Tables) -> DataFrame:
    """Acts of bulletins with a header line and labelled lines."""
    line = F.concat(
        F.lit("Portaria nº "), F.col("l_partkey").cast("string"), F.lit(" de "), F.date_format("l_shipdate", "dd/MM/yyyy"), F.lit(" – Outorga\n"), F.when(F.col("l_partkey") % 3 != 0, F.concat(F.lit("Requerente: Titular "), F.col("l_suppkey").cast("string"), F.lit("\n"))).otherwise("Requerente:\n"),
        F.lit("Município: Município "), F.col("l_linenumber").cast("string"),
    )
    return notices.headed_acts(_bulletins(t, line, "Diário Oficial\n"), "l_orderkey", "texto", ["Requerente", "Município"])


@query("""
WITH d AS (SELECT l_orderkey AS k, l_partkey AS p, l_shipdate AS d, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS b FROM lineitem)
SELECT k AS l_orderkey, b AS block, CAST(d AS DATE) AS data, CAST(n AS INTEGER) AS n, 'Ato ' || n || ' da parte ' || p AS ato FROM d, range(2) r(n) WHERE n = 0 OR p % 2 = 0""")
def paragraph_bulletins(t: Tables) -> DataFrame:
    """Acts of bulletins with a title, a subtitle and a paragraph for each act."""
    part = F.col("l_partkey")
    act = lambda n: F.concat(F.lit(f"\nAto {n} da parte "), part.cast("string"))
    line = F.concat(F.lit("PUBLICAÇÃO DE ATOS - "), F.date_format("l_shipdate", "dd/MM/yyyy"), F.lit("\nSubtítulo"), act(0), F.when(part % 2 == 0, act(1)).otherwise(""))
    return notices.paragraph_acts(_bulletins(t, line, ""), "l_orderkey", "texto")


def _bulletins(t: Tables, line: Column, head: str) -> DataFrame:
    """A text per order: a block for each of its lines, in their order."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("x")))).alias("l"))
    return rows.select("l_orderkey", F.concat(F.lit(head), F.array_join(F.transform("l", lambda x: x["x"]), "\n")).alias("texto"))


@query(r"""
WITH d AS (SELECT doc_id, unnest(list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce(text, ''), 'The ', chr(1) || 'The ', 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')) AS ato FROM documents)
SELECT doc_id, count(*) AS atos, md5(string_agg(ato, '|' ORDER BY ato)) AS h FROM d GROUP BY 1""")
def marked_splits(t: Tables) -> DataFrame:
    """Texts cut before every marker (X26, generic)."""
    rows = t.documents.select("doc_id", notices.marked_acts(F.col("text"), "The ").alias("a")).filter(F.size("a") > 0)
    return rows.select("doc_id", F.size("a").cast("long").alias("atos"), F.md5(F.array_join(F.array_sort("a"), "|")).alias("h"))


@query("""
WITH d AS (SELECT c_custkey, c_custkey % 13 + 1 AS pergunta, ['confirmado', 'nao_localizado', 'talvez', 'precisa_revisao'][c_custkey % 4 + 1] AS resposta, CASE WHEN c_nationkey % 2 = 0 THEN 'nota' ELSE ' ' END AS observacao FROM customer)
SELECT c_custkey, resposta FROM d WHERE resposta = 'talvez' OR (resposta = 'nao_localizado' AND observacao = ' ')""")
def checklist_violations(t: Tables) -> DataFrame:
    """Checklist rows that break the rule of persistence."""
    c = F.col("c_custkey")
    answer = F.element_at(F.array(*[F.lit(x) for x in ("confirmado", "nao_localizado", "talvez", "precisa_revisao")]), (c % 4 + 1).cast("int"))
    d = t.customer.select("c_custkey", answer.alias("resposta"), F.when(F.col("c_nationkey") % 2 == 0, "nota").otherwise(" ").alias("observacao"))
    return checklist.violations_of(d).select("c_custkey", "resposta")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'republicacao_literal' WHEN o_orderkey % 7 = 0 THEN 'fora_de_escopo' WHEN o_orderkey % 5 = 0 THEN 'descartado_por_regra_deterministica' WHEN o_orderstatus = 'F' THEN 'continuidade_sem_mudanca_material' WHEN o_orderkey % 3 = 0 THEN 'enriquecimento_ja_concluido' END AS dispensa,
  CASE WHEN o_orderkey % 9 = 0 THEN 'PENDENTE_DE_SCORE' WHEN o_totalprice >= 100000 THEN 'NA_SELECAO' ELSE 'FORA_DA_SELECAO' END AS situacao FROM orders""")
def act_dismissals(t: Tables) -> DataFrame:
    """Dismissals of cases of acts (F20, F19), and the earlier score decision with its fixed cut."""
    k = F.col("o_orderkey")
    flags = calls.act_flags(k % 7 == 0, k % 5 == 0, k % 11 == 0, F.col("o_orderstatus") == "F", k % 3 == 0)
    return t.orders.select("o_orderkey", calls.first_dismissal(flags).alias("dispensa"), queue.fixed_cut_decision(F.when(k % 9 != 0, F.col("o_totalprice")), 100000).alias("situacao"))
