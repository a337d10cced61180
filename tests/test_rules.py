"""Boundary, null and tie rows of the rule operators."""

from pyspark.sql import functions as F

from ledgerline.functions import dates, keys, numbers, text
from ledgerline.operators import joins, latest, scope
from ledgerline.operators.rules import cascade
from ledgerline.plans import calls, criticality, notices, recalculation, scores
from ledgerline.plans import vocabulary as V
from ledgerline.sources import scan

REF = "2026-10-14"
ACT = "tipo_scm string, tipo_texto string, data_ato string, titular string, substancia string, area_ha string, n_municipios int, tem_evidencia boolean"


def acts(spark, *rows):
    base = dict(tipo_scm=None, tipo_texto=None, data_ato="2026-08-01", titular="EMPRESA X", substancia="GRANITO", area_ha="100", n_municipios=1, tem_evidencia=True)
    names = [f.split()[0] for f in ACT.split(", ")]
    df = spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], ACT)
    return criticality.classified_acts(df, F.lit(REF).cast("date")).collect()


def test_act_levels(spark):
    got = acts(
        spark,
        dict(tipo_scm="AUT PESQ/TRANSF DIREITOS-CESSÃO TOTAL PROTOC", titular="Kinross", substancia="ouro", area_ha="2000"),
        dict(tipo_scm="AUT PESQ/TRANSF DIREITOS-CESSÃO TOTAL APROVADA PUBL", titular="Kinross", substancia="ouro", area_ha="1096"),
        dict(tipo_scm="AUT PESQ/TAH - PAGAMENTO EFETUADO", titular="VALE", substancia="ferro", area_ha="5000", n_municipios=3),
        dict(tipo_scm="CONC LAV/DECAIMENTO CONCESSÃO LAVRA INSTAURADO PUBL", data_ato="2026-05-05"),
        dict(tipo_scm="AUT PESQ/DECAIMENTO ALVARÁ PESQUISA PUBL", data_ato="2026-05-05"),
        dict(tipo_scm="CONC LAV/DECAIMENTO INSTAURADO PUBL", tem_evidencia=False),
        dict(),
    )
    assert [(r.nivel, r.prioridade) for r in got] == [("BAIXA", "D"), ("ALTA", "B"), ("ROTINA", "D"), ("CRITICO", "A"), ("ALTA", "B"), ("POTENCIAL_CRITICO_PENDENTE_EVIDENCIA", None), ("NAO_AVALIAVEL", None)]
    assert got[0].fase == "pedido" and got[1].fase == "efetiva" and got[2].motivos == ["rotina_anula_gatilhos"] and got[3].selecionavel and not got[5].selecionavel


def test_age_edges(spark):
    df = spark.createDataFrame([("CRITICO", a) for a in (180, 181, 365, 366, 1095, 1096, None)], "l string, a int")
    level, why = cascade(F.col("l"), F.col("a"), V.ACT_AGE_LIMITS, V.LEVELS, "BAIXA", "BAIXA")
    got = df.select(level.alias("l"), F.size(why).alias("n")).collect()
    assert [r.l for r in got] == ["CRITICO", "ALTA", "ALTA", "MEDIA", "MEDIA", "BAIXA", "BAIXA"] and [r.n for r in got] == [0, 1, 1, 2, 2, 3, 1]


def test_link_score_may_be_negative(spark):
    names = scores.LINK_FLAGS
    rows = [{"municipio_minerador"}, {"material_mineral", "municipio_minerador"}, {"produto_causa_nao_mineraria"}, {"cadeia_mineral_industrial_nao_confirmada"}]
    df = spark.createDataFrame([tuple(n in r for n in names) for r in rows], ", ".join(f"{n} boolean" for n in names))
    s, band, _ = scores.link_score({n: F.col(n) for n in names})
    assert [tuple(r) for r in df.select(s, band).collect()] == [(0.0, "descartado"), (6.0, "provavel"), (-4.0, "descartado"), (5.0, "provavel")]


def test_permit_score_golden_and_errors(spark):
    parts = dict(zip(V.PERMIT_MAXIMA, (8, 3, 6, 12, 9, 10, 4, 5)))
    lit = {k: F.lit(v) for k, v in parts.items()}
    no = F.lit(False)
    d = spark.range(1).select(scores.permit_score(lit, no, no, F.lit(0.0), no).alias("a"), scores.permit_score(lit | {"dimensao_hidrica_fisica": F.lit(21)}, no, no, F.lit(0.0), no).alias("b")).first()
    assert (d.a.score, d.a.faixa) == (57.0, "C") and d.b.score is None and d.b.erros == ["fora_dos_limites:dimensao_hidrica_fisica"]


def test_text_matching(spark):
    df = spark.createDataFrame([("Sem vítima no local; houve vítima depois e nada mais a dizer.",), ("não houve vítima",), (None,)], "t string")
    got = df.select(text.has_unnegated(F.col("t"), ["vítima"]).alias("v"), text.normalise(F.col("t")).alias("n")).collect()
    assert [r.v for r in got] == [True, False, False] and got[2].n == "" and got[1].n == "nao houve vitima"
    one = spark.createDataFrame([("particular de art recolhida",)], "t string").select(text.has_phrase(F.col("t"), ["recolh*"]).alias("a"), text.has_phrase(F.col("t"), ["arte"]).alias("b"), text.has_substring(F.col("t"), ["ticul"]).alias("c")).first()
    assert tuple(one) == (True, False, True)


def test_keys(spark):
    row = spark.range(1).select(keys.instrument_of(F.lit("Guia n° 61/2023 emitida")).alias("a"), keys.instrument_of(F.lit("GU - 405/2026")).alias("b"), keys.family_of(F.lit("INTIMAÇÃO PARA DEFESA")).alias("c")).first()
    assert row.a == "61/2023" and row.b is None and "decaimento" in row.c


def test_dates_and_numbers(spark):
    df = spark.createDataFrame([("2026-05-05",), ("05/05/2026",), ("2026-13-01",), ("",), (None,)], "d string")
    assert [str(r[0]) for r in df.select(dates.to_day(F.col("d"))).collect()] == ["2026-05-05", "2026-05-05", "None", "None", "None"]
    n = spark.createDataFrame([("1.852,42",), ("12,5",), ("1096.57",), ("x",)], "a string").select(numbers.number_pt(F.col("a")), numbers.dump_area(F.col("a"))).collect()
    assert [tuple(r) for r in n] == [(1852.42, 0.0), (12.5, 12.5), (1096.57, 1096.57), (None, 0.0)]


def test_null_start_wins_and_ties(spark):
    links = spark.createDataFrame([("p", "a", "2020-01-01", " "), ("p", "b", None, ""), ("q", "b", "2020-01-01", None), ("q", "a", "2020-01-01", None), ("r", "a", "2021", "2022")], "p string, id string, s string, e string")
    assert sorted((r.p, r.id) for r in latest.currently_valid(links, "p", "s", "e", "id").collect()) == [("p", "b"), ("q", "a")]


def test_as_of_takes_the_version_in_force(spark):
    facts = spark.createDataFrame([(1, "m", 5), (2, "m", 10), (3, "m", 1), (4, "x", 9)], "id int, k string, at int")
    versions = spark.createDataFrame([("m", 5, 1.0), ("m", 7, 2.0)], "k string, since int, price double")
    assert {r.id: r.price for r in joins.as_of(facts, versions, "k", "at", "since", ["price"], ["id"]).collect()} == {1: 1.0, 2: 2.0, 3: None, 4: None}


def test_reject_reasons_exclude_each_other(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a int")
    row = scope.reject_counters(df, [("one", F.col("a") == 1), ("small", F.col("a") < 3)]).first()
    assert (row.read, row.one, row.small, row.kept) == (4, 1, 1, 2)


def test_dismissal_order(spark):
    df = spark.createDataFrame([(True, True), (False, True), (None, None)], "a boolean, b boolean")
    assert [r[0] for r in df.select(calls.first_dismissal({"fora_de_escopo": F.col("b"), "registro_identico": F.col("a")})).collect()] == ["registro_identico", "fora_de_escopo", None]


def test_selection_does_not_depend_on_row_order(spark):
    rows = [(i, V.LEVELS[i % 5], "ABCD"[i % 4], float(i % 3), i % 7, i % 2, f"e{i:02d}") for i in range(40)]
    cols = "n int, nivel string, prioridade string, pontuacao double, idade_dias int, qualidade_evidencia int, id_evento string"
    pick = lambda r: sorted((x.id_evento, x.posicao, x.resultado) for x in criticality.selected(spark.createDataFrame(r, cols).withColumn("nivel_potencial", F.lit(None).cast("string")), F.col("nivel").isin(*V.SELECTION_FLOOR), criticality.selection_order(), 5).collect())
    a = pick(rows)
    assert a == pick(rows[::-1]) and sum(x[2] == "escolhido" for x in a) == 5


def test_two_provisional_ids_of_one_real_id_conflict(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id bigint, n string")
    m = spark.createDataFrame([(1, 9), (2, 9), (3, 4), (3, 8)], "o bigint, n bigint")
    got = {r.n: (r.id, r.outcome) for r in latest.migrated_ids(rows, m, "id", "o", "n").collect()}
    assert got == {"a": (9, "migrado"), "b": (2, "conflito"), "c": (3, "conflito"), "d": (4, "mantido")}


def test_header_contract_reads_first_lines(spark, tmp_path):
    for name, lines in {"Evento.txt": ["IDEvento;DSEvento", "1;a;b;c"], "Municipio.txt": ["IDMunicipio;NMMunicipio", "1;x"], "ProcessoMunicipio.txt": ["dsprocesso;IDMUN", "1;2"], "other.txt": ["x"]}.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="latin-1")
    got = {r.arquivo: r.situacao for r in scan.header_contract(spark, str(tmp_path)).collect()}
    assert (got["Evento.txt"], got["Municipio.txt"], got["ProcessoMunicipio.txt"], got["Pessoa.txt"]) == ("ok", "erro_colunas", "aviso_nomes", "ausente") and "other.txt" not in got


def test_hits_are_places_of_non_overlapping_terms(spark):
    for t, want in (("abcabc", [1, 4]), ("xabc", [2]), ("", []), ("aba", []), ("abc" * 40, list(range(1, 121, 3)))):
        got = spark.range(1).select(text.hits(F.lit(t), "abc").alias("h")).first().h
        assert got == want


def test_notice_labels_in_their_layouts(spark):
    one = "N° Protocolo: 12/2026\nLOCAL; BR-040, km 3,5\nFONTE(S) DE INFORMAÇÕES: Z\nBREVE DESCRIÇÃO DA OCORRÊNCIA: caiu; o produto: óleo\nPRODUTO: n/a\nNúcleo de Prevenção e Emergência Ambiental\nRua"
    df = spark.createDataFrame([(1, one), (2, None), (3, "nothing")], "id bigint, text string")
    got = {r.id: r for r in notices.notice_details(df, "id", "text").collect()}
    r = got[1]
    assert (r.protocolo, r.local, r.fontes, r.descricao, r.produto, r.rodovia, r.km, r.municipio) == ("12/2026", "BR-040, km 3,5", "Z", "caiu; o produto: óleo", None, "BR-040", "3.5", None)
    assert got[2].protocolo is None and got[3].local is None


def test_notice_inputs_from_stored_rows(spark):
    rows = [("processado", "confirmado", None, "Acidente 01/02/2026", '{"rejeito_ou_produto_perigoso_ou_volume_significativo": {"x": 1}}', 0), ("falha_extracao", "provavel", "2026-01-01", "", "not json", 3), (None, None, None, None, None, 2)]
    df = spark.createDataFrame(rows, "status_processamento string, faixa_vinculo string, data_hora_ocorrencia string, titulo_fato string, gatilhos_aplicados string, nev int")
    for c in recalculation.FACTS:
        df = df.withColumn(c, F.lit(c == "vitimas"))
    got = recalculation.notice_inputs(df).collect()
    assert [(r.data_ocorrencia, r.tem_evidencia, sorted(k for k, v in r.sinais_textuais.items() if v)) for r in got] == [("01/02/2026", True, ["rejeito"]), ("2026-01-01", False, []), (None, True, [])]
    assert got[0].confirmados["vitimas"] and not got[0].confirmados["risco_estrutura"]
