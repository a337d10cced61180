"""Versions admitted in pairs; rankings and queues of any size; case tables in one commit."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.segments import blocks
from ledgerline.plans import case_tables, cases, queue, workflow
from ledgerline.sources import publish

LOG = "event_id int, seq int, id int, tipo string, acao string, para string, dossie_id int, hash_dossie string, liberacao_id int, bloqueantes int, versao_id int"


def release(e, seq, dossier=1, digest="h1"):
    return (e, seq, seq, "transicao", "LIBERAR_PRE_RELEASE", "PRE_RELEASE_LIBERADO", dossier, digest, None, None, None)


def version(e, seq, on, dossier=1, blocking=0):
    return (e, seq, seq, "versao", None, None, dossier, None, on, blocking, None)


def made(e, seq, of):
    return (e, seq, seq, "transicao", "GERAR_PRE_RELEASE", "PRE_RELEASE_GERADO", None, None, None, None, of)


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_versions_and_their_transitions_are_admitted_in_pairs(spark, size):
    rows = [
        release(1, 1), version(1, 2, 1), made(1, 3, 2), release(1, 4), version(1, 5, 4, blocking=2), made(1, 6, 5),  # two good pairs
        version(2, 1, 7), made(2, 2, 1),  # before any release
        release(3, 1), version(3, 2, 1),  # no transition
        release(4, 1), made(4, 2, 9),  # no version
        release(5, 1, digest="h9"), version(5, 2, 1), made(5, 3, 2),  # the released hash is not the dossier's
        release(6, 1), version(6, 2, 1, dossier=2), made(6, 3, 2),  # another dossier than the released one
        release(7, 1), (7, 2, 2, "transicao", "DEVOLVER_ANALISE", "DEVOLVIDO_PARA_AJUSTE", None, None, None, None, None), version(7, 3, 1), made(7, 4, 3),  # no longer the last transition
        release(8, 1), version(8, 2, 1), version(8, 3, 1), made(8, 4, 2),  # something stands between
    ]
    dossiers = spark.createDataFrame([(1, e, "h1") for e in range(1, 9)], "id int, event_id int, hash string").withColumn("id", F.lit(1)).unionByName(spark.createDataFrame([(2, 6, "h1")], "id int, event_id int, hash string"))
    own = dossiers.withColumn("id", F.col("event_id") * 10 + F.col("id"))
    log = spark.createDataFrame(rows, LOG).withColumn("dossie_id", F.col("event_id") * 10 + F.col("dossie_id"))
    got = {(r.event_id, r.seq): (r.versao, r.status_validacao, list(r.violations), r.admitted) for r in workflow.paired_log(log, own, blocks(F.col("seq"), size)).collect()}
    assert len(got) == len(rows)
    assert got[1, 2] == (1, "aprovada", [], True) and got[1, 5] == (2, "reprovada", [], True) and got[1, 3][3] and got[1, 6][3]
    assert got[2, 1][2] == ["geracao_sem_liberacao_valida"] and got[2, 2][2] == ["versao_recusada"]
    assert got[3, 2][2] == ["versao_sem_transicao"] and got[4, 2][2] == ["transicao_sem_versao"]
    assert got[5, 2][2] == ["liberacao_hash_dossie_diverge"] and got[5, 3][2] == ["versao_recusada"]
    assert got[6, 2][2] == ["versao_exige_o_dossie_liberado"] and got[6, 3][2] == ["versao_recusada"]
    assert got[7, 3][2] == ["geracao_sem_liberacao_valida"] and got[7, 4][2] == ["versao_recusada"]
    assert got[8, 2][2] == ["versao_sem_transicao"] and got[8, 3][2] == ["versao_sem_transicao"] and got[8, 4][2] == ["transicao_sem_versao"]
    # Versions count only once they are admitted, and none is admitted without its transition.
    pairs = {k for k, v in got.items() if v[3] and (k[0], k[1]) in {(1, 2), (1, 5), (1, 3), (1, 6)}}
    assert len(pairs) == 4


def test_a_lot_of_a_million_items_freezes_in_chunks(spark):
    ranked = spark.range(1_000_000).select(F.lit("lot").alias("lot"), (F.col("id") + 1).alias("n"), F.col("id").alias("event"))
    chunks, lots = workflow.frozen_lots(ranked, "lot", "n", "event", 100, 10_000)
    (lot,) = lots.collect()
    assert (lot.n, lot.partes, lot.dentro_do_teto) == (1_000_000, 100, False)
    assert chunks.agg(F.max(F.size("itens"))).first()[0] == 10_000
    small, (one,) = workflow.frozen_lots(ranked.limit(3).repartition(2), "lot", "n", "event", 3, 2)[0], workflow.frozen_lots(ranked.filter("n <= 3"), "lot", "n", "event", 3, 2)[1].collect()
    parts = ['[{"n":1,"event":0},{"n":2,"event":1}]', '[{"n":3,"event":2}]']
    assert one.hash == hashlib.sha256("\n".join(hashlib.sha256(p.encode()).hexdigest() for p in parts).encode()).hexdigest() and one.dentro_do_teto
    assert small.count() >= 1


def test_queue_pages_keep_the_order_and_every_item(spark):
    ranked = spark.createDataFrame([("a", k, f"e{k}") for k in range(1, 8)] + [("b", 1, "x")], "empresa_id string, ordem int, id string").repartition(3)
    pages = sorted((r.empresa_id, r.parte, [i.id for i in r.itens]) for r in queue.queue_pages(ranked, ["id"], size=3).collect())
    assert pages == [("a", 0, ["e1", "e2", "e3"]), ("a", 1, ["e4", "e5", "e6"]), ("a", 2, ["e7"]), ("b", 0, ["x"])]


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "string"])
def test_queues_are_ranked_in_parts_of_a_day(spark, kind):
    base = spark.range(300).select(F.lit("t").alias("empresa_id"), "id", F.timestamp_millis(F.col("id") * 7_777_777 + 1_700_000_000_000).alias("m"))
    stamp = {"bigint": F.unix_millis("m"), "timestamp": F.col("m"), "string": F.col("m").cast("string")}[kind]
    items = base.select("empresa_id", "id", stamp.alias("material_ts"), F.lit(False).alias("atualizado"), F.lit(1).alias("rank_prioridade"), F.lit(1).alias("rank_criticidade"), F.lit(True).alias("inedito"), F.lit(True).alias("decisorio"), F.lit(5.0).alias("score_valor"), F.lit(1).alias("qualidade_evidencia"))
    got = {r.id: r.ordem for r in queue.ranked_queue(items).collect()}
    assert got == {i: 300 - i for i in range(300)}
    assert items.select(queue._day_of(items).alias("d")).distinct().count() <= 29


def acts(spark):
    rows = [
        ("c1", "p1", "CONC LAV/DECAIMENTO INSTAURADO PUBL", None, "VALE S.A.", "Nova Lima", "2026-05-05", "OURO", "12,5", 1), ("c1", "p2", "GUIA UTILIZACAO AUTORIZADA PUBL", "texto próprio", "VALE S.A.", "Itabira", "2026-06-05", "OURO", "", 2),
        ("c1", "p2", "GUIA UTILIZACAO AUTORIZADA PUBL", "texto próprio", "VALE S.A.", "Itabira", "2026-06-05", "OURO", "", 2), ("c2", None, "GUIA UTILIZACAO REQUERIMENTO PROTOC", "", None, None, None, None, None, 1), ("c3", "p9", "OUTRO", None, "VALE S.A.", None, "2026-01-01", None, None, 1),
    ]
    return spark.createDataFrame(rows, "caso_id string, processo string, descricao string, narrativa string, empresa string, municipio string, data_evento string, substancia string, area_ha string, n int")


def test_case_tables_are_read_from_one_commit(spark, tmp_path):
    tables = case_tables.case_tables(acts(spark), "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map(F.lit("empresa"), F.lit("Vale S.A.")))
    root = str(tmp_path / "run")
    assert case_tables.publish_cases(tables, "caso_id", root, 3) and not case_tables.publish_cases(tables, "caso_id", root, 3)
    read = {n: spark.read.parquet(f"{root}/batch=3/{n}").collect() for n in case_tables.TABLES}
    cases = {r.caso_id: r for r in read["cases"]}
    assert cases["c1"].processo == "p1; p2" and cases["c1"].municipio == "Itabira; Nova Lima" and cases["c1"].atos == 3 and cases["c1"].selecionavel and cases["c1"].antecedentes == 1
    assert cases["c2"].motivo_fila.startswith("criterio_da_carteira_nao_atendido") and cases["c3"].motivo_fila == "abaixo_das_bandas_A_B_da_carteira"
    assert {(r.caso_id, r.marco) for r in read["timeline"]} == {("c1", "decisao"), ("c1", "publicacao"), ("c2", "documento"), ("c3", "documento")}
    evidence = {r.id: r for r in read["evidence"]}
    assert len(evidence) == len(read["evidence"]) and all(r.evidencia_id in evidence for r in read["timeline"])
    assert {evidence[r.evidencia_id].trecho for r in read["timeline"] if r.caso_id == "c1"} == {"CONC LAV/DECAIMENTO INSTAURADO PUBL", "texto próprio"}
    assert len(read["checklist"]) == 36 and all(r.evidencia_id in evidence for r in read["checklist"] if r.resposta == "confirmado")
    assert sorted((r.item, r.class_id, r.links) for r in read["edges"]) == [("c1", "c1", 1), ("c3", "c1", 1)]


def test_a_run_that_breaks_a_rule_publishes_no_table(spark, tmp_path):
    tables = case_tables.case_tables(acts(spark), "caso_id", F.col("n"), {"outro": 1.0}, F.create_map().cast("map<string,string>"))
    bad = {**tables, "timeline": tables["timeline"].withColumn("marco", F.lit("outro"))}
    with pytest.raises(publish.PostConditionFailed):
        case_tables.publish_cases(bad, "caso_id", str(tmp_path / "run"), 1)
    assert not (tmp_path / "run" / "batch=1").exists()
    assert all(r.motivo_fila == "score_ponderado_pendente:outro" and r.prioridade is None for r in tables["cases"].collect())


def test_no_acts_give_empty_tables(spark):
    tables = case_tables.case_tables(acts(spark).limit(0), "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"))
    assert all(df.count() == 0 for df in tables.values())


def test_cases_are_scored_without_sorting_each_act_for_each_distinct_count(spark, monkeypatch):
    rows = [("c1", f"p{k % 4}", "OUTRO", None, "VALE S.A.", ("a", "b", None)[k % 3], "2026-05-05", "OURO", "", k) for k in range(24)] + [(None, None, "OUTRO", None, None, None, None, None, None, 1)]
    d = spark.createDataFrame(rows, acts(spark).schema)
    plans = []
    monkeypatch.setattr(cases, "written", lambda df, name: plans.append(df) or df, raising=False)
    got = cases.assembled(d, "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"))
    assert "Expand" not in "".join(df._jdf.queryExecution().optimizedPlan().toString() for df in [*plans, got])
    assert {(r.caso_id, r.atos, r.processos, r.municipios, r.primeiro.processo) for r in got.collect()} == {("c1", 24, 4, 2, "p0"), (None, 1, 0, 0, None)}


def test_case_tables_shuffle_no_answers_and_only_repeated_acts(spark):
    silent = [("c4", "p1", "", None, "X", "Nova Lima", "2026-05-05", None, "", 1)] * 2 + [(None, None, "", "", None, None, None, None, None, k) for k in (1, 2)]
    d = acts(spark).unionByName(spark.createDataFrame(silent, acts(spark).schema))
    tables = case_tables.case_tables(d, "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"))
    plan = lambda name: tables[name]._jdf.queryExecution().optimizedPlan().toString()
    assert plan("checklist").count("Join") == 1 and "LeftAnti" in plan("timeline") and "LeftAnti" in plan("evidence")
    timeline = {(r.caso_id, r.trecho): r.evidencia_id for r in tables["timeline"].collect()}
    assert tables["timeline"].count() == 6 and sorted(len(rows) for rows in [tables["cases"].collect(), tables["checklist"].collect()]) == [5, 60]
    standard = {r.caso_id: r.evidencia_padrao for r in tables["cases"].collect()}
    assert timeline["c4", ""] == standard["c4"] is not None and timeline[None, ""] is None and standard[None] is None
    assert {r.resposta for r in tables["checklist"].collect() if r.caso_id is None and r.pergunta == 1} == {"precisa_revisao"}


def with_silent_acts(spark):
    silent = [("c4", "p1", "", None, "X", "Nova Lima", "2026-05-05", None, "", 1)] * 2 + [(None, None, "", "", None, None, None, None, None, k) for k in (1, 2)]
    return acts(spark).unionByName(spark.createDataFrame(silent, acts(spark).schema))


def test_a_commit_holds_no_ids_and_gives_the_five_tables(spark, tmp_path):
    given = (with_silent_acts(spark), "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map(F.lit("empresa"), F.lit("Vale S.A.")))
    stored, root = case_tables.stored_tables(*given), str(tmp_path / "run")
    assert case_tables.publish_stored(stored, "caso_id", root, 3) and not case_tables.publish_stored(stored, "caso_id", root, 3)
    got, wanted = case_tables.committed(spark, {n: df.schema for n, df in stored.items()}, "caso_id", root, 3), case_tables.case_tables(*given)
    assert set(got) == set(case_tables.TABLES)
    for name, df in wanted.items():
        assert got[name].dtypes == df.dtypes and sorted(map(str, got[name].collect())) == sorted(map(str, df.collect())), name
    # Only acts that say nothing themselves hold a hash, their case's.
    held = [str(r) for n in stored for r in spark.read.parquet(f"{root}/batch=3/{n}").drop("padrao").collect()]
    assert not any(r.id in row or r.ato in row for r in got["evidence"].collect() for row in held)
    assert [bool(r.padrao) for r in spark.read.parquet(f"{root}/batch=3/acts").collect()].count(True) == 1


@pytest.mark.parametrize(
    ("name", "change"),
    [("acts", lambda df: df.unionByName(df)), ("acts", lambda df: df.withColumn("marco", F.lit("outro"))), ("cases", lambda df: df.unionByName(df)), ("cases", lambda df: df.withColumn("respostas", F.transform("respostas", lambda _: F.lit("talvez"))))],
)
def test_a_commit_that_breaks_a_rule_is_refused(spark, tmp_path, name, change):
    stored = case_tables.stored_tables(acts(spark), "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"))
    with pytest.raises(publish.PostConditionFailed):
        case_tables.publish_stored({**stored, name: change(stored[name])}, "caso_id", str(tmp_path / "run"), 1)
    assert not (tmp_path / "run" / "batch=1").exists()


def test_cases_with_their_lists_are_shuffled_once(spark, monkeypatch):
    rows = [("c1", f"p{k % 4}", "OUTRO", None, "VALE S.A.", ("a", "b", None)[k % 3], "2026-05-05", "OURO", "", k) for k in range(24)] + [(None, None, "OUTRO", None, None, None, None, None, None, 1)]
    d = spark.createDataFrame(rows, acts(spark).schema)
    plans = []
    monkeypatch.setattr(cases, "written", lambda df, name: plans.append(df) or df)
    got = cases.prescored(d, "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"), lists=True)
    assert plans[0]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r.caso_id, r.atos, r.processos, r.municipios, r.primeiro.processo, tuple(sorted(r["__processos"])), tuple(sorted(r["__municipios"]))) for r in got.collect()} == {
        ("c1", 24, 4, 2, "p0", ("p0", "p1", "p2", "p3"), ("a", "b")), (None, 1, 0, 0, None, (), ())
    }


@pytest.mark.parametrize(("most", "kind"), [(case_tables.SMALL, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_cases_stay_in_place_where_companies_are_few(spark, monkeypatch, most, kind):
    monkeypatch.setattr(case_tables, "SMALL", most)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = case_tables.stored_tables(acts(spark), "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"))["cases"]
        assert kind in found._jdf.queryExecution().executedPlan().toString()
        assert {(r.caso_id, r.antecedentes) for r in found.collect()} == {("c1", 1), ("c2", 0), ("c3", 1)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
