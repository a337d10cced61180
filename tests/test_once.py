"""Texts and lists are read once a row, and what is heavy stays where it lies."""

from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.plans import gates, workflow


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sentences_are_folded_once_for_all_markers(spark):
    rows = [(1, "A  Licença\tvale. Não é\nsegura"), (2, " \n "), (3, None), (4, "\t"), (5, "licen\nca"), (6, "Licença talvez? licença não! Mina")]
    d = spark.createDataFrame(rows, "k int, t string")
    order = (("L", ("licenca vale",)), ("N", ("nao e",)), ("M", ("mina",)), ("X", ("licenca",)))
    status = d.select("k", text.text_status(F.col("t"), order, "VAZIO", "NADA").alias("s"), text.worst_state(F.col("t"), {"a": ("licenca",), "b": ("mina",), "c": ("ouro",)}, ("nao ",), ("talvez",)).alias("w"))
    assert plan_of(status.select("s")).count("lower(") == 1 and plan_of(status.select("w")).count("lower(") == 1
    got = {r.k: (r.s, r.w) for r in status.collect()}
    assert got == {1: ("L", {"a": "afirmado"}), 2: ("VAZIO", {}), 3: ("VAZIO", {}), 4: ("NADA", {}), 5: ("NADA", {}), 6: ("M", {"a": "incerto", "b": "afirmado"})}


def test_a_sentence_is_padded_once_for_all_terms(spark):
    d = spark.createDataFrame([(1, "Ouro-fino e ferro. Ferro"), (2, None)], "k int, t string")
    found = gates.gate_signals(d, "k", "t", {"G1": ("ouro", "ferro"), "G2": ("ouro fino", "ouro")}, ("nunca",), ("consta",), ("talvez",), "G2")
    assert sorted((r.position, r.gate, r.term) for r in found.collect()) == [(0, "G1", "ferro"), (0, "G1", "ouro"), (0, "G2", "ouro"), (0, "G2", "ouro fino"), (1, "G1", "ferro")]
    assert "Contains(concat( , regexp_replace" not in plan_of(found)


def test_lists_are_parsed_once_and_only_evidence_is_joined(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(workflow, "written", lambda df, name: plans.append(plan_of(df)) or df, raising=False)
    matrix = '[{"codigo":"a","estado":"confirmado","classe_impacto":"GRAVIDADE","evidencia_ids":["e1","e2","e2"]},{"estado":"outro","classe_impacto":"X"},null]'
    d = spark.createDataFrame([(1, 7, matrix), (2, 7, "x"), (3, 8, "[]"), (4, 8, None)], "id int, event_id int, matriz string")
    evidence = spark.createDataFrame([("e1", 7), ("e2", 8)], "id string, event_id int")
    got = {r.id: list(r.violations) for r in workflow.matrix_violations(d, evidence).collect()}
    assert got == {1: ["a:evidencia_de_outro_evento", "?:classe_impacto", "?:estado", "?:sem_codigo", "?:classe_impacto", "?:estado", "?:sem_codigo"], 2: ["matriz_invalida"], 3: [], 4: ["matriz_invalida"]}
    assert len(plans) == 1 and plans[0].count("from_json") == 1


def test_no_window_or_join_carries_a_matrix(spark):
    v = spark.createDataFrame([(1, 5, 1, 1, "aprovada", "{}")], "id int, event_id int, versao int, dossie_id int, status_validacao string, review string").withColumn("created_at", F.current_timestamp())
    gap = '[{"estado":"nao_localizado","classe_impacto":"GRAVIDADE"}]'
    d = spark.createDataFrame([(1, 5, 1, gap, "{}")], "id int, event_id int, versao int, matriz string, alertas string")
    checks = spark.createDataFrame([(5, "sem_mudanca")], "event_id int, resultado string").withColumn("criado_em", F.current_timestamp())
    found = workflow.publication_pending(v, d, checks, spark.createDataFrame([(5, "MONITORADO")], "event_id int, state string"))
    assert [r.blocks for r in found.collect()] == [["B1", "B2"]]
    plan = plan_of(found)
    assert plan.index("Window") < plan.index("from_json") and plan.count("from_json") >= 1
