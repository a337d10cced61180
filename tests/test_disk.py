"""What a run leaves on disk and what it shuffles."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import shared
from ledgerline.plans import case_tables, cases
from ledgerline.queries import QUERIES
from ledgerline.queries import case_tables as queries

SCHEMA = "caso_id string, processo string, descricao string, narrativa string, empresa string, municipio string, data_evento string, substancia string, area_ha string, n int"
FOLDER = "/root/testdata/sf0.001"


def acts(spark):
    rows = [(f"c{k % 9}", f"p{k % 4}", "OUTRO", None, "VALE S.A.", ("a", "b", None)[k % 3], "2026-05-05", "OURO", "", k) for k in range(90)]
    rows += [(None, None, "OUTRO", None, None, None, None, None, None, 1)] * 3 + [("d1", "p", "OUTRO", None, "X", None, None, None, None, 1), ("d2", None, "OUTRO", None, " ", None, None, None, None, 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def folder(tmp_path, monkeypatch):
    for module in (shared, queries):
        monkeypatch.setattr(module, "shared_path", lambda spark, name: f"file://{tmp_path}/ledgerline-{uuid.uuid4().hex}/{name}")
    return tmp_path


@pytest.mark.parametrize("most", [shared.PART, 7])
def test_a_table_by_key_is_grouped_without_a_shuffle(spark, folder, monkeypatch, most):
    monkeypatch.setattr(shared, "PART", most)
    d, names = acts(spark), {t.name for t in spark.catalog.listTables()}
    found = shared.laid(d, "acts", "caso_id")
    assert {t.name for t in spark.catalog.listTables()} == names
    assert sorted(map(str, found.collect())) == sorted(map(str, d.collect())) and found.dtypes == d.dtypes
    groups = found.groupBy("caso_id").agg(F.collect_set("processo").alias("p"), F.count("*").alias("n"))
    assert "Exchange" not in groups._jdf.queryExecution().executedPlan().toString()
    assert {r.caso_id: (len(r.p), r.n) for r in groups.collect()} == {**{f"c{k}": (4, 10) for k in range(9)}, None: (0, 3), "d1": (1, 1), "d2": (0, 1)}
    assert len(found.inputFiles()) > 1 if most == 7 else found.count() == 95


def test_acts_of_a_case_are_not_shuffled(spark, monkeypatch):
    plans, again = [], []
    monkeypatch.setattr(cases, "written", lambda df, name: plans.append(df) or shared.written(df, name))
    monkeypatch.setattr(case_tables, "written", lambda df, name: (again.append(df) if name == "again" else None) or shared.written(df, name))
    stored = case_tables.stored_tables(acts(spark), "caso_id", F.col("n"), {"score_m9a": 1.0}, F.create_map().cast("map<string,string>"))
    assert len(plans) == len(again) == 1
    assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() for df in (*plans, *again))
    # 4 processes with 3 places each; the acts of no case are one.
    assert {(r.caso_id, r.atos) for r in stored["cases"].collect()} == {*((f"c{k}", 10) for k in range(9)), (None, 3), ("d1", 1), ("d2", 1)}
    assert stored["acts"].count() == acts(spark).drop("n").distinct().count()
    assert {(r.item, r.criterio, r.value, r.class_id, r.links) for r in stored["edges"].collect()} == {(f"c{k}", "empresa", "VALE S.A.", "c0", 8) for k in range(9)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_a_run_leaves_its_commit_alone(spark, folder):
    clean = spark.conf.get(shared._CLEAN, None)
    found = QUERIES["case_evidence"](spark, FOLDER)
    assert [sorted(os.listdir(folder / d)) for d in os.listdir(folder)] == [["run"]] and spark.conf.get(shared._CLEAN, None) == clean
    assert found.count() == found.select("id").distinct().count() > 0


def test_what_passes_goes_on_failure_too(spark, folder):
    with pytest.raises(ValueError), shared.passing(spark) as gone:
        assert shared.written(spark.range(3), "one").count() == 3 and len(os.listdir(folder)) == 1
        gone()
        assert not os.listdir(folder)
        with shared.passing(spark):
            shared.written(spark.range(3), "two")
        assert not os.listdir(folder)
        shared.written(spark.range(3), "three")
        raise ValueError
    assert not os.listdir(folder)
    assert shared.written(spark.range(3), "kept").count() == 3 and len(os.listdir(folder)) == 1
