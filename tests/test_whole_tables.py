"""Registered queries that must take whole tables, not a part of them."""

import duckdb
import pytest

from ledgerline.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name,table", [("call_hash_reuse_all", "events"), ("ranking_freeze_all", "orders")])
def test_whole_table_equals_sql(spark, name, table):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    mine = [tuple(r) for r in df.collect()]
    theirs = con.sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(mine, key=str) == sorted(theirs, key=str)
    rows = con.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    assert (len(mine) if table == "events" else sum(r.n for r in df.collect())) == rows


def test_response_audit_reads_whole_answers(spark, tmp_path):
    long = "plain words " * 30
    rows = [(1, 0, "user", "Tell me of 2024 please, in words"), (1, 1, "assistant", f"{long} [9] and 777 score"), (1, 2, "user", "go on"), (1, 3, "assistant", f"{long} of nothing")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.turn: r.errors.split(",") for r in QUERIES["response_audit"](spark, str(tmp_path)).collect()}
    assert set(got) == {1, 3}
    assert {"citacao_fora_do_dossie", "numero_sem_fonte", "termo_vedado:score"} <= set(got[1]) and not {"citacao_fora_do_dossie", "numero_sem_fonte"} & set(got[3])


def test_cases_are_added_up_without_their_members(spark):
    plan = QUERIES["consolidate_cases"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
