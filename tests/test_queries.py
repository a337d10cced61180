"""Registered queries against their SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from ledgerline.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SOME = ("enrich_fact", "scoped_load_counts", "asof_price", "consolidate_cases", "capped_score_bands", "selection_groups", "queue_rank", "transition_violations", "version_rotation", "field_audit", "stream_state", "page_links", "date_functions", "flagship", "recalculated_scores", "act_inputs", "antecedent_classes", "diagnostic_ids", "notice_fields", "module_names", "industry_codes", "id_migration", "case_assembly", "module_checklists", "analysis_audit")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else str(v.replace(tzinfo=None)) if hasattr(v, "tzinfo") else v


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    mine = Counter(str([plain(v) for v in r]) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    sql = ORACLES[name]
    theirs = Counter(str([plain(v) for v in r]) for r in con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({sql})").fetchall())
    assert mine == theirs


def test_names_are_unique_and_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 100
