"""Registered queries: each applies an operator to the given tables, with its DuckDB SQL where SQL can say it."""

from __future__ import annotations

from ledgerline.queries import aggregates, case_tables, cases, decisions, dossiers, flow, notice_cases, records, scope, spans, streams, tables, texts, windows
from ledgerline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregates", "case_tables", "cases", "decisions", "dossiers", "flow", "notice_cases", "records", "scope", "spans", "streams", "tables", "texts", "windows"]
