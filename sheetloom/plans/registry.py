"""All registered queries of the core, and the SQL that checks them."""

from __future__ import annotations

from sheetloom.plans import documents, facts, layout, metrics, search, sheets, training

MODULES = [training, facts, sheets, documents, layout, search, metrics]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
