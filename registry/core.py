"""Registration of a query together with its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from registry.bindings import SQL_VIEWS, Tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(tables)` under `name`; without `sql` only the rows are checked."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            _SQL[name] = sql
        return fn

    return register


def _views_used(sql: str) -> list[str]:
    """The views a statement names, views they depend on first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for view, body in SQL_VIEWS.items():
            if view not in found and re.search(rf"\b{view}\b", text):
                visit(body)
                if view not in found:
                    found.append(view)

    visit(sql)
    return found


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, sql in _SQL.items():
        views = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in _views_used(sql))
        statements[name] = f"WITH {views}\nSELECT * FROM ({sql}) AS result" if views else sql
    return statements
