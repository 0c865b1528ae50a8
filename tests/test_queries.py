"""Every registered query at the smallest scale, next to its SQL where it has one."""

from __future__ import annotations

import duckdb
import pytest

import registry
from check import TABLES, rows_of

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_sql_names_are_queries():
    assert set(SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = registry.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    if name not in SQL:
        assert rows
        return
    got_columns, got = rows_of(df.columns, rows)
    cursor = duck.execute(SQL[name])
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got_columns == want_columns
    assert got == want
