"""Queries that SQL can express, against DuckDB on the sf0.001 tables."""

from __future__ import annotations

import duckdb
import pytest

from revlens.llm.oracle import ORACLE
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want, df = con.sql(ORACLE[name]), QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    rows = sorted(tuple(str(r[c]) for c in order) for r in df.collect())
    assert rows == sorted(tuple(str(r[want.columns.index(c)]) for c in order) for r in want.fetchall())
