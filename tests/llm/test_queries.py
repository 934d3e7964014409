"""Queries of this subpackage that have SQL, against it."""

import duckdb
import pytest

from check import TABLES, rows
from panelcast.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    database = duckdb.connect()
    for table in TABLES:
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got, want = queries.QUERIES[name](spark, FOLDER), database.sql(queries.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    found = want.fetchall()
    assert found and rows(got.columns, map(tuple, got.collect())) == rows(want.columns, found)
