"""Queries of the subpackage that have SQL give the same rows as DuckDB."""

import math

import duckdb
import pytest
from drover.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(SQL[name])
    columns = [d[0] for d in result.description]
    mine = QUERIES[name](spark, FOLDER)
    assert sorted(mine.columns) == sorted(columns)
    key = lambda row: [(v is None, str(v)) for v in row]
    expected = sorted(result.fetchall(), key=key)
    for a, b in zip(sorted(map(tuple, mine.select(columns).collect()), key=key), expected, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9))
