"""Compare registered queries with their SQL, row by row, whatever the row order."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import SparkSession

from drover.registry import ALL

DATA = os.environ.get("DROVER_TESTDATA", "/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET threads TO 4")
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    shaped = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda row: [(v is None, str(v)) for v in row])


def compare(spark: SparkSession, name: str, folder: str, connection) -> int:
    """Rows compared; raises AssertionError on the first difference."""
    query = ALL[name]
    df = query.run(spark, folder)
    mine = _rows(df.columns, df.collect())
    result = connection.execute(query.sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns), (sorted(df.columns), sorted(columns))
    expected = _rows(columns, result.fetchall())
    assert len(mine) == len(expected), f"{len(mine)} rows, expected {len(expected)}"
    for a, b in zip(mine, expected):
        assert a == b, (a, b)
    return len(mine)
