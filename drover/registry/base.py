"""How queries are registered and how they reach the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Table files of one folder as attributes: `tables.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


def registrar(queries: dict[str, Query]):
    """Decorator factory: `@query(sql)` registers a function under its own name."""

    def query(sql: str | None = None):
        def add(build: Callable[[Tables], DataFrame]):
            queries[build.__name__] = Query(build, sql)
            return build

        return add

    return query
