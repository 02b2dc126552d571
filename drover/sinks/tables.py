"""Catalog tables: create, insert with checks, and commit a next state."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from drover.operators.ordering import col
from drover.operators.quality import required_valid, settled_rows
from drover.schemas import TableSpec


class Inserted(NamedTuple):
    """Rows that the table did not take, and how many rows it did and did not take."""

    rejected: DataFrame
    n_inserted: int
    n_rejected: int


def create_table(
    spark: SparkSession, spec: TableSpec, name: str | None = None, location: str | None = None
) -> str:
    """Drop the table if it is there and make it anew, empty. Returns its name.

    Without `location` its data lies in a folder of its own in the warehouse.
    """
    name = name or spec.name
    location = location or _new_state(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({spec.ddl()}) USING parquet LOCATION '{location}'")
    return name


def insert(
    df: DataFrame, spec: TableSpec, name: str | None = None, mode: str = "fail"
) -> DataFrame | None:
    """Insert by column name after checking keys, nulls, lengths and ranges.

    `fail` writes nothing if any row is bad. `quarantine` writes the good rows
    and returns the others with their reasons.
    """
    rejected = insert_counted(df, spec, name, mode).rejected
    return rejected if mode == "quarantine" else None


def insert_counted(
    df: DataFrame, spec: TableSpec, name: str | None = None, mode: str = "fail"
) -> Inserted:
    """`insert`, with the counts that the tasks took while they wrote the checked rows."""
    spark = df.sparkSession
    name = name or spec.name
    target = spark.table(name)
    if mode == "fail":
        found = required_valid(df, spec, target)
    elif mode == "quarantine":
        found = settled_rows(df, spec, target)
    else:
        raise ValueError(f"unknown mode: {mode}")
    found.accepted.select(*[col(c) for c in target.columns]).write.insertInto(name)
    return Inserted(found.rejected, found.n_accepted, found.n_rejected)


def _states(spark: SparkSession, name: str) -> str:
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_states/{name}"


def _new_state(spark: SparkSession, name: str) -> str:
    return f"{_states(spark, name)}/{uuid.uuid4().hex}"


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def publish(spark: SparkSession, name: str, state: DataFrame, location: str | None = None) -> str:
    """Commit the next state of a table: write it aside, then point the table to it.

    Readers see the old rows or the new ones, never a mix; a failed write
    leaves the table as it was. States lie in the warehouse unless a location is
    given. Returns the new location; `remove_superseded` deletes earlier ones.
    Columns that the table lacks raise.
    """
    location = location or _new_state(spark, name)
    columns = spark.table(name).columns
    if set(state.columns) != set(columns):
        raise ValueError(f"{name} has columns {columns}, its next state {state.columns}")
    state.select(*[col(c) for c in columns]).write.parquet(location)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.sql(f"REFRESH TABLE {name}")
    return location


def remove_superseded(spark: SparkSession, name: str) -> int:
    """Delete the states that `publish` put into the warehouse and that are not the table's own.

    For when no job reads them any more. Returns how many there were.
    """
    return _remove_states(spark, name, _location(spark, name).rstrip("/").rpartition("/")[2])


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table and all its states in the warehouse."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _remove_states(spark, name)


def _remove_states(spark: SparkSession, name: str, but: str | None = None) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(_states(spark, name))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    old = [s.getPath() for s in system.listStatus(path) if s.getPath().getName() != but]
    for state in old:
        system.delete(state, True)
    return len(old)
