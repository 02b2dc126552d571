"""JDBC reads and writes. Settings are plain options; the driver jar comes with the cluster."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# URL layouts and driver classes of the four databases.
DIALECTS = {
    "mysql": ("jdbc:mysql://{host}/{database}", "com.mysql.cj.jdbc.Driver"),
    "mssql": (
        "jdbc:sqlserver://{host};databaseName={database}",
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    ),
    "postgres": ("jdbc:postgresql://{host}/{database}", "org.postgresql.Driver"),
    "snowflake": (
        "jdbc:snowflake://{host}/?db={database}",
        "net.snowflake.client.jdbc.SnowflakeDriver",
    ),
}
BATCH_ROWS = 1_000


class Split(NamedTuple):
    """Read a table in `parts` ranges of a number, date or timestamp column."""

    column: str
    lower: object
    upper: object
    parts: int


def connection(dialect: str, host: str, database: str, **options: str) -> dict[str, str]:
    """Options of one database; pass user and password from the environment or a secret store."""
    url, driver = DIALECTS[dialect]
    return {"url": url.format(host=host, database=database), "driver": driver, **options}


def read_options(
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of one read; a split read of a query goes in as a derived table."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = {"fetchsize": str(fetch_rows)}
    if split is None:
        return {**options, **({"dbtable": table} if table else {"query": query})}
    return {
        **options,
        "dbtable": table or f"({query}) split_source",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def read_database(
    spark: SparkSession,
    target: dict[str, str],
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
) -> DataFrame:
    """A table or query result, with its schema even if it has no rows.

    Without a `split` all rows come through one connection, so give one for
    any table that grows. Filters and columns are pushed to the database.
    """
    options = {**target, **read_options(table, query, split)}
    return spark.read.format("jdbc").options(**options).load()


def write_options(table: str, connections: int, batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    return {
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }


def append_to_database(
    df: DataFrame, target: dict[str, str], table: str, connections: int = 8
) -> None:
    """Append rows through at most `connections` connections.

    Each connection commits its own share. Write to an empty staging table and
    move the rows from there where the insert must be all or nothing.
    """
    options = {**target, **write_options(table, connections)}
    df.write.format("jdbc").options(**options).mode("append").save()
