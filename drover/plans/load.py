"""Load prepared rows into source tables and copy source tables to staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from drover.functions.scalars import cast_columns, fill_blank
from drover.operators.reshape import discard
from drover.schemas import STAGING_TABLES, SOURCE_TABLES
from drover.sinks.tables import create_table, insert


def source_rows(df: DataFrame, drop: tuple[str, ...] = ("id",)) -> DataFrame:
    """Blank out missing text and drop the row id where there is one."""
    return discard(fill_blank(df), drop, strict=False)


def load_source(df: DataFrame, entity: str, table: str | None = None, mode: str = "fail"):
    """Insert prepared rows into the source table of `entity`."""
    return insert(source_rows(df), SOURCE_TABLES[entity], table, mode)


def staged_rows(df: DataFrame, entity: str) -> DataFrame:
    """Source rows in the staging table's types, blanks for missing text.

    Decimals stay decimal all the way.
    """
    spec = STAGING_TABLES[entity]
    types = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    return cast_columns(fill_blank(df.select(*spec.columns)), types)


def source_to_staging(
    spark: SparkSession, entity: str, source: str | None = None, staging: str | None = None,
    mode: str = "fail", recreate: bool = False,
):
    """Copy the whole source table of `entity` into its staging table."""
    spec = STAGING_TABLES[entity]
    name = staging or spec.name
    if recreate:
        create_table(spark, spec, name)
    rows = staged_rows(spark.table(source or SOURCE_TABLES[entity].name), entity)
    return insert(rows, spec, name, mode)
