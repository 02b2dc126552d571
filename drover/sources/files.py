"""Readers for CSV files, object extracts, query results and document collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.functions.scalars import NULL_MARK, from_one_line, nan_to_null
from drover.operators.ordering import col
from drover.operators.reconcile import visible
from drover.operators.reshape import flatten

# CSV texts read as missing.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    strict: bool = True,
    file_column: str | None = None,
    multi_line: bool = True,
    one_line: bool = False,
) -> DataFrame:
    """CSV with a header from any file system Spark can reach.

    Quoted line breaks belong to their value. A file is then read by one task;
    turn `multi_line` off for files that have none, so that large ones are split.
    `one_line` is for files that `write_csv(.., one_line=True)` wrote: these are split
    as well, and all texts come back as they were, NULL, empty and missing-value texts too.

    With a schema its columns are picked by name and read as text, missing-value
    texts become NULL, and then the columns are cast: bad values raise, or
    become NULL if `strict` is off. Codes with leading zeros belong in the
    schema as string. Files whose headers differ from the first one's raise.
    Without a schema types are inferred, which costs another pass over the
    files. `file_column` adds the path of the row's file.
    """
    multi_line = multi_line and not one_line
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)

    if one_line:
        # Otherwise an empty text would be read as NULL.
        reader = reader.option("nullValue", NULL_MARK)

    def text(name: str) -> Column:
        if one_line:
            return from_one_line(col(name))
        return F.when(~col(name).isin(*MISSING_TEXTS), col(name))

    if schema is None:
        df = reader.option("inferSchema", not one_line).csv(paths)
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        values = [
            text(c).alias(c) if c in texts else col(c)
            for c in df.columns
        ]
    else:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        header = reader.option("multiLine", False).csv(paths).schema  # reads one line
        missing = [f.name for f in wanted.fields if f.name not in header.names]
        if missing:
            raise ValueError(f"no such columns in the file: {missing}")
        df = reader.option("multiLine", multi_line).option("enforceSchema", False).schema(header).csv(paths)
        values = []
        for f in wanted.fields:
            value = text(f.name)
            typed = value.cast(f.dataType) if strict else value.try_cast(f.dataType)
            values.append(typed.alias(f.name))
    if file_column:
        values.append(F.col("_metadata.file_path").alias(file_column))
    return df.select(*values)


def read_object(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | str | None = None,
    deleted_flag: str = "IsDeleted",
    include_deleted: bool = False,
) -> DataFrame:
    """Extract of one target object; soft-deleted rows are left out unless asked for."""
    reader = spark.read.format(format)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return visible(df, deleted_flag, include_deleted) if deleted_flag in df.columns else df


def flat_records(results: DataFrame, records: str = "records") -> DataFrame:
    """Rows of a query result whose `records` array holds nested objects."""
    rows = results.select(F.inline(col(records)))
    return nan_to_null(flatten(rows))


def read_query_result(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Result pages (JSON objects with a `records` array) as one flat frame.

    Each page file is one JSON object; a page is as large as the service makes
    it, and pages are read in parallel.
    """
    reader = spark.read.option("multiLine", True)
    return flat_records((reader.schema(schema) if schema is not None else reader).json(paths))


load_query = read_query_result


def read_documents(
    spark: SparkSession,
    path: str,
    field: str | None = None,
    value=None,
    format: str = "json",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A document collection, whole or filtered to `field == value` when both are given."""
    reader = spark.read.format(format)
    if format == "parquet":
        reader = reader.option("mergeSchema", True)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return find_documents(df, field, value)


def find_documents(df: DataFrame, field: str | None = None, value=None) -> DataFrame:
    if field is None or value is None:
        return df
    return df.filter(col(field) == F.lit(value))
