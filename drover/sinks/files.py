"""Writers for CSV files, document collections, named outputs and key lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.functions.scalars import to_one_line
from drover.operators.keylists import in_lists
from drover.operators.ordering import col

MANIFEST = "_manifest"


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", one_line: bool = False
) -> None:
    """CSV with a header; `path` is a folder on any file system Spark can reach.

    Outer blanks, quotes and line breaks are kept; `read_csv` reads them back.
    With `one_line` every record is one line of the file, line breaks being escaped
    and NULL marked; read such files with `read_csv(.., one_line=True)`,
    which splits large ones among tasks and gives back every text as it was.
    """
    if one_line:
        df = df.select(*[to_one_line(col(c).cast("string")).alias(c) for c in df.columns])
    writer = df.write.mode(mode).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path, header=True)


def insert_documents(df: DataFrame, path: str, format: str = "json") -> None:
    """Append rows to a document collection; collections are made on first use."""
    df.write.mode("append").format(format).save(path)


def write_named_outputs(outputs: Mapping[str, DataFrame], path: str, format: str = "csv") -> None:
    """One folder per name below `path`, and a manifest that keeps their order."""
    spark = next(iter(outputs.values())).sparkSession
    for name, df in outputs.items():
        if format == "csv":
            write_csv(df, f"{path}/{name}")
        else:
            df.write.format(format).save(f"{path}/{name}")
    manifest = spark.createDataFrame(list(enumerate(outputs)), "position int, name string")
    manifest.coalesce(1).write.json(f"{path}/{MANIFEST}")


def write_key_list(
    df: DataFrame, column: str, path: str, per_list: int = 1_000, one_per_line: bool = False
) -> None:
    """IN-list texts of a column as text files, one list after the other."""
    lists = in_lists(df, column, per_list, one_per_line)
    lists.select(F.col("in_list")).write.text(path)
