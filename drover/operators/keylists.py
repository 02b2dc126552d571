"""Key columns as SQL IN-list text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.functions.scalars import sql_quote
from drover.operators.ordering import ROWS_PER_CHUNK, col, with_row_index
from drover.session import stage


def _distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column).alias("_value")).filter(F.col("_value").isNotNull()).distinct()


def _in_list(one_per_line: bool) -> Column:
    separator = ",\n" if one_per_line else ","
    ordered = F.array_sort(
        F.collect_list(F.struct(F.col("_value"), sql_quote(F.col("_value")).alias("text")))
    )
    return F.concat(F.lit("("), F.array_join(ordered["text"], separator), F.lit(")"))


def in_lists(
    df: DataFrame,
    column: str,
    per_list: int = 1_000,
    one_per_line: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Distinct values in order, quoted, `per_list` to a text: rows (part, in_list).

    NULL is left out, as it matches nothing in a list. Deletes and filters in
    this package join key frames instead; the text is for use elsewhere.
    """
    values = stage(_distinct_values(df, column), "key-list")
    numbered = with_row_index(values, "_value", "_at", rows_per_chunk=rows_per_chunk)
    part = F.floor(F.col("_at") / per_list).cast("bigint").alias("part")
    return numbered.groupBy(part).agg(_in_list(one_per_line).alias("in_list"))
