"""Row numbers, ranks and running sums without a single-task window.

Every function deals its input to ranges of the full sort key, sorts inside the
ranges and stores the result once (`chunks`). The number of ranges
follows the number of rows, without an upper limit, and a group with a third of
all rows is spread over a third of the ranges.

`order_by` names ascending columns, NULL first. Rows with equal values go by a
hash of the whole row; equal rows keep an arbitrary order among themselves, but one
order for good, and all copies of a row fall into one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.operators.chunks import (
    ROWS_PER_CHUNK,
    Ordered,
    all_of,
    col,
    fresh,
    in_order,
    names,
)
from drover.operators.scans import number_rows, sum_rows

__all__ = [
    "ROWS_PER_CHUNK", "Ordered", "all_of", "col", "fresh", "in_order", "names",
    "rank_in_group", "rows_between", "running_sums", "with_row_index",
]

#: Ranges whose rows are counted to find out which of them a slice touches.
SLICE_RANGES = 1_000


def _positions(ordered: Ordered, start: int = 0) -> tuple[DataFrame, Column]:
    """The rows beside what their chunk has before it, and the column of positions."""
    before = fresh(ordered.rows.columns, "_before")
    joined = ordered.with_carry(ordered.before(**{before: F.lit(1).cast("long")}))
    return joined, col(ordered.place) + F.coalesce(col(before), F.lit(0)) + F.lit(start)


def with_row_index(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str = "row_index",
    start: int = 0,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add the row's position in `order_by`, counted from `start`."""
    ordered = in_order(df, order_by, rows_per_chunk)
    joined, position = _positions(ordered, start)
    return joined.select(*ordered.kept(), position.alias(name))


def rows_between(
    df: DataFrame,
    order_by: str | Sequence[str],
    start: int,
    stop: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Rows at positions [start, stop) in `order_by`.

    The keys alone are dealt to ranges and counted; only rows of the ranges that the
    slice touches are sorted and stored. `df` is read for each of these steps.
    """
    order = names(order_by)
    total = df.count()
    start, stop = max(start, 0), min(stop, total)
    if start >= stop:
        return df.limit(0)
    ranges = min(SLICE_RANGES, max(1, -(-total // rows_per_chunk)))
    if ranges > 1:
        df, start, stop = _touched(df, order, start, stop, ranges)
    ordered = in_order(df, order, rows_per_chunk)
    joined, position = _positions(ordered)
    return joined.filter((position >= start) & (position < stop)).select(*ordered.kept())


def _touched(
    df: DataFrame, order: Sequence[str], start: int, stop: int, ranges: int
) -> tuple[DataFrame, int, int]:
    """The rows of the key ranges that hold the slice, and the slice's place in them."""
    key = F.struct(*[col(c).alias(f"k{i}") for i, c in enumerate(order)])
    keys = df.select(key.alias("key"))
    dealt = keys.repartitionByRange(ranges, *[F.col(f"key.k{i}") for i in range(len(order))])
    counted = dealt.groupBy(F.spark_partition_id().alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("low")
    )
    found = sorted(counted.collect(), key=lambda r: r["range"])  # at most `ranges` rows
    types = [df.schema[c].dataType for c in order]

    def bound(low) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(low, types))])

    before, skipped, low, high = 0, 0, None, None
    for row in found:
        if before + row["rows"] <= start:
            skipped = before + row["rows"]
        elif low is None:
            low = row["low"]
        if before >= stop and high is None:
            high = row["low"]
        before += row["rows"]
    # Equal keys lie in one range, so bounds don't cut them apart.
    part = df.filter(key >= bound(low))
    if high is not None:
        part = part.filter(key < bound(high))
    return part, start - skipped, stop - skipped


def rank_in_group(
    df: DataFrame,
    group_by: str | Sequence[str],
    order_by: str | Sequence[str],
    name: str = "rank",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add 1, 2, .. within each group (NULLs form a group) in `order_by`.

    In order of group and `order_by` a group is one run; its rows are numbered
    where they are sorted, and a run that goes over several chunks is carried on.
    """
    group, order = names(group_by), names(order_by)
    return number_rows(
        df, group, group + order, name, base=1, step=1, rows_per_chunk=rows_per_chunk
    )


def running_sums(
    df: DataFrame,
    order_by: str | Sequence[str],
    sums: dict[str, str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add running totals `{new column: summed column}` in `order_by`."""
    return sum_rows(df, order_by, sums, rows_per_chunk)
