"""Projection, renaming, flattening, unions, slices and positional zips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.operators.ordering import ROWS_PER_CHUNK, col, fresh, names, rows_between, with_row_index

# Slices that end by this row are taken by a top-k plan, others by position.
TOP_K_LIMIT = 10_000


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns])


def discard(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop columns; a missing one is an error unless `strict` is off."""
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise ValueError(f"no such columns: {missing}")
    return df.select(*[col(c) for c in df.columns if c not in set(columns)])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def add_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def add_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[col(c).alias(prefix + c) for c in df.columns])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def flatten(df: DataFrame, skip: Sequence[str] = ("attributes",)) -> DataFrame:
    """Turn nested lookups of any depth into columns named `Parent.Field`.

    Works on the schema alone. Plain columns come first, unpacked ones after
    them, level by level; members named in `skip` are left out, also at the
    top. Arrays and maps stay as they are.
    """

    def level(fields: list[tuple[str, Column, T.DataType]]) -> list[tuple[str, Column]]:
        plain = [(n, c) for n, c, t in fields if not isinstance(t, T.StructType)]
        nested = [
            (f"{n}.{f.name}", c.getField(f.name), f.dataType)
            for n, c, t in fields
            if isinstance(t, T.StructType)
            for f in t.fields
            if f.name not in skip
        ]
        return plain + (level(nested) if nested else [])

    top = [(f.name, col(f.name), f.dataType) for f in df.schema.fields if f.name not in skip]
    return df.select(*[c.alias(n) for n, c in level(top)])


def slice_rows(
    df: DataFrame, order_by: str | Sequence[str], start: int, count: int
) -> DataFrame:
    """Rows [start, start + count) in `order_by`; past the end gives fewer rows."""
    order = names(order_by)
    if start + count <= TOP_K_LIMIT:
        return df.orderBy(*[col(c) for c in order]).offset(start).limit(count)
    return rows_between(df, order, start, start + count)


def renumber(
    df: DataFrame,
    order_by: str | Sequence[str],
    name: str = "id",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Replace column `name` by 1..n in `order_by`, which may include the old `name`."""
    number = fresh([*df.columns, name], "_number")
    indexed = with_row_index(df, order_by, number, start=1, rows_per_chunk=rows_per_chunk)
    return discard(indexed, [name], strict=False).withColumnRenamed(number, name)


def zip_rows(
    left: DataFrame,
    right: DataFrame,
    left_order: str | Sequence[str],
    right_order: str | Sequence[str],
    how: str = "inner",
    index: str | None = None,
) -> DataFrame:
    """Put the i-th row of one frame beside the i-th of the other.

    `how='left'` keeps all left rows and fills NULL where the right side has
    fewer. `index` names the position column to keep.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    at = index or fresh([*left.columns, *right.columns], "_at")
    joined = with_row_index(left, left_order, at).join(
        with_row_index(right, right_order, at), at, how
    )
    return joined if index else joined.drop(at)
