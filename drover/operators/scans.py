"""Numbers along an order that go on, or start again, with the values of the rows: a segmented scan.

Inside a chunk the scan runs over the sorted rows before they are stored. Of a
chunk then remains a summary: the values of its first and last row, its steps and
where its last run began. Two neighbouring summaries make one; so what the
earlier chunks carry into a chunk is found in a tree of summaries.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.operators import chunks
from drover.operators.chunks import ROWS_PER_CHUNK, Scan, col, in_order, names

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """A text that is the same for equal values, NULLs and not-a-numbers included, and only for them."""
    parts = []
    for name in columns:
        kind, value = df.schema[name].dataType, col(name)
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            text = (value + F.lit(0.0).cast(kind)).cast("string")  # one zero
        elif isinstance(kind, T.BinaryType):
            text = F.hex(value)
        elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            text = F.to_json(F.struct(value), {"ignoreNullFields": "false", **MICROSECONDS})
            text = F.when(value.isNotNull(), text)
        else:
            text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts) if parts else F.lit("")


def _runs(changing: bool, hold: bool) -> Scan:
    """Steps since the chunk's first row, and at which of them the last run inside the chunk began (-1: none)."""

    def make():
        last: list[pa.Array] = []
        steps_so_far, start_so_far = 0, -1

        def differs(values: pa.Array, before: pa.Array) -> np.ndarray:
            previous = pa.concat_arrays([before, values[:-1]])
            return pc.not_equal(values, previous).to_numpy(zero_copy_only=False)

        def step(arrays: list[pa.Array]) -> list[pa.Array]:
            nonlocal last, steps_so_far, start_so_far
            first = not last
            group, changes = arrays
            if first:
                last = [group[:1], changes[:1]]
            new_group = differs(group, last[0])
            new_change = differs(changes, last[1])
            last = [group[-1:], changes[-1:]]
            breaks = new_group if not changing or hold else new_group | ~new_change
            advances = new_change.astype(np.int64) if hold else np.ones(len(group), dtype=np.int64)
            if first:
                breaks[0], advances[0] = False, 0
            steps = steps_so_far + np.cumsum(advances)
            start = np.maximum.accumulate(np.where(breaks, steps, -1))
            start = np.maximum(start, start_so_far)
            steps_so_far, start_so_far = int(steps[-1]), int(start[-1])
            return [pa.array(steps), pa.array(start)]

        return step

    return Scan((), (("steps", T.LongType()), ("start", T.LongType())), make)


def _totals(count: int, types: Sequence[T.DataType]) -> Scan:
    """Running sums of `count` inputs, which have the type of their sum; NULL as long as all were."""

    def make():
        totals: list = [None] * count

        def one(k: int, values: pa.Array) -> pa.Array:
            if isinstance(values.type, (pa.Decimal128Type, pa.Decimal256Type)):
                found, total = [], totals[k]
                for value in values.to_pylist():
                    total = total if value is None else value if total is None else total + value
                    found.append(total)
                totals[k] = total
                return pa.array(found, values.type)
            known = np.cumsum(values.is_valid().to_numpy(zero_copy_only=False)) > 0
            zero = pa.scalar(0, values.type)
            begin = zero if totals[k] is None else pa.scalar(totals[k], values.type)
            sums = pc.cumulative_sum_checked(pc.fill_null(values, zero), start=begin)
            if totals[k] is None:
                sums = pc.if_else(pa.array(known), sums, pa.scalar(None, values.type))
            totals[k] = sums[-1].as_py()
            return sums

        return lambda arrays: [one(k, a) for k, a in enumerate(arrays)]

    return Scan((), tuple((f"sum{k}", t) for k, t in enumerate(types)), make)


def sum_rows(
    df: DataFrame, order_by: str | Sequence[str], sums: dict[str, str], rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Running totals; see `ordering.running_sums`."""
    types = [df.select(F.sum(col(c)).alias("s")).schema["s"].dataType for c in sums.values()]
    scan = _totals(len(sums), types)
    inputs = tuple(col(c).cast(t) for c, t in zip(sums.values(), types))
    ordered = in_order(df, order_by, rows_per_chunk, Scan(inputs, scan.outputs, scan.make))
    taken = list(ordered.rows.columns)
    carries = [chunks.fresh(taken, f"_carry{k}") for k in range(len(sums))]
    # The last row of a chunk has the chunk's total.
    total = {c: F.max_by(col(a), col(ordered.place)) for c, a in zip(carries, ordered.added)}
    per_chunk = ordered.edges().groupBy(col(ordered.chunk)).agg(*[v.alias(c) for c, v in total.items()])
    carried = chunks.sums_before(per_chunk, ordered.chunk, carries, ordered.chunks)
    found = [
        F.coalesce(col(a) + col(c), col(a), col(c)).cast(t).alias(new)
        for new, a, c, t in zip(sums, ordered.added, carries, types)
    ]
    return ordered.with_carry(carried).select(*ordered.kept(), *found)


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order_by: str | Sequence[str],
    name: str,
    changes: Sequence[str] = (),
    base: int = 10,
    step: int = 10,
    hold: bool = False,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Number rows along `order_by`; see `sequence.number_runs` for when a number starts again."""
    changing = bool(changes)
    scan = _runs(changing, hold)
    inputs = (key_text(df, group), key_text(df, changes))
    ordered = in_order(df, names(order_by), rows_per_chunk, Scan(inputs, scan.outputs, scan.make))
    chunk, place = col(ordered.chunk), col(ordered.place)
    steps, start = map(col, ordered.added)

    def starts_run(now: str, before: str) -> Column:
        new_group = F.col(f"{now}.g") != F.col(f"{before}.g")
        return new_group if not changing or hold else new_group | (F.col(f"{now}.c") == F.col(f"{before}.c"))

    def advances(now: str, before: str) -> Column:
        if not hold:
            return F.lit(1).cast("bigint")
        return (F.col(f"{now}.c") != F.col(f"{before}.c")).cast("bigint")

    seen = F.struct(key_text(df, group).alias("g"), key_text(df, changes).alias("c"))
    ends = ordered.edges().groupBy(chunk.alias("chunk")).agg(
        F.min_by(seen, place).alias("head"),
        F.max_by(seen, place).alias("tail"),
        F.max(steps).alias("total"),
        F.max(F.when(start >= 0, start)).alias("last_start"),
    )

    def carry(ends: DataFrame, count: int) -> DataFrame:
        """For each summary its offset in steps and where the run it begins in began."""
        blocks = count > chunks.FANOUT
        if blocks:
            ends = ends.withColumn("block", F.expr(f"chunk DIV {chunks.FANOUT}"))
            by_chunk = Window.partitionBy("block").orderBy("chunk")
        else:
            by_chunk = Window.orderBy("chunk")
        earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
        inside = (
            ends.withColumn("before", F.lag("tail").over(by_chunk))
            .withColumn("opens", F.col("before").isNotNull() & starts_run("head", "before"))
            .withColumn("entry", F.when(F.col("before").isNull(), F.lit(0)).otherwise(advances("head", "before")))
            .withColumn(
                "offset",
                F.coalesce(F.sum(F.col("total") + F.col("entry")).over(earlier), F.lit(0)) + F.col("entry"),
            )
            .withColumn(
                "latest",
                F.coalesce(F.col("offset") + F.col("last_start"), F.when(F.col("opens"), F.col("offset"))),
            )
            .withColumn(
                "began",
                F.when(F.col("opens"), F.col("offset")).otherwise(F.last("latest", ignorenulls=True).over(earlier)),
            )
        )
        if not blocks:
            return inside.select("chunk", "offset", F.coalesce("began", F.lit(0)).alias("began"))
        whole = inside.groupBy("block").agg(
            F.min_by("head", "chunk").alias("head"),
            F.max_by("tail", "chunk").alias("tail"),
            F.max(F.col("offset") + F.col("total")).alias("total"),
            F.max("latest").alias("last_start"),
        )
        above = carry(whole.withColumnRenamed("block", "chunk"), -(-count // chunks.FANOUT))
        above = above.select(F.col("chunk").alias("block"), F.col("offset").alias("low"), F.col("began").alias("early"))
        return inside.join(above, "block").select(
            "chunk",
            (F.col("low") + F.col("offset")).alias("offset"),
            F.coalesce(F.col("low") + F.col("began"), "early").alias("began"),
        )

    offset, began = (chunks.fresh(ordered.rows.columns, n) for n in ("_offset", "_began"))
    carried = carry(ends, ordered.chunks).select(
        F.col("chunk").alias(ordered.chunk), F.col("offset").alias(offset), F.col("began").alias(began)
    )
    since = F.when(start >= 0, col(offset) + start).otherwise(col(began))
    number = F.lit(base) + F.lit(step) * (col(offset) + steps - since)
    return ordered.with_carry(carried).select(*ordered.kept(), number.cast("bigint").alias(name))
