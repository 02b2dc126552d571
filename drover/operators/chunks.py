"""Rows in chunks along an order: the store that numbers, ranks and running sums are taken from.

Rows are dealt to ranges of the sort key, sorted inside the ranges and stored
once. A row's place in its range is then fixed, so repeated tasks and rows with
equal keys can't move it. A `Scan` runs over the sorted rows of a range before
they are stored, so what a row owes to the rows before it in its range needs no
further shuffle. What the earlier ranges carry over is one row per range, summed up
in a tree of FANOUT ranges each.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.session import stage

# Workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_CHUNK = 100_000
#: Summaries that one window of a carry tree goes over.
FANOUT = 1_000
#: Summaries of that many chunks are small enough to be broadcast (about 100 bytes each).
BROADCAST_CHUNKS = 100_000


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def col(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def fresh(taken: Sequence[str], name: str) -> str:
    """`name`, with underscores in front until no column has it."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = "_" + name
    return name


@dataclass(frozen=True)
class Scan:
    """A pass over the sorted rows of one chunk.

    `make` gives a function for one chunk; it gets the `inputs` of each batch in turn
    and returns the `outputs` (names and types), remembering what it needs of the rows before.
    """

    inputs: tuple[Column, ...]
    outputs: tuple[tuple[str, T.DataType], ...]
    make: Callable[[], Callable[[list[pa.Array]], list[pa.Array]]]


@dataclass(frozen=True)
class Ordered:
    """Stored rows with the number of their chunk, their place in it from 0, and what a scan added."""

    rows: DataFrame
    columns: list[str]
    chunk: str
    place: str
    chunks: int
    added: tuple[str, ...] = ()
    edge: str | None = None

    def kept(self) -> list[Column]:
        return [col(c) for c in self.columns]

    def before(self, **sums: Column) -> DataFrame:
        """For each chunk, the sums over the rows of the earlier chunks; NULL where there is nothing."""
        totals = self.rows.groupBy(col(self.chunk)).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
        return sums_before(totals, self.chunk, list(sums), self.chunks)

    def edges(self) -> DataFrame:
        """First and last row of each chunk that was scanned."""
        return self.rows.filter(col(self.edge))

    def with_carry(self, carried: DataFrame) -> DataFrame:
        """The rows beside the one row that `carried` has for their chunk."""
        small = self.chunks <= BROADCAST_CHUNKS
        return self.rows.join(F.broadcast(carried) if small else carried, self.chunk)


def sums_before(totals: DataFrame, chunk: str, sums: Sequence[str], chunks: int) -> DataFrame:
    """`totals` has sums for each chunk; gives the sums of all chunks before it."""
    if chunks <= FANOUT:
        earlier = Window.orderBy(col(chunk)).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(col(chunk), *[F.sum(col(s)).over(earlier).alias(s) for s in sums])
    block = fresh(totals.columns, "_block")
    parts = totals.withColumn(block, F.expr(f"`{chunk}` DIV {FANOUT}"))
    earlier = Window.partitionBy(block).orderBy(col(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    blocks = parts.groupBy(block).agg(*[F.sum(col(s)).alias(s) for s in sums])
    above = sums_before(blocks, block, sums, -(-chunks // FANOUT))
    above = above.select(col(block), *[col(s).alias(f"{block}_{s}") for s in sums])
    inside = parts.select(col(chunk), col(block), *[F.sum(col(s)).over(earlier).alias(s) for s in sums])

    def both(name: str) -> Column:
        return F.coalesce(col(name) + col(f"{block}_{name}"), col(name), col(f"{block}_{name}"))

    return inside.join(above, block).select(col(chunk), *[both(s).alias(s) for s in sums])


def in_order(
    df: DataFrame, order_by: str | Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK, scan: Scan | None = None
) -> Ordered:
    """Store `df` in chunks of about `rows_per_chunk` rows along `order_by`.

    Rows with equal keys go by a hash of the whole row, so a key with many
    rows is spread over as many chunks as it fills.
    """
    chunk = fresh(df.columns, "_chunk")
    place = fresh([*df.columns, chunk], "_place")
    order = [col(name) for name in names(order_by)]
    hashed = [col(f.name) for f in df.schema.fields if not _has_map(f.dataType)]
    ties = [F.xxhash64(*hashed)] if hashed else []
    chunks = max(1, -(-df.count() // rows_per_chunk))
    dealt = df.repartitionByRange(chunks, *order, *ties) if chunks > 1 else df.repartition(1)
    taken = [*df.columns, chunk, place]
    inputs = [fresh(taken, f"_in{i}") for i in range(len(scan.inputs))] if scan else []
    rows = dealt.sortWithinPartitions(*order, *ties).select(
        *[col(c) for c in df.columns],
        F.spark_partition_id().alias(chunk),
        # The lower 33 bits count the rows of a partition.
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(place),
        *[c.alias(n) for c, n in zip(scan.inputs if scan else (), inputs)],
    )
    added: tuple[str, ...] = ()
    edge = None
    if scan:
        edge = fresh(taken, "_edge")
        added = tuple(fresh([*taken, edge], f"_{name}") for name, _ in scan.outputs)
        rows = _scanned(rows, len(taken), scan, (*added, edge))
    return Ordered(stage(rows, "ordered"), list(df.columns), chunk, place, chunks, added, edge)


def _has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map anywhere; these have no hash."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def _scanned(rows: DataFrame, kept: int, scan: Scan, added: Sequence[str]) -> DataFrame:
    fields = rows.schema.fields[:kept]
    kinds = [*(t for _, t in scan.outputs), T.BooleanType()]
    outputs = [T.StructField(n, t) for n, t in zip(added, kinds)]
    out_names = [f.name for f in [*fields, *outputs]]
    make = scan.make

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        # One batch is held back, because only the end shows which row is the last.
        held: list[pa.Array] | None = None
        first = True

        def marked(columns: list[pa.Array], last: bool) -> pa.RecordBatch:
            edge = [False] * len(columns[0])
            edge[0] = first
            edge[-1] = edge[-1] or last
            return pa.RecordBatch.from_arrays([*columns, pa.array(edge)], names=out_names)

        for batch in batches:
            if batch.num_rows:
                if held is not None:
                    yield marked(held, False)
                    first = False
                columns = batch.columns
                held = [*columns[:kept], *step(columns[kept:])]
        if held is not None:
            yield marked(held, True)

    return rows.mapInArrow(task, T.StructType([*fields, *outputs]))
