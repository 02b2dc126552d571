"""Two-pass external shuffle: scatter into memory-sized buckets, then Fisher-Yates inside each."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.llm.text import tidy
from drover.session import stage

#: Bytes that one bucket should hold.
BUCKET_BYTES = 32 << 20


def fisher_yates(count: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly random order of `count` rows, by swaps from the last place down."""
    order = np.arange(count)
    picks = rng.integers(0, np.arange(count, 0, -1)) if count else order
    for last, pick in zip(range(count - 1, 0, -1), picks):
        order[last], order[pick] = order[pick], order[last]
    return order


def _bytes(schema: T.StructType) -> Column:
    """About what a row takes in memory."""
    sizes = [F.lit(1).cast("long")]
    for field in schema.fields:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(value)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(value)))
        else:
            size = F.lit(8)
        sizes.append(F.coalesce(size, F.lit(0)).cast("long"))
    return reduce(lambda a, b: a + b, sizes)


def shuffle_rows(
    df: DataFrame, shards: int = 8, seed: int = 0, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """All rows in a random order, dealt to `shards` shards whose counts differ by one at most.

    First pass: a seeded hash scatters the rows over buckets of about
    `bucket_bytes`. The hash takes in the row's place in its input
    task, so equal rows and equal keys spread as well. Second pass: each bucket
    is sorted by hash, brought into Fisher-Yates order by a generator seeded
    with `seed` and the bucket, and written to the shared folder; a repeated
    task gives the same order. A row's position is its place in the bucket plus
    the sizes of the buckets before; shard s holds the positions of the s-th
    equal part, and `slot` counts from 0 in it.

    Adds shard and slot, replacing columns of these names. NULLs, empty texts
    and repeated rows are rows like any other; an empty table gives an empty one.
    Rows are measured by all their columns, whatever these are called.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    df = df.drop("shard", "slot")
    total = df.agg(F.sum(_bytes(df.schema)).alias("b")).first()["b"] or 0
    buckets = max(1, -(-total // bucket_bytes))

    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    draw = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
    keyed = df.select(row, draw.alias("draw"))
    keyed = keyed.withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit("bucket"), "draw"), F.lit(buckets)).cast("int")
    )

    @tidy
    def shuffled(table: pa.Table) -> pa.Table:
        table = table.sort_by("draw")
        bucket = table.column("bucket")[0].as_py()
        order = fisher_yates(table.num_rows, np.random.default_rng([seed, bucket]))
        table = table.take(pa.array(order))
        return pa.table(
            {
                "row": table.column("row"),
                "bucket": table.column("bucket"),
                "place": pa.array(np.arange(table.num_rows), pa.int64()),
            }
        )

    # The row's type as it is, columns that can't be NULL included.
    schema = T.StructType(
        [keyed.schema["row"], T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType())]
    )
    placed = keyed.groupBy("bucket").applyInArrow(shuffled, schema)
    placed = stage(placed, "shuffled")
    # One row per bucket, so this table is as small against the data as a row against a bucket.
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    count = F.expr("sum(size) OVER ()")
    before = F.expr("sum(size) OVER (ORDER BY bucket) - size")
    offsets = sizes.select("bucket", before.alias("before"), count.alias("count"))
    position = F.col("before") + F.col("place")
    dealt = placed.join(F.broadcast(offsets), "bucket").withColumn("position", position)
    # floor(position * shards / count), exact in whole numbers also for the first of a shard
    shard = F.expr(f"((position + 1) * {shards} - 1) DIV count")
    first = F.expr("shard_no * count DIV {0}".format(shards))
    dealt = dealt.withColumn("shard_no", shard).withColumn("slot_no", F.col("position") - first)
    return dealt.select(
        *(F.col(f"row.`{c}`") for c in df.columns),
        F.col("shard_no").cast("int").alias("shard"),
        F.col("slot_no").cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard; `slot` gives the order."""
    df.write.partitionBy("shard").parquet(path)
