"""Batches that arrive as files in a landing folder, applied one after another."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from drover.operators.ordering import col
from drover.operators.submit import BATCH_SIZE, Submitter, submit

# Workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: What the state of a key is: the layout's version and when its last row came. The key itself is Spark's.
STATE = "version int, seen bigint"
STATE_VERSION = 1


def stream_batches(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    format: str = "parquet",
    files_per_batch: int = 1,
    interval: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Hand each batch of new files to `apply(rows, batch_id)`, in order.

    Without `interval` the query takes all files that are there and stops;
    with one it pauses that long between batches. A batch that failed comes
    again under its old id, so `apply` must overwrite what it wrote for that id.
    """
    stream = (
        spark.readStream.format(format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**options)
        .load(landing)
    )
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def land_target_keys(target: DataFrame, target_key: str, checkpoint: str) -> None:
    """Give the target's keys to the stream with this checkpoint; its next batch takes them in.

    `net_new_stream` does so at its first start. Call it again for keys that
    came into the target by other ways since.
    """
    keys = target.select(col(target_key).alias("key")).distinct()
    keys.write.mode("append").parquet(_target_keys(checkpoint))


def _target_keys(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-target-keys"


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in a batch, so that a hot key's rows don't all go to one task."""
    for batch in batches:
        if batch.num_rows:
            order = pc.sort_indices(batch, [("key", "ascending"), ("at", "ascending")], null_placement="at_start")
            key = batch.column("key").take(order)
            differs = pc.fill_null(pc.not_equal(key[1:], key[:-1]), True).to_numpy(zero_copy_only=False)
            unknown = key.is_null().to_numpy(zero_copy_only=False)
            differs &= ~(unknown[1:] & unknown[:-1])
            yield batch.take(order.filter(pa.array(np.concatenate([[True], differs]))))


def net_new_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: DataFrame,
    key: str,
    target_key: str,
    order_by: str,
    output: str,
    checkpoint: str,
    submitter: Submitter | None = None,
    files_per_batch: int = 1,
    format: str = "parquet",
    expire_after: float | None = None,
    **options: str,
) -> StreamingQuery:
    """Keep rows whose key neither the target nor an earlier batch holds.

    Within a batch the first row in `order_by` stands for its key; NULL is a key like
    any other. Rows go to `output/batch=<id>`, with `RESULTS_*` columns if a
    submitter sends them. All files that are there are taken in one start.

    The keys that were seen are the stream's state, with the time of their last row
    and nothing else of it; the target's keys are brought into it once, at the first
    start. A key of which nothing came for `expire_after` seconds is forgotten, and
    new when it comes again. The checkpoint takes up the state at the next start;
    one that was written by another STATE_VERSION raises.
    """
    if not _exists(spark, _target_keys(checkpoint)):
        land_target_keys(target, target_key, checkpoint)
    rows = (
        spark.readStream.format(format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .options(**options)
        .load(landing)
    )
    kind = schema[key].dataType
    row = T.StructType([T.StructField("row", T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))])
    landed = rows.select(
        col(key).alias("key"),
        col(order_by).alias("at"),
        F.lit(False).alias("known"),
        F.struct(*[col(c) for c in schema.names]).alias("row"),
    )
    landed = landed.mapInArrow(
        _first_of_each, T.StructType([T.StructField(f.name, f.dataType) for f in landed.schema.fields])
    )
    # A batch takes all key files that are there, whatever the number of landed files.
    held_type = target.schema[target_key].dataType
    held = spark.readStream.schema(T.StructType([T.StructField("key", held_type)])).parquet(_target_keys(checkpoint))
    held = held.select(
        F.col("key").cast(kind).alias("key"),
        F.lit(None).cast(schema[order_by].dataType).alias("at"),
        F.lit(True).alias("known"),
        F.lit(None).cast(row["row"].dataType).alias("row"),
    )
    lasting = None if expire_after is None else int(expire_after * 1000)

    def first_seen(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        known = False
        if state.exists:
            version, seen = state.get
            if version != STATE_VERSION:
                raise ValueError(f"the state is of version {version}, not {STATE_VERSION}")
            known = lasting is None or now - seen < lasting
        best = None
        for frame in frames:
            known = known or bool(frame["known"].any())
            if known:
                continue
            missing = frame["at"].isna()
            at = missing.idxmax() if missing.any() else frame["at"].idxmin()
            place = (not missing[at], None if missing[at] else frame["at"][at])
            if best is None or place[0] < best[0] or (place[0] == best[0] and place[0] and place[1] < best[1]):
                best = (*place, frame["row"][at])
        state.update((STATE_VERSION, now))
        if lasting is not None:
            state.setTimeoutTimestamp(now + lasting)
        if not known and best is not None:
            yield pd.DataFrame({"row": [best[2]]})

    both, timeout = landed.unionByName(held), GroupStateTimeout.NoTimeout
    if lasting is not None:
        # Time is that of the batches: no row is ever late, and a start ends when its files are done.
        both = both.withColumn("time", F.current_timestamp()).withWatermark("time", "0 seconds")
        timeout = GroupStateTimeout.EventTimeTimeout
    new = both.groupBy("key").applyInPandasWithState(
        first_seen, row, T.StructType.fromDDL(STATE), "append", timeout
    )

    def apply(rows: DataFrame, batch_id: int) -> None:
        fresh = rows.select(*[F.col("row").getField(c).alias(c) for c in schema.names])
        if submitter is not None:
            fresh = submit(fresh, submitter, [key, order_by], BATCH_SIZE)
        fresh.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    writer = new.writeStream.outputMode("append").foreachBatch(apply)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
