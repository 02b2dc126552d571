"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "drover", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new folder under `spark.checkpoint.dir`, which every executor must see.

    For data that may be deleted after the job; tables don't belong there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage before operators that pass over their input several
    times, and pins the outcome of steps that must not run twice.
    """
    return stage_counted(df, purpose)[0]


def stage_counted(
    df: DataFrame, purpose: str = "stage", **conditions: Column
) -> tuple[DataFrame, dict[str, int]]:
    """`stage`, and how many of the rows meet each condition.

    The counts are taken by the tasks that write, so they cost no pass of their
    own. A task that is repeated counts once.
    """
    spark = df.sparkSession
    path = shared_path(spark, purpose)
    counts = {}
    if conditions:
        seen = Observation(f"{purpose}-{uuid.uuid4().hex}")
        metrics = [F.count(F.when(c, True)).alias(n) for n, c in conditions.items()]
        df.observe(seen, *metrics).write.parquet(path)
        counts = seen.get
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), {n: counts.get(n, 0) for n in conditions}
