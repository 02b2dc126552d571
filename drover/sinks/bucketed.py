"""Tables in buckets of their key, so that checks against each other need no shuffle.

Staging and target table have as many buckets of the same key columns, sorted by
them. Spark then joins bucket with bucket, and counts keys, where the rows lie;
the shuffle is paid once, when the table is written. For keys that are nearly unique:
all rows of one key lie in one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drover.operators.chunks import all_of, col, fresh, names

BUCKETS = 200
#: Rows that one task sorts and counts without needing more than some tens of MB.
ROWS_PER_BUCKET = 500_000


def buckets_for(*tables: DataFrame, least: int = 1, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """How many buckets tables that are checked against each other need, so that none outgrows a task.

    Follows the rows of the largest one, without an upper limit.
    """
    rows = max(df.count() for df in tables)
    return max(least, -(-rows // rows_per_bucket))


def write_bucketed(df: DataFrame, name: str, key: str | Sequence[str], buckets: int = BUCKETS) -> str:
    """Make the catalog table `name`, one sorted file for each bucket of `key`; it must not exist."""
    keys = names(key)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    # Spark deals rows to tasks as it does to buckets, so each task writes one bucket.
    dealt = df.repartition(buckets, *map(col, keys))
    dealt.write.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).format("parquet").saveAsTable(name)
    return name


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table; (0, []) if it has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = rows.get("Bucket Columns", "[]").strip("[]")
    return int(rows.get("Num Buckets", 0)), [c.strip().strip("`") for c in columns.split(",") if c.strip()]


def _pair(spark: SparkSession, first: str, second: str) -> list[str]:
    """The bucket columns that both tables share by place; raises if a join would shuffle them."""
    (n, keys), (m, others) = bucketing(spark, first), bucketing(spark, second)
    if not n or n != m or len(keys) != len(others):
        raise ValueError(f"{first} has {n} buckets by {keys}, {second} {m} by {others}")
    for a, b in zip(keys, others):
        kinds = spark.table(first).schema[a].dataType, spark.table(second).schema[b].dataType
        if kinds[0] != kinds[1]:
            raise ValueError(f"{a} is {kinds[0].simpleString()}, {b} is {kinds[1].simpleString()}")
    return keys


def _keys_of(spark: SparkSession, name: str) -> DataFrame:
    _, keys = bucketing(spark, name)
    return spark.table(name).select(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)])


def _same(keys: Sequence[str]) -> Column:
    return all_of([col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])


def net_new_rows(spark: SparkSession, staging: str, target: str) -> DataFrame:
    """Rows of the staging table whose key the target lacks; those with a NULL in the key stay."""
    keys = _pair(spark, staging, target)
    return spark.table(staging).join(_keys_of(spark, target).hint("merge"), _same(keys), "left_anti")


def known_rows(spark: SparkSession, staging: str, target: str) -> DataFrame:
    """Rows of the staging table whose key the target holds."""
    keys = _pair(spark, staging, target)
    return spark.table(staging).join(_keys_of(spark, target).hint("merge"), _same(keys), "left_semi")


def without_listed(spark: SparkSession, table: str, listed: str) -> DataFrame:
    """Rows left after deleting the listed keys; rows with a NULL in the key stay."""
    return net_new_rows(spark, table, listed)


def check_keys(spark: SparkSession, staging: str, target: str, reasons: str = "reject_reasons") -> DataFrame:
    """The staging rows with what is wrong with their key: null:<column>, duplicate_key, key_exists.

    Keys are counted and looked up in their bucket; neither table is shuffled. A
    key with a NULL in it is neither a duplicate nor known.
    """
    keys = _pair(spark, staging, target)
    rows = spark.table(staging)
    many, known = (fresh(rows.columns, n) for n in ("_many", "_known"))
    # The count and the join use one sort of the bucket.
    counted = rows.withColumn(many, F.count(F.lit(1)).over(Window.partitionBy(*map(col, keys))))
    held = _keys_of(spark, target).distinct().withColumn(known, F.lit(True))
    found = counted.join(held.hint("merge"), _same(keys), "left")
    rules = [F.when(col(k).isNull(), f"null:{k}") for k in keys]
    repeated = all_of([col(k).isNotNull() for k in keys]) & (F.col(many) > 1)
    rules += [F.when(repeated, "duplicate_key"), F.when(F.col(known), "key_exists")]
    return found.select(*map(col, rows.columns), F.array_compact(F.array(*rules)).alias(reasons))
