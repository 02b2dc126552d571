"""Submission that can be resumed: a ledger of committed batches, by run and batch.

The rows of a run are numbered and stored when it starts for the first time, so
that a batch holds the same rows at every start. The task that sends a batch
writes its outcomes to the ledger at once; what is there is never sent again, be
it that Spark repeats a lost task or that the run is started anew.

    <output>/operation=<op>/run_id=<id>/
        rows/       the numbered rows
        starts/     one entry for each start
        begun/      one entry for each batch that was about to be sent
        done/       the outcomes of each batch, one file each
        results/, success/, fallout/, unknown/   when all batches are done

The folder can be on any file system that Spark and pyarrow both reach.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.operators import submit
from drover.operators.ordering import col
from drover.operators.submit import BATCH, BATCH_SIZE, OPERATIONS, RESULT_FIELDS, RESULT_PREFIX, ROW, SUCCESS

# Workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ATTEMPT = RESULT_PREFIX + "attempt"
#: Batches whose files share a folder.
PER_FOLDER = 1_000


def _system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, as Spark writes them, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


@dataclass(frozen=True)
class Ledger:
    """What is known of a run's batches. Entries are written aside and moved, so none is ever half there."""

    folder: str

    def _path(self, kind: str, name: str, suffix: str = "") -> tuple[fs.FileSystem, str]:
        system, root = _system(self.folder)
        return system, f"{root}/{kind}/{name}{suffix}"

    @staticmethod
    def _name(batch: int) -> str:
        return f"{batch // PER_FOLDER:09d}/{batch:012d}"

    def _write(self, system: fs.FileSystem, path: str, table: pa.Table | None) -> None:
        folder, _, name = path.rpartition("/")
        system.create_dir(folder, recursive=True)
        aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as out:
            if table is None:
                out.write(b"\n")  # Spark does not list empty files
            else:
                pq.write_table(table, out)
        system.move(aside, path)

    def has(self, kind: str) -> bool:
        system, path = self._path(kind, "")
        return system.get_file_info(path.rstrip("/")).type == fs.FileType.Directory

    def start(self) -> int:
        """Enter a start of the run; gives its number, from 1."""
        system, path = self._path("starts", "")
        path = path.rstrip("/")
        system.create_dir(path, recursive=True)
        names = [f.base_name for f in system.get_file_info(fs.FileSelector(path))]
        number = 1 + max((int(n) for n in names if n.isdigit()), default=0)
        self._write(system, f"{path}/{number}", None)
        return number

    def begin(self, batch: int) -> None:
        self._write(*self._path("begun", self._name(batch)), None)

    def commit(self, batch: int, outcomes: pa.Table) -> None:
        self._write(*self._path("done", self._name(batch), ".parquet"), outcomes)

    def committed(self, batch: int) -> bool:
        system, path = self._path("done", self._name(batch), ".parquet")
        return system.get_file_info(path).type == fs.FileType.File


class Run(NamedTuple):
    """State of a run after a start: stored outcomes so far, and how many batches are left."""

    results: DataFrame
    sent: int
    left: int

    @property
    def complete(self) -> bool:
        return self.left == 0


def run_folder(output: str, operation: str, run_id: str) -> str:
    return f"{output.rstrip('/')}/operation={operation}/run_id={run_id}"


def _result_schema(rows: T.StructType) -> T.StructType:
    fields = [f for f in rows.fields if f.name != ROW]
    fields += [T.StructField(RESULT_PREFIX + n, t) for n, _, t in RESULT_FIELDS]
    return T.StructType([*fields, T.StructField(ATTEMPT, T.IntegerType())])


def _stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{folder}/done")


def _rows(df: DataFrame, ledger: Ledger, order_by, batch_size: int) -> DataFrame:
    """The numbered rows of the run, stored by its first start."""
    spark, path = df.sparkSession, f"{ledger.folder}/rows"
    system, local = _system(path)
    if system.get_file_info(f"{local}/_SUCCESS").type != fs.FileType.File:
        # A start that died while it wrote them has sent nothing.
        submit._numbered_batches(df, order_by, batch_size).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    if rows.drop(BATCH, ROW).columns != df.columns:
        raise ValueError(f"the run was started with the columns {rows.drop(BATCH, ROW).columns}")
    return rows


def run_resumable(
    df: DataFrame,
    submitter: submit.Submitter,
    operation: str,
    order_by: str | Sequence[str],
    output: str,
    run_id: str,
    batch_size: int = BATCH_SIZE,
    stop_after: int | None = None,
) -> Run | None:
    """Send the batches of a run that were not sent yet, at most `stop_after` of them.

    Call it again with the same `output`, operation and `run_id` to go on, after a
    failure or the next day; rows, order and batch size are those of the first
    start. A batch whose submitter raises has failed rows, as in `submit`;
    a start that dies leaves the batches it has not committed for the next one.
    A batch that was sent by a task that died before it could write the
    outcomes is sent again, so the submitter must be safe to call twice.

    When the last batch is done, results and the three reports are written. An
    empty frame is not submitted and gives None.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation: {operation}")
    ledger = Ledger(run_folder(output, operation, run_id))
    spark, folder = df.sparkSession, ledger.folder
    if not ledger.has("rows") and df.isEmpty():
        return None
    rows = _rows(df, ledger, order_by, batch_size)
    schema = _result_schema(rows.schema)
    columns = [f.name for f in rows.schema.fields if f.name not in (BATCH, ROW)]
    attempt = ledger.start()

    def send(batch: pa.Table) -> pa.Table:
        number = batch.column(BATCH)[0].as_py()
        if not ledger.committed(number):
            ledger.begin(number)
            batch = batch.sort_by(ROW)
            try:
                results = submitter(batch.select(columns))
            except Exception as error:
                results = submit.failed_batch(batch.num_rows, str(error))
            outcomes = submit._attach_results(batch.drop_columns([ROW]), results)
            attempts = pa.array([attempt] * batch.num_rows, pa.int32())
            ledger.commit(number, outcomes.append_column(ATTEMPT, attempts))
        return pa.table({BATCH: [number]})

    pending = rows
    if ledger.has("done"):
        known = _stored(spark, folder, schema).select(BATCH).distinct()
        pending = rows.join(known, BATCH, "left_anti")
    left = pending.select(BATCH).distinct().count()
    if stop_after is not None:
        # At most `stop_after` numbers.
        first = pending.select(BATCH).distinct().orderBy(BATCH).limit(stop_after)
        pending = pending.join(first, BATCH, "left_semi")
    sent = pending.groupBy(BATCH).applyInArrow(send, f"{BATCH} long").count() if left else 0
    left -= sent
    results = _stored(spark, folder, schema) if left else _finish(spark, folder, schema)
    return Run(results, sent, left)


def _finish(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Results in few files, and the reports, once for a run."""
    system, path = _system(f"{folder}/results")
    read = spark.read.schema(schema)
    if system.get_file_info(f"{path}/_SUCCESS").type != fs.FileType.File:
        _stored(spark, folder, schema).write.mode("overwrite").parquet(f"{folder}/results")
    system, path = _system(f"{folder}/reported")
    if system.get_file_info(path).type != fs.FileType.File:
        results = read.parquet(f"{folder}/results")
        submit.report(submit.split_results(results), folder, mode="overwrite")
        system.open_output_stream(path).close()
    return read.parquet(f"{folder}/results")


def account(spark: SparkSession, output: str, operation: str, run_id: str) -> DataFrame:
    """One row for each batch of a run: its rows and what became of them.

    `state` is done, in_doubt (begun, but no outcome was written: all its rows
    are unknown) or waiting (never sent, its rows are unsent). For each batch
    passed + failed + unknown + unsent = rows.
    """
    ledger = Ledger(run_folder(output, operation, run_id))
    rows = spark.read.parquet(f"{ledger.folder}/rows")
    found = rows.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))
    if ledger.has("done"):
        flag = col(SUCCESS)
        done = _stored(spark, ledger.folder, _result_schema(rows.schema)).groupBy(BATCH).agg(
            F.count_if(flag).alias("passed"),
            F.count_if(~flag).alias("failed"),
            F.max(col(ATTEMPT)).alias("attempt"),
        )
    else:
        done = spark.createDataFrame([], f"{BATCH} long, passed long, failed long, attempt int")
    if ledger.has("begun"):
        names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{ledger.folder}/begun")
        begun = names.select(F.regexp_extract("path", r"(\d+)$", 1).cast("long").alias(BATCH), F.lit(True).alias("begun"))
    else:
        begun = spark.createDataFrame([], f"{BATCH} long, begun boolean")
    state = (
        F.when(F.col("attempt").isNotNull(), "done").when(F.col("begun"), "in_doubt").otherwise("waiting")
    )
    passed, failed = (F.coalesce(F.col(c), F.lit(0)) for c in ("passed", "failed"))
    waiting = F.col("state") == "waiting"
    return (
        found.join(done, BATCH, "left")
        .join(begun, BATCH, "left")
        .withColumn("state", state)
        .select(
            BATCH, "rows", "state", "attempt",
            passed.alias("passed"),
            failed.alias("failed"),
            F.when(waiting, 0).otherwise(F.col("rows") - passed - failed).alias("unknown"),
            F.when(waiting, F.col("rows")).otherwise(0).cast("long").alias("unsent"),
        )
    )
