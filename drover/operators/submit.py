"""Send rows to a target in fixed batches and account for every outcome."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.functions.scalars import to_one_line
from drover.operators.ordering import ROWS_PER_CHUNK, col, running_sums, with_row_index
from drover.session import stage
from drover.sinks.files import write_csv
from drover.sources.files import read_csv

# Workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_SIZE = 1_000
BATCH = "batch_id"
ROW = "_row"
REPORT = "report"

# The outcome columns of a submitted row.
RESULT_FIELDS = (
    ("success", pa.bool_(), T.BooleanType()),
    ("id", pa.string(), T.StringType()),
    ("created", pa.bool_(), T.BooleanType()),
    ("errors", pa.string(), T.StringType()),
)
RESULT_PREFIX = "RESULTS_"
SUCCESS = RESULT_PREFIX + "success"
OPERATIONS = ("insert", "upsert", "update", "delete", "hard_delete")

# Takes the rows of one batch in order; returns a table of `RESULT_FIELDS`
# columns whose i-th row is the outcome of the i-th row sent. It must be safe to
# call again with the same rows, because Spark repeats lost tasks.
Submitter = Callable[[pa.Table], pa.Table]


class Outcome(NamedTuple):
    success: DataFrame
    fallout: DataFrame
    unknown: DataFrame


def assign_batches(
    df: DataFrame,
    order_by: str | Sequence[str],
    batch_size: int = BATCH_SIZE,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add `batch_id`: rows [0, n) in `order_by` are batch 0, the next n batch 1, .."""
    return _numbered_batches(df, order_by, batch_size, rows_per_chunk).drop(ROW)


def _numbered_batches(df, order_by, batch_size, rows_per_chunk=ROWS_PER_CHUNK) -> DataFrame:
    indexed = with_row_index(df, order_by, ROW, rows_per_chunk=rows_per_chunk)
    return indexed.withColumn(BATCH, F.floor(F.col(ROW) / batch_size).cast("bigint"))


def submit(
    df: DataFrame,
    submitter: Submitter,
    order_by: str | Sequence[str],
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Send `df` batch by batch; every row comes back with `batch_id` and `RESULTS_*`.

    A batch whose submitter raises becomes failed rows with the error's text.
    Rows that the submitter gives no outcome for have NULL outcomes. The
    returned frame is lazy: store it once (`run_dml` does) before splitting it.
    """
    batched = _numbered_batches(df, order_by, batch_size)
    sent = df.columns
    schema = T.StructType(
        [
            *batched.drop(ROW).schema.fields,
            *[T.StructField(RESULT_PREFIX + n, t) for n, _, t in RESULT_FIELDS],
        ]
    )

    def send(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by(ROW)
        try:
            results = submitter(batch.select(sent))
        except Exception as error:
            results = failed_batch(batch.num_rows, str(error))
        return _attach_results(batch.drop_columns([ROW]), results)

    return batched.groupBy(BATCH).applyInArrow(send, schema)


def failed_batch(rows: int, error: str) -> pa.Table:
    return pa.table({"success": [False] * rows, "created": [False] * rows, "errors": [error] * rows})


def _attach_results(batch: pa.Table, results: pa.Table) -> pa.Table:
    """Set result columns beside the rows by position, NULL where results run out."""
    missing = batch.num_rows - results.num_rows
    if missing < 0:
        raise ValueError("more results than rows")
    for name, kind, _ in RESULT_FIELDS:
        values = (
            results.column(name).cast(kind).combine_chunks()
            if name in results.column_names
            else pa.nulls(results.num_rows, kind)
        )
        if isinstance(values, pa.ChunkedArray):
            values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.nulls(0, kind)
        padded = pa.concat_arrays([values, pa.nulls(missing, kind)])
        batch = batch.append_column(RESULT_PREFIX + name, padded)
    return batch


def split_results(results: DataFrame) -> Outcome:
    """Rows that passed, rows that failed, and rows without an outcome."""
    flag = F.col(SUCCESS)
    return Outcome(
        results.filter(flag), results.filter(~flag), results.filter(flag.isNull())
    )


def batch_totals(results: DataFrame, flag: str = SUCCESS) -> DataFrame:
    """Passed and failed rows per batch, and both summed up to the batch.

    Reads `results` once, which should be stored results.
    """
    per_batch = results.groupBy(BATCH).agg(
        F.count_if(col(flag)).cast("bigint").alias("passed"),
        F.count_if(~col(flag)).cast("bigint").alias("failed"),
    )
    return running_sums(
        stage(per_batch, "batch-totals"),
        BATCH,
        {"passed_so_far": "passed", "failed_so_far": "failed"},
    )


def run_dml(
    df: DataFrame,
    submitter: Submitter,
    operation: str,
    order_by: str | Sequence[str],
    output: str,
    run_id: str,
    batch_size: int = BATCH_SIZE,
) -> Outcome | None:
    """Submit once, keep the results, and report success, fallout and unknown outcomes as CSV.

    Everything goes below `output/operation=../run_id=..`. Results are written
    before they are split, so no row is sent a second time by the reports.
    An empty frame is not submitted and gives None.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"unknown operation: {operation}")
    if df.isEmpty():
        return None
    base = f"{output.rstrip('/')}/operation={operation}/run_id={run_id}"
    submitted = submit(df, submitter, order_by, batch_size)
    submitted.write.mode("errorifexists").parquet(f"{base}/results")
    results = df.sparkSession.read.schema(submitted.schema).parquet(f"{base}/results")
    outcome = split_results(results)
    report(outcome, base)
    return outcome


def write_reports(results: DataFrame, base: str, mode: str = "errorifexists") -> str:
    """The three reports in one pass over the results: `base`/reports/report=<success, fallout, unknown>.

    Records are one line each, so large reports are read by many tasks, and what
    `read_reports` gives back is what was sent. An outcome that no row had has no folder.
    """
    flag = F.col(SUCCESS)
    name = F.when(flag, "success").when(~flag, "fallout").otherwise("unknown")
    path = f"{base}/reports"
    columns = [to_one_line(col(c).cast("string")).alias(c) for c in results.columns]
    writer = results.select(*columns, name.alias(REPORT)).write.mode(mode).partitionBy(REPORT)
    writer = writer.option("escape", '"').option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path, header=True)
    return path


def read_reports(spark: SparkSession, base: str, schema: T.StructType | str) -> DataFrame:
    """All rows of the reports that `write_reports` wrote, with the name of their `report`."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_report = T.StructType([*wanted.fields, T.StructField(REPORT, T.StringType())])
    return read_csv(spark, f"{base}/reports", with_report, one_line=True)


def report(outcome: Outcome, base: str, mode: str = "errorifexists") -> None:
    """Three CSV reports, which together hold every row: passed, failed, and without an outcome."""
    for name, part in outcome._asdict().items():
        write_csv(part, f"{base}/{name}", mode)
