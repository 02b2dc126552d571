"""Makes a session ready for these operators: the package on its executors, small batches of texts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of an Arrow batch. Documents are long, and a batch lies in memory on both sides at once.
BATCH_ROWS = 1_000

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source files to Spark once for each application, and bound its batches."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="drover-source-")) / "drover.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
