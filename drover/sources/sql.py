"""Free SQL text over named frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def run_sql(
    spark: SparkSession,
    text: str,
    views: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run a query that names frames as `{view}` and values as `:arg`; values are never spliced."""
    return spark.sql(text, args=dict(args or {}), **(views or {}))
