"""From raw documents to packed sequences: each stage applies one operator to all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from drover.llm import stages
from drover.session import stage

STAGES = stages.STAGES

#: No stage can be said in SQL; `tests/llm` compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and reread before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
