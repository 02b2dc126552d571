"""What the plans of the registered queries must not contain."""

import re

import oracle
import pytest

from drover.operators import reconcile
from drover.registry import ALL

# Large enough for several chunks of events, orders and lines.
FOLDER = f"{oracle.DATA}/sf0.1"
FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "Scan ExistingRDD",
)
# These order fewer rows than fill one chunk.
ONE_CHUNK = {"renumber_rows", "sql_in_list", "sql_in_list_parts", "batch_totals"}


def lines(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"^[\s:+|*()0-9-]*", "", line) for line in text.splitlines()]


@pytest.mark.parametrize("name", sorted(ALL))
def test_plan(spark, name):
    plan = lines(ALL[name].run(spark, FOLDER))
    for node in FORBIDDEN:
        assert not [line for line in plan if line.startswith(node)], node
    assert not [line for line in plan if "FlatMapGroupsInArrow" in line]
    # Only aggregates, one row per chunk at most, go to a single task.
    for line, below in zip(plan, plan[1:]):
        if line.startswith("Exchange SinglePartition") and name not in ONE_CHUNK:
            assert re.match(r"(Hash|Sort|ObjectHash)Aggregate|Project", below), below


def test_filters_and_columns_reach_the_scan(spark):
    plan = "\n".join(lines(ALL["filter_equals"].run(spark, FOLDER)))
    assert "EqualTo(event_type,error)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan


@pytest.mark.parametrize("hashed", [True, False])
def test_one_shuffle_per_side_in_a_full_merge(spark, hashed):
    """An outer merge is one join; where keys can't be hashed alike, its parts read the same shuffles."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = ALL["diff_provenance"].run(spark, FOLDER)
        if not hashed:
            left = spark.read.parquet(f"{FOLDER}/customer.parquet").selectExpr("double(c_custkey) AS c", "c_name")
            right = spark.read.parquet(f"{FOLDER}/orders.parquet").selectExpr("double(o_custkey) AS o", "o_orderkey")
            df = reconcile.merge(left, right, "c", "o", how="outer")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        if hashed:
            assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2
        else:
            assert plan.count("ReusedExchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
