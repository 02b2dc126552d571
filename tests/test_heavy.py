"""Heavy keys are found, and merges that split them give the rows of plain joins."""

from collections import Counter

import pytest
from drover.operators import heavy, reconcile
from pyspark.sql import functions as F


def frames(spark):
    """One key in half of the left rows, another in half of the right, one heavy on both, NULLs, lone heavy keys."""
    k = F.col("id")
    left = spark.range(600).select(
        F.when(k % 2 == 0, 7).when(k % 11 == 1, F.lit(None)).when(k % 5 == 1, 99).otherwise(k).cast("int").alias("k"),
        (k % 40).alias("x"),
        F.lit("l").alias("_found"),
    )
    right = spark.range(200).select(
        F.when(k % 2 == 0, 11).when(k % 9 == 1, 7).when(k % 7 == 1, F.lit(None)).when(k % 5 == 1, 98).otherwise(k)
        .cast("int").alias("k"),
        (k % 30).alias("y"),
        F.create_map(F.lit("a"), k).alias("m"),
    )
    return left, right


def rows(df):
    return Counter(tuple(str(v) for v in r) for r in df.collect())


def plain(left, right, how):
    """The rows of a merge, by comparing all pairs."""
    out, met = Counter(), set()
    ls, rs = left.collect(), right.collect()
    for a in ls:
        hits = [j for j, b in enumerate(rs) if a["k"] == b["k"]]
        met |= set(hits)
        for j in hits:
            out[(str(a["k"]), str(a["x"]), "l", str(rs[j]["y"]), str(rs[j]["m"]), "both")] += 1
        if not hits and how in ("left", "outer"):
            out[(str(a["k"]), str(a["x"]), "l", "None", "None", "left_only")] += 1
    for j, b in enumerate(rs):
        if j not in met and how in ("right", "outer"):
            out[(str(b["k"]), "None", "None", str(b["y"]), str(b["m"]), "right_only")] += 1
    return out


@pytest.mark.parametrize("how", ["left", "right", "outer"])
def test_merge_with_heavy_keys_like_all_pairs(spark, how):
    left, right = frames(spark)
    merged = reconcile.merge(left, right, "k", "k", how, least_heavy=10)
    assert rows(merged.select("k", "x", "_found", "y", "m", "_merge")) == plain(left, right, how)
    whole = reconcile.merge(left, right, "k", "k", how, least_heavy=10**6)
    assert rows(whole) == rows(merged)
    assert "_merge" not in reconcile.merge(left, right, "k", "k", how, indicator=False).columns


def test_without_heavy_keys_there_is_one_join(spark):
    left, right = frames(spark)
    plan = reconcile.merge(left, right, "k", "k", "outer")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Join FullOuter" in plan


def test_heavy_keys_are_found(spark):
    left, _ = frames(spark)
    found = heavy.heavy_keys(left, [F.col("k")], parts=8, least_rows=10)
    key = spark.createDataFrame([(7,)], "k int").select(F.xxhash64("k")).first()[0]
    assert found.get(key, 0) >= 4  # half of the rows by parts of an eighth
    assert heavy.heavy_keys(left, [F.col("k")], least_rows=302) == {}
    assert heavy.heavy_keys(left.limit(0), [F.col("k")], least_rows=1) == {}


def test_every_pair_of_rows_meets_once(spark):
    left, right = spark.range(50).selectExpr("1 AS k", "id AS x"), spark.range(30).selectExpr("1 AS k", "id AS y")
    merged = reconcile.merge(left, right, "k", "k", "outer", least_heavy=2)
    assert rows(merged.select("x", "y")) == Counter({(str(x), str(y)): 1 for x in range(50) for y in range(30)})


def test_keys_of_unlike_types_and_empty_sides(spark):
    left, right = frames(spark)
    wide = right.withColumn("k", F.col("k").cast("long"))
    assert not heavy.hashable(left, wide, ["k"], ["k"])
    merged = reconcile.merge(left, wide, "k", "k", "outer", least_heavy=10)
    assert rows(merged.select("k", "x", "_found", "y", "m", "_merge")) == plain(left, right, "outer")
    alone = reconcile.merge(left, right.limit(0), "k", "k", "outer", least_heavy=10)
    assert alone.count() == left.count() and alone.filter("_merge <> 'left_only'").isEmpty()
    assert reconcile.merge(left.limit(0), right.limit(0), "k", "k", "outer").isEmpty()
