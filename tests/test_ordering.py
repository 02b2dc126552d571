import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from drover.operators import chunks
from drover.operators.ordering import (
    in_order,
    rank_in_group,
    rows_between,
    running_sums,
    with_row_index,
)


def nulls_first(value):
    return (value is not None, value)


@pytest.fixture(scope="module")
def rows(spark):
    """500 rows; group 'hot' holds a third of them, and some keys are NULL."""
    rng = random.Random(3)
    data = []
    for i in range(500):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, ""])
        data.append((i, group, rng.randrange(-50, 50), rng.choice([None, 1.5, -2.0])))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "id int, g string, v int, d double").repartition(5)


@pytest.mark.parametrize("chunk", [7, 60, 10_000])
def test_row_index(rows, chunk):
    data, df = rows
    got = with_row_index(df, ["g", "d", "id"], "at", start=1, rows_per_chunk=chunk)
    want = sorted(data, key=lambda r: [nulls_first(r[1]), nulls_first(r[3]), r[0]])
    assert {r["id"]: r["at"] for r in got.collect()} == {r[0]: i + 1 for i, r in enumerate(want)}


@pytest.mark.parametrize("chunk", [7, 60, 10_000])
def test_rank_in_group(rows, chunk):
    data, df = rows
    got = rank_in_group(df, "g", ["v", "id"], "n", rows_per_chunk=chunk)
    want, seen = {}, {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        seen[r[1]] = seen.get(r[1], 0) + 1
        want[r[0]] = seen[r[1]]
    assert {r["id"]: r["n"] for r in got.collect()} == want


@pytest.mark.parametrize("chunk", [7, 10_000])
def test_running_sums(rows, chunk):
    data, df = rows
    got = running_sums(df, "id", {"total": "v"}, rows_per_chunk=chunk)
    want, total = {}, 0
    for r in sorted(data):
        total += r[2]
        want[r[0]] = total
    assert {r["id"]: r["total"] for r in got.collect()} == want


@pytest.mark.parametrize("start,stop", [(0, 3), (100, 180), (490, 600), (600, 700), (20, 20)])
def test_rows_between(rows, start, stop):
    data, df = rows
    want = [r[0] for r in sorted(data, key=lambda r: [nulls_first(r[1]), r[0]])][start:stop]
    for chunk in (7, 10_000):
        got = rows_between(df, ["g", "id"], start, stop, rows_per_chunk=chunk)
        assert sorted(r["id"] for r in got.collect()) == sorted(want)


def test_hot_group_is_spread_over_chunks(spark):
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id"
    )
    ordered = in_order(df, ["g", "id"], rows_per_chunk=100)
    sizes = ordered.rows.groupBy(ordered.chunk).count().collect()
    assert len(sizes) > 20
    assert max(r["count"] for r in sizes) < 400


def test_chunks_have_no_upper_limit(spark):
    ordered = in_order(spark.range(20_000), "id", rows_per_chunk=8)
    assert ordered.rows.select(ordered.chunk).distinct().count() > 2_000


@pytest.mark.parametrize(
    "kind,make",
    [
        ("decimal(12,3)", lambda i: Decimal(i - 40) / 8),
        ("date", lambda i: date.fromordinal(730_000 + i)),
        ("timestamp", lambda i: datetime(2024, 3, 30, i % 24, i % 60, 1, i)),
        ("timestamp_ntz", lambda i: datetime(2024, 3, 30, i % 24, i % 60, 1, i)),
        ("double", lambda i: float("nan") if i == 7 else (i - 40) * 1e10 / 3),
        ("boolean", lambda i: bool(i % 2)),
        ("string", lambda i: 'a"\\' + chr(200 + i)),
    ],
)
def test_key_types(spark, kind, make):
    data = [(i, make(i) if i % 10 else None) for i in range(80)]
    df = spark.createDataFrame(data, f"id int, k {kind}").repartition(3)
    got = with_row_index(df, ["k", "id"], "at", rows_per_chunk=6)
    whole = with_row_index(df, ["k", "id"], "at")
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_struct_keys_and_taken_names(spark):
    names = "id int, _chunk int, _place int, _before string, _rn int, _rows int, _carried int, _group0 int, _other int"
    data = [(i, *[i % 3] * 2, "x", *[i % 5] * 5) for i in range(90)]
    df = spark.createDataFrame(data, names).withColumn("k", F.struct(F.lit(1).alias("a"), "id"))
    got = with_row_index(df, "k", "at", rows_per_chunk=7).collect()
    assert all(r["at"] == r["id"] and r["_before"] == "x" for r in got) and len(got) == 90
    ranks = rank_in_group(df, "_chunk", "k", "n", rows_per_chunk=7).collect()
    assert all(r["n"] == r["id"] // 3 + 1 for r in ranks) and len(ranks) == 90
    sums = running_sums(df, "k", {"total": "_rows"}, rows_per_chunk=7).collect()
    assert all(r["total"] == sum(i % 5 for i in range(r["id"] + 1)) for r in sums)


def test_ties_keep_one_order_for_good(spark):
    df = spark.range(1_000).select((F.col("id") % 3).alias("k"), "id").repartition(9)
    indexed = with_row_index(df, "k", "at", rows_per_chunk=50)
    once, again = sorted(indexed.collect()), sorted(indexed.collect())
    assert once == again and sorted(r["at"] for r in once) == list(range(1_000))


def test_empty(spark):
    df = spark.createDataFrame([], "g string, id int")
    assert with_row_index(df, "id").count() == 0
    assert rank_in_group(df, "g", "id").count() == 0
    assert rows_between(df, "id", 0, 5).count() == 0


def test_carries_in_a_tree(spark, rows, monkeypatch):
    """Windows over three chunks each give what one window over all of them gives."""
    monkeypatch.setattr(chunks, "FANOUT", 3)
    monkeypatch.setattr(chunks, "BROADCAST_CHUNKS", 5)
    test_row_index(rows, 7)
    test_rank_in_group(rows, 7)
    test_running_sums(rows, 7)


def test_running_sums_of_all_kinds_and_nulls(spark):
    data = [(i, None if i < 25 or i % 3 else i, None if i % 4 else Decimal(i) / 8, None if i < 40 else i / 4) for i in range(90)]
    df = spark.createDataFrame(data, "id int, a int, b decimal(10,3), c double").repartition(4)
    sums = {"x": "a", "y": "b", "z": "c"}
    got = running_sums(df, "id", sums, rows_per_chunk=8)
    kinds = df.agg(*[F.sum(c).alias(n) for n, c in sums.items()]).schema
    assert [got.schema[n].dataType for n in sums] == [kinds[n].dataType for n in sums]
    found = {r["id"]: (r["x"], r["y"], r["z"]) for r in got.collect()}
    for i in range(90):
        for k in (1, 2, 3):
            known = [r[k] for r in data[: i + 1] if r[k] is not None]
            assert found[i][k - 1] == (sum(known) if known else None)


def test_one_shuffle_and_no_window_for_the_rows(spark, rows, monkeypatch):
    """What is stored comes from one range shuffle; what is read back is joined to one row per chunk."""
    _, df = rows
    plans = []
    real = chunks.stage

    def noted(frame, purpose="stage"):
        plans.append(frame._jdf.queryExecution().toString())
        return real(frame, purpose)

    monkeypatch.setattr(chunks, "stage", noted)
    for made in (rank_in_group(df, "g", "v", "n", 60), running_sums(df, "id", {"t": "v"}, 60), with_row_index(df, "id")):
        stored = plans.pop().partition("== Physical Plan ==")[2]
        assert stored.count("Exchange rangepartitioning") <= 1 and "hashpartitioning" not in stored and "Window" not in stored
        read = made._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(id" not in read and read.count("BroadcastHashJoin") >= 1
    assert not plans


def test_hot_key_is_spread_by_the_rest_of_the_row(spark):
    df = spark.range(3_000).select(F.lit(1).alias("k"), "id")
    ordered = in_order(df, "k", rows_per_chunk=100)
    assert max(r["count"] for r in ordered.rows.groupBy(ordered.chunk).count().collect()) < 400


@pytest.mark.parametrize("start,stop", [(0, 5), (97, 113), (295, 400), (-5, 3)])
def test_slices_of_ties_and_nulls(spark, start, stop):
    """Equal keys are never cut apart by the ranges, whatever their values."""
    data = [(None if i % 7 == 0 else float("nan") if i % 5 == 0 else float(i % 40), "x" * (i % 3) if i % 4 else None, i) for i in range(300)]
    df = spark.createDataFrame(data, "d double, s string, id int").repartition(4)
    whole = {r["id"]: r["at"] for r in with_row_index(df, ["d", "s", "id"], "at").collect()}
    got = rows_between(df, ["d", "s", "id"], start, stop, rows_per_chunk=9)
    assert sorted(whole[r["id"]] for r in got.collect()) == list(range(max(start, 0), min(stop, 300)))
    assert rows_between(df, ["d", "s"], start, stop, rows_per_chunk=9).count() == min(stop, 300) - max(start, 0)


def test_a_deep_slice_stores_only_what_it_touches(spark, monkeypatch):
    sizes = []
    real = chunks.stage

    def noted(frame, purpose="stage"):
        stored = real(frame, purpose)
        sizes.append(stored.count())
        return stored

    monkeypatch.setattr(chunks, "stage", noted)
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k"), "id").repartition(5)
    want = sorted(r[0] for r in df.select("k").collect())[12_000:12_100]
    assert sorted(r["k"] for r in rows_between(df, "k", 12_000, 12_100, rows_per_chunk=500).collect()) == want
    assert sizes and max(sizes) < 2_500
