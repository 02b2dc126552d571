import uuid

import pytest

from drover.sinks import bucketed


@pytest.fixture
def table(spark):
    made = []

    def make(rows, schema, key, buckets=4):
        name = f"b{uuid.uuid4().hex}"
        made.append(bucketed.write_bucketed(spark.createDataFrame(rows, schema).repartition(3), name, key, buckets))
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


SCHEMA = "id long, part string, v int, _many int"


@pytest.fixture
def pair(table):
    rows = [(k, f"p{k % 3}", k, 0) for k in range(50)] + [(7, "p1", -1, 0), (None, "p", 1, 0), (8, None, 2, 0), (8, None, 3, 0)]
    staging = table(rows, SCHEMA, ["id", "part"])
    target = table([(k, f"p{k % 3}", k) for k in range(40, 60)] + [(3, "other", 0), (None, "p", 0)], "pk long, b string, w int", ["pk", "b"])
    return rows, staging, target


def test_net_new_known_and_deleted_without_a_shuffle(spark, pair):
    rows, staging, target = pair
    held = {(k, f"p{k % 3}") for k in range(40, 60)} | {(3, "other")}
    new, known = bucketed.net_new_rows(spark, staging, target), bucketed.known_rows(spark, staging, target)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, new.collect())) == sorted(key(r) for r in rows if r[:2] not in held)
    assert sorted(map(key, known.collect())) == sorted(key(r) for r in rows if r[:2] in held)
    for df in (new, known, bucketed.without_listed(spark, staging, target)):
        text = plan(df)
        assert "Exchange" not in text and "SortMergeJoin" in text


def test_key_check_without_a_shuffle(spark, pair):
    rows, staging, target = pair
    found = bucketed.check_keys(spark, staging, target)
    assert found.columns == ["id", "part", "v", "_many", "reject_reasons"] and "Exchange" not in plan(found)
    reasons = {(r.id, r.part, r.v): r.reject_reasons for r in found.collect()}
    assert len(reasons) == len(rows)
    for k, part, v, _ in rows:
        want = [f"null:{c}" for c, x in (("id", k), ("part", part)) if x is None]
        want += ["duplicate_key"] if (k, part) == (7, "p1") else []
        want += ["key_exists"] if k is not None and k >= 40 else []
        assert reasons[k, part, v] == want


def test_tables_that_do_not_fit_raise(spark, table, pair):
    _, staging, _ = pair
    other = table([(1, "a")], "id long, part string", ["id", "part"], 8)
    text = table([("1", "a")], "id string, part string", ["id", "part"])
    for name in (other, text, table([(1,)], "id long", "id")):
        with pytest.raises(ValueError):
            bucketed.net_new_rows(spark, staging, name)
    with pytest.raises(ValueError):
        bucketed.write_bucketed(spark.range(1), "none", "k")
    assert bucketed.bucketing(spark, staging) == (4, ["id", "part"])


def test_empty_tables(spark, table):
    empty, one = table([], "id long", "id"), table([(1,), (2,)], "id long", "id")
    assert bucketed.net_new_rows(spark, one, empty).count() == 2
    assert bucketed.net_new_rows(spark, empty, one).count() == 0
    assert bucketed.check_keys(spark, empty, one).count() == 0


def test_buckets_follow_the_rows(spark):
    few, many = spark.range(10), spark.range(1001)
    assert bucketed.buckets_for(few, many, rows_per_bucket=100) == bucketed.buckets_for(many, rows_per_bucket=100) == 11
    assert bucketed.buckets_for(few, least=8) == 8 and bucketed.buckets_for(spark.range(0)) == 1
    assert bucketed.buckets_for(spark.range(50_000_000)) == 100


def test_key_check_sorts_each_bucket_once(spark, pair):
    _, staging, target = pair
    text = plan(bucketed.check_keys(spark, staging, target)).partition("== Initial Plan")[0]
    # One sort of the rows, for their count and their join, and one of the known keys.
    assert text.count("Sort [") == 2 and text.count("SortMergeJoin") == 1
