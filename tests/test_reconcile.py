import pandas as pd
import pytest
from pyspark.sql import functions as F

from drover.operators import reconcile
from drover.operators.reconcile import CardinalityError, diff, merge

LEFT = [("a", 1), (None, 2), ("b", 3), ("b", 4)]
RIGHT = [("a", 10), (None, 20), ("c", 30)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def frames(spark):
    return (
        spark.createDataFrame(LEFT, "k string, v int"),
        spark.createDataFrame(RIGHT, "j string, v int"),
    )


def expected(how, left_on="k", right_on="j", right="j"):
    left = pd.DataFrame(LEFT, columns=["k", "v"])
    other = pd.DataFrame(RIGHT, columns=[right, "v"])
    merged = left.merge(
        other, how=how, left_on=left_on, right_on=right_on, suffixes=("_left", "_right"), indicator=True
    ).astype(object)
    merged = merged.where(merged.notnull(), None)
    plain = [
        tuple(int(v) if isinstance(v, float) else v for v in r)
        for r in merged.itertuples(index=False)
    ]
    return list(merged.columns), sorted(plain, key=str)


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_merge_like_pandas(frames, how):
    got = merge(*frames, "k", "j", how=how)
    columns, want = expected(how)
    assert got.columns == columns
    assert rows(got) == want


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_merge_on_one_name(frames, how):
    left, right = frames
    got = merge(left, right.withColumnRenamed("j", "k"), "k", "k", how=how)
    columns, want = expected(how, right_on="k", right="k")
    assert got.columns == columns
    assert rows(got) == want


@pytest.mark.parametrize("how,validate", [("left", "m:1"), ("right", "m:1"), ("outer", "m:1")])
def test_validated_merge_gives_the_same_rows(frames, how, validate):
    assert rows(merge(*frames, "k", "j", how=how, validate=validate)) == rows(
        merge(*frames, "k", "j", how=how)
    )


def test_right_join_on_unique_left(frames):
    left, right = frames
    got = merge(right, left, "j", "k", how="right", validate="1:m")
    assert rows(got) == rows(merge(right, left, "j", "k", how="right"))


def test_merge_with_itself(frames):
    left, _ = frames
    got = merge(left, left, "k", "k", how="outer")
    assert got.columns == ["k", "v_left", "v_right", "_merge"]
    assert got.count() == 6
    assert got.filter("_merge <> 'both'").count() == 0


def test_names_with_dots(spark):
    left = spark.createDataFrame([(1, "x")], "`a.id` int, `b.c` string")
    got = merge(left, left, "a.id", "a.id", how="outer", indicator=False)
    assert got.columns == ["a.id", "b.c_left", "b.c_right"]
    assert rows(got) == [(1, "x", "x")]


def test_diff_parts_add_up(frames):
    left, right = frames
    parts = diff(left, right, "k", "j")
    whole = merge(left, right, "k", "j", how="outer")
    for part, name in zip(parts, ("both", "left_only", "right_only")):
        assert rows(part) == rows(reconcile.only_part(whole, name))
    assert diff(left, right, "k", "j", drop_provenance=True).both.columns == [
        "k", "v_left", "j", "v_right",
    ]


def test_diff_on_two_keys(spark):
    left = spark.createDataFrame([(1, None, "x"), (1, 2, "y")], "a int, b int, c string")
    right = spark.createDataFrame([(1, None), (2, 2)], "a int, d int")
    parts = diff(left, right, ["a", "b"], ["a", "d"])
    assert rows(parts.both) == [(1, None, "x", None, "both")]
    assert rows(parts.left_only) == [(1, 2, "y", None, "left_only")]
    assert rows(parts.right_only) == [(2, None, None, 2, "right_only")]


def test_cardinality(frames):
    left, right = frames
    merge(left, right, "k", "j", validate="m:1")
    with pytest.raises(CardinalityError):
        merge(left, right, "k", "j", validate="1:1")
    with pytest.raises(CardinalityError):
        merge(right, left, "j", "k", validate="one_to_one")
    with pytest.raises(ValueError):
        merge(left, right, "k", "j", validate="2:1")


def test_outer_with_a_unique_side(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([("a", 10), ("c", 30), (None, 40)], "k string, w int")
    plain = rows(merge(left, right, "k", "k", how="outer"))
    assert rows(merge(left, right, "k", "k", how="outer", validate="m:1")) == plain
    other = [(k, w, v, m.replace("left", "x").replace("right", "left").replace("x", "right")) for k, v, w, m in plain]
    assert rows(merge(right, left, "k", "k", how="outer", validate="1:m")) == sorted(other, key=str)


def test_no_cross_join_and_no_column_twice(spark, frames):
    left, right = frames
    with pytest.raises(ValueError, match="unknown join"):
        merge(left, right, "k", "j", how="cross")
    tagged = spark.createDataFrame([("a", "x")], "k string, _merge string")
    with pytest.raises(ValueError, match="_merge"):
        merge(tagged, right, "k", "j")
    assert "_merge" in merge(tagged, right, "k", "j", indicator=False).columns
    with pytest.raises(ValueError, match="twice"):
        merge(
            spark.createDataFrame([(1, 1, 1)], "k int, v int, v_left int"),
            spark.createDataFrame([(1, 1)], "k int, v int"), "k", "k",
        )


def test_key_lists_and_null(frames):
    left, right = frames
    keys = right.withColumnRenamed("j", "k")
    assert rows(reconcile.with_keys(left, keys, "k")) == [("a", 1)]
    assert rows(reconcile.without_keys(left, keys, "k")) == [("b", 3), ("b", 4), (None, 2)]
    assert rows(reconcile.without_keys(left, keys, "k", nulls_match=True)) == [("b", 3), ("b", 4)]
    assert rows(reconcile.net_new(left, right, "k", "j")) == [("b", 3), ("b", 4)]


def test_lookup_filter(spark):
    quotes = spark.createDataFrame([(1, True), (2, False), (3, None)], "Id int, flag boolean")
    orders = spark.createDataFrame([(10, 1), (20, 2), (30, 3), (40, None)], "Id int, QuoteId int")
    contracts = spark.createDataFrame([(100, 10), (200, 20), (300, 40), (400, None)], "Id int, OrderId int")
    got = reconcile.filter_by_lookup(
        contracts, [("OrderId", orders, "Id"), ("QuoteId", quotes, "Id")], F.col("flag")
    )
    assert rows(got) == [(100, 10)]


def test_visible(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, gone boolean")
    assert [r[0] for r in rows(reconcile.visible(df, "gone"))] == [2, 3]
    assert reconcile.visible(df, "gone", include_deleted=True).count() == 3


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), (None, 1, "z"), ("b", 1, None)], "k string, o int, v string"
    )
    assert rows(reconcile.first_per_key(df, "k", "o")) == [("a", 1, "y"), ("b", 1, None), (None, 1, "z")]
    assert rows(reconcile.last_per_key(df, "k", "o", ["v"])) == [("a", "x"), ("b", None), (None, "z")]
    assert rows(reconcile.first_per_key(df, ["k", "o", "v"], "o")) == rows(df)
