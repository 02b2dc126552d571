import pytest

from drover.operators import dml
from drover.operators.reconcile import CardinalityError


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(1, "a", "p", 1.0), (2, "a", "q", 2.0), (3, "b", "r", 3.0), (4, None, "s", 4.0)],
        "id int, k string, v string, w double",
    )


def test_keyed_update(spark, target):
    changes = spark.createDataFrame(
        [(1, "a", "old", 7), (2, "a", "new", 8), (3, "b", None, 9), (4, "zz", "x", 1), (5, None, "y", 1)],
        "o int, k string, v string, w int",
    )
    got = dml.keyed_update(target, changes, "k", ["v"], order_by="o")
    assert rows(got) == [(1, "a", "new", 1.0), (2, "a", "new", 2.0), (3, "b", None, 3.0), (4, None, "s", 4.0)]
    assert got.schema == target.schema
    again = dml.keyed_update(got, changes, "k", ["v"], order_by="o")
    assert rows(again) == rows(got)
    with pytest.raises(CardinalityError):
        dml.keyed_update(target, changes, "k", ["v"])


def test_update_first_document(spark, target):
    changes = spark.createDataFrame(
        [("a", "A", 1), (None, "N", 2), ("zz", "Z", 3)], "k string, v string, extra int"
    )
    got = dml.update_first_document(target, changes, "k", "id")
    assert got.columns == ["id", "k", "v", "w", "extra"]
    assert rows(got) == [
        (1, "a", "A", 1.0, 1), (2, "a", "q", 2.0, None), (3, "b", "r", 3.0, None), (4, None, "N", 4.0, 2),
    ]


def test_deletes(spark, target):
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [r[0] for r in rows(dml.delete_keys(target, keys, "k"))] == [3, 4]
    assert [r[0] for r in rows(dml.delete_documents(target, keys, "k"))] == [3]
    assert [r[0] for r in rows(dml.delete_where(target, "k", "a"))] == [3, 4]
    assert [r[0] for r in rows(dml.delete_where(target, "k", None))] == [1, 2, 3]


@pytest.mark.parametrize("chunk", [2, 1000])
def test_delete_one_each(spark, target, chunk):
    keys = spark.createDataFrame([("a",), (None,), (None,), ("zz",)], "k string")
    got = dml.delete_one_each(target, keys, "k", "id", rows_per_chunk=chunk)
    assert [r[0] for r in rows(got)] == [2, 3]
    none = spark.createDataFrame([], "k string")
    assert rows(dml.delete_one_each(target, none, "k", "id")) == rows(target)


def test_delete_and_kept_make_the_whole(spark, target):
    keys = spark.createDataFrame([("a",)], "k string")
    from drover.operators.reconcile import with_keys

    kept, gone = dml.delete_keys(target, keys, "k"), with_keys(target, keys, "k")
    assert rows(kept.union(gone)) == rows(target)


def test_upsert(spark, target):
    incoming = spark.createDataFrame(
        [("a", "A1", 1), ("a", "A2", 2), ("n", "N", 3), (None, "X", 4), (None, "Y", 5)],
        "k string, v string, o int",
    )
    got = dml.upsert(target, incoming, "k", order_by="o")
    assert got.columns == ["id", "k", "v", "w", "RESULTS_created"]
    assert rows(got) == sorted(
        [
            (1, "a", "A2", 1.0, False), (2, "a", "A2", 2.0, False), (3, "b", "r", 3.0, None),
            (4, None, "s", 4.0, None), (None, "n", "N", None, True), (None, None, "X", None, True),
            (None, None, "Y", None, True),
        ],
        key=str,
    )


def test_unknown_columns_raise(spark, target):
    odd = spark.createDataFrame([("a", "x")], "k string, other string")
    for change in (
        lambda: dml.upsert(target, odd, "k"),
        lambda: dml.append_rows(target, odd),
        lambda: dml.keyed_update(target, odd, "k", ["other"]),
    ):
        with pytest.raises(ValueError, match="other"):
            change()


def test_append_and_matched(spark, target):
    new = spark.createDataFrame([("z", 9, 0.5, "t")], "k string, id int, w double, v string")
    assert rows(dml.append_rows(target, new))[-1] == (9, "z", "t", 0.5)
    got = dml.matched_updates(target, new.union(new), ["id"], ["id"], "id", {"Type": "Prospect"})
    assert rows(got) == []


def test_keys_of_other_types(spark, target):
    changes = spark.createDataFrame([(1, "new"), (9, "none")], "id bigint, v string")
    got = dml.keyed_update(target, changes, "id", ["v"])
    assert [r["v"] for r in got.orderBy("id").collect()] == ["new", "q", "r", "s"]
    assert [r["id"] for r in rows_of(dml.delete_keys(target, changes, "id"))] == [2, 3, 4]
    decimals = changes.selectExpr("CAST(id AS decimal(12,2)) AS id")
    assert [r["id"] for r in rows_of(dml.delete_documents(target, decimals, "id"))] == [2, 3, 4]
    assert dml.upsert(target.drop("w"), changes, "id").filter("RESULTS_created").count() == 1


def rows_of(df):
    return sorted(df.collect(), key=str)
