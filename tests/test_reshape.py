import pytest

from drover.operators import keylists, reshape


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_projection(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, `b.c` string, d double")
    assert reshape.keep(df, ["b.c", "a"]).columns == ["b.c", "a"]
    assert reshape.discard(df, ["b.c"]).columns == ["a", "d"]
    with pytest.raises(ValueError):
        reshape.discard(df, ["zz"])
    assert reshape.discard(df, ["zz", "a"], strict=False).columns == ["b.c", "d"]
    assert reshape.rename(df, {"a": "A"}).columns == ["A", "b.c", "d"]
    assert reshape.add_prefix(df, "R_").columns == ["R_a", "R_b.c", "R_d"]
    assert tuple(reshape.add_literals(df, {"f": True, "d": "s"}).first()) == (1, "x", "s", True)


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, n string")
    b = spark.createDataFrame([("y", 2, 0.5)], "n string, id int, w double")
    assert rows(reshape.union_all([a, b, a])) == [(1, "x", None), (1, "x", None), (2, "y", 0.5)]


def test_flatten(spark):
    schema = """Id string, attributes struct<type: string, url: string>,
        Account struct<attributes: struct<type: string>, Name: string,
                       Owner: struct<attributes: struct<type: string>, Name: string>>,
        tags array<struct<a: int>>, Amount double"""
    df = spark.createDataFrame(
        [("1", ("t", "u"), (("t",), "Acme", (("t",), "Jo")), [(1,)], 2.0), ("2", None, None, None, None)],
        schema,
    )
    flat = reshape.flatten(df)
    assert flat.columns == ["Id", "tags", "Amount", "Account.Name", "Account.Owner.Name"]
    assert [tuple(r)[3:] for r in flat.collect()] == [("Acme", "Jo"), (None, None)]
    assert reshape.flatten(flat).columns == flat.columns


def test_slices(spark, monkeypatch):
    df = spark.range(5).withColumnRenamed("id", "k").repartition(3)
    assert rows(reshape.slice_rows(df, "k", 3, 10)) == [(3,), (4,)]
    assert rows(reshape.slice_rows(df, "k", 9, 10)) == []
    monkeypatch.setattr(reshape, "TOP_K_LIMIT", 0)
    assert rows(reshape.slice_rows(df, "k", 3, 10)) == [(3,), (4,)]
    assert rows(reshape.slice_rows(df, "k", 1, 2)) == [(1,), (2,)]


def test_zip_and_renumber(spark):
    a = spark.createDataFrame([("x",), ("z",), ("y",)], "a string")
    b = spark.createDataFrame([(5,), (4,)], "b int")
    assert rows(reshape.zip_rows(a, b, "a", "b")) == [("x", 4), ("y", 5)]
    assert rows(reshape.zip_rows(a, b, "a", "b", how="left", index="i")) == [(0, "x", 4), (1, "y", 5), (2, "z", None)]
    with pytest.raises(ValueError):
        reshape.zip_rows(a, a, "a", "a")
    files = spark.createDataFrame([("f2", 1, "c"), ("f1", 2, "b"), ("f1", 1, "a")], "f string, id int, v string")
    got = reshape.renumber(files, ["f", "id"])
    assert {(r["v"], r["id"]) for r in got.collect()} == {("a", 1), ("b", 2), ("c", 3)}


def test_key_lists(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("it's",)], "k string")
    parts = keylists.in_lists(df, "k", per_list=2, rows_per_chunk=1)
    assert rows(parts) == [(0, "('a','b')"), (1, "('it''s')")]
    numbers = keylists.in_lists(spark.range(12), "id", per_list=5)
    assert rows(numbers)[0] == (0, "('0','1','2','3','4')")
