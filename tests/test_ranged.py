import uuid

import pytest
from pyspark.sql import functions as F

from drover.operators.reconcile import CardinalityError
from drover.sinks.ranged import ConflictError, RangedTable


@pytest.fixture
def table(spark):
    made = RangedTable(spark, f"t{uuid.uuid4().hex}")
    yield made
    made.drop()


def rows(spark, count=1000):
    return spark.range(count).selectExpr("id * 2 AS id", "CONCAT('n', id) AS name", "id % 7 AS n").repartition(4)


def state(table):
    return {r.id: (r.name, r.n) for r in table.read().collect()}


def files(table, version=None):
    """The files of each range, by folder."""
    found = {}
    for r in table.read(version).select(F.col("_metadata.file_path")).distinct().collect():
        folder, _, name = r[0].rpartition("/")
        found.setdefault(folder.partition("/data/")[2], set()).add(name)
    return found


def test_update_rewrites_only_ranges_that_hold_its_keys(spark, table):
    first = table.create(rows(spark), "id", 100)
    assert len(first.ranges) == 10 and first.rows == 1000
    assert all(a.high < b.low for a, b in zip(first.ranges, first.ranges[1:]))
    before = files(table)
    low = first.ranges[3].low
    # 2001 lies beyond the last key, low + 1 between two keys: no row has them.
    changes = spark.createDataFrame([(low, "x"), (low + 2, None), (low + 1, "y"), (2001, "z"), (None, "w")], "id long, name string")
    second = table.update(changes, ["name"])
    after = files(table)
    untouched = {r.folder for r in first.ranges if r is not first.ranges[3]}
    assert {k: after[k] for k in untouched} == {k: before[k] for k in untouched}
    assert first.ranges[3].folder not in after and len(after) == 10 and second.rows == 1000
    expected = {2 * k: (f"n{k}", k % 7) for k in range(1000)}
    assert {r.id: (r.name, r.n) for r in table.read(first).collect()} == expected
    expected |= {low: ("x", expected[low][1]), low + 2: (None, expected[low + 2][1])}
    assert state(table) == expected
    assert table.version(0) == first and table.version() == second


def test_deletes_upserts_and_splits(spark, table):
    table.create(rows(spark), "id", 100)
    before = files(table)
    table.delete(spark.range(50).selectExpr("id AS gone"), "gone")
    assert table.version().rows == 975 and len(set(files(table)) & set(before)) == 9
    incoming = spark.createDataFrame([(-5, "new", 1), (51, "new", 2), (60, "known", 3), (None, "none", 4)], "id long, name string, n long")
    table.upsert(incoming)
    expected = {2 * k: (f"n{k}", k % 7) for k in range(25, 1000)}
    expected |= {-5: ("new", 1), 51: ("new", 2), 60: ("known", 3), None: ("none", 4)}
    assert state(table) == expected
    # Ascending keys all go to the last range, which is split.
    table.append(spark.range(5000, 5450).selectExpr("id", "'late' AS name", "id % 2 AS n"))
    version = table.version()
    assert version.rows == len(expected) + 450 and max(r.rows for r in version.ranges) <= 200
    bounded = [r for r in version.ranges if r.low is not None]
    assert all(a.high < b.low for a, b in zip(bounded, bounded[1:]))
    assert state(table) == expected | {k: ("late", k % 2) for k in range(5000, 5450)}
    # A key in a split range is found again.
    table.delete(spark.createDataFrame([(5300,)], "id long"))
    assert table.read().where("id = 5300").count() == 0 and table.version().rows == version.rows - 1


def test_conflicts_and_errors(spark, table):
    start = table.create(rows(spark, 100), "id", 10)
    one = spark.createDataFrame([(4, "x")], "id long, name string")
    table.update(one, ["name"])
    with pytest.raises(ConflictError):
        table.delete(one, start=start)
    assert table.version().number == 1 and table.read().count() == 100
    with pytest.raises(CardinalityError):
        table.append(spark.createDataFrame([(4, "x", 1)], "id long, name string, n long"))
    with pytest.raises(CardinalityError):
        table.update(one.union(one), ["name"])
    with pytest.raises(ValueError, match="exists"):
        table.create(rows(spark), "id")
    with pytest.raises(ValueError, match="no version"):
        table.version(9)
    # A manifest without its end is one that is being written.
    path, system = table._files("manifest/000000000002.json")
    out = system.create(path, False)
    out.write(b'{"key": "id"')
    out.close()
    assert table.version().number == 1


def test_hot_keys_text_keys_and_empty_tables(spark, table):
    hot = spark.range(600).selectExpr("IF(id < 400, 'hot', CONCAT('k', id)) AS id", "CAST(id AS string) AS name", "id AS n")
    made = table.create(hot, "id", 100)
    assert sum(r.low <= "hot" <= r.high for r in made.ranges) >= 4
    assert len(table.touched(spark.createDataFrame([("hot",)], "k string"), "k")) >= 4
    table.update(spark.createDataFrame([("hot", "x"), ("é\"", "no")], "id string, name string"), ["name"])
    assert table.read().where("name = 'x'").count() == 400 and table.read().count() == 600
    table.delete(spark.createDataFrame([("hot",)], "id string"))
    assert table.version().rows == 200
    table.delete(table.read().select("id"))
    assert table.version().rows == 0 and table.read().count() == 0 and table.version().ranges == ()
    table.upsert(spark.createDataFrame([("a", "b", 1)], "id string, name string, n long"))
    assert table.read().count() == 1


def test_removing_superseded(spark, table):
    table.create(rows(spark, 200), "id", 20)
    table.delete(spark.createDataFrame([(0,), (100,)], "id long"))
    table.append(spark.range(1000, 1100).selectExpr("id", "'' AS name", "id AS n"))
    before = state(table)
    kept = files(table)
    assert table.remove_superseded() > 0
    assert state(table) == before and files(table) == kept and table.remove_superseded() == 0
    with pytest.raises(ValueError):
        table.version(0)


def test_small_ranges_share_tasks_and_folders_are_found_by_halving(spark, table):
    first = table.create(rows(spark, 6000), "id", 10)
    # 600 ranges by 12 tasks; a task may leave a range that isn't full.
    assert 600 <= len(first.ranges) <= 612 and first.rows == 6000 and max(r.rows for r in first.ranges) == 10
    assert all(a.high < b.low for a, b in zip(first.ranges, first.ranges[1:]))
    assert {f.rpartition("-")[0][:10] for part in files(table).values() for f in part} == {f"part-{k:05d}" for k in range(12)}
    plans = []
    kept = table._write
    table._write = lambda df, *more: plans.append(df) or kept(df, *more)
    incoming = spark.range(0, 13000, 5).selectExpr("id", "CONCAT('u', id) AS name", "1L AS n")
    second = table.upsert(incoming)
    text = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at(" not in text and plans[0].rdd.getNumPartitions() == 13
    expected = {2 * k: (f"n{k}", k % 7) for k in range(6000)} | {k: (f"u{k}", 1) for k in range(0, 13000, 5)}
    assert state(table) == expected and second.rows == len(expected)
    assert max(r.rows for r in second.ranges) <= 20
    bounded = [r for r in second.ranges if r.low is not None]
    assert all(a.high < b.low for a, b in zip(bounded, bounded[1:]))
