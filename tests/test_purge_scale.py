"""A purge goes over each object once for each step, however many steps lie before it."""

from pyspark.sql import functions as F

from drover.operators.outcomes import outcomes, perform
from drover.plans import change

FLAG = "Migrated_Record__c boolean"


def relations(df, column):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum("Relation [" in line and f"{column}#" in line for line in plan.splitlines())


def stored(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.schema(schema).parquet(str(path))


def test_outcomes_read_the_target_once(spark, tmp_path):
    target = stored(spark, tmp_path / "t", [(k, "x") for k in (1, 2, 2, 3, None)], "Id long, other string")
    rows = stored(spark, tmp_path / "r", [(1,), (2,), (3,), (3,), (4,), (None,)], "Id long")
    found = outcomes("delete", rows, target, "Id")
    assert relations(found, "other") == 1
    got = sorted((str(r.Id), r.RESULTS_success, r.RESULTS_errors) for r in found.collect())
    assert got == [
        ("1", True, None), ("2", True, None), ("3", False, "duplicate_key"), ("3", False, "duplicate_key"),
        ("4", False, "unknown_key"), ("None", False, "null:Id"),
    ]
    left = perform("delete", target, rows, "Id").state
    assert sorted(str(r.Id) for r in left.collect()) == ["3", "None"]


def test_keys_of_another_type(spark):
    target = spark.createDataFrame([(1,), (2,)], "Id int")
    rows = spark.createDataFrame([(1,), (3,), (3,), (1 << 40,)], "Id long")
    found = {(r.Id, r.RESULTS_errors) for r in outcomes("insert", rows, target, "Id").collect()}
    assert found == {(1, "key_exists"), (3, "duplicate_key"), (1 << 40, None)}


def test_children_are_found_by_the_stored_ids_of_their_parent(spark, tmp_path):
    tables = {
        "quotes": stored(spark, tmp_path / "q", [("q1", True), ("q2", False), ("q3", None)], f"Id string, {FLAG}"),
        "orders": stored(spark, tmp_path / "o", [("r1", "q1"), ("r2", "q2"), ("r3", None)], "Id string, QuoteId string"),
        "contracts": stored(spark, tmp_path / "c", [("k1", "r1"), ("k2", "r2"), ("k3", "r1")], "Id string, OrderId string"),
        "lines": stored(spark, tmp_path / "l", [("s1", "k1"), ("s2", "k2"), ("s3", "k3")], "Id string, ContractId string"),
    }
    hops = (("ContractId", "contracts"), ("OrderId", "orders"), ("QuoteId", "quotes"))
    purges = [change.Purge("quotes"), change.Purge("orders", hops[2:]), change.Purge("contracts", hops[1:]), change.Purge("lines", hops)]
    selected = []
    kept = change.stage
    try:
        change.stage = lambda df, purpose: selected.append(df) or kept(df, purpose)
        done = change.purge_states(tables, purges)
    finally:
        change.stage = kept
    # The last one reads its own rows and its parents' ids, not the whole path once more.
    assert relations(selected[-1], "QuoteId") == relations(selected[-1], "OrderId") == 0
    left = {name: sorted(r.Id for r in applied.state.collect()) for name, applied in done.items()}
    assert left == {"lines": ["s2"], "contracts": ["k2"], "orders": ["r2", "r3"], "quotes": ["q2", "q3"]}
    # A purge whose parent isn't purged itself still goes up the whole path.
    alone = change.purge_states(tables, [purges[-1]])["lines"].state
    assert [r.Id for r in alone.filter(F.col("Id") != "s2").collect()] == []
