"""Whole jobs on small tables with the layout of the real ones."""

import random
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from offline import offline_submitter
from pyspark.sql import functions as F

from drover.operators import submit
from drover.plans import change, load, prepare
from drover.schemas import ACCOUNTS, SOURCE_TABLES, STAGING_TABLES
from drover.sinks import tables
from drover.streaming.landing import land_target_keys, net_new_stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def accounts(spark):
    data = [
        (i, f"555-000-{i:04}", f"Company {i}", "Tech" if i % 2 else None, Decimal(i * 1000) + Decimal("0.75"),
         f"acct-{i}", i, None if i == 4 else i * 2, ["Gold", "Silver"][i % 2], 30_000 + i)
        for i in range(1, 9)
    ]
    schema = "id int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ACCOUNTS.schema.fields)
    return spark.createDataFrame(data, schema)


def test_contacts(spark, accounts):
    parts = [
        spark.createDataFrame([(i, f"F{p}{i}", "L", "e", "t", "d", "l") for i in (1, 2, 99)],
                              "id int, first_name string, last_name string, email string, title string, department string, languages string")
        for p in (1, 2, 3)
    ]
    got = prepare.contacts_with_accounts(accounts, parts)
    assert sorted(got.columns) == sorted(SOURCE_TABLES["contacts"].columns)
    assert {(r["first_name"], r["account_number_external_id"]) for r in got.collect()} == {
        (f"F{p}{i}", f"acct-{i}") for p in (1, 2, 3) for i in (1, 2)
    }


def test_contracts(spark, accounts):
    part = spark.createDataFrame([(1, "c1", "2024-02-29"), (2, "c2", "2023-03-01")], "id int, contract_number string, start_date string")
    got = {r["contract_number"]: r for r in prepare.contracts_with_accounts(accounts, [part]).collect()}
    assert got["c1"]["end_date"] == date(2025, 2, 27) and got["c2"]["end_date"] == date(2024, 2, 29)
    assert got["c2"]["account_number_external_id"] == "acct-2"


def test_contract_lines(spark, accounts):
    contracts = spark.createDataFrame([(f"acct-{i}", f"c{i}") for i in (1, 2, 3)], "account_number_external_id string, contract_number string")
    generators = spark.createDataFrame(
        [("f2", 1, "g3", "diesel", None), ("f1", 1, "g1", "gas", "5kw"), ("f1", 2, "g2", None, "7kw"), ("f3", 1, "g4", "x", "y")],
        "file string, id int, contract_line_number string, gen_type string, gen_type_capacity string")
    installations = spark.createDataFrame([("f1", i, f"i{i}", None if i == 2 else "roof") for i in (1, 2)],
                                          "file string, id int, contract_line_number string, installation string")
    levels = spark.createDataFrame([("f1", i, f"s{i}") for i in (1, 2, 3)], "file string, id int, contract_line_number string")
    got = prepare.contract_lines(accounts, contracts, generators, installations, levels, line_order=["file", "id"])
    assert got.columns == ["contract_line_number", "contract_number", "product", "quantity"]
    assert rows(got) == sorted([
        ("g1", "c1", "gas-5kw", 1), ("g2", "c2", "-7kw", 1), ("g3", "c3", "diesel-", 1),
        ("i1", "c1", "install - roof", 1), ("i2", "c2", None, 1),
        ("s1", "c1", "sla - Silver", 1), ("s2", "c2", "sla - Gold", 1), ("s3", "c3", "sla - Silver", 1),
    ], key=str)


def test_load_and_stage(spark, accounts):
    source = tables.create_table(spark, SOURCE_TABLES["accounts"], "j_accounts")
    load.load_source(accounts, "accounts", source)
    assert spark.table(source).filter("industry = ''").count() == 4
    staged = tables.create_table(spark, STAGING_TABLES["accounts"], "j_staged")
    with pytest.raises(ValueError, match="null:number_of_employees"):
        load.source_to_staging(spark, "accounts", source, staged)
    rejected = load.source_to_staging(spark, "accounts", source, staged, mode="quarantine")
    assert [r["account_number_external_id"] for r in rejected.collect()] == ["acct-4"]
    assert spark.table(staged).count() == 7
    load.source_to_staging(spark, "accounts", source, staged, mode="quarantine", recreate=True)
    assert spark.table(staged).count() == 7


def test_net_new_accounts(spark, accounts, tmp_path):
    staged = load.staged_rows(load.source_rows(accounts), "accounts").na.fill(0)
    target = spark.createDataFrame(
        [("sf1", "acct-1", True), ("sf2", "acct-2", False), ("sf3", None, True)],
        "Id string, Account_Number_External_ID__c string, Migrated_Record__c boolean",
    )
    check = offline_submitter("Account_Number_External_ID__c", refuse=("Name", ["Company 8"]))
    outcome = change.insert_new_accounts(staged, target, check, str(tmp_path), "run")
    sent = {r["Account_Number_External_ID__c"]: r for r in outcome.success.collect()}
    assert set(sent) == {f"acct-{i}" for i in (2, 3, 4, 5, 6, 7)}
    assert sent["acct-3"]["AnnualRevenue"] == 3000 and sent["acct-3"]["Migrated_Record__c"] is True
    assert [r["Name"] for r in outcome.fallout.collect()] == ["Company 8"]
    nothing = change.insert_new_accounts(
        staged, target.limit(0), check, str(tmp_path), "all"
    )
    assert nothing.success.count() + nothing.fallout.count() == 8


@pytest.fixture(scope="module")
def objects(spark):
    def frame(data, columns):
        return spark.createDataFrame(data, columns)

    flagged = "Id string, Migrated_Record__c boolean"
    return {
        "accounts": frame([("a1", True), ("a2", False), ("a3", None)], flagged),
        "contacts": frame([("c1", "a1"), ("c2", "a2"), ("c3", None)], "Id string, AccountId string"),
        "opportunities": frame([("o1", "a1"), ("o2", "a3")], "Id string, AccountId string"),
        "quotes": frame([("q1", True), ("q2", False)], flagged),
        "quote_lines": frame([("ql1", True), ("ql2", False)], flagged),
        "orders": frame([("r1", "q1"), ("r2", "q2")], "Id string, QuoteId string"),
        "order_lines": frame([("rl1", True)], flagged),
        "contracts": frame([("k1", "r1"), ("k2", "r2"), ("k3", None)], "Id string, OrderId string"),
        "subscriptions": frame([("s1", "k1"), ("s2", "k2"), ("s3", "k3"), ("sé", "k1")], "Id string, ContractId string"),
    }


def test_purge(spark, objects, tmp_path):
    check = offline_submitter("Id", operation="delete")
    done = change.purge_all(objects, check, str(tmp_path), "run")
    ids = {name: sorted(r["Id"] for r in o.success.collect()) if o else [] for name, o in done.items()}
    assert ids == {
        "accounts": ["a1"], "contacts": ["c1"], "opportunities": ["o1"], "quotes": ["q1"],
        "quote_lines": ["ql1"], "orders": ["r1"], "order_lines": ["rl1"], "contracts": ["k1"],
        "subscriptions": ["s1", "sé"],
    }
    assert list(done)[0] == "subscriptions"
    clean = {k: v.limit(0) for k, v in objects.items()}
    assert set(change.purge_all(clean, check, str(tmp_path / "no"), "run").values()) == {None}


def test_examples(spark):
    mock = spark.createDataFrame([(i, f"n{i}", i * 1.5, True, "d", f"u{i}") for i in range(20)],
                                 "id int, Name string, AmountPaid double, IsActive boolean, CreatedDate string, key string")
    got = change.slice_to_insert(mock, "id", 5, 10)
    assert got.columns == ["id", "Name", "Amount_Paid__c", "key", "Migrated_Record__c"]
    assert sorted(r["id"] for r in got.collect()) == list(range(5, 15))
    target = spark.createDataFrame([(f"sf{i}", f"u{i}") for i in (4, 5, 9, 10)], "Id string, key string")
    updates = change.slice_to_update(target, mock, "key", "id", 5, 5, {"Type": "Prospect", "Industry": "Government"})
    assert rows(updates) == [("sf5", "Prospect", "Government"), ("sf9", "Prospect", "Government")]
    users = spark.createDataFrame([("x", "Kim"), ("y", "Lee")], "Id string, Name string")
    made = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", None)], "Id string, CreatedById string")
    assert rows(change.created_by(made, users, "Kim")) == [("1",)]


def test_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    schema = spark.createDataFrame([], "id int, key string").schema
    target = spark.createDataFrame([("k0",)], "k string")

    def land(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(landing))

    def run(submitter=None):
        stream = net_new_stream(
            spark, str(landing), schema, target, "key", "k", "id",
            str(tmp_path / "out"), str(tmp_path / "checkpoint"), submitter,
        )
        stream.awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")).select("id", "key"))

    land([(2, "k1"), (1, "k1"), (3, "k0"), (4, None)])
    land([(5, "k1"), (6, "k2"), (7, None)])
    first = run()
    assert first == [(1, "k1"), (4, None), (6, "k2")]
    assert run() == first
    land([(8, "k2"), (9, "k3")])
    assert run() == sorted([*first, (9, "k3")], key=str)


def test_stream_with_submitter(spark, tmp_path):
    landing = str(tmp_path / "landing")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, key string")
    df.write.parquet(landing)
    stream = net_new_stream(
        spark, landing, df.schema, spark.createDataFrame([], "k string"), "key", "k", "id",
        str(tmp_path / "out"), str(tmp_path / "cp"), offline_submitter("id", refuse=("key", ["b"])),
    )
    stream.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("key", "RESULTS_success")) == [("a", True), ("b", False)]


def test_hot_keys_give_whole_results(spark):
    """A third of the rows on one key, against a plain count."""
    from drover.operators import dml, reconcile

    rng = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}") for i in range(3_000)]
    df = spark.createDataFrame(data, "id int, k string").repartition(6)
    keys = spark.createDataFrame([("hot",)] * 400 + [("k1",)], "k string")
    hot = sum(k == "hot" for _, k in data)
    kept = dml.delete_one_each(df, keys, "k", "id", rows_per_chunk=100)
    assert kept.filter("k = 'hot'").count() == hot - 400
    assert kept.filter("k = 'hot'").agg(F.min("id")).first()[0] == 1200
    merged = reconcile.merge(df, keys.distinct(), "k", "k", how="outer", indicator=True)
    assert merged.filter("_merge = 'both' AND k = 'hot'").count() == hot
    assert merged.count() == len(data)


def landed(spark, tmp_path, df, name="landing"):
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))


def stream(spark, tmp_path, schema, target, **more):
    query = net_new_stream(
        spark, str(tmp_path / "landing"), schema, target, "key", "k", "id",
        str(tmp_path / "out"), str(tmp_path / "checkpoint"), **more,
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(str(tmp_path / "out")).drop("batch")


def test_stream_state_holds_keys_alone_and_survives_a_restart(spark, tmp_path):
    schema = "id bigint, key string, text string, at timestamp, amount decimal(20,4), big bigint, list array<int>"
    df = spark.createDataFrame(
        [(2**60 + 1, "a", "x" * 500, datetime(2024, 1, 1, 2, 3, 4, 5), Decimal("1.2345"), None, [1, None]),
         (2**60, "a", None, None, None, 2**60 + 7, None), (5, "old", "y", None, None, None, None)], schema)
    target = spark.createDataFrame([("old",)], "k string")
    landed(spark, tmp_path, df)
    got = stream(spark, tmp_path, df.schema, target)
    assert [tuple(r) for r in got.collect()] == [(2**60, "a", None, None, None, 2**60 + 7, None)]
    state = spark.read.format("statestore").load(str(tmp_path / "checkpoint"))
    names = [f.name for f in state.schema["value"].dataType.fields]
    assert state.count() == 2 and {r["key"]["key"] for r in state.collect()} == {"a", "old"}
    text = state.schema.simpleString()
    assert "decimal" not in text and "amount" not in text and names

    # A new start knows all keys, the target's too, though the target is not read again.
    more = spark.createDataFrame([(9, "a"), (8, "old"), (7, "new"), (6, None)], "id bigint, key string")
    landed(spark, tmp_path, more)
    got = stream(spark, tmp_path, df.schema, spark.createDataFrame([], "k string"))
    assert sorted((r["key"] or "", r["id"]) for r in got.collect()) == [("", 6), ("a", 2**60), ("new", 7)]


def test_stream_forgets_keys_and_takes_in_later_ones(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, key string").schema
    none = spark.createDataFrame([], "k string")

    def send(*rows, **more):
        landed(spark, tmp_path, spark.createDataFrame(rows, schema))
        return sorted((r["key"], r["id"]) for r in stream(spark, tmp_path, schema, none, **more).collect())

    assert send((1, "a"), expire_after=3600) == [("a", 1)]
    assert send((2, "a"), expire_after=3600) == [("a", 1)]
    time.sleep(0.3)
    assert send((3, "a"), (4, "b"), expire_after=0.2) == [("a", 1), ("a", 3), ("b", 4)]
    land_target_keys(spark.createDataFrame([("c",), ("d",)], "k string"), "k", str(tmp_path / "checkpoint"))
    assert send((5, "c"), (6, "b"), (7, "e"), expire_after=3600) == [("a", 1), ("a", 3), ("b", 4), ("e", 7)]


def test_stream_with_a_hot_key(spark, tmp_path):
    """Half of all rows have one key; few of them leave their task."""
    df = spark.range(20_000).selectExpr("20000 - id AS id", "IF(id % 2 = 0, 'hot', CONCAT('k', id % 50)) AS key")
    df.repartition(4).write.parquet(str(tmp_path / "landing"))
    got = stream(spark, tmp_path, df.schema, spark.createDataFrame([("k1",)], "k string"), files_per_batch=4)
    first = {r["key"]: r["id"] for r in df.groupBy("key").agg(F.min("id").alias("id")).collect()}
    first.pop("k1")
    assert {r["key"]: r["id"] for r in got.collect()} == first
