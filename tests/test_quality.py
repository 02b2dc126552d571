import pytest
from pyspark.sql import functions as F

from drover.operators import quality
from drover.schemas import ACCOUNTS, CONTACTS, CONTRACT_LINES, STAGING_TABLES


def reasons(rejected, key):
    return {r[key]: r["reject_reasons"] for r in rejected.collect()}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [
            ("1", "c", "gen", "1"),
            ("2", "c", "x" * 51, "1"),
            ("3", None, "gen", "many"),
            ("4", "c", "gen", "99999999999"),
            ("5", "c", "gen", "1"),
            ("5", "c", "gen", "2"),
            (None, "c", "gen", "1"),
            ("6", "c", "x" * 50, "-1"),
        ],
        "contract_line_number string, contract_number string, product string, quantity string",
    )


def test_reasons(spark, lines):
    target = spark.createDataFrame([("6",), (None,)], "contract_line_number string")
    checked = quality.check_rows(lines, CONTRACT_LINES, target)
    assert [tuple(r) for r in checked.accepted.collect()] == [("1", "c", "gen", 1)]
    assert checked.accepted.schema == CONTRACT_LINES.schema
    assert reasons(checked.rejected, "contract_line_number") == {
        "2": ["length:product"],
        "3": ["null:contract_number", "range:quantity"],
        "4": ["range:quantity"],
        "5": ["duplicate_key"],
        None: ["null:contract_line_number"],
        "6": ["key_exists"],
    }
    assert checked.accepted.count() + checked.rejected.count() == lines.count()


def test_settled_parts_are_the_same(spark, lines):
    plain = quality.check_rows(lines, CONTRACT_LINES)
    settled = quality.check_rows(lines, CONTRACT_LINES, settle=True)
    for a, b in zip(plain, settled):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_composite_key(spark):
    row = ("acct", "Ann", "Lee", "e", "t", "d", "l")
    df = spark.createDataFrame([row, ("b", "Ann", "Ray", *row[3:]), row], CONTACTS.schema)
    assert quality.check_rows(df, CONTACTS).accepted.count() == 1


def test_staged_accounts_take_no_null(spark):
    assert ACCOUNTS.required == ("account_number_external_id",)
    assert STAGING_TABLES["accounts"].required == tuple(ACCOUNTS.columns)


def test_require_valid(spark, lines):
    with pytest.raises(quality.ConstraintError, match="duplicate_key|length:product"):
        quality.require_valid(lines, CONTRACT_LINES)
    good = lines.filter("contract_line_number = '1'")
    assert quality.require_valid(good, CONTRACT_LINES).count() == 1


def test_counts_come_with_the_write(spark):
    from drover.session import stage_counted

    df = spark.range(1000, numPartitions=7)
    stored, counts = stage_counted(df, "counted", even=F.col("id") % 2 == 0, none=F.col("id") < 0, unknown=F.lit(None) > 1)
    assert counts == {"even": 500, "none": 0, "unknown": 0} and stored.count() == 1000
    stored, counts = stage_counted(df.limit(0), "counted", all=F.lit(True))
    assert counts == {"all": 0} and stored.isEmpty()
    lines = spark.createDataFrame([("a",), (None,)], "contract_line_number string")
    for c in CONTRACT_LINES.columns:
        if c not in lines.columns:
            lines = lines.withColumn(c, F.lit(None).cast("string"))
    found = quality.settled_rows(lines, CONTRACT_LINES)
    assert (found.n_accepted, found.n_rejected) == (found.accepted.count(), found.rejected.count())
    assert found.n_accepted + found.n_rejected == 2
