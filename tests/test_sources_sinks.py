import glob
import json
import random
from datetime import date
from decimal import Decimal

import pytest

from drover.operators import quality
from drover.schemas import ACCOUNTS, CONTRACT_LINES, CONTRACTS
from drover.session import shared_path, stage
from drover.sinks import files as sinks
from drover.sinks import tables
from drover.sources import database
from drover.sources import files as sources
from drover.sources.sql import run_sql


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text('code,n,day,note\n031300575,7,2024-02-29,"say ""hi"", then go"\nNA,null,,N/A\n')
    schema = "code string, n int, day date, note string"
    got = sources.read_csv(spark, str(file), schema)
    assert rows(got) == [("031300575", 7, date(2024, 2, 29), 'say "hi", then go'), (None, None, None, None)]
    inferred = sources.read_csv(spark, str(file))
    assert dict(inferred.dtypes)["note"] == "string" and inferred.count() == 2
    file.write_text("code,n\nx,seven\n")
    assert rows(sources.read_csv(spark, str(file), "code string, n int", strict=False)) == [("x", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources.read_csv(spark, str(file), "code string, n int").collect()


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,other,code\n7,zz,01\n")
    got = sources.read_csv(spark, str(tmp_path), "code string, n int")
    assert rows(got) == [("01", 7)] and got.columns == ["code", "n"]
    with pytest.raises(ValueError, match="lost"):
        sources.read_csv(spark, str(tmp_path), "code string, lost int")
    (tmp_path / "b.csv").write_text("code,other,n\n02,zz,8\n")
    with pytest.raises(Exception, match="header"):
        sources.read_csv(spark, str(tmp_path), "code string, n int").collect()


def test_csv_files_in_order(spark, tmp_path):
    for i in (2, 1):
        (tmp_path / f"part_{i}.csv").write_text(f"id,v\n1,a{i}\n2,b{i}\n")
    paths = [str(tmp_path / f"part_{i}.csv") for i in (1, 2)]
    got = sources.read_csv(spark, paths, "id int, v string", file_column="file")
    assert [r["v"] for r in got.orderBy("file", "id").collect()] == ["a1", "b1", "a2", "b2"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q"uote', "a,b"), (2, None, "line")], "id int, a string, b string")
    sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(sources.read_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_query_result(spark, tmp_path):
    record = {
        "attributes": {"type": "Account"},
        "Id": "1",
        "Owner": {"attributes": {"type": "User"}, "Name": "Jo", "Manager": {"Name": "Al"}},
        "Score": 1.5,
    }
    page = {"totalSize": 2, "records": [{**record, "Owner": None, "Id": "2"}, record]}
    (tmp_path / "1.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "2.json").write_text(json.dumps({"totalSize": 0, "records": []}))
    got = sources.load_query(spark, str(tmp_path))
    assert set(got.columns) == {"Id", "Score", "Owner.Name", "Owner.Manager.Name"}
    assert {r["Id"]: r["Owner.Manager.Name"] for r in got.collect()} == {"1": "Al", "2": None}


def test_objects_and_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, True, "x"), (2, False, "y"), (3, None, "x")], "Id int, IsDeleted boolean, k string")
    df.write.parquet(str(tmp_path / "obj"))
    assert sorted(r["Id"] for r in sources.read_object(spark, str(tmp_path / "obj")).collect()) == [2, 3]
    assert sources.read_object(spark, str(tmp_path / "obj"), include_deleted=True).count() == 3
    path = str(tmp_path / "docs")
    sinks.insert_documents(df, path)
    sinks.insert_documents(spark.createDataFrame([(4, "new")], "Id int, extra string"), path)
    got = sources.read_documents(spark, path)
    assert got.count() == 4 and "extra" in got.columns
    assert sources.read_documents(spark, path, "k", "x").count() == 2
    assert sources.read_documents(spark, path, "k", None).count() == 4
    parquet = str(tmp_path / "docs_parquet")
    sinks.insert_documents(df, parquet, "parquet")
    sinks.insert_documents(df.select("Id").withColumnRenamed("Id", "other"), parquet, "parquet")
    assert "other" in sources.read_documents(spark, parquet, format="parquet").columns


def test_run_sql(spark):
    df = spark.createDataFrame([(1, "x'; --"), (2, "y")], "id int, k string")
    got = run_sql(spark, "SELECT id FROM {t} WHERE k = :k", {"t": df}, {"k": "x'; --"})
    assert rows(got) == [(1,)]


def test_database_options():
    target = database.connection("postgres", "db.example.com", "crm", user="u")
    assert target["url"] == "jdbc:postgresql://db.example.com/crm" and target["user"] == "u"
    assert database.connection("mssql", "h", "d")["url"] == "jdbc:sqlserver://h;databaseName=d"
    assert database.read_options(query="SELECT 1")["query"] == "SELECT 1"
    split = database.read_options(query="SELECT * FROM t", split=database.Split("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT * FROM t) split_source"
    assert (split["partitionColumn"], split["lowerBound"], split["numPartitions"]) == ("id", "0", "8")
    assert database.write_options("t", 4)["batchsize"] == "1000"
    with pytest.raises(ValueError):
        database.read_options()


def test_named_outputs_and_key_list(spark, tmp_path):
    a, b = spark.range(2), spark.range(3)
    sinks.write_named_outputs({"second": a, "first": b}, str(tmp_path / "book"))
    manifest = spark.read.json(str(tmp_path / "book" / sinks.MANIFEST)).orderBy("position").collect()
    assert [r["name"] for r in manifest] == ["second", "first"]
    assert spark.read.csv(str(tmp_path / "book" / "first"), header=True).count() == 3
    sinks.write_key_list(b, "id", str(tmp_path / "keys"))
    assert spark.read.text(str(tmp_path / "keys")).first()[0] == "('0','1','2')"


@pytest.fixture
def lines_table(spark):
    name = tables.create_table(spark, CONTRACT_LINES, "t_lines")
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_insert_modes(spark, lines_table):
    good = spark.createDataFrame([("gen", "1", "c", 1)], "product string, contract_line_number string, contract_number string, quantity int")
    tables.insert(good, CONTRACT_LINES, lines_table)
    assert rows(spark.table(lines_table)) == [("1", "c", "gen", 1)]
    mixed = good.union(spark.createDataFrame([("p", "2", "c", 2), ("p", "3", None, 2)], good.schema))
    with pytest.raises(quality.ConstraintError, match="key_exists"):
        tables.insert(mixed, CONTRACT_LINES, lines_table)
    assert spark.table(lines_table).count() == 1
    rejected = tables.insert(mixed, CONTRACT_LINES, lines_table, mode="quarantine")
    assert {r["contract_line_number"]: r["reject_reasons"] for r in rejected.collect()} == {
        "1": ["key_exists"], "3": ["null:contract_number"],
    }
    assert spark.table(lines_table).count() == 2
    with pytest.raises(ValueError):
        tables.insert(good, CONTRACT_LINES, lines_table, mode="maybe")


def test_publish_a_state_that_reads_the_table(spark, lines_table):
    good = spark.createDataFrame([("1", "c", "gen", 1), ("2", "c", "gen", 1)], CONTRACT_LINES.schema)
    tables.insert(good, CONTRACT_LINES, lines_table)
    first = tables.publish(spark, lines_table, spark.table(lines_table).filter("contract_line_number = '1'"))
    second = tables.publish(spark, lines_table, spark.table(lines_table).union(spark.table(lines_table)))
    assert first != second
    assert spark.table(lines_table).count() == 2
    tables.create_table(spark, CONTRACT_LINES, lines_table)
    assert spark.table(lines_table).count() == 0


def test_tables_outlive_the_scratch_folder(spark, lines_table):
    good = spark.createDataFrame([("1", "c", "gen", 1)], CONTRACT_LINES.schema)
    tables.insert(good, CONTRACT_LINES, lines_table)
    place = tables.publish(spark, lines_table, spark.table(lines_table))
    assert spark.conf.get("spark.checkpoint.dir") not in place
    assert tables.remove_superseded(spark, lines_table) >= 1
    assert tables.remove_superseded(spark, lines_table) == 0
    assert spark.table(lines_table).count() == 1
    with pytest.raises(ValueError, match="columns"):
        tables.publish(spark, lines_table, spark.table(lines_table).selectExpr("*", "1 AS more"))


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    data = [(1, " lead"), (2, "trail\t "), (3, 'q"uote\\x'), (4, "two\nlines\r\nthree"), (5, "a,b"), (6, None)]
    df = spark.createDataFrame(data, "id int, text string")
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert rows(sources.read_csv(spark, str(tmp_path / "csv"), "id int, text string")) == rows(df)


def test_schemas():
    assert [f.dataType.simpleString() for f in ACCOUNTS.schema.fields][3] == "decimal(16,2)"
    assert "`start_date` date" in CONTRACTS.ddl()


def test_types_are_kept_to_the_cent(spark):
    name = tables.create_table(spark, ACCOUNTS, "t_accounts")
    row = ("1", "Acme", "Tech", Decimal("12345678901234.56"), "k", 1, 2, "Gold", 3)
    tables.insert(spark.createDataFrame([row], ACCOUNTS.schema), ACCOUNTS, name)
    assert spark.table(name).first()["annual_revenue"] == Decimal("12345678901234.56")


def test_shared_folder(spark, tmp_path):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    df = spark.createDataFrame([(1, None)], "a int, b string")
    staged = stage(df)
    assert staged.schema == df.schema and rows(staged) == rows(df)


TEXTS = ["", None, "NA", "\\N", "\\\\N", "\\", "a\\", "\\n", "\n", "\r\n", "\\\n", "\\\\n", " a ", '"', 'a"b,c', "é\u2028x", "#", "\t", "\\r\r"]


def test_one_line_csv_gives_back_every_text(spark, tmp_path):
    rng = random.Random(7)
    texts = TEXTS + ["".join(rng.choice('\\nr\n\r"N, ') for _ in range(rng.randrange(8))) for _ in range(400)]
    rows = [(i, t, None if i % 3 else i / 7, None if i % 2 else date(2024, 1, 1 + i % 28)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, text string, x double, day date")
    path = str(tmp_path / "csv")
    sinks.write_csv(df.repartition(2), path, one_line=True)
    lines = sum(open(f, newline="").read().count("\n") for f in glob.glob(path + "/*.csv"))
    assert lines == len(rows) + 2
    got = sources.read_csv(spark, path, "id int, text string, x double, day date", one_line=True)
    assert sorted(map(tuple, got.collect())) == rows
    plain = sources.read_csv(spark, path, one_line=True)
    assert {(r["id"], r["text"]) for r in plain.collect()} == {(str(i), t) for i, t, *_ in rows}


def test_one_line_csv_is_split_among_tasks(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(20_000).selectExpr("id", "concat('line ', id, '\\n\"x\", ') AS text")
    sinks.write_csv(df.coalesce(1), path, one_line=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        got = sources.read_csv(spark, path, "id bigint, text string", one_line=True)
        assert got.rdd.getNumPartitions() > 5 * len(glob.glob(path + "/*.csv"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
