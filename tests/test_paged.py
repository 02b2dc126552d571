import contextlib
import datetime
import io
import json
import sys
from decimal import Decimal

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from drover.sources import paged
from drover.sources.paged import Condition, PageFolder, read_paged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = """Id bigint, Status string, IsDeleted boolean, Rate double, Day date, Cost decimal(9,2),
    Parent struct<Name: string, Top: struct<Name: string>>"""


class Service:
    """Pages made on the spot; notes in a folder what it was asked for."""

    def __init__(self, pages, log):
        self.count, self.log = pages, log

    def pages(self):
        return self.count

    def understands(self, condition):
        return condition.op != "in"

    def fetch(self, page, conditions):
        (self.log / f"{page}").write_text(json.dumps([[c.column, c.op, str(c.value), c.wanted] for c in conditions]))
        rows = [
            {
                "attributes": {"type": "x"},
                "Id": k,
                "Status": None if k % 5 == 0 else "AB"[k % 2],
                "IsDeleted": None if k % 4 == 0 else k % 4 == 1,
                "Rate": float("nan") if k % 7 == 0 else k / 2,
                "Day": datetime.date(2020, 1, 1 + k % 20),
                "Cost": Decimal(k),
                "Parent": None if k % 6 == 0 else {"Name": f"p{k}", "Top": {"Name": "t"}},
            }
            for k in range(page * 10, page * 10 + 10)
        ]
        return [r for r in rows if all(paged.meets(r[c.column], c) for c in conditions)]


def asked(log):
    return {p.name: json.loads(p.read_text()) for p in log.iterdir()}


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return tmp_path / "log"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_pages_in_parallel_and_flat(spark, log):
    df = read_paged(spark, Service(25, log), SCHEMA, include_deleted=True, pages_per_task=4)
    assert df.columns == ["Id", "Status", "IsDeleted", "Rate", "Day", "Cost", "Parent.Name", "Parent.Top.Name"]
    assert df.rdd.getNumPartitions() == 7
    rows = df.collect()
    assert sorted(r.Id for r in rows) == list(range(250)) and set(asked(log)) == {str(k) for k in range(25)}
    by_id = {r.Id: r for r in rows}
    assert by_id[7]["Parent.Name"] == "p7" and by_id[6]["Parent.Name"] is None and by_id[3].Cost == Decimal("3.00")
    nested = read_paged(spark, Service(1, log), SCHEMA, include_deleted=True, flat=False)
    assert nested.columns[-1] == "Parent"


def test_filters_reach_the_service(spark, log):
    df = read_paged(spark, Service(10, log), SCHEMA)
    wanted = df.filter("Status = 'A' AND Id > 20 AND Day >= DATE'2020-01-05' AND Id IN (22, 42, 44, 47, 62)")
    text = plan(wanted)
    assert "EqualTo(Status,A)" in text and "GreaterThan(Id,20)" in text and "IsDeleted" in text.split("PushedFilters")[1]
    ids = sorted(r.Id for r in wanted.collect())
    assert ids == [44] == [k for k in (22, 42, 44, 62) if k % 5 and (k % 20) >= 4 and k % 4 != 1]
    sent = {(c, op) for c, op, _, _ in asked(log)["3"]}
    assert {("Status", "="), ("Id", ">"), ("Day", ">="), ("IsDeleted", "<=>")} <= sent and ("Id", "in") not in sent


@pytest.mark.parametrize(
    "text",
    ["Status = 'A'", "Status <> 'A'", "NOT (Status <=> 'A')", "Status IS NULL", "Id BETWEEN 3 AND 40", "NOT Id <= 30",
     "Id IN (1, 2, 3)", "Id NOT IN (1, 2)", "Rate = 2.5", "isnan(Rate)", "`Parent.Name` = 'p7'", "Cost = 4.00",
     "Status = 'A' OR Id = 3", "IsDeleted IS NULL", "NOT IsDeleted", "Day < DATE'2020-01-03'"],
)
def test_same_rows_as_spark_filters(spark, log, text):
    df = read_paged(spark, Service(5, log), SCHEMA, include_deleted=True)
    local = spark.createDataFrame(df.collect(), df.schema)
    assert sorted(r.Id for r in df.filter(text).collect()) == sorted(r.Id for r in local.filter(text).collect())


def test_soft_deleted_and_empty(spark, log):
    df = read_paged(spark, Service(5, log), SCHEMA)
    assert sorted(r.Id for r in df.collect()) == [k for k in range(50) if k % 4 != 1]
    assert read_paged(spark, Service(0, log), SCHEMA).count() == 0
    with pytest.raises(ValueError):
        read_paged(spark, Service(1, log), SCHEMA, pages_per_task=0)


def test_page_folder(spark, tmp_path):
    for page in (0, 2):
        folder = tmp_path / f"page={page}"
        folder.mkdir()
        for part in range(2):
            records = [{"Id": page * 10 + part * 2 + k, "Status": "é\n", "More": 1} for k in range(2)]
            (folder / f"part-{part}.json").write_text(json.dumps({"totalSize": 4, "records": records}) + "\n")
        (folder / "_SUCCESS").touch()
    service = PageFolder("file:" + str(tmp_path))
    assert service.pages() == 3 and service.fetch(1, []) == []
    assert [r["Id"] for r in service.fetch(2, [Condition("Id", ">", 21)])] == [22, 23]
    df = read_paged(spark, service, "Id bigint, Status string, Missing string", pages_per_task=1)
    assert sorted(tuple(r) for r in df.collect()) == [(k, "é\n", None) for k in (0, 1, 2, 3, 20, 21, 22, 23)]
    assert not service.understands(Condition("Day", "=", datetime.date(2020, 1, 1)))


def test_conditions_are_as_in_sql():
    meets = paged.meets
    assert not meets(None, Condition("a", "=", 1)) and not meets(None, Condition("a", "=", 1, False))
    assert meets(None, Condition("a", "<=>", None)) and not meets(None, Condition("a", "<=>", None, False))
    assert meets(None, Condition("a", "null")) and meets(1, Condition("a", "null", wanted=False))
    assert not meets(1, Condition("a", "in", (2, None), False)) and meets(1, Condition("a", "in", (2,), False))


def test_stored_pages_are_read_again(spark, tmp_path):
    pages = spark.range(0, 1000).selectExpr("id DIV 10 AS page", "named_struct('Id', id, 'Status', IF(id % 3 = 0, NULL, 'é\n')) AS r")
    pages = pages.groupBy("page").agg(F.count("r").alias("totalSize"), F.collect_list("r").alias("records"))
    for folder in (str(tmp_path / "a"), "file://" + str(tmp_path / "b")):
        paged.store_pages(pages, folder)
        paged.store_pages(pages, folder)  # a repeated task puts the same pages in place
        service = PageFolder(folder)
        assert service.pages() == 100 and sorted(r["Id"] for r in service.fetch(3, [])) == list(range(30, 40))
        df = read_paged(spark, service, "Id bigint, Status string", pages_per_task=7)
        assert sorted(tuple(r) for r in df.collect()) == [(k, None if k % 3 == 0 else "é\n") for k in range(1000)]
    # No folders of attempts and no file beside the page's own.
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == sorted(f"page={k}" for k in range(100))
    assert all([f.name for f in p.iterdir()] == ["page.json"] for p in (tmp_path / "a").iterdir())
    paged.store_pages(pages.limit(0), str(tmp_path / "none"))
    assert PageFolder(str(tmp_path / "none")).pages() == 0
