import pyarrow as pa
import pytest
from offline import offline_submitter

from drover.operators import submit


@pytest.fixture(scope="module")
def sent(spark):
    data = [(i, "bad" if i % 4 == 0 else "ok", None if i == 7 else 2**60 + i) for i in range(25)]
    return spark.createDataFrame(data, "id int, kind string, big bigint").repartition(3)


def test_batches(sent):
    got = submit.assign_batches(sent, "id", 10)
    assert {r["id"]: r["batch_id"] for r in got.collect()} == {i: i // 10 for i in range(25)}


def test_each_row_has_an_outcome(sent):
    check = offline_submitter("id", required=["big"], refuse=("kind", ["bad"]))
    results = submit.submit(sent, check, "id", 10)
    rows = {r["id"]: r for r in results.collect()}
    assert len(rows) == 25
    # Large integers and NULLs pass through unchanged.
    assert rows[3]["big"] == 2**60 + 3 and rows[7]["big"] is None
    assert rows[3]["RESULTS_success"] and rows[3]["RESULTS_id"] == "3" and rows[3]["RESULTS_created"]
    assert rows[4]["RESULTS_errors"] == "REFUSED: kind" and rows[4]["RESULTS_id"] is None
    assert rows[7]["RESULTS_errors"] == "REQUIRED_FIELD_MISSING: big"
    outcome = submit.split_results(results)
    assert outcome.success.count() + outcome.fallout.count() + outcome.unknown.count() == 25


def test_batch_sizes_and_row_order(sent):
    def record(batch):
        text = ",".join(map(str, batch.column("id").to_pylist()))
        return pa.table({"success": [True] * batch.num_rows, "id": [text] * batch.num_rows})

    got = submit.submit(sent, record, "id", 10).select("batch_id", "RESULTS_id").distinct().collect()
    assert {r[0]: r[1] for r in got} == {
        b: ",".join(map(str, range(b * 10, min(b * 10 + 10, 25)))) for b in range(3)
    }


def test_short_results_and_errors(sent):
    def short(batch):
        if batch.column("id")[0].as_py() >= 20:
            raise RuntimeError("service down")
        return pa.table({"success": pa.array([True, False], pa.bool_())})

    outcome = submit.split_results(submit.submit(sent, short, "id", 10))
    assert sorted(r["id"] for r in outcome.success.collect()) == [0, 10]
    assert sorted(r["id"] for r in outcome.fallout.collect()) == [1, 11, 20, 21, 22, 23, 24]
    assert outcome.unknown.count() == 16
    assert {r["RESULTS_errors"] for r in outcome.fallout.filter("id >= 20").collect()} == {"service down"}


def test_no_results_at_all(sent):
    nothing = submit.submit(sent, lambda batch: pa.table({}), "id", 10)
    assert submit.split_results(nothing).unknown.count() == 25


def test_totals(sent):
    results = submit.submit(sent, offline_submitter("id", refuse=("kind", ["bad"])), "id", 10)
    rows = sorted(tuple(r) for r in submit.batch_totals(results).collect())
    assert rows == [(0, 7, 3, 7, 3), (1, 8, 2, 15, 5), (2, 3, 2, 18, 7)]


def test_reports_in_one_write(spark, tmp_path):
    rows = [(1, "NA", True, None), (2, "", False, "line\nbreak"), (3, None, None, None), (4, "\\N", False, '"q",')]
    df = spark.createDataFrame(rows, "id int, text string, RESULTS_success boolean, RESULTS_errors string")
    submit.write_reports(df, str(tmp_path))
    names = {True: "success", False: "fallout", None: "unknown"}
    assert {p.name for p in (tmp_path / "reports").iterdir() if p.is_dir()} == {f"report={n}" for n in names.values()}
    got = submit.read_reports(spark, str(tmp_path), df.schema)
    assert sorted(map(tuple, got.collect())) == [(*r, names[r[2]]) for r in rows]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        submit.write_reports(df, str(tmp_path))
    submit.write_reports(df.filter("id = 1"), str(tmp_path), "overwrite")
    assert submit.read_reports(spark, str(tmp_path), df.schema).count() == 1


def test_run_dml_sends_once(spark, sent, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def count(batch, log=str(log)):
        import uuid
        from pathlib import Path

        (Path(log) / uuid.uuid4().hex).write_text(str(batch.num_rows))
        return offline_submitter("id", refuse=("kind", ["bad"]))(batch)

    outcome = submit.run_dml(sent, count, "insert", "id", str(tmp_path / "out"), "r1", 10)
    assert (outcome.success.count(), outcome.fallout.count()) == (18, 7)
    outcome.success.collect()
    assert len(list(log.iterdir())) == 3
    base = tmp_path / "out" / "operation=insert" / "run_id=r1"
    assert spark.read.csv(str(base / "success"), header=True).count() == 18
    assert spark.read.csv(str(base / "fallout"), header=True).count() == 7
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        submit.run_dml(sent, count, "insert", "id", str(tmp_path / "out"), "r1", 10)
    assert submit.run_dml(sent.filter("id < 0"), count, "insert", "id", str(tmp_path / "no"), "r1") is None
    assert not (tmp_path / "no").exists()
    with pytest.raises(ValueError):
        submit.run_dml(sent, count, "merge", "id", str(tmp_path / "x"), "r1")
