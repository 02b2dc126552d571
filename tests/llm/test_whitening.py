"""Whitening against numpy's eigenvalues and plain whole numbers."""

import math

import numpy as np
import pytest
from drover.llm import whitening
from drover.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(rows):
    """Rows that remain as whole numbers, the fit list, its covariance."""
    kept = [
        (k, tuple(math.floor(256 * float(c)) for c in v))
        for k, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    listed = sorted({x for _, x in kept})
    x = np.array(listed, dtype=np.float64)
    c = x - x.mean(axis=0)
    return kept, listed, c.T @ c / len(x)


def check(found, rows, tolerance=1e-9):
    kept, listed, cov = plain(rows)
    n, sums = len(listed), [sum(d) for d in zip(*listed)]
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1].T
    rank = min(4, int((values > 1e-10 * values[0]).sum()))
    assert len(found) == len(kept) * rank
    by_row = {}
    for row in found:
        by_row.setdefault((row.vec_id, row.component), []).append(row)
    expected = {}
    for k, x in kept:
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for j in range(rank):
            w = (np.array(x) - np.array(sums) / n) @ vectors[j] / math.sqrt(values[j])
            expected.setdefault((k, j + 1), []).append((exact, w, values[j] / cov.trace()))
    assert by_row.keys() == expected.keys()
    signs = {}
    for key, group in expected.items():
        mine = sorted((r.deviation, abs(r.whitened), r.explained) for r in by_row[key])
        for (d, w, e), (d2, w2, e2) in zip(mine, sorted((d, abs(w), e) for d, w, e in group)):
            assert d == d2 and abs(w - w2) < tolerance * max(1, abs(w2)) and math.isclose(e, e2, rel_tol=1e-9)
        if len(group) == 1 and abs(group[0][1]) > 1e-6:
            signs.setdefault(key[1], set()).add(by_row[key][0].whitened * group[0][1] > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert all(r.n == n and r.identity_error < 1e-4 for r in found)


def test_query_like_eigh(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, FOLDER).collect(), rows, 1e-6)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.normal(0, 1, 5) * [100, 10, 1, 0.1, 0] + 1000]) for k in range(60)]
    rows += [(k % 7, rows[k % 3][1]) for k in range(100, 140)]
    rows += [(None, rows[5][1]), (200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5)]
    rows += [(203, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (204, [-0.0] * 5)]
    df = spark.createDataFrame([(k, v, "a", 1.5) for k, v in rows], "vec_id long, e array<double>, n string, whitened double")
    found = whitening.whiten(df, whitening.fit(df, "e"), "e")
    assert found.columns == ["vec_id", "e", *whitening.RESULTS]
    check(found.collect(), rows)
    # Vectors of another length than most are left out; a column may be called as an inner one is.
    more = df.select("vec_id", "e", "n").withColumn("_x", df.n).union(
        spark.createDataFrame([(300, [1.0], "", ""), (301, [], "", "")], "vec_id long, e array<double>, n string, _x string")
    )
    found = whitening.whiten(more, whitening.fit(more, "e"), "e")
    assert "_x" in found.columns
    check(found.collect(), rows)


@pytest.mark.parametrize(
    "vectors", [[], [None], [[]], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [[1.0], [1.001]]]
)
def test_no_direction_gives_no_row(spark, vectors):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    model = whitening.fit(df)
    assert model is None and whitening.whiten(df, model).count() == 0


def test_rank_and_large_numbers(spark):
    rows = [(k, [float(k % 10), 2.0 * (k % 10), 3.0]) for k in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert len(whitening.fit(df).values) == 1
    check(whitening.whiten(df, whitening.fit(df)).collect(), rows)
    rows = [(k, [2.0**50 + 2.0**40 * k, float(k * k)]) for k in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = {k: sum((9 * int(a * 256) - s) ** 2 for a, s in zip(v, [sum(int(r[1][i] * 256) for r in rows) for i in (0, 1)]))
             for k, v in rows}
    got = whitening.whiten(df, whitening.fit(df)).where("component = 1").collect()
    assert {r.vec_id: int(r.deviation) for r in got} == exact


@pytest.mark.parametrize("size", [1, 2, 5, 30])
def test_cholesky_and_jacobi(size):
    rng = np.random.default_rng(size)
    a = rng.normal(size=(size + 3, size)) * 10.0 ** rng.integers(-4, 5, size)
    scatter = a.T @ a
    factor, rows = whitening.pivoted_cholesky(scatter)
    assert np.allclose(np.triu(factor, 1), 0) and np.allclose((factor @ factor.T)[np.ix_(*[np.argsort(rows)] * 2)], scatter, rtol=1e-10, atol=0)
    values, vectors = whitening.principal(scatter)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-9)
    assert np.allclose(np.sqrt(values), np.linalg.svd(a, compute_uv=False)[: len(values)], rtol=1e-7)
