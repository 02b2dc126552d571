"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drover.llm.text import tidy
from drover.operators.ordering import fresh
from drover.session import stage

#: Entries are counted in steps of one over this number.
SCALE = 256

#: The scatter matrix lies on the driver; at this many dimensions it has 128 MB.
MOST_DIMENSIONS = 4096

#: A direction whose remaining variance is this share of its own is rounding, not data.
TOLERANCE = 1e-12

RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


@dataclass(frozen=True)
class Whitening:
    """What `fit` found: `components` holds unit eigenvectors as rows, by falling `values`."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def whole_numbers(df: DataFrame, column: str, name: str) -> DataFrame:
    """The rows whose vector has only finite entries, with `name`: floor(SCALE * entry) of each."""
    vector = F.col(f"`{column}`").cast("array<double>")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(vector, lambda c: F.floor(c * SCALE).cast("long"))
    return df.where(vector.isNotNull() & F.coalesce(finite, F.lit(False))).withColumn(name, whole)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: 64-bit numbers, or Python's where these might overflow."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
    if n * largest + max(abs(s) for s in sums) < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x less the mean, rounded once."""
    return deviations(x, n, sums).astype(np.float64) / n


def _summed(vectors: DataFrame, width: int, share: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of `share(x)`, matrices of `width` columns, over all batches of vectors.

    A task adds up its own batches and sends its matrix row by row; equal rows
    of all tasks are added in one group each, so what is collected has the size
    of one matrix.
    """
    schema = "i int, part array<double>"

    @tidy
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = share(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            starts = np.arange(0, total.size + 1, width, dtype=np.int32)
            rows = pa.ListArray.from_arrays(starts, pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), rows], names=["i", "part"]
            )

    @tidy
    def together(table: pa.Table) -> pa.Table:
        part = _matrix(table.column("part")).sum(axis=0)
        return pa.table({"i": table.column("i")[:1], "part": pa.array([part], pa.list_(pa.float64()))})

    parts = vectors.mapInArrow(own, schema).groupBy("i").applyInArrow(together, schema)
    return np.array([row["part"] for row in sorted(parts.collect())]).reshape(-1, width)


def _exact_sums(vectors: DataFrame, dimensions: int) -> tuple[int, ...]:
    """Sums of each dimension; halves of 32 bits can't overflow within a batch."""

    @tidy
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dimensions
        for batch in batches:
            x = _matrix(batch.column(0))
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimensions), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["i", "part"]
        )

    parts = vectors.mapInArrow(own, "i int, part decimal(38,0)")
    total = parts.groupBy("i").agg(F.sum("part").cast("decimal(38,0)").alias("total"))
    return tuple(int(row["total"]) for row in total.orderBy("i").collect())


def pivoted_cholesky(scatter: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """A triangular factor of the rows in pivot order, and that order.

    The next pivot is the dimension with most variance left; one whose rest is
    below `tolerance` of what it had is none. The number of columns is the rank.
    """
    left = scatter.diagonal().astype(np.float64)
    least = tolerance * left
    factor = np.zeros_like(scatter, dtype=np.float64)
    order: list[int] = []
    for k in range(len(scatter)):
        open_ = np.where(left > least, left, 0.0)
        open_[order] = 0.0
        pivot = int(open_.argmax())
        if open_[pivot] <= 0:
            break
        column = scatter[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        column[order] = 0.0
        factor[:, k] = column / np.sqrt(left[pivot])
        factor[pivot, k] = np.sqrt(left[pivot])
        left = left - factor[:, k] ** 2
        order.append(pivot)
    rest = [i for i in range(len(scatter)) if i not in set(order)]
    rows = np.array(order + rest, dtype=np.int64)
    return factor[rows][:, : len(order)], rows


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate columns in pairs until all are orthogonal; each round of a sweep has disjoint pairs."""
    a = factor[:, np.argsort(-np.linalg.norm(factor, axis=0), kind="stable")].copy()
    columns = a.shape[1]
    if columns < 2:
        return a
    limit = np.finfo(float).eps * np.sqrt(len(a))
    seats = np.arange(columns + columns % 2)
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[::-1][: len(seats) // 2]
            real = (p < columns) & (q < columns)
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            skew = np.abs(xy) > limit * np.sqrt(xx * yy)
            if skew.any():
                turned = True
                p, q, x, y = p[skew], q[skew], x[:, skew], y[:, skew]
                ratio = (yy[skew] - xx[skew]) / (2 * xy[skew])
                tangent = np.where(ratio < 0, -1.0, 1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
                cosine = 1 / np.hypot(1.0, tangent)
                a[:, p], a[:, q] = cosine * (x - tangent * y), cosine * (y + tangent * x)
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    return a


def principal(scatter: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the scatter by falling size, and unit eigenvectors as rows; none for rounding's rest."""
    factor, rows = pivoted_cholesky(scatter, tolerance)
    turned = one_sided_jacobi(factor)
    length = np.linalg.norm(turned, axis=0)
    order = np.argsort(-length, kind="stable")
    vectors = np.zeros((len(order), len(scatter)))
    vectors[:, rows] = (turned[:, order] / length[order]).T
    # The entry of largest size is positive, so that reruns agree.
    if len(vectors):
        signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
        vectors *= signs[:, None]
    return length[order] ** 2, vectors


def fit(df: DataFrame, column: str = "embedding", components: int = 4) -> Whitening | None:
    """Components of the distinct whole-number vectors of `column`.

    Vectors that are NULL or hold NULL, NaN or infinite entries don't count;
    entries beyond 64 bits stop at their ends. All vectors have one length; if
    not, those of the most frequent length (of equal ones the longest) count. Repeated
    vectors count once. There are as many components as the scatter has rank,
    at most `components`; no vector, empty ones or equal ones give None.

    The distinct vectors are stored once and read for sums, scatter and the
    check of the result; the driver holds one matrix of dimensions squared.
    """
    x = "x"
    distinct = stage(whole_numbers(df.select(column), column, x).select(x).distinct(), "vectors")
    lengths = distinct.where(F.size(x) > 0).groupBy(F.size(x).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if most is None:
        return None
    dimensions, n = most["d"], most["n"]
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {dimensions} entries, more than {MOST_DIMENSIONS}")
    listed = distinct.where(F.size(x) == dimensions)
    sums = _exact_sums(listed, dimensions)

    def products(x: np.ndarray) -> np.ndarray:
        c = centred(x, n, sums)
        return c.T @ c

    scatter = _summed(listed, dimensions, products)
    found, vectors = principal((scatter + scatter.T) / 2)
    if not len(found):
        return None
    values, vectors = found[:components] / n, vectors[:components]
    scaled = (vectors / np.sqrt(values)[:, None]).T
    kept = len(values)
    mean = _summed(listed, kept, lambda x: (centred(x, n, sums) @ scaled).sum(axis=0, keepdims=True)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ scaled - mean
        return w.T @ w

    error = float(np.abs(_summed(listed, kept, spread) / n - np.eye(kept)).max())
    return Whitening(n, sums, values, vectors, float(scatter.trace()) / n, error)


def whiten(df: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """One row for each row of `df` with a fitting vector, and each component, numbered from 1.

    Adds component, n, deviation (exact; NULL beyond 38 digits), whitened,
    explained and identity_error, replacing columns of these names; NULL ids,
    repeated rows and other columns go along. Rows whose vector `fit` leaves out
    are dropped; without a model nothing is left. Rows never move between tasks.
    """
    kept = [c for c in df.columns if c not in RESULTS]
    fields = [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name in kept]
    added = T._parse_datatype_string(
        "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    ).fields
    schema = T.StructType([T.StructField("row", T.StructType(fields)), *added])
    flat = [F.col(f"row.`{c}`") for c in kept] + [F.col(c) for c in RESULTS]
    x = fresh(df.columns, "_x")
    rows = whole_numbers(df, column, x)
    packed = rows.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(x).alias("x"))
    if model is None:
        empty = packed.where(F.lit(False)).select("row", *(F.lit(None).cast(f.dataType).alias(f.name) for f in added))
        return empty.select(*flat)
    n, sums, most = model.n, model.sums, 10**38
    scaled = (model.components / np.sqrt(model.values)[:, None]).T
    count = len(model.values)
    explained = model.values / model.trace
    error = model.identity_error

    def squares(x: np.ndarray) -> pa.Array:
        away = deviations(x, n, sums)
        if away.dtype != object and x.shape[1] * int(np.abs(away).max(initial=0)) ** 2 < 1 << 62:
            return pa.array((away * away).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
        total = (away.astype(object) ** 2).sum(axis=1)
        return pa.array([int(t) if t < most else None for t in total], pa.decimal128(38, 0))

    @tidy
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            repeated = pa.array(np.repeat(np.arange(len(x)), count))
            columns = [
                batch.column(0).take(repeated),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * count, n)),
                squares(x).take(repeated),
                pa.array((centred(x, n, sums) @ scaled).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(x) * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", *RESULTS])

    fitting = packed.where(F.size("x") == model.dimensions)
    return fitting.mapInArrow(task, schema).select(*flat)
