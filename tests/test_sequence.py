import random

import pytest

from drover.operators import chunks
from drover.operators.sequence import number_groups, number_runs


def loop(rows, changing=False, hold=False, base=10, step=10):
    """Row after row, as a reader would do it by hand."""
    out, number = {}, None
    for i, (at, g, c) in enumerate(rows):
        if i == 0 or g != rows[i - 1][1]:
            number = base
        elif not changing:
            number += step
        elif c != rows[i - 1][2]:
            number += step
        elif not hold:
            number = base
        out[at] = number
    return out


EXAMPLE = [(i, g, c) for i, (g, c) in enumerate(zip("aaabbaa", [1, 1, 2, 1, 2, 3, 4]))]


def numbers(df):
    return {r["at"]: r["seq"] for r in df.collect()}


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_example(spark, chunk):
    df = spark.createDataFrame(EXAMPLE, "at int, g string, c int")
    runs = numbers(number_runs(df, "g", "at", "seq", rows_per_chunk=chunk))
    assert [runs[i] for i in range(7)] == [10, 20, 30, 10, 20, 10, 20]
    changing = numbers(number_runs(df, ["g"], "at", "seq", changing="c", rows_per_chunk=chunk))
    assert [changing[i] for i in range(7)] == [10, 10, 20, 10, 20, 10, 20]
    held = numbers(number_runs(df, "g", "at", "seq", ["c"], hold=True, rows_per_chunk=chunk))
    assert [held[i] for i in range(7)] == [10, 10, 20, 10, 20, 10, 20]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("chunk", [5, 40])
def test_random_runs(spark, seed, chunk):
    rng = random.Random(seed)
    # Long runs that cross several chunks, short ones, and NULLs in both columns.
    rows, g = [], None
    for i in range(300):
        if rng.random() < (0.02 if 100 < i < 200 else 0.4):
            g = rng.choice(["a", "b", None])
        rows.append((i * 3, g, rng.choice([1, 2, None])))
    df = spark.createDataFrame(rows, "at int, g string, c int").repartition(4)
    got = numbers(number_runs(df, "g", "at", "seq", base=5, step=2, rows_per_chunk=chunk))
    assert got == loop(rows, base=5, step=2)
    got = numbers(number_runs(df, "g", "at", "seq", changing="c", rows_per_chunk=chunk))
    assert got == loop(rows, changing=True)
    got = numbers(number_runs(df, "g", "at", "seq", changing="c", hold=True, rows_per_chunk=chunk))
    assert got == loop(rows, changing=True, hold=True)


@pytest.mark.parametrize("chunk", [3, 100])
def test_number_groups(spark, chunk):
    df = spark.createDataFrame(
        [("x", 2, 1), ("y", 1, 2), ("x", 1, 3), (None, 5, 4), ("x", 2, 5), (None, 4, 6)],
        "g string, c int, at int",
    )
    got = numbers(number_groups(df, "g", ["c", "at"], "seq", rows_per_chunk=chunk))
    assert got == {3: 10, 1: 20, 5: 30, 2: 10, 6: 10, 4: 20}


def test_hold_needs_changing(spark):
    with pytest.raises(ValueError):
        number_runs(spark.range(1), "id", "id", "seq", hold=True)


@pytest.mark.parametrize("fanout", [2, 7])
def test_runs_carried_through_a_tree(spark, monkeypatch, fanout):
    """Many small chunks, whose summaries meet in windows of a few: rows of one long run lie in most of them."""
    monkeypatch.setattr(chunks, "FANOUT", fanout)
    rng = random.Random(fanout)
    rows, g = [], "a"
    for i in range(400):
        if rng.random() < (0.0 if 80 < i < 300 else 0.3):
            g = rng.choice(["a", "b", None])
        rows.append((i, g, rng.choice([1, 2, None]) if i % 90 > 30 else 5))
    df = spark.createDataFrame(rows, "at int, g string, c int").repartition(4)
    assert numbers(number_runs(df, "g", "at", "seq", rows_per_chunk=6)) == loop(rows)
    got = numbers(number_runs(df, "g", "at", "seq", changing="c", rows_per_chunk=6))
    assert got == loop(rows, changing=True)
    got = numbers(number_runs(df, "g", "at", "seq", changing="c", hold=True, rows_per_chunk=6))
    assert got == loop(rows, changing=True, hold=True)


def test_values_of_all_kinds_are_compared(spark):
    """Zeros of both signs and not-a-numbers are equal, times differ by a microsecond, texts by their parts."""
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, CAST(0.0 AS double), TIMESTAMP'2024-01-01 00:00:00.000001', 'a', 'bc', array(1, NULL), X'00'),
          (2, CAST(-0.0 AS double), TIMESTAMP'2024-01-01 00:00:00.000001', 'a', 'bc', array(1, NULL), X'00'),
          (3, CAST('NaN' AS double), TIMESTAMP'2024-01-01 00:00:00.000002', 'ab', 'c', array(1), X'01'),
          (4, CAST('NaN' AS double), TIMESTAMP'2024-01-01 00:00:00.000002', 'ab', 'c', array(1), X'01'),
          (5, NULL, NULL, '-', NULL, NULL, NULL),
          (6, NULL, NULL, '-', NULL, NULL, NULL)
        AS t(at, d, t, s, u, l, b)""")
    for group in ("d", "t", ["s", "u"], "l", "b", ["d", "t", "s", "u", "l", "b"]):
        got = numbers(number_runs(df, group, "at", "seq", rows_per_chunk=2))
        assert [got[k] for k in range(1, 7)] == [10, 20] * 3, group
