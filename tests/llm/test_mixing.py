"""Mixing against plain Python: targets, nearness, nesting, reruns, hot rows."""

import math
from collections import Counter, defaultdict

import pytest
from drover.llm import mixing
from drover.session import stage
from pyspark.sql import functions as F


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, set(names)
    while left:
        rest = share * sum(sizes.values()) - sum(full.values())
        level = rest / sum(weight[s] for s in left)
        over = [s for s in left if weight[s] * level > most * sizes[s]]
        if not over:
            return full | {s: weight[s] * level for s in left}
        full |= {s: float(most * sizes[s]) for s in over}
        left -= set(over)
    return full


def check(found, rows):
    """`rows` are (source, size); `found` the mix of them."""
    sizes = Counter()
    for source, size in rows:
        sizes[source] += size or 0
    wanted = plain_targets(sizes)
    assert Counter((r.source, r.size) for r in found) == Counter(rows)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, wanted[r.source], rel_tol=1e-12, abs_tol=1e-12)
        assert r.taken in ((0, 0, 0) if not r.size else (0, r.size, 2 * r.size))
        taken[r.source] += r.taken
    for source, target in wanted.items():
        largest = max((size or 0) for s, size in rows if s == source)
        assert abs(taken[source] - target) <= largest / 2 + 1e-6


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, s, n, "t", 0.5, True) for k, (s, n) in enumerate(rows)],
        "doc_id long, source string, size long, text string, target double, _draw boolean",
    )


def test_mix_like_plain_targets(spark):
    rows = [(f"s{k * k % 11}", 1 + k * 7919 % 400) for k in range(3000)] + [(None, 5)] * 40 + [("hot", 900)] * 1500
    rows += [("\U0001f600", 3), ("￮", 4), ("", 9), ("z", None), ("zero", 0)]
    df = frame(spark, rows)
    found = mixing.mix(df)
    assert found.columns == ["doc_id", "source", "size", "text", "_draw", "source_size", "target", "taken"]
    check(found.collect(), rows)
    key = ["doc_id", "taken"]
    again = mixing.mix(df.repartition(3)).select(key).collect()
    assert sorted(found.select(key).collect()) == sorted(again)


@pytest.mark.parametrize("rows", [[("a", 7)], [("a", 7), ("b", 1)], [(None, 1)] * 3, [("a", 0)], [(None, None)]])
def test_few_rows(spark, rows):
    check(mixing.mix(frame(spark, rows)).collect(), rows)


def test_no_rows(spark):
    assert mixing.mix(frame(spark, [("a", 1)]).limit(0)).count() == 0


def test_equal_rows_are_told_apart(spark):
    """A third and more of all rows are the same, so their draws are."""
    rows = [("a", 10)] * 5000 + [("b", 10)] * 5000
    df = spark.createDataFrame(rows, "source string, size long").repartition(4)
    check(mixing.mix(df).collect(), rows)


def test_thresholds_nest(spark):
    rows = [(f"s{k % 3}" if k % 5 else None, k % 50, k * 2654435761 % 997, k) for k in range(6000)]
    df = stage(spark.createDataFrame(rows, "source string, words long, draw long, tie long").withColumn(
        "draw", F.col("draw") * (1 << 50)))
    names = df.select("source").distinct()
    budgets = names.crossJoin(spark.createDataFrame([(float(b),) for b in (0, 1, 500, 501, 9000, 10**9)], "budget double"))
    found = mixing.thresholds(df, budgets).collect()
    assert len(found) == 4 * 6
    taken = {}
    for t in found:
        mine = {(d, i) for s, w, _, i in rows for d in [_ * (1 << 50)] if s == t.source
                and ((d, i) < (t.last_draw, t.last_tie) or (d, i) == (t.last_draw, t.last_tie) and t.included)}
        words = sum(rows[i][1] for _, i in mine)
        total = sum(w for s, w, _, _ in rows if s == t.source)
        assert abs(words - min(t.budget, total)) <= 25
        taken[t.source, t.budget] = mine
    for (source, low), small in taken.items():
        assert all(small <= large for (s, high), large in taken.items() if s == source and high >= low)


def test_words(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " a b  c d ", "x" * 100_000, "x " * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.count_words("text")).collect()] == [0, 0, 0, 1, 2, 1, 100_000]
