"""Repeated strings against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from drover.llm import repeats
from drover.llm.queries import QUERIES
from drover.llm.shipping import ship


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship(spark)


def plain(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    n = repeats.LENGTH
    seen = Counter(t[i : i + n] for _, t in texts for i in range(len(t) - n + 1))
    out = Counter()
    for doc_id, text in texts:
        gone = np.zeros(len(text) + 1, dtype=bool)
        for i in range(len(text) - n + 1):
            if seen[text[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out[(doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def check(spark, rows, **limits):
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, key string").repartition(5)
    mine = repeats.measure(frame, repeats.find_repeats(frame, **limits)).collect()
    assert Counter(tuple(r) for r in mine) == plain(rows)
    return frame


def prose(rng, count):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(count))


def corpus(rng):
    passages = [prose(rng, rng.randrange(20, 90)) for _ in range(6)]
    passages += [passages[0][k : k + 200] for k in (0, 1, 7)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(prose(rng, rng.randrange(1, 60)))
            else:
                passage = rng.choice(passages)
                a = rng.randrange(0, max(1, len(passage) - 190))
                parts.append(passage[a : a + rng.choice((150, 190, 199, 200, 201, 260, 1000))])
        texts.append(rng.choice(("", " ", "X")).join(parts))
    texts += ["ab" * 300, "a" * 199, "a" * 200, "a" * 201, "ab" * 50, None, "", "é" * 100, "é" * 99 + "aé", texts[0], texts[0]]
    return texts


@pytest.mark.parametrize("large", [repeats.LARGE_GROUP, 2])
def test_like_counting_windows(spark, large):
    for seed in (1, 2):
        texts = corpus(random.Random(seed))
        check(spark, list(enumerate(texts)), large_group=large)


def test_odd_rows(spark):
    same = prose(random.Random(9), 80)
    frame = check(spark, [(1, same), (1, same), (None, same + "!"), (None, None), (2, ""), (3, None), (3, None)])
    assert repeats.measure(frame.limit(0), repeats.find_repeats(frame.limit(0))).count() == 0


def test_removal_keeps_whole_characters(spark):
    rng = random.Random(4)
    shared = "é" + prose(rng, 60) + "é"
    texts = [prose(rng, 10) + "Aè" + shared + "êX" + prose(rng, 10), prose(rng, 9) + "Bè" + shared + "êY" + prose(rng, 9), None, "", shared[:50]]
    frame = spark.createDataFrame([(k, t, len(t or ""), k, k) for k, t in enumerate(texts)], "doc_id long, text string, n_chars int, key long, copied long")
    rows = {r["doc_id"]: r for r in repeats.remove_repeats(frame, repeats.find_repeats(frame)).collect()}
    assert len(rows) == 5 and rows[2]["text"] is None and rows[4]["text"] == texts[4] and rows[4]["key"] == 4
    for k in (0, 1):
        gone = rows[k]["text"]
        assert gone == texts[k].replace("è" + shared + "ê", "") and rows[k]["n_chars"] == len(gone)


def test_removal_with_clashing_names_and_no_nulls(spark):
    text = "0123456789" * 30
    df = spark.range(4).select(F.lit(text).alias("text"), F.col("id").alias("doc_id"), F.lit(1).alias("_"), F.lit(2).alias("row"),
                               F.lit(3).alias("key"), F.lit(4).alias("low"))
    out = repeats.remove_repeats(df, repeats.find_repeats(df.select("doc_id", "text")))
    assert [tuple(r) for r in sorted(out.collect(), key=lambda r: r["doc_id"])] == [("", k, 1, 2, 3, 4) for k in range(4)]


def test_refinement_sorts_and_measures():
    rng = np.random.default_rng(0)
    block = np.sort(rng.integers(0, 5, 200))
    suffix = rng.integers(97, 99, (200, 40)).astype(np.uint8)
    suffix[::7, :24] = suffix[0, :24]
    order, common = repeats.refine(block, suffix)
    rows = [(block[k], suffix[k].tobytes()) for k in order]
    assert rows == sorted(rows)
    for k in range(1, 200):
        (a, x), (b, y) = rows[k - 1], rows[k]
        expected = 0 if a != b else next((i for i in range(40) if x[i] != y[i]), 40)
        assert common[k] == expected


def test_query_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    mine = QUERIES["op7_suffix_repeats"](spark, folder).collect()
    assert Counter(tuple(r) for r in mine) == plain(rows)
