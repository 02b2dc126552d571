"""Context-tree weighting against a plain recursive version."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from drover.llm import ctw
from drover.llm.queries import QUERIES
from drover.llm.shipping import ship

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship(spark)


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode())


def plain(rows):
    """doc_id -> (tokens, known, training tokens, base score, score)."""
    depth = ctw.DEPTH
    train = [tokens(t) for _, t, held in rows if not held]
    counts = Counter(w for ws in train for w in [*ws, b"\n"])
    total, distinct = sum(counts.values()), len(counts)
    nodes = defaultdict(lambda: [0, 0])
    for words in train:
        seq = b"\n" * depth + b" ".join(words) + b"\n"
        for i in range(depth, len(seq)):
            for d in range(depth + 1):
                for k in range(8):
                    nodes[(seq[i - d : i], k, seq[i] >> (8 - k))][(seq[i] >> (7 - k)) & 1] += 1
    below = defaultdict(list)
    for context, k, prefix in list(nodes):
        if context:
            below[(context[1:], k, prefix)].append((context, k, prefix))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    @cache
    def weighted(node):
        own = kt(*nodes[node])
        if len(node[0]) == depth:
            return own
        return np.logaddexp(own, sum(weighted(c) for c in below[node])) - math.log(2)

    def bit(history, k, prefix, value):
        mixed = None
        for d in range(depth, -1, -1):
            node = (history[len(history) - d :], k, prefix)
            if node not in nodes:
                continue
            n = nodes[node]
            estimate = (n[value] + 0.5) / (sum(n) + 1)
            stop = math.exp(kt(*n) - math.log(2) - weighted(node)) if d < depth else 1.0
            mixed = estimate if mixed is None else stop * estimate + (1 - stop) * mixed
        return 0.5 if mixed is None else mixed

    out = {}
    for doc_id, text, _ in rows:
        words = tokens(text)
        seq = b"\n" * depth + b" ".join(words) + b"\n"
        score = 0.0
        for i in range(depth, len(seq)):
            for k in range(8):
                score += math.log10(bit(seq[i - depth : i], k, seq[i] >> (8 - k), (seq[i] >> (7 - k)) & 1))
        own = [*words, b"\n"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        out[doc_id] = (len(own), sum(counts[w] > 0 for w in own), total, base, score)
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, held_out boolean, block string, key int")
    found = ctw.score(frame.repartition(3)).collect()
    expected = plain(rows)
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    for r in found:
        n, known, total, base, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)
    return frame


def test_like_the_plain_version(spark):
    rng = random.Random(3)
    words = ["the", "The", "cat", "sat", "on", "mat.", "é", "xyzzy"]
    rows = [(k, " \n".join(rng.choices(words, k=rng.randrange(0, 30))), k % 4 == 0) for k in range(24)]
    rows += [(50, None, False), (51, "", True), (52, " \t ", False), (53, "never seen ÿ\x00 q", True), (None, "the cat", True)]
    check(spark, rows)


def test_without_training_texts_and_empty(spark):
    frame = check(spark, [(1, "a b", True), (2, None, True)])
    assert ctw.score(frame.limit(0)).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    data = rng.choice(np.frombuffer(b"ab c\n", dtype=np.uint8), 400)
    code = data[ctw.DEPTH :].astype(np.uint64)
    for k in range(1, ctw.DEPTH + 1):
        code = code | (data[ctw.DEPTH - k : len(data) - k].astype(np.uint64) << np.uint64(8 * (ctw.DEPTH - k + 1)))
    code, count = np.unique(code, return_counts=True)
    context = code[7] & ~np.uint64(255)
    every = np.union1d(code, context + np.arange(256, dtype=np.uint64))
    counts = np.zeros(len(every))
    counts[np.searchsorted(every, code)] = count
    frames = []
    for group in np.unique(every >> np.uint64(8 * (ctw.DEPTH - 1))):
        chosen = (every >> np.uint64(8 * (ctw.DEPTH - 1))) == group
        level = ctw.subtree(every[chosen], counts[chosen], 2)[0]
        for k in range(8):
            first = ctw.runs(level.nodes[k])
            unit = level.unit[first]
            frames.append({"byte": (unit >> np.uint64(16)) & np.uint64(255), "node": (1 << k) | ((unit & np.uint64(255)) >> np.uint64(8 - k)).astype(int), "zeros": level.zeros[k], "ones": level.ones[k], "weighted": level.weighted[k]})
    import pandas as pd

    top = ctw.Top(pd.concat(map(pd.DataFrame, frames)).groupby(["byte", "node"], as_index=False).sum())
    group = every[(every >> np.uint64(8 * (ctw.DEPTH - 1))) == context >> np.uint64(8 * (ctw.DEPTH - 1))]
    values = ctw.log_probabilities(group, counts[np.searchsorted(every, group)], top)
    assert math.isclose((10 ** values[(group & ~np.uint64(255)) == context]).sum(), 1.0, rel_tol=1e-9)


def test_query_beats_the_base_on_held_out_texts(spark):
    rows = QUERIES["op4_context_tree_weighting"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_unknown_held_out_is_held_out(spark):
    rows = [(1, "a b", True), (2, "a c", False), (3, "b", None)]
    found = {r.doc_id: r for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    assert found[3].held_out and not found[2].held_out and {r.train_tokens for r in found.values()} == {3}
