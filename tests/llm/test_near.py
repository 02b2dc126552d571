"""Near duplicates against comparing all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from drover.llm import near
from drover.llm.components import components
from drover.llm.queries import QUERIES
from drover.llm.shipping import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def plain(rows):
    """Counter of (doc_id, n_shingles, component_id), by comparing all pairs of distinct sets."""
    members = defaultdict(list)
    for doc_id, text in rows:
        members[plain_set(text)].append(doc_id)
    alone = members.pop(frozenset(), [])
    sets = list(members)
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, x in enumerate(sets):
        for j in range(i):
            if 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(sets):
        ids = [d for d in members[x] if d is not None]
        least[find(i)] = min([least.get(find(i), float("inf")), *ids])
    out = Counter((d, 0, d) for d in alone)
    for i, x in enumerate(sets):
        value = least[find(i)]
        out.update((d, len(x), None if value == float("inf") else value) for d in members[x])
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, n int")
    mine = near.near_duplicates(frame.repartition(4))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in mine.collect()) == plain(rows)
    return frame


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship(spark)


def edits(rng, words, count):
    words = list(words)
    for _ in range(count):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_groups_and_shared_passages(spark):
    rng = random.Random(5)
    vocabulary = [f"v{k}" for k in range(4000)]
    passage = rng.choices(vocabulary, k=60)
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randrange(40, 260))
        for _ in range(rng.randrange(1, 9)):  # some of them just above, some just below the limit
            texts.append(edits(rng, base, rng.randrange(0, 9)))
    chain = rng.choices(vocabulary, k=200)
    for _ in range(10):
        chain = chain[8:] + rng.choices(vocabulary, k=8)
        texts.append(" ".join(chain))
    for _ in range(60):  # a passage that many texts hold and nothing else in common
        texts.append(" ".join(passage + rng.choices(vocabulary, k=rng.randrange(0, 40))))
    group = rng.choices(vocabulary, k=120)
    texts += [edits(rng, group, 2) for _ in range(80)] + [" ".join(group)] * 30
    ids = rng.sample(range(10**6), len(texts))
    check(spark, list(zip(ids, texts)))


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two three four"), (7, "One  two\nthree four"),
        (8, "one two three four five"), (9, "a " * 9000), (10, "a " * 7), (None, "a a a a a a"), (None, None), (4, "one"),
        (None, "only null here"), (None, "ONLY NULL HERE"), (11, "é" * 3000), (12, " "), (12, " "), (-5, "one"),
    ]
    frame = check(spark, rows)
    assert near.near_duplicates(frame.limit(0)).count() == 0
    kept = near.keep_one(frame).collect()
    assert sorted((r["doc_id"] for r in kept if r["doc_id"] is not None)) == [-5, 1, 2, 3, 6, 8, 9, 11, 12]
    assert sum(r["doc_id"] is None for r in kept) == 4 and kept[0]["key"] == "x"


def test_prefixes_keep_the_promise():
    """Similar sets share at least m shingles of their prefixes for every m that is asked."""
    rng = np.random.default_rng(2)
    levels = rng.integers(0, 3, 64).astype(np.uint8)
    for _ in range(300):
        common = rng.integers(0, 2**63, rng.integers(1, 80), dtype=np.uint64)
        x = np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, 20), dtype=np.uint64)]))
        y = np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, 20), dtype=np.uint64)]))
        inter = len(np.intersect1d(x, y))
        if 100 * inter < 75 * (len(x) + len(y) - inter):
            continue
        n = np.array([len(x), len(y)])
        found = near.prefixes(n, np.repeat([0, 1], n), np.concatenate([x, y]), levels)
        overlap = -(-75 * sum(n) // 175)
        for asks in range(1, min(near.MOST_MATCHES, *near._least_overlap(n)) + 1):
            reach = n[found.row] - overlap + asks
            a, b = (set(found.token[(found.row == k) & (found.rank < reach)].tolist()) for k in (0, 1))
            assert len(a & b) >= asks
        assert all(found.asks <= near._least_overlap(n))


def test_components(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)]
    links += [(1000, 1000 + k) for k in range(1, 40)]
    root = {n: n for pair in links for n in pair}
    for _ in range(len(links)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    mine = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in mine} == root and len(mine) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    mine = QUERIES["op9_near_duplicates"](spark, folder).collect()
    assert Counter(map(tuple, mine)) == plain(rows)
