"""Benchmark decontamination against scoring every passage with every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from drover.llm import decontamination as d
from drover.llm.queries import QUERIES
from drover.llm.shipping import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship(spark)


def split_words(text):
    return WORD.findall((text or "").translate(LOWER))


def word_runs(words):
    size = min(d.RUN, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def overlap(part, passage):
    if not part:
        return 1.0
    size = len(next(iter(part)))
    held = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return sum(r in held for r in part) / len(part)


def plain(docs, items):
    bags = [Counter(split_words(q) + split_words(a)) for _, q, a in items]
    df = Counter(t for b in bags for t in b)
    total, average = len(items), max(sum(sum(b.values()) for b in bags) / len(items), 1.0)
    impact = []
    for b in bags:
        size = sum(b.values())
        impact.append(
            {t: math.log(1 + (total - df[t] + 0.5) / (df[t] + 0.5)) * n * (d.K1 + 1) / (n + d.K1 * (1 - d.B + d.B * size / average)) for t, n in b.items()}
        )
    # The next power of two above the item's words.
    steps = [max(8, 1 << (max(sum(b.values()), 1) - 1).bit_length()) for b in bags]
    out = Counter()
    for doc_id, text in docs:
        words = split_words(text)
        for (item_id, q, a), own, step in zip(items, impact, steps):
            hit = False
            for start in range(0, len(words), step):
                passage = words[start : start + 2 * step]
                score = sum(own.get(t, 0) for t in set(passage))
                if not own or score < d.THRESHOLD * sum(own.values()) * (1 - 1e-9):
                    continue
                question, answer = (overlap(word_runs(split_words(x)), passage) for x in (q, a))
                hit |= question >= d.OVERLAP and (answer >= d.OVERLAP or question >= d.SURE)
            if hit:
                out[(doc_id, item_id)] += 1
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common = ["the", "of", "and", "to"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(n)]

    items = [(k, " ".join(prose(rng.randrange(3, 40))) + ".", " ".join(prose(rng.randrange(0, 6)))) for k in range(40)]
    items += [(100, "the of and to", ""), (101, None, None), (102, "", "to"), (None, "only w1 here and w2", "w3"), (3, "repeated id w9 w8 w7", "w6")]
    docs = []
    for k in range(120):
        words = prose(rng.randrange(0, 160))
        if rng.random() < 0.6:
            _, q, a = rng.choice(items)
            planted = split_words(q) + split_words(a)
            if rng.random() < 0.5 and planted:
                planted = planted[: rng.randrange(1, len(planted) + 1)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w if rng.random() < 0.95 else "changed" for w in planted]
        docs.append((k, " ".join(words).upper() if k % 7 == 0 else "\n".join(words)))
    return docs + [(None, docs[0][1]), (500, None), (501, ""), (502, docs[1][1]), (502, docs[1][1])], items


@pytest.mark.parametrize("limits", [{}, {"index_bytes": 700}, {"index_bytes": 120}])
def test_leaks_like_plain_scoring(spark, limits):
    """The size of an index changes nothing, nor does a very long item among short ones."""
    docs, items = corpus(1)
    rng = random.Random(4)
    items.append((900, " ".join(f"w{rng.randrange(400)}" for _ in range(2500)) + ".", "the end"))
    docs.append((900, " ".join(split_words(items[-1][1])[:2300])))
    frame = spark.createDataFrame([(*x, 0) for x in docs], "doc_id long, text string, item_id int").repartition(3)
    tests = spark.createDataFrame([(*x, "z") for x in items], "item_id long, question string, answer string, text string")
    rows = d.find_leaks(frame, tests, **limits).collect()
    mine = Counter((r["doc_id"], r["item_id"]) for r in rows)
    expected = plain(docs, items)
    assert (mine - expected, expected - mine) == (Counter(), Counter())
    assert len(mine) > 30 and (900, 900) in mine
    if not limits:
        clean = d.without_leaks(frame, tests).collect()
        leaked = {k for k, _ in mine}
        assert Counter(r["doc_id"] for r in clean) == Counter(k for k, _ in docs if k not in leaked)
        assert clean[0].asDict().keys() == set(frame.columns)
    assert all(0 <= r["score"] <= 1 and 0 <= r["question_overlap"] <= 1 for r in rows)
    for a, b in ((frame.limit(0), tests), (frame, tests.limit(0))):
        assert d.find_leaks(a, b).count() == 0
        assert d.without_leaks(a, b).count() == a.count()


def test_wand_finds_what_full_scoring_finds():
    docs, items = corpus(5)
    frequency = Counter(h for _, q, a in items for h in set(np.concatenate(d._word_lists([q, a])).tolist()))
    index = d.Index(items, frequency, len(items), 20.0, 0.4)
    rng = random.Random(0)
    for _ in range(300):
        query = sorted(rng.sample(range(len(index.terms)), rng.randrange(1, 60)))
        score = np.zeros(len(items))
        for t in query:
            score[index.owner[index.first[t] : index.end[t]]] += index.weight[index.first[t] : index.end[t]]
        assert [k for k, _ in index.search(query)] == np.flatnonzero(score >= 1 - 1e-9).tolist()


def test_query_finds_verbatim_items(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    verbatim = {(k, i["item_id"]) for k, t in docs for i in items if i["text"] in t}
    mine = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontamination"](spark, folder).collect()}
    assert verbatim <= mine and len(mine) <= len(verbatim) + 2


def test_a_long_item_makes_no_clean_text_a_leak(spark):
    """The parts of a short item far from each other are none, whatever items there are besides."""
    filler = [f"f{k}" for k in range(3000)]
    text = filler[:700] + "alpha beta gamma delta".split() + filler[700:2200] + "epsilon zeta eta theta".split() + filler[2200:]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, "alpha beta gamma delta epsilon zeta eta theta")], "doc_id long, text string")
    short = [(1, "alpha beta gamma delta epsilon zeta eta theta", "")]
    long = [(2, " ".join(f"long{k}" for k in range(4000)), "")]
    for items in (short, short + long):
        frame = spark.createDataFrame(items, "item_id long, question string, answer string")
        assert [(r["doc_id"], r["item_id"]) for r in d.find_leaks(docs, frame).collect()] == [(2, 1)]
