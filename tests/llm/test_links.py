"""Links and their counts against all pairs."""

import random
import re
from collections import Counter

from drover.llm import links
from drover.llm.shipping import ship

SCHEMA = "doc_id long, text string"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def plain(rows):
    sets = [plain_set(t) for _, t in rows]
    kinds = set(sets) - {frozenset()}
    count = {s: sum(x != s and 100 * len(s & x) >= 75 * len(s | x) for x in kinds) for s in kinds}
    copies = Counter(sets)
    return Counter(
        (d, len(s), copies[s] - 1 if s else 0, count.get(s, 0)) for (d, _), s in zip(rows, sets)
    )


def near_copies():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 90)))) for k in range(60)]
    for k in range(60, 160):  # a large group whose members are mostly linked with each other
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    rows += [(200 + k, rows[k][1].upper()) for k in range(0, 160, 7)]
    return rows + [(300, None), (301, ""), (302, " \n"), (303, "a b"), (304, "A  B"), (None, "a b"), (None, None), (303, "a b")]


def test_link_counts_like_all_pairs(spark):
    ship(spark)
    rows = near_copies()
    found = links.link_counts(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["n_copies"], r["n_links"]) for r in found)
    assert got == plain(rows)
    assert max(r["n_links"] for r in found) > 20


def test_links_of_an_empty_table(spark):
    ship(spark)
    assert links.link_counts(spark.createDataFrame([], SCHEMA)).isEmpty()
