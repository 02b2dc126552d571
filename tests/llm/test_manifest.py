"""The manifest against a plain recursive tree."""

import hashlib

import duckdb
import pytest
from drover.llm import manifest
from drover.llm.queries import QUERIES, SQL
from pyspark.sql import functions as F


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each node its (left, right) siblings level by level."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            run = p - p % 3
            ways[k].append((nodes[run:p], nodes[p + 1 : run + 3]))
            at[k] = p // 3
        nodes = [H(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def plain(rows):
    """rows: (key, source, leaf, candidate); the results as a sorted list."""
    groups = {}
    for row in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots = {s: tree([r[2] for r in groups[s]]) for s in names}
    root, above = tree([subroots[s][0] for s in names])
    found = []
    for k, s in enumerate(names):
        for row, way in zip(groups[s], subroots[s][1]):
            node = row[3]
            for left, right in way + above[k]:
                node = H(*left, node, *right)
            proof = H(*(x for left, right in way + above[k] for x in left + right))
            found.append((row[0], row[2], subroots[s][0], root, proof, node, node == root))
    return sorted(found, key=repr)


@pytest.mark.parametrize("height", [1, 2, 8])
def test_like_recursive_tree(spark, height):
    texts = [None, "", "a", "é\nü", "x\n" * 3, "long " * 20_000]
    rows = [(k * 37 % 301 if k % 9 else None, f"s{k * k % 7}" if k % 4 else None, texts[k % 6], k % 3) for k in range(400)]
    rows += [(5, "hot", "same", 1)] * 150 + [(1, "", "\n", 1), (2, "￮", "", 1), (3, "\U0001f600", "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, root int")
    # The candidate loses its line breaks.
    cut = F.translate("leaf", "\n", "")
    found = manifest.manifest(df, candidate=["doc_id", "source", cut, "root"], height=height)
    assert found.columns == ["doc_id", "source", *manifest.RESULTS]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    mine = sorted(map(tuple, found.select(names).collect()), key=repr)
    lost = [(k, s, leaf(k, s, t, n), leaf(k, s, t and t.replace("\n", ""), n)) for k, s, t, n in rows]
    assert mine == plain(lost)
    one = found.where("doc_id = 3 AND source > 'z'").first()
    assert manifest.fold(one.leaf, one.siblings, one.turns) == one.root


@pytest.mark.parametrize("rows", [[(1, "a")], [(None, None)], [(k, "a") for k in range(10)], [(1, s) for s in "abcd"]])
def test_small_forests(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string")
    found = manifest.manifest(df, height=1)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    mine = sorted(map(tuple, found.select(names).collect()), key=repr)
    assert mine == plain([(k, s, leaf(k, s), leaf(k, s)) for k, s in rows])
    assert all(r[-1] for r in mine)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, source string, siblings int")
    assert manifest.manifest(df).count() == 0


def test_query_and_sql_with_odd_rows(spark, tmp_path):
    texts = [None, "", "a\nb", "é", "same\n"]
    rows = [(k if k % 6 else None, texts[k % 5], "en" if k % 2 else None, f"s{k % 5}" if k % 3 else None, k) for k in range(200)]
    rows += [rows[2]] * 20
    folder = str(tmp_path)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op13_merkle_manifest"](spark, folder)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    result = connection.execute(SQL["op13_merkle_manifest"])
    expected = sorted(result.fetchall(), key=repr)
    assert sorted(map(tuple, found.select([d[0] for d in result.description]).collect()), key=repr) == expected
    assert len({r[-1] for r in expected}) == 2
