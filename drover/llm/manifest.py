"""Merkle manifest of a dataset: leaves and the outer nodes they need, cogrouped by superblock."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.llm.text import tidy
from drover.operators.ordering import col, rank_in_group, with_row_index
from drover.session import stage

#: Children of a node.
RUN = 3
#: Levels that one superblock reduces: 3 ** 8 leaves.
HEIGHT = 8

RESULTS = ("leaf", "subroot", "root", "position", "siblings", "turns", "proof_sha256", "folded_root", "verified")


def digest(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


def leaf_of(columns: Sequence[str | Column]) -> Column:
    """SHA-256 of a row: each value as its UTF-8 length, a colon and itself; `-` for NULL."""
    texts = [(col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def depth(count: int) -> int:
    """Levels above `count` leaves until one node is left."""
    levels, reach = 0, 1
    while reach < count:
        levels, reach = levels + 1, reach * RUN
    return levels


def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the levels above them; each node is the digest of a run."""
    found = [nodes]
    for _ in range(levels):
        last = found[-1]
        found.append([digest("".join(last[i : i + RUN])) for i in range(0, len(last), RUN)])
    return found


def path(levels: list[list[str]], place: int) -> tuple[str, str]:
    """Siblings of a leaf, level by level and left to right, and for each level its place and their number."""
    siblings, turns = [], []
    for nodes in levels[:-1]:
        first = place - place % RUN
        others = nodes[first:place] + nodes[place + 1 : first + RUN]
        siblings += others
        turns.append(f"{place - first}{len(others)}")
        place //= RUN
    return "".join(siblings), "".join(turns)


def fold(node: str, siblings: str, turns: str) -> str:
    """The root that a leaf and its siblings lead to."""
    at = 0
    for place, others in zip(map(int, turns[::2]), map(int, turns[1::2])):
        left, right = at + 64 * place, at + 64 * others
        node = digest(siblings[at:left] + node + siblings[left:right])
        at = right
    return node


def _levels(count: int, height: int) -> int:
    """Levels that a superblock of a tree with `count` nodes reduces."""
    return min(depth(count), height)


#: The tree a node belongs to: its source, and whether that is not NULL.
TREE = ("present", "tree")


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"position DIV {RUN**height}"))


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The top of each superblock, as a node of the next tier."""

    @tidy
    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        levels = climb(block["node"].tolist(), _levels(int(block["count"].iat[0]), height))
        first = block.iloc[:1]
        return pd.DataFrame(
            {
                **{c: first[c] for c in TREE},
                "position": first["block"],
                "count": -(-first["count"] // RUN**height),
                "leaves": first["leaves"],
                "node": levels[-1],
            }
        )

    schema = "present boolean, tree string, position long, count long, leaves long, node string"
    blocks = _blocks(nodes, height).select(*TREE, "block", "position", "count", "leaves", "node")
    return stage(blocks.groupBy(*TREE, "block").applyInPandas(top, schema), "tops")


def _reduce(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """All tiers of nodes from the leaves up, and the roots of all trees."""
    tiers, roots = [nodes], None
    while True:
        tops = _tops(tiers[-1], height)
        done = tops.where("count = 1").select(*TREE, "leaves", "node")
        roots = done if roots is None else roots.unionByName(done)
        rest = tops.where("count > 1")
        if rest.isEmpty():
            return tiers, roots
        tiers.append(rest)


def _exchange(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """For each node of a tier its siblings up to the root, as the outer nodes of its children.

    `outer` has one row for each superblock: what lies above its top.
    """

    @tidy
    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("position"), above.iloc[0]
        levels = climb(block["node"].tolist(), _levels(int(block["count"].iat[0]), height))
        found = [path(levels, k) for k in range(len(block))]
        return pd.DataFrame(
            {
                **{c: block[c] for c in TREE},
                "block": block["position"],
                "siblings": [s + above["siblings"] for s, _ in found],
                "turns": [t + above["turns"] for _, t in found],
                "subroot": above["subroot"],
                "root": above["root"],
            }
        )

    schema = "present boolean, tree string, block long, siblings string, turns string, subroot string, root string"
    left = _blocks(nodes, height).select(*TREE, "block", "position", "count", "node").groupBy(*TREE, "block")
    return stage(left.cogroup(outer.groupBy(*TREE, "block")).applyInPandas(join, schema), "outer")


def _down(tiers: list[DataFrame], outer: DataFrame, height: int) -> DataFrame:
    """The outer nodes of the first tier's superblocks; `outer` has those of the trees' roots.

    A tree enters at the first tier where it has one superblock.
    """
    found = None
    for tier in reversed(range(len(tiers))):
        one = F.col("leaves") <= RUN ** (height * (tier + 1))
        if tier:
            one &= F.col("leaves") > RUN ** (height * tier)
        entering = outer.where(one).withColumn("block", F.lit(0).cast("long")).drop("leaves")
        found = entering if found is None else found.unionByName(entering)
        if tier:
            found = _exchange(tiers[tier], found, height)
    return found


def manifest(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    columns: Sequence[str] | None = None,
    candidate: Sequence[str | Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """The Merkle root over all rows, with the proof of each row and its verification.

    A row's leaf is `leaf_of(columns)`, by default of all columns. The leaves of a
    source, by `key`, are hashed in runs of three until one node is left, the
    subroot; the subroots, by source, likewise to the root. `candidate` are the
    columns of a row to be verified (a copy, say) in place of the row's own: its leaf is
    folded with the row's siblings, and `verified` says whether that gives the root.

    Returns key, source and leaf, subroot, root, position (in its source),
    siblings (their digests one after the other, from the leaf to the root),
    turns (for each level the node's place in its run and the number of
    siblings), proof_sha256, folded_root, verified. Other columns are dropped.
    NULL keys come first in their source, NULL is the first source; rows with
    equal keys go by leaf, equal rows in any order, each with a place of its own. An
    empty table gives an empty one.

    Leaves are stored with their position, then dealt to superblocks of 3 **
    `height`. Each superblock reduces its leaves to one node, these are
    dealt again until one is left for each source, and the same goes for the subroots. Back
    down each superblock is cogrouped with the one row of outer nodes above it. So a
    task holds one superblock, however large a source is.
    """
    columns = list(columns or df.columns)
    own = leaf_of(columns)
    tie = F.xxhash64(F.monotonically_increasing_id())
    leaves = df.select(
        col(key).alias("_key"),
        col(source).alias("_source"),
        own.alias("leaf"),
        (own if candidate is None else leaf_of(candidate)).alias("candidate"),
        tie.alias("tie"),
    )
    ranked = rank_in_group(stage(leaves, "leaves"), "_source", ["_key", "leaf", "tie"], "rank")
    counts = ranked.groupBy("_source").agg(F.count(F.lit(1)).alias("count"))
    known = F.col("_source").isNotNull()
    # One row for each source; Spark splits a hot source unless this is small enough to broadcast.
    numbered = ranked.join(
        counts.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))
    ).select(
        "_key", "_source", "leaf", "candidate",
        known.alias("present"),
        F.coalesce(F.col("_source").cast("string"), F.lit("")).alias("tree"),
        (F.col("rank") - 1).alias("position"),
        "count",
        F.col("count").alias("leaves"),
        F.col("leaf").alias("node"),
    )
    numbered = stage(numbered, "numbered")
    tiers, subroots = _reduce(numbered, height)

    subroots = stage(subroots, "subroots")
    sources = F.lit(subroots.count()).cast("long")
    listed = with_row_index(subroots.withColumnRenamed("node", "subroot"), list(TREE), "position")
    one_tree = stage(
        listed.select(
            F.lit(True).alias("present"), F.lit("").alias("tree"), "position",
            sources.alias("count"), sources.alias("leaves"), F.col("subroot").alias("node"),
        ),
        "subroots",
    )
    upper, root = _reduce(one_tree, height)
    none = F.lit("")
    start = root.select(
        *TREE, "leaves", none.alias("siblings"), none.alias("turns"), none.alias("subroot"), F.col("node").alias("root")
    )
    above = _exchange(upper[0], _down(upper, start, height), height)
    above = above.select("block", "siblings", "turns", "root").join(
        listed.select(F.col("position").alias("block"), *TREE, "leaves", "subroot"), "block"
    )
    above = stage(above.select(*TREE, "leaves", "siblings", "turns", "subroot", "root"), "outer")
    outer = _down(tiers, above, height)

    @tidy
    def prove(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("position"), above.iloc[0]
        levels = climb(block["leaf"].tolist(), _levels(int(block["count"].iat[0]), height))
        found = [path(levels, k) for k in range(len(block))]
        siblings = [s + above["siblings"] for s, _ in found]
        turns = [t + above["turns"] for _, t in found]
        block = block.assign(siblings=siblings, turns=turns, subroot=above["subroot"], root=above["root"])
        block["proof_sha256"] = [digest(s) for s in siblings]
        block["folded_root"] = [fold(*each) for each in zip(block["candidate"], siblings, turns)]
        block["verified"] = block["folded_root"] == block["root"]
        return block[["_key", "_source", *RESULTS]]

    types = {f.name: f.dataType.simpleString() for f in leaves.schema.fields}
    schema = (
        f"_key {types['_key']}, _source {types['_source']}, leaf string, subroot string, root string, position long, "
        "siblings string, turns string, proof_sha256 string, folded_root string, verified boolean"
    )
    blocks = _blocks(numbered, height).select("_key", "_source", "leaf", "candidate", *TREE, "block", "position", "count")
    proved = blocks.groupBy(*TREE, "block").cogroup(outer.groupBy(*TREE, "block")).applyInPandas(prove, schema)
    return proved.select(F.col("_key").alias(key), F.col("_source").alias(source), *RESULTS)
