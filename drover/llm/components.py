"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: long); `root` is the least node in reach.

    Each round every root takes the least root that one of its members is linked
    to, then follows the chain of roots to its end in steps that double. Rounds
    are stored in the shared folder; their number grows with the logarithm of
    the longest path in practice. Only counts reach the driver.
    """
    edges = links.select("a", "b").union(links.select("b", "a")).distinct()
    edges = stage(edges, "edges")
    roots = stage(
        edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        .select("node", F.least("node", "least").alias("root")),
        "roots",
    )
    while True:
        jumped = roots.alias("x").join(roots.alias("y"), F.expr("x.root = y.node"), "left")
        roots = stage(
            jumped.select("x.node", F.coalesce("y.root", "x.root").alias("root")), "roots"
        )
        near = (
            edges.join(roots.withColumnRenamed("node", "a").withColumnRenamed("root", "mine"), "a")
            .join(roots.withColumnRenamed("node", "b").withColumnRenamed("root", "other"), "b")
            .where("other < mine")
            .groupBy("mine")
            .agg(F.min("other").alias("to"))
        )
        hooks = stage(near, "hooks")
        if hooks.isEmpty():
            # Chains of roots may remain where nothing is left to hook.
            flat = roots.alias("x").join(roots.alias("y"), F.expr("x.root = y.node"))
            if flat.where("x.root <> y.root").isEmpty():
                return roots
            continue
        moved = roots.alias("x").join(hooks.alias("h"), F.expr("x.root = h.mine"), "left")
        roots = stage(moved.select("x.node", F.coalesce("h.to", "x.root").alias("root")), "roots")
