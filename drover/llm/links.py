"""The whole Jaccard join: every link between texts with different shingle sets, and each text's number of links.

`near.near_duplicates` tells which documents are connected and skips pairs that
are connected already. Here no pair is skipped, and the adaptive multi-match
prefixes of `near` alone decide which pairs are compared shingle by shingle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drover.llm import near
from drover.session import stage


def similar_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between class keys, a pair once, and membership (doc_id, n_shingles, class_key).

    Documents with equal shingle sets are one class, so copies aren't expanded
    into pairs; two classes are linked when their sets' Jaccard similarity is at
    least `near.SIMILARITY`, compared in whole numbers. The links are as many as
    there are similar pairs of different sets, which in a group of n near copies
    is up to n * (n - 1) / 2; no link is left out. NULL, empty and blank texts
    have no set, a NULL key and no link; NULL ids and repeated rows are kept; an
    empty table gives two empty ones. Both results are stored.
    """
    found = stage(near.survey(docs), "links-survey")
    members = found.where("part IS NULL").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.expr("CASE WHEN n > 0 THEN key END").alias("class_key")
    )
    words = (
        F.conv(F.substring("signs", 1 + 16 * k, 16), 16, -10).cast("long").alias(name)
        for k, name in enumerate(near._SIGNS)
    )
    classes = stage(
        found.where("part IS NULL AND n > 0")
        .groupBy("key")
        .agg(F.first("n").cast("long").alias("n"), F.hex(F.first("packed")).alias("signs"))
        .select("key", "n", *words),
        "links-classes",
    )
    levels = near._frequency_levels(found.where("part IS NOT NULL"))
    shared = stage(near._shared(near._postings(docs, levels)), "links-shared")
    # Each class is a group of its own, so that no pair counts as connected already.
    alone = classes.selectExpr("key AS node", "key AS root")
    pairs = stage(near._across(shared, alone, classes), "links-pairs")
    return stage(near._verified(docs, pairs), "links"), members


def link_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, class_key, n_copies, n_links) for every row of `docs` (doc_id, text).

    `n_copies` counts the other rows with the same set, `n_links` the other
    classes that the row's class is linked to; both are 0 for rows without a
    set. Cases as in `similar_classes`.
    """
    links, members = similar_classes(docs)
    ends = links.select(F.explode(F.array("a", "b")).alias("class_key"))
    linked = ends.groupBy("class_key").agg(F.count(F.lit(1)).alias("n_links"))
    sizes = members.where("class_key IS NOT NULL").groupBy("class_key").agg(F.count(F.lit(1)).alias("n"))
    # One row per class; as structs are compared, a class with many rows can be split at run time.
    of_class = sizes.join(linked, "class_key", "left").select(F.struct("class_key").alias("_class"), "n", "n_links")
    return (
        members.withColumn("_key", F.struct("class_key"))
        .join(of_class, F.col("_key") == F.col("_class"), "left")
        .select(
            "doc_id",
            "n_shingles",
            "class_key",
            F.coalesce(F.col("n") - 1, F.lit(0)).alias("n_copies"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
