"""URL filter lists: host-suffix and path-prefix expressions, looked up by short hash prefixes.

Only DataFrame functions run on rows, so the work stays in compiled code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drover.operators.ordering import col, fresh

#: Hex digits of the digest that the lookup joins on; full digests are compared after the join.
PREFIX_DIGITS = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for NULL or without `://`.

    The host runs from the first `://` to `/`, `?`, `#` or the end, the path
    from there to `?`, `#` or the end.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    host = F.translate(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _suffix(host: Column, labels: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -labels)


def _folder(path: Column, depth: Column) -> Column:
    """The first `depth` folders of a path, with their slashes; depth 0 is the empty path."""
    return F.when(depth == 0, "").otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), depth), F.lit("/")))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _expression(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge `pages.url` by `rules` (host, path, verdict): adds host, path, rule and verdict.

    A rule fits its host and all hosts below it, if the URL's path starts with
    the rule's path. The longest rule wins, longer hosts before longer paths;
    of equal rules `block` wins. Pages that no rule fits get `default` and a
    NULL rule. Each distinct URL is expanded once into host suffixes times
    folder prefixes, at most as many labels and folders deep as any rule is;
    a part of a rule's path after its last slash is compared after the join.
    A NULL URL, or one without a host, is fitted by no rule. Copies of a row are
    judged alike; columns of `pages` named host, path, rule or verdict are
    replaced. An empty rule list gives `default` everywhere; rules without a
    host fit nothing, a NULL path counts as an empty one.
    """
    frame = pages.drop("host", "path", "rule", "verdict")
    listed = rules.select(
        F.lower("host").alias("rule_host"),
        F.coalesce(F.col("path"), F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    ).where(F.col("rule_host") != "")
    labels = F.size(F.split("rule_host", r"\."))
    listed = listed.withColumns(
        {"_labels": labels, "_depth": _slashes(F.col("rule_path"))}
    ).withColumn(
        "_digest", _expression(F.col("rule_host"), _folder(F.col("rule_path"), F.col("_depth")))
    )
    deepest = listed.agg(
        F.max("_labels").alias("l"), F.max("_depth").alias("d"), F.min("_depth").alias("s")
    ).first()
    most_labels, most_depth, least_depth = (deepest[k] or 0 for k in ("l", "d", "s"))
    listed = listed.select(
        F.substring("_digest", 1, PREFIX_DIGITS).alias("_short"), "_digest",
        "rule_host", "rule_path", "rule_verdict",
    )

    host, path = split_url(F.col("url"))
    distinct = frame.select("url").where(F.col("url").isNotNull()).distinct()
    distinct = distinct.select("url", host.alias("_host"), path.alias("_path"))
    # Labels and folders are exploded one after the other: no product of arrays is built.
    expanded = distinct.withColumn(
        "_label",
        F.explode(
            F.sequence(
                F.lit(1),
                F.greatest(F.lit(1), F.least(F.size(F.split("_host", r"\.")), F.lit(most_labels))),
            )
        ),
    ).withColumn(
        "_depth",
        F.explode(
            F.when(
                _slashes(F.col("_path")) >= least_depth,
                F.sequence(
                    F.lit(least_depth), F.least(_slashes(F.col("_path")), F.lit(most_depth))
                ),
            )
        ),
    )
    expanded = expanded.withColumn(
        "_key",
        _expression(_suffix(F.col("_host"), F.col("_label")), _folder(F.col("_path"), F.col("_depth"))),
    ).withColumn("_prefix", F.substring("_key", 1, PREFIX_DIGITS))
    hits = expanded.join(
        listed,
        (F.col("_prefix") == F.col("_short"))
        & (F.col("_key") == F.col("_digest"))
        & F.startswith("_path", "rule_path"),
    )
    best = hits.groupBy("url").agg(
        F.max(
            F.struct(
                F.length("rule_host").alias("h"),
                F.length("rule_path").alias("p"),
                (F.col("rule_verdict") == "block").alias("b"),
                F.concat("rule_host", "rule_path").alias("rule"),
                F.col("rule_verdict").alias("verdict"),
            )
        ).alias("_best")
    )
    # The grouped side is compared as a struct, so that Spark shuffles it anew and can split a hot URL.
    # NULL URLs are no key: all of them would go to one task.
    hit = fresh(frame.columns, "_hit")
    found = best.select(F.struct(F.col("url").alias("_url"), "_best").alias(hit))
    named = frame.where(F.col("url").isNotNull()).join(found, F.struct("url") == F.struct(F.col(hit)["_url"].alias("url")), "left")
    nameless = frame.where(F.col("url").isNull()).withColumn(hit, F.lit(None).cast(found.schema[hit].dataType))
    host, path = split_url(F.col("url"))
    return named.unionByName(nameless).select(
        *map(col, frame.columns),
        host.alias("host"),
        path.alias("path"),
        F.col(hit)["_best"]["rule"].alias("rule"),
        F.coalesce(F.col(hit)["_best"]["verdict"], F.lit(default)).alias("verdict"),
    )
