"""URL filters and licence scans against plain Python."""

import math
import re
from collections import Counter

import duckdb
import pytest
from drover.session import stage
from pyspark.sql import functions as F
from drover.llm import licenses, urls
from drover.llm.queries import QUERIES, SQL, URL_RULES

FOLDER = "/root/testdata/sf0.001"
URLS = [
    None, "", "no scheme", "://", "http://", "http://NET", "http://a.NET/", "http://net/x?y", "https://example.net/en/1",
    "https://WWW.example.net/en/", "https://example.net/en", "https://xexample.net/en/a", "http://a.b.example.com/de/fr/x#y",
    "http://example.com?/de/", "http://org/fr/", "http://x.org/fr/a/b/c/d/e", "http://x.org/FR/", "x://y.org#/fr/",
    "http://a..net//", "http://é.net/é", "http://net/" + "a/" * 5000, "a://b://net/",
]
RULES = [*URL_RULES, ("a.net", "/x", "block"), ("a.net", "/x/y", "allow"), ("a.net", "/x/y", "block"), ("b.org", "", "block"), ("", "/", "block"), (None, "/", "block"), ("c.org", None, "block")]


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h), len(p or ""), v == "block", h + (p or ""), v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.mark.parametrize("rules", [URL_RULES, RULES, []])
def test_urls_like_plain_python(spark, rules):
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    more = [f"http://{h}/{p}" for h in ("a.net", "z.a.net", "b.org", "c.org", "ba.net") for p in ("", "x", "xx/y", "x/y", "x/yz/")]
    every = [*URLS, *more, *URLS]
    pages = spark.createDataFrame([(k, u, "keep", "z") for k, u in enumerate(every)], "page_id long, url string, _best string, rule string")
    rows = urls.filter_urls(pages, listed).collect()
    assert len(rows) == len(every)
    for row in rows:
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == judged(row["url"], rules), row["url"]
        assert row["_best"] == "keep"


def test_urls_empty_table(spark):
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert urls.filter_urls(spark.createDataFrame([], "url string"), listed).count() == 0


def test_hot_urls_are_split(spark):
    """NULL URLs aren't joined, and a URL in half the rows goes to several tasks."""
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = spark.range(120_000).select(
        "id", F.when(F.col("id") % 4 == 0, F.lit(None)).when(F.col("id") % 4 < 3, F.lit("http://a.net/x"))
        .otherwise(F.concat(F.lit("http://b.org/fr/"), F.col("id").cast("string"))).alias("url"),
        F.concat(*(F.sha2(F.concat(F.col("id").cast("string"), F.lit(k)), 512) for k in "abcd")).alias("more"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.files.maxPartitionBytes": "1MB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        judged = urls.filter_urls(stage(pages.repartition(8)), listed)
        parts = judged.groupBy(F.spark_partition_id().alias("p"), F.col("url").isNull().alias("n"))
        parts = parts.agg(F.count(F.lit(1)).alias("count"), F.max(F.xxhash64("more")))
        sizes = [r["count"] for r in parts.where("NOT n").collect()]
        assert sum(sizes) == 90_000 and max(sizes) < 30_000
        assert {tuple(r) for r in judged.groupBy("rule", "verdict").count().collect()} == {
            (None, "allow", 30_000), ("net/", "block", 60_000), ("org/fr/", "allow", 30_000)}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_url_query_like_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    result = connection.execute(SQL["op6_url_filters"])
    names = [d[0] for d in result.description]
    expected = sorted(map(str, result.fetchall()))
    mine = QUERIES["op6_url_filters"](spark, FOLDER).select(names).collect()
    assert sorted(str(tuple(r)) for r in mine) == expected


def cosine(a, b):
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b.get(t, 0) for t, x in a.items()) / norm if norm else 0.0


def scanned(files, threshold=0.8, header=20):
    t = licenses.Templates()

    def best(notice):
        bag = Counter(re.findall(licenses.WORD, notice.lower()))
        vector = {w: n * t.idf.get(w, t.unseen) for w, n in bag.items()}
        return max(((round(min(cosine(vector, v), 1.0), 6), n) for v, n in zip(t.vectors, t.names)))

    own, declared = {}, {}
    for key, path, text in files:
        lines = (text or "").split("\n")
        named = bool(path and re.match(licenses.LICENCE_FILE, path.split("/")[-1]))
        found = max(best(n) for n in [*lines, "\n".join(lines[:header]), *([text or ""] if named else [])])
        own[key] = found if found[0] >= threshold else None
        folder = None if path is None else path.rpartition("/")[0]
        if named and own[key]:
            declared[folder] = max(declared.get(folder, (0, "")), own[key])
    result = {}
    for key, path, text in files:
        above = None if path is None else path.rpartition("/")[0]
        if own[key]:
            result[key] = (own[key][1], own[key][0], own[key][1], None)
            continue
        while above is not None and above not in declared:
            above = above.rpartition("/")[0] if above else None
        result[key] = (None, None, declared[above][1] if above is not None else None, above)
    return result


def check_licences(spark, files):
    frame = spark.createDataFrame([(*f, "x", "y") for f in files], "id long, path string, text string, license string, match string")
    rows = licenses.scan_licenses(frame).collect()
    assert len(rows) == len(files)
    expected = scanned(files)
    for r in rows:
        assert (r["own_license"], r["own_score"], r["license"], r["inherited_from"]) == expected[r["id"]], r["path"]
        assert r["match"] == "y"
    return rows


def test_licences_like_plain_python(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        (1, "a/LICENSE", mit), (2, "a/x.txt", "prose"), (3, "a/b/c/y", "prose\n" + apache), (4, "a/b/c/z", None),
        (5, "a/b/COPYING.md", ""), (6, "LICENCE", "Licensed under CC BY-NC 4.0."), (7, "q/r", "of the and"), (8, None, "x"),
        (9, None, mit), (10, "top", "x"), (11, "a/b/c/LICENSE", "x " * 3000 + "\n" + apache.upper()), (12, "a/b/c/d/e", ""),
        (13, "a/x.txt", "prose"), (14, "a/notice", apache), (15, "LICENSE/x", "y"), (16, "m/n", "Released\nunder the\nMIT License."),
        (17, "m/n2", "Released under the MIT of License and more words that follow here"), (18, "/", "k"), (19, "", mit),
        (20, "m/o", "version 3 of general public work " * 400),
    ]
    rows = check_licences(spark, files)
    assert {r["id"]: r["license"] for r in rows}[2] == "MIT"
    assert licenses.scan_licenses(spark.createDataFrame([], "path string, text string")).count() == 0


def test_licence_query_like_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in QUERIES["op1_license_scans"](spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    expected = scanned([(d["doc_id"], rows[d["doc_id"]]["path"], d["text"]) for d in docs])
    for key, row in rows.items():
        assert (row["own_license"], row["own_score"], row["license"], row["inherited_from"]) == expected[key]


DECLARED = [
    ("SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: ISC", None),
    ("MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), ("MIT", None), ("license", None),
    ("Apache License Version 2.0, January 2004", "Apache-2.0"), ("BSD 3-Clause License", "BSD-3-Clause"),
    ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GPL-3.0"), ("GNU General Public License", None),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General"
     " Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your"
     " option) any later version.", "GPL-3.0"),
    ("Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file.", "BSD-3-Clause"),
    ("Creative Commons Attribution-NonCommercial 4.0 International Public License", "CC-BY-NC-4.0"),
    ("Creative Commons Attribution-ShareAlike 4.0 International Public License", None),
]


def test_headers_titles_and_tags(spark):
    frame = spark.createDataFrame([(k, f"{k}/x.py", f"import x\n{t}") for k, (t, _) in enumerate(DECLARED)], "id int, path string, text string")
    found = {r["id"]: r["own_license"] for r in licenses.scan_licenses(frame).collect()}
    assert {t: found[k] for k, (t, _) in enumerate(DECLARED)} == dict(DECLARED)


def test_whole_licence_files(spark):
    """Each with a holder above, and with its lines broken elsewhere, so that no line of its is a template."""
    files = []
    for path in licenses.TEXTS.glob("*.txt"):
        words = path.read_text("utf-8").split()
        text = "Copyright (c) 2024 Jane Doe and contributors\n" + "\n".join(" ".join(words[k : k + 7]) for k in range(0, len(words), 7))
        files += [(path.stem, f"{path.stem}/LICENSE", text), (path.stem, f"{path.stem}/src/x.py", "x = 1")]
    assert len(files) == 22
    for r in licenses.scan_licenses(spark.createDataFrame(files, "id string, path string, text string")).collect():
        assert r["license"] == r["id"]


PROSE = "one two three four five six seven eight nine ten " * 12
WINDOWS = [
    (PROSE + "\nThis work is licensed under the GNU General\nPublic License, version 3.\n" + PROSE, "GPL-3.0"),
    ("x\n" * 400 + "# Licensed under the Apache\n# License, Version 2.0.\n" + PROSE, "Apache-2.0"),
    (PROSE + "Released under the MIT License. " + PROSE, "MIT"),
    (PROSE + "/* SPDX-License-Identifier:\n   MPL-2.0 */ " + PROSE, "MPL-2.0"),
    (PROSE + "the MIT License is shorter than others " + PROSE, None),
    (PROSE + "licensed " * 500, None),
    ("Mozilla", None),
]


def test_wrapped_inner_and_late_notices(spark):
    mit = (licenses.TEXTS / "MIT.txt").read_text("utf-8")
    gpl = (licenses.TEXTS / "GPL-3.0.txt").read_text("utf-8")
    cases = [*WINDOWS, ("x = 1\n" * 40 + mit + PROSE, "MIT")]
    files = [(str(k), f"{k}/x.py", text) for k, (text, _) in enumerate(cases)] + [("gpl", "gpl/LICENSE", "Copyright Jane Doe\n" + gpl)]
    frame = spark.createDataFrame(files, "id string, path string, text string")
    found = {r["id"]: r["own_license"] for r in licenses.scan_licenses(frame, windows=True).collect()}
    assert found == {str(k): name for k, (_, name) in enumerate(cases)} | {"gpl": "GPL-3.0"}
    without = {r["id"]: r["own_license"] for r in licenses.scan_licenses(frame).collect()}
    assert [without[str(k)] for k in (0, 1, 2)] == [None] * 3
