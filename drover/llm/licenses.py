"""Licence scans: TF-IDF cosine of notices to templates, then inheritance along directories.

Only DataFrame functions run on rows, so the work stays in compiled code.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"

#: Public wordings by which the licences are declared.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, version 2.0."),
)
GPL_HEADER = (
    "This {program} is free software{colon} you can redistribute it and/or modify it under the terms of "
    "the GNU {kind}General Public License as published by the Free Software Foundation, either version "
    "{version} of the License, or (at your option) any later version."
)
#: The standard notices that files carry at their top.
HEADERS = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                   "file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-2.0", GPL_HEADER.format(program="program", colon=";", kind="", version="2")),
    ("GPL-3.0", GPL_HEADER.format(program="program", colon=":", kind="", version="3")),
    ("LGPL-2.1", GPL_HEADER.format(program="library", colon=";", kind="Lesser ", version="2.1")),
    ("LGPL-3.0", GPL_HEADER.format(program="library", colon=":", kind="Lesser ", version="3")),
    ("AGPL-3.0", GPL_HEADER.format(program="program", colon=":", kind="Affero ", version="3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
                "copy of the MPL was not distributed with this file, You can obtain one at "
                "http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the "
                     "LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
)
#: Names that stand alone on a line, mostly at the top of a licence file.
TITLES = (
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License 2.0"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "GNU General Public License v2.0"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "GNU General Public License v3.0"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-4.0", "Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Attribution-NonCommercial 4.0 International"),
)
#: SPDX identifiers of each licence.
TAGS = (
    ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("BSD-2-Clause", "BSD-2-Clause"),
    ("BSD-3-Clause", "BSD-3-Clause"), ("MPL-2.0", "MPL-2.0"), ("CC-BY-4.0", "CC-BY-4.0"),
    ("CC-BY-NC-4.0", "CC-BY-NC-4.0"),
    *((name, name + form) for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
      for form in ("", "-only", "-or-later")),
)
#: Folder of whole licence texts, each named by its licence; only the driver reads them.
TEXTS = Path(__file__).parent / "licence_texts"
#: Function words, which tell little about a licence; all are weighted `LITTLE` and no template holds them.
COMMON = frozenset(
    "a all an and any are as at be but by can do does for from has have if in into is it its may must no "
    "not of on one only or other shall should such than that the their them then there these they this "
    "those to under was we when where which who will with without you your".split()
)
LITTLE = 1e-4
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
#: Kinds of templates that are looked for inside a text; titles and whole licences are not.
WINDOWED = ("header", "tag")


def known_templates() -> list[tuple[str, str, str]]:
    """All templates as (licence, kind, text); kinds are file, header, title and tag."""
    texts = sorted(TEXTS.glob("*.txt"))
    return [
        *((name, "header", text) for name, text in (*NOTICES, *HEADERS)),
        *((name, "title", text) for name, text in TITLES),
        *((name, "tag", f"SPDX-License-Identifier: {text}") for name, text in TAGS),
        *((path.stem, "file", path.read_text("utf-8")) for path in texts),
    ]


class Templates:
    """TF-IDF vectors of template texts; terms that no template holds get the highest IDF.

    A title or tag of two terms counts both alike, so that neither alone reaches 0.8.
    """

    def __init__(self, templates=None):
        templates = known_templates() if templates is None else templates
        self.names = [name for name, _, _ in templates]
        self.kinds = [kind for _, kind, _ in templates]
        self.words = [re.findall(WORD, text.lower()) for _, _, text in templates]
        bags = [Counter(w for w in words if w not in COMMON) for words in self.words]
        held = Counter(term for bag in bags for term in bag)
        self.unseen = math.log(1 + len(bags)) + 1
        self.idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in sorted(held.items())}
        self.vectors = [
            {
                t: 1.0 if kind in ("title", "tag") and len(bag) == 2 else n * self.idf[t]
                for t, n in sorted(bag.items())
            }
            for kind, bag in zip(self.kinds, bags)
        ]
        self.norms = [math.sqrt(sum(w * w for w in v.values())) for v in self.vectors]
        self.idf |= {t: LITTLE for t in sorted(COMMON)}

    def telling(self, threshold: float) -> list[str]:
        """Terms of which a text must hold one to reach `threshold` with any template.

        The terms left out of a template have a norm below threshold times the
        template's, so by Cauchy-Schwarz a text with only those stays below it.
        Of short templates long words are taken first, as they are rarer in other
        texts, of whole licences the heaviest, and before all those chosen already.
        """
        chosen: set[str] = set()
        for kind, vector, norm in zip(self.kinds, self.vectors, self.norms):
            left = norm * norm
            for term, weight in sorted(
                vector.items(),
                key=lambda x: (x[0] not in chosen, -x[1] if kind == "file" else -len(x[0]), x[0]),
            ):
                if left < (threshold * norm) ** 2 * (1 - 1e-9):
                    break
                chosen.add(term)
                left -= weight * weight
        return sorted(chosen)

    def anchors(self, threshold: float) -> dict[str, list[tuple[int, int]]]:
        """By term: its places in headers and tags, as (words before it, words of the template).

        A text that reaches `threshold` with such a template holds one of its
        heaviest terms (see `telling`), so its window lies around that term.
        """
        found: dict[str, set[tuple[int, int]]] = {}
        for kind, words, vector, norm in zip(self.kinds, self.words, self.vectors, self.norms):
            left = norm * norm
            for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
                if kind not in WINDOWED or left < (threshold * norm) ** 2 * (1 - 1e-9):
                    break
                places = {(k, len(words)) for k, word in enumerate(words) if word == term}
                found.setdefault(term, set()).update(places)
                left -= weight * weight
        return {term: sorted(places) for term, places in sorted(found.items())}


def _any_of(terms: list[str]) -> str:
    """A pattern of all terms, dealt by first letters so that few are tried at each place."""
    heads = sorted({t[0] for t in terms})
    tails = ["|".join(re.escape(t[1:]) for t in terms if t[0] == head) for head in heads]
    return "(?:" + "|".join(f"{head}(?:{tail})" for head, tail in zip(heads, tails)) + ")"


def _windows(words: Column, anchors: dict[str, list[tuple[int, int]]]) -> Column:
    """Runs of `words` as long as a template and placed so that one of its anchors fits."""
    spans = F.create_map(
        *(
            column
            for term, places in anchors.items()
            for column in (
                F.lit(term),
                F.array(
                    *(
                        F.struct(F.lit(before).alias("before"), F.lit(length).alias("length"))
                        for before, length in places
                    )
                ),
            )
        )
    )
    places = F.filter(
        F.transform(words, lambda word, at: F.struct(word.alias("word"), at.alias("at"))),
        lambda place: place["word"].isin(*anchors),
    )

    def cut(place: Column) -> Column:
        return F.transform(
            F.element_at(spans, place["word"]),
            lambda span: F.concat_ws(
                " ",
                F.slice(
                    words,
                    F.greatest(place["at"] - span["before"], F.lit(0)) + 1,
                    span["length"] + F.least(place["at"] - span["before"], F.lit(0)),
                ),
            ),
        )

    return F.flatten(F.transform(places, cut))


def _matches(texts: DataFrame, templates: Templates) -> DataFrame:
    """The best template of each notice (id, notice), as struct (score, license).

    `match` is the best of all templates, `inside` of those looked for in windows.

    Notices without terms are left out.

    Vectors are rows (id, term, weight). The template side has one row per
    template and term, so its size is that of the templates given.
    """
    spark = texts.sparkSession
    terms = spark.createDataFrame(
        [(t, w) for t, w in templates.idf.items()], "term string, idf double"
    )
    vectors = spark.createDataFrame(
        [
            (name, kind in WINDOWED, number, norm, t, w)
            for number, (name, kind, vector, norm) in enumerate(
                zip(templates.names, templates.kinds, templates.vectors, templates.norms)
            )
            for t, w in vector.items()
        ],
        "license string, windowed boolean, template int, length double, term string, part double",
    )
    weights = (
        texts.select(
            "id",
            F.explode(F.regexp_extract_all(F.lower("notice"), F.lit(f"({WORD})"), 1)).alias("term"),
        )
        .groupBy("id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
        .join(F.broadcast(terms), "term", "left")
        .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(templates.unseen)))
    )
    norms = weights.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    products = (
        weights.join(F.broadcast(vectors), "term")
        .groupBy("id", "template", "license", "windowed", "length")
        .agg(F.sum(F.col("w") * F.col("part")).alias("product"))
    )
    cosine = F.round(F.least(F.col("product") / (F.col("norm") * F.col("length")), F.lit(1.0)), 6)
    scored = F.struct(cosine.alias("score"), "license")
    return (
        products.join(norms, "id")
        .groupBy("id")
        .agg(F.max(scored).alias("match"), F.max(F.when(F.col("windowed"), scored)).alias("inside"))
    )


def scan_licenses(
    files: DataFrame,
    templates: Templates | None = None,
    threshold: float = 0.8,
    header_lines: int = 20,
    licence_file: str = LICENCE_FILE,
    windows: bool = False,
) -> DataFrame:
    """The licence of every file (path, text): its own, or that of the nearest directory above.

    Every line of the whole text, the header (its first `header_lines` lines as
    one) and, in licence files, the whole text are compared with the templates;
    the best cosine of at least `threshold` gives `own_license` and `own_score`
    (of equal scores the last licence by name). With `windows`, files in which
    these find nothing are also compared with headers and tags by every window
    of the whole text that is as long as the template and has one of its
    heaviest terms in place, so notices that are wrapped, inside a line or after
    the header are found. A file without its own notice takes the licence of the nearest directory, its own or one above, that has a
    licence file with a recognised licence; of several there, the one with the
    best score. Adds directory, own_license, own_score, license and
    inherited_from (the directory; NULL for own and unknown licences), replaces
    columns of these names and drops the text.

    NULL and empty texts have no notice; a file with a NULL path inherits
    nothing. Repeated rows are kept, each with the same result; an empty table
    gives an empty one.
    """
    templates = templates or Templates()
    added = ("directory", "own_license", "own_score", "license", "inherited_from")
    # A text without any telling term can't reach the threshold, so most rows end here.
    telling = r"(?i)(?<![a-z0-9])" + _any_of(templates.telling(threshold)) + "(?![a-z0-9])"
    name = F.element_at(F.split("path", "/"), -1)
    named = F.coalesce(F.rlike(name, F.lit(licence_file)), F.lit(False))
    kept = [c for c in files.columns if c not in (*added, "text")]
    # The digest stands for the text; other rows get a key that matches nothing and spreads them.
    digest = F.when(
        F.rlike("text", F.lit(telling)), F.concat(F.sha2("text", 256), named.cast("string"))
    )
    rows = files.drop(*added).select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"),
        F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", ""))
        .when(F.col("path").isNotNull(), "")
        .alias("directory"),
        named.alias("declares"),
        F.coalesce(digest, F.col("path"), F.lit("")).alias("digest"),
    )
    lines = F.split("text", "\n")
    notices = F.concat(
        F.filter(lines, lambda line: F.rlike(line, F.lit(telling))),
        F.filter(
            F.array(F.concat_ws("\n", F.slice(lines, 1, header_lines))),
            lambda head: F.rlike(head, F.lit(telling)),
        ),
        F.when(named, F.array("text")).otherwise(F.array().cast("array<string>")),
    )
    texts = files.where(F.rlike("text", F.lit(telling))).select(
        digest.alias("digest"),
        F.array_distinct(notices).alias("notices"),
        F.regexp_extract_all(F.lower("text"), F.lit(f"({WORD})"), 1).alias("words"),
    )
    units = F.transform("notices", lambda n: F.struct(n.alias("notice"), F.lit(True).alias("unit")))
    if windows:
        cut = F.array_distinct(_windows(F.col("words"), templates.anchors(threshold)))
        more = F.transform(cut, lambda n: F.struct(n.alias("notice"), F.lit(False).alias("unit")))
        units = F.concat(units, more)
    noted = (
        texts.select("digest", F.inline(units))
        .withColumn("id", F.unhex(F.sha2("notice", 256)))
    )
    matches = _matches(noted.select("id", "notice").dropDuplicates(["id"]), templates)
    # Units go before windows: a licence's text may quote the notices of others.
    own = (
        noted.select("digest", "id", "unit")
        .distinct()
        .join(matches, "id")
        .select("digest", "unit", F.when(F.col("unit"), F.col("match")).otherwise(F.col("inside")).alias("match"))
        .where(F.col("match.score") >= threshold)
        .groupBy("digest")
        .agg(F.max(F.struct("unit", "match")).alias("best"))
        .select("digest", F.col("best.match").alias("match"))
    )
    found = rows.join(own, "digest", "left").select(
        "row",
        "directory",
        "declares",
        F.col("match.score").alias("own_score"),
        F.col("match.license").alias("license"),
    )
    declared = (
        found.where("declares AND license IS NOT NULL")
        .groupBy(F.col("directory").alias("above"))
        .agg(F.max(F.struct("own_score", "license")).alias("best"))
    )
    # Each distinct directory with all directories above it, as long as its path is deep.
    depth = F.when(F.col("directory") == "", 0).otherwise(F.size(F.split("directory", "/")))
    above = (
        found.where("license IS NULL AND directory IS NOT NULL")
        .select("directory")
        .distinct()
        .select("directory", F.explode(F.sequence(F.lit(0), depth)).alias("level"))
        .withColumn(
            "above",
            F.when(F.col("level") == 0, "").otherwise(
                F.expr("substring_index(directory, '/', level)")
            ),
        )
    )
    nearest = (
        above.join(declared, "above")
        .groupBy("directory")
        .agg(F.max(F.struct("level", "above", F.col("best.license").alias("license"))).alias("near"))
    )
    joined = found.alias("f").join(
        nearest.alias("n"), F.expr("f.directory = n.directory AND f.license IS NULL"), "left"
    )
    return joined.select(
        *(F.col(f"f.row.`{c}`") for c in kept),
        F.col("f.directory").alias("directory"),
        F.col("f.license").alias("own_license"),
        F.col("f.own_score").alias("own_score"),
        F.coalesce("f.license", "n.near.license").alias("license"),
        F.when(F.col("f.license").isNull(), F.col("n.near.above")).alias("inherited_from"),
    )
