"""Licence scan: sparse TF-IDF cosine of header blocks and licence files to templates, then inheritance by path joins; DataFrame operations only.

A template is a text by which a licence is declared: a line, a file header or the licence itself, in clauses of up to 64
words. A text, whatever its lines, is a sequence of terms (runs of letters and digits, lower case). Its windows are cut
out around every licence word (`ANCHORS`; each clause has one): of each of the `SIZES`, all windows on a grid of a quarter
of the size that hold the word. A window is compared with the clauses of its size (the least that a clause fits in) in the
space of the templates' terms, weighted tf * idf, idf from the frequencies in all distinct windows and clauses. A clause
stands in a text if one of the text's windows has a cosine of `least` or more. Of the templates that have clauses in a
text, the one with the largest (sum of its clauses' cosines)^2 / (number of its clauses) names the licence, so a longer
template that is there as a whole wins over a shorter one that is part of it; the score is the sum by the number.

A licence file is one whose name starts with LICENSE, LICENCE, COPYING or UNLICENSE, or whose words mostly lie in the
best windows of its clauses. A file without a licence of its own takes that of the licence file in its nearest ancestor directory.

Plan: equal windows are scored once, whatever the number of texts that hold them, and only their terms that templates
have; templates are a table of fixed size; ancestors are exploded from paths (one row a directory level) and joined by
directory, salted, with the one licence each directory has.

Defined cases: null text has no licence of its own but may inherit; a null path has no ancestors; of equally good
templates the first by name counts, of several licence files in a directory the one with the best score, then the least
path; a very long text is searched as a whole, its windows are as many as its licence words ask for; repeated rows get a
row each, with the same values; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm.common import let, select_required, written

_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
]
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
_GNU_END = [
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {} for more details.",
]


def _gnu(name: str, version: int) -> list[str]:
    return [f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.", _GNU_END[0].format(name)]


#: Texts by which licences are declared, in clauses, under their SPDX names.
TEXTS: list[tuple[str, list[str]]] = [
    ("AGPL-3.0", ["licensed under the GNU Affero General Public License version 3"]),
    ("AGPL-3.0", _gnu("GNU Affero General Public License", 3)),
    ("Apache-2.0", ["Licensed under the Apache License, Version 2.0"]),
    (
        "Apache-2.0",
        [
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
            "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        ],
    ),
    (
        "Apache-2.0",
        [
            "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
            "Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document. \"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
        ],
    ),
    ("BSD-2-Clause", ["Use of this source code is governed by a BSD 2-Clause simplified license"]),
    ("BSD-2-Clause", [*_BSD, _BSD_END]),
    ("BSD-3-Clause", ["Use of this source code is governed by a BSD 3-Clause style license"]),
    ("BSD-3-Clause", [*_BSD, "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", _BSD_END]),
    ("BSL-1.0", ["Distributed under the Boost Software License, Version 1.0"]),
    ("CC-BY-4.0", ["This work is licensed under a Creative Commons Attribution 4.0 International License"]),
    ("CC-BY-4.0", ["Licensed under CC BY 4.0"]),
    ("CC-BY-NC-4.0", ["Licensed under CC BY-NC 4.0"]),
    ("CC-BY-NC-4.0", ["This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"]),
    ("CC-BY-SA-4.0", ["Licensed under CC BY-SA 4.0"]),
    ("CC-BY-SA-4.0", ["This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"]),
    ("CC0-1.0", ["dedicated to the public domain under CC0 1.0 Universal"]),
    ("GPL-2.0", ["licensed under the GNU General Public License, version 2"]),
    ("GPL-2.0", _gnu("GNU General Public License", 2)),
    ("GPL-3.0", ["licensed under the GNU General Public License, version 3"]),
    ("GPL-3.0", _gnu("GNU General Public License", 3)),
    ("ISC", ["Released under the ISC License"]),
    (
        "ISC",
        [
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
        ],
    ),
    ("LGPL-3.0", ["licensed under the GNU Lesser General Public License version 3"]),
    ("LGPL-3.0", _gnu("GNU Lesser General Public License", 3)),
    ("MIT", ["Released under the MIT License"]),
    (
        "MIT",
        [
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        ],
    ),
    ("MPL-2.0", ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"]),
    ("Proprietary", ["All rights reserved. Copyright proprietary and confidential"]),
    ("Unlicense", ["This is free and unencumbered software released into the public domain"]),
]
#: Licences also stand in texts as identifiers.
TEXTS += [(name, [f"SPDX-License-Identifier: {name}"]) for name in sorted({name for name, _ in TEXTS} - {"Proprietary"})]
#: Terms around which texts are searched; every clause has one.
ANCHORS = "affero apache cc cc0 commons copyleft copyright copyrighted gnu isc licence licences license licensed licenses licensor merchantability mozilla permission redistribution redistributions spdx unencumbered unlicense warranties warranty".split()
#: Numbers of terms of windows; clauses are compared with windows of the least size that they fit in.
SIZES = (4, 8, 16, 32, 64)
LEAST = 0.6
MOSTLY = 0.5
SALTS = 16
TERM = r"[\p{L}\p{N}]+"
FILE_NAME = r"(?i)^(un)?licen[cs]e|^copying"


def clauses() -> list[tuple[str, int, int, int, int, str]]:
    """(license, template, n_clauses, clause, size, text) of all clauses."""
    out = []
    for k, (name, texts) in enumerate(TEXTS):
        for text in texts:
            n = len(re.findall(r"[^\W_]+", text))
            out.append((name, k, len(texts), len(out), next(s for s in SIZES if n <= s), text))
    return out


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(clauses(), "license string, template int, n_clauses int, clause int, size int, phrase string")


def windows_of(terms: Column) -> Column:
    """(size, start, words) of the windows around each licence word of an array of terms."""

    def starts(at: Column, size: int) -> Column:
        step = max(1, size // 4)
        first = F.greatest(F.lit(0), F.ceil((at - size + 1) / step).cast("int"))
        return F.transform(F.sequence(first, F.floor(at / step).cast("int")), lambda k: k * step)

    def windows(x: Column) -> Column:
        at = F.filter(F.transform(x, lambda w, i: F.when(w.isin(ANCHORS), i)), lambda i: i.isNotNull())

        def cut(places: Column) -> Column:
            every = [F.transform(F.array_distinct(F.flatten(F.transform(places, lambda p: starts(p, s)))), lambda b: F.struct(F.lit(s).alias("size"), b.alias("start"), F.array_join(F.slice(x, b + 1, s), " ").alias("words"))) for s in SIZES]  # noqa: B023
            return F.concat(*every)

        return let(at, cut)

    return let(terms, windows)


def scored_windows(windows: DataFrame, least: float) -> DataFrame:
    """(size, words, clause, score) of distinct windows (size, words) where clauses stand."""
    known = templates(windows.sparkSession)
    vocabulary = sorted({w for *_, text in clauses() for w in re.findall(r"[^\W_]+", text.lower())})
    spread = F.explode(F.filter(F.split("words", " "), lambda w: w.isin(vocabulary))).alias("term")
    of_windows = windows.select("size", "words", spread).groupBy("size", "words", "term").agg(F.count(F.lit(1)).alias("tf"))
    of_clauses = known.select("size", "clause", F.explode(terms_of(F.col("phrase"))).alias("term")).groupBy("size", "clause", "term").agg(F.count(F.lit(1)).alias("tf"))
    seen = of_windows.select("term").unionAll(of_clauses.select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = windows.agg(F.count(F.lit(1)).alias("n")).select((F.col("n") + len(clauses())).alias("n"))
    # one row, and one for each term of the templates
    idf = seen.join(F.broadcast(total)).select("term", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    wanted = of_clauses.join(idf, "term").withColumn("v", F.col("tf") * F.col("idf"))
    norms = wanted.groupBy("clause").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("clause_norm"))
    weighed = of_windows.join(F.broadcast(idf), "term").withColumn("w", F.col("tf") * F.col("idf"))
    window_norms = weighed.groupBy("size", "words").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("window_norm"))
    dots = weighed.join(F.broadcast(wanted.select("size", "clause", "term", "v")), ["size", "term"]).groupBy("size", "words", "clause").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = dots.join(F.broadcast(norms), "clause").join(window_norms, ["size", "words"]).select("size", "words", "clause", F.round(F.col("dot") / F.col("clause_norm") / F.col("window_norm"), 6).alias("score"))
    return cosine.where(F.col("score") >= least)


def own_licenses(rows: DataFrame, least: float) -> DataFrame:
    """(key, license, score, line_words, n_words): for each text where clauses stand, the best licence, and how many words lie in the best windows of clauses."""
    # windows are cut out of a text only if it has a licence word at all
    some = F.lower(F.col("text")).rlike("|".join(ANCHORS))
    found = F.when(some, let(terms_of(F.col("text")), lambda x: F.struct(F.size(x).cast("long").alias("n_words"), windows_of(x).alias("windows"))))
    held = rows.select("key", found.alias("found")).where("found IS NOT NULL").select("key", "found.n_words", F.explode("found.windows").alias("w")).select("key", "n_words", "w.*").distinct()
    held = written(held, "license-windows")
    scored = scored_windows(held.select("size", "words").distinct(), least)
    hit = held.join(scored, ["size", "words"])
    best_window = F.min(F.struct((-F.col("score")).alias("s"), "start", "size", "n_words")).alias("w")
    by_clause = hit.groupBy("key", "clause").agg(best_window)
    inside = F.sequence("w.start", F.least(F.col("w.start") + F.col("w.size"), F.col("w.n_words").cast("int")) - 1)
    covered = F.size(F.array_distinct(F.flatten(F.collect_set(inside)))).cast("long")
    words = by_clause.groupBy("key").agg(covered.alias("line_words"), F.max("w.n_words").alias("n_words"))
    of_templates = templates(rows.sparkSession).select("clause", "template", "license", "n_clauses")
    named = by_clause.select("key", "clause", (-F.col("w.s")).alias("score")).join(F.broadcast(of_templates), "clause")
    by_template = named.groupBy("key", "template", "license", "n_clauses").agg(F.round(F.sum("score"), 6).alias("total"))
    rank = F.struct((-F.round(F.col("total") * F.col("total") / F.col("n_clauses"), 6)).alias("r"), "license", (-F.col("total") / F.col("n_clauses")).alias("s"))
    best = by_template.groupBy("key").agg(F.min(rank).alias("b"))
    return best.join(words, "key").select("key", F.col("b.license").alias("license"), F.round(-F.col("b.s"), 6).alias("score"), "line_words", "n_words")


def directories(path: Column) -> Column:
    """The directories above a path, the nearest first, as (directory, distance); "" is the root."""
    parts = F.split(path, "/", -1)
    return let(parts, lambda p: F.transform(F.sequence(F.lit(1), F.size(p)), lambda k: F.struct(F.array_join(F.slice(p, 1, F.size(p) - k), "/").alias("directory"), k.alias("distance"))))


def scan(files: DataFrame, least: float = LEAST, mostly: float = MOSTLY) -> DataFrame:
    """(doc_id, path, license, score, origin) of each row of files (doc_id, path, text); origin is header, file, inherited or null."""
    text, path = F.coalesce(F.col("text"), F.lit("")), F.col("path")
    rows = select_required(files, ["doc_id", "path", "text"]).select("doc_id", "path", text.alias("text"), F.xxhash64(text, F.coalesce(path, F.lit(""))).alias("key"))
    own = own_licenses(rows, least)
    named = F.element_at(F.split(path, "/", -1), -1).rlike(FILE_NAME)
    light = rows.drop("text").join(own, "key", "left")
    light = light.withColumn("is_file", F.col("license").isNotNull() & (F.coalesce(named, F.lit(False)) | (F.col("line_words") >= mostly * F.col("n_words"))))
    light = written(light, "licensed")
    at = F.regexp_replace("path", r"/?[^/]*$", "")
    sources = light.where("is_file AND path IS NOT NULL").groupBy(at.alias("directory")).agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "license")).alias("f")).select("directory", F.col("f.license").alias("from_license"), F.col("f.s").alias("from_score"))
    sources = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    above = light.where("license IS NULL AND path IS NOT NULL").select("path").distinct().select("path", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("salt"), F.explode(directories(path)).alias("d")).select("path", "salt", "d.directory", "d.distance")
    near = above.join(sources, ["directory", "salt"]).groupBy("path").agg(F.min_by(F.struct("from_license", "from_score"), "distance").alias("f"))
    out = light.join(near, "path", "left")
    origin = F.when(F.col("is_file"), "file").when(F.col("license").isNotNull(), "header").when(F.col("f").isNotNull(), "inherited")
    return out.select("doc_id", "path", F.coalesce("license", "f.from_license").alias("license"), F.coalesce("score", -F.col("f.from_score")).alias("score"), origin.alias("origin"))
