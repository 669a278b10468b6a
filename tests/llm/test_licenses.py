"""Licence texts as they stand in files: wrapped, commented, cut, in long lines, with other words around."""

import random
import textwrap

import cases
import pytest
from ledgerleaf.llm import licenses


def text_of(name, n_clauses):
    return " ".join(next(t for license_name, t in licenses.TEXTS if license_name == name and len(t) == n_clauses))


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("the a of in river stone walks green under morning table seven quickly and bird house over light with paper".split()) for _ in range(n))


def commented(text, mark, width=60):
    return "\n".join(f"{mark} {x}" for x in textwrap.wrap(text, width))


BSD_3 = "Copyright (c) 2019, Some Body\nAll rights reserved.\n\n" + textwrap.fill(text_of("BSD-3-Clause", 4).replace("Redistributions of", "1. Redistributions of").replace("Redistributions in", "2. Redistributions in").replace("Neither", "3. Neither"), 70)
CASES = {
    "BSD-3 file": (BSD_3, "BSD-3-Clause", "file"),
    "BSD-2 file": ("Copyright 2020 X\n" + textwrap.fill(text_of("BSD-2-Clause", 3), 64), "BSD-2-Clause", "file"),
    "Apache file head": ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n\n      \"License\" shall mean the terms and conditions for use, reproduction,\n      and distribution as defined by Sections 1 through 9 of this document.\n\n" + prose(1, 400), "Apache-2.0", "header"),
    "Apache header": (commented("Copyright 2021 The Authors. " + next(" ".join(t) for _, t in licenses.TEXTS if t[0].startswith("Licensed under the Apache") and len(t) == 2), "#") + "\n\n" + prose(2, 500), "Apache-2.0", "header"),
    "one-line Apache header": ("// Licensed under the Apache License, Version 2.0\n" + prose(3, 300), "Apache-2.0", "header"),
    "ISC file": (textwrap.fill("ISC License. Copyright (c) 2004 " + text_of("ISC", 2), 72), "ISC", "file"),
    "MIT file": ("MIT License\n\nCopyright (c) 2022 Some One\n\n" + textwrap.fill(text_of("MIT", 3), 66), "MIT", "file"),
    "wrapped GPL-3 header": (commented(next(" ".join(t) for n, t in licenses.TEXTS if n == "GPL-3.0" and len(t) == 2), " *", 50) + "\n" + prose(4, 300), "GPL-3.0", "header"),
    "wrapped LGPL-3 header": (commented(next(" ".join(t) for n, t in licenses.TEXTS if n == "LGPL-3.0" and len(t) == 2), " *", 50) + "\n" + prose(9, 300), "LGPL-3.0", "header"),
    "identifier": ("/* SPDX-License-Identifier: MIT */ " + prose(5, 100), "MIT", "header"),
    "sentence in a long line": (prose(6, 12) + " Released under the MIT License " + prose(7, 200), "MIT", "header"),
    "prose": (prose(8, 100) + " my driving license was old and the permission came late " + prose(8, 100), None, None),
    "null": (None, None, None),
    "empty": ("", None, None),
    "very long": (prose(10, 60_000) + " Released under the ISC License " + prose(11, 10), "ISC", "header"),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, f"{k}/x", text) for i, (k, (text, _, _)) in enumerate(CASES.items())]
    return {r["path"][:-2]: (r["license"], r["origin"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}


@pytest.mark.parametrize("case", CASES)
def test_licence_texts(found, case):
    assert found[case] == CASES[case][1:]


def test_files_below_inherit_from_the_nearest_directory_above(spark):
    rows = [(1, "a/LICENSE", BSD_3), (2, "a/b/c/d/e.py", "x"), (3, "a/b/c/COPYING", CASES["MIT file"][0]), (4, "a/b/f.py", None), (5, "g.py", "x"), (6, "a/b/c/d/e.py", "x")]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", *[f"1 AS `{c}`" for c in cases.CLASHING if c != "path"])
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan(df).collect()}
    assert got == {1: ("BSD-3-Clause", "file"), 2: ("MIT", "inherited"), 3: ("MIT", "file"), 4: ("BSD-3-Clause", "inherited"), 5: (None, None), 6: ("MIT", "inherited")}


def test_every_clause_has_a_licence_word():
    assert all(set(text.lower().replace("-", " ").replace('"', " ").replace("/", " ").replace(".", " ").replace(",", " ").replace(":", " ").split()) & set(licenses.ANCHORS) for *_, text in licenses.clauses())
