import random
import re
from itertools import combinations

import cases
import numpy as np
from ledgerleaf.llm import ngram_join
from ledgerleaf.llm.components import components


def sets(rows, width=5):
    out = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        out.append({tuple(w[a : a + width]) for a in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute(rows, percent):
    s = sets(rows)
    at = list(range(len(rows)))
    find = lambda x: x if at[x] == x else find(at[x])
    for a, b in combinations(range(len(rows)), 2):
        both = len(s[a] & s[b])
        if both and 100 * both >= percent * (len(s[a]) + len(s[b]) - both):
            x, y = sorted((find(a), find(b)))
            at[y] = x
    return {rows[i][0]: (len(s[i]), rows[find(i)][0]) for i in range(len(rows))}


def test_against_brute_force(spark):
    df, rows = cases.documents(spark, seed=7, n=90)
    # a chain of texts, each a few words from the one before
    r = random.Random(3)
    w = [f"k{i}" for i in range(80)]
    chain = []
    for i in range(30):
        w[r.randrange(80)] = f"n{i}"
        chain.append((1000 + i, " ".join(w), None, None, None))
    df = df.select("doc_id", "text", "class", "sig").unionByName(spark.createDataFrame([c[:2] for c in chain], "doc_id long, text string"), allowMissingColumns=True)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.link(df).collect()}
    want = brute(rows + chain, 80)
    assert got == want
    kept = ngram_join.keep_one(df)
    assert sorted(x.doc_id for x in kept.collect()) == sorted({c for _, c in want.values()})
    assert kept.columns == df.columns


def test_tiles_and_rounds_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    r = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(60)] = f"e{r.randrange(1000)}"
        rows.append((i, " ".join(w), None, None, None))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.link(spark.createDataFrame(rows, cases.SCHEMA)).collect()}
    assert got == brute(rows, 80)


def test_signatures_are_complete():
    """Linked sets of any size share a signature, empty parts or not."""
    r = np.random.default_rng(0)
    for n in [1, 2, 3, 5, 8, 13, 40, 150]:
        for _ in range(40):
            a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
            k = int(r.integers(0, max(1, n // 9) + 1))
            keep = r.permutation(len(a))[k:]
            b = np.unique(np.concatenate([a[keep], r.integers(0, 1 << 63, int(r.integers(0, k + 1))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if not len(b) or 100 * both < 80 * (len(a) + len(b) - both):
                continue
            sigs, of = ngram_join.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), 80)
            assert np.intersect1d(sigs[of == 0], sigs[of == 1]).size


def test_defined_cases(spark):
    df = spark.createDataFrame([(3, None), (4, " "), (7, "a b"), (7, "A B"), (None, "a b"), (9, "a b c")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link(df).collect()), key=str)
    assert got == sorted([(3, 0, 3), (4, 0, 4), (7, 1, 7), (7, 1, 7), (None, 1, 7), (9, 1, 9)], key=str)
    assert ngram_join.link(cases.empty(spark)).count() == 0
    assert sorted(str(r.doc_id) for r in ngram_join.keep_one(df).collect()) == ["3", "4", "7", "9", "None"]


def test_components(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(50)] + [(100, 200), (300, 200), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == dict.fromkeys(range(51), 0) | {100: 100, 200: 100, 300: 100}
