"""Substring and suffix deduplication against brute force."""

import random
import re

import cases
import numpy as np
import pytest
from ledgerleaf.llm.deep_shallow import blind_trie, deep_shallow
from ledgerleaf.llm.substring_dedup import dedup_substrings
from ledgerleaf.llm.suffix_dedup import dedup_bytes


def brute(sequences, width):
    """For each sequence, in order, which items an earlier equal window covers."""
    seen, out = set(), []
    for s in sequences:
        gone = [False] * len(s)
        for a in range(len(s) - width + 1):
            k = tuple(s[a : a + width])
            if k in seen:
                gone[a : a + width] = [True] * width
            seen.add(k)
        out.append(gone)
    return out


def spans(gone):
    return sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))


@pytest.mark.parametrize("width", [3, 20])
def test_words(spark, width):
    df, rows = cases.documents(spark, seed=width)
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    got = {r.doc_id: r for r in dedup_substrings(df, width).collect()}
    assert len(got) == len(rows)
    for row, w, gone in zip(rows, words, brute(words, width), strict=True):
        g = got[row[0]]
        assert (g.n_words, g.n_removed, g.n_spans) == (len(w), sum(gone), spans(gone)), row
        assert g.kept_text == " ".join(x for x, y in zip(w, gone, strict=True) if not y)


@pytest.mark.parametrize(("width", "gram"), [(100, 32), (10, 4), (7, 7)])
def test_bytes(spark, width, gram):
    df, rows = cases.documents(spark, seed=width)
    data = [(r[1] or "").encode() for r in rows]
    got = {r.doc_id: r for r in dedup_bytes(df, width, gram).collect()}
    for row, b, gone in zip(rows, data, brute(data, width), strict=True):
        g = got[row[0]]
        assert (g.n_bytes, g.n_removed, g.n_spans) == (len(b), sum(gone), spans(gone)), row[0]
        assert bytes(g.kept) == bytes(x for x, y in zip(b, gone, strict=True) if not y)


def test_repeated_ids_nulls_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (5, None)], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.n_words, r.n_removed) for r in dedup_substrings(df).collect())
    assert got == [(False, 40, 0), (True, 0, 0), (True, 40, 40), (True, 40, 40)]
    assert sorted((r.doc_id is not None, r.n_removed) for r in dedup_bytes(df).collect()) == [(False, 0), (True, 0), (True, len(text)), (True, len(text))]
    assert dedup_substrings(cases.empty(spark)).count() == dedup_bytes(cases.empty(spark)).count() == 0
    with pytest.raises(ValueError, match="width"):
        dedup_substrings(df, 0)


def test_deep_shallow_orders_and_measures():
    r = random.Random(1)
    for _ in range(40):
        n, length = r.randint(1, 300), r.choice([5, 30])
        rows = np.array([[r.choice(b"ab") if r.random() < 0.1 else 97 for _ in range(length)] for _ in range(n)], np.uint8)
        classes, common = deep_shallow(rows)
        texts = [x.tobytes() for x in rows]
        distinct = sorted(set(texts))
        assert [distinct[c] for c in classes] == texts
        lcp = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))
        assert common.tolist() == [0] + [lcp(a, b) for a, b in zip(distinct, distinct[1:], strict=False)]


def test_blind_trie():
    r = random.Random(2)
    texts = list({bytes(r.choice(b"abc") for _ in range(12)) for _ in range(200)})
    assert [texts[i] for i in blind_trie(texts)] == sorted(texts)
