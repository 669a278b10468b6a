"""Mixes against brute force over a sorted list, and the cases that mixes define."""

import hashlib
import re
from collections import defaultdict

import cases
import pytest

from ledgerleaf.llm import mixing


def brute(rows, weights=(1, 2, 3), limit=3, share=1.0):
    """The same mix from a sort of each source's documents: {(doc_id, text): [taken]}."""
    sized = defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        place = int(hashlib.md5(f"{'' if doc_id is None else doc_id}:{text}".encode()).hexdigest()[:15], 16)
        sized[source].append((place, len(re.findall(r"[^\x20\x09-\x0D]+", text)), doc_id, text))
    order = sorted(sized, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(weights[k % len(weights)]) for k, s in enumerate(order)}
    total = {s: sum(x[1] for x in sized[s]) for s in order}
    capped, budget = set(), share * sum(total.values())
    while True:
        left, among = budget - sum(limit * total[s] for s in capped), sum(weight[s] for s in order if s not in capped)
        new = {s for s in order if s not in capped and limit * total[s] <= left * weight[s] / among}
        if not new:
            break
        capped |= new
    target = {s: float(limit * total[s]) if s in capped else left * weight[s] / among for s in order}
    out = []
    for s in order:
        whole, before = int(target[s] // total[s]) if total[s] else 0, 0
        for _, size, doc_id, text in sorted(sized[s], key=lambda x: (x[0], x[1])):
            more = size > 0 and 2 * (target[s] - whole * total[s] - before) >= size
            out.append((doc_id, size, total[s], target[s], size * (whole + more)))
            before += size
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "share"), [(1, 1.0), (2, 0.25), (3, 2.5), (4, 5.0)])
def test_mix_equals_brute_force(spark, seed, share):
    df, rows = cases.documents(spark, seed, 150)
    got = sorted((tuple(r) for r in mixing.mix(df, share=share).collect()), key=repr)
    want = brute(rows, share=share)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])
    if share == 1.0:
        assert got == sorted((tuple(r) for r in mixing.mix(df.repartition(7)).collect()), key=repr)


def test_repeated_rows_are_taken_one_by_one(spark):
    """A thousand equal rows without an id, beside a source that is too small: as many of them as the target says."""
    rows = [(None, "a b c d", None, "s", 7)] * 1000 + [(1, "x", None, "t", 1), (2, None, None, "t", None), (3, "y", None, None, 1)]
    df = spark.createDataFrame(rows, cases.SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in mixing.mix(df, share=0.5).collect()), key=repr)
    assert got == brute(rows, share=0.5)
    assert sorted({r[4] for r in got if r[1] == 4}) == [0, 4]
    assert sum(r[4] for r in got if r[1] == 4) == pytest.approx(0.5 * 4002 - 6, abs=2)


def test_smaller_mixes_are_part_of_larger_ones(spark):
    df, _ = cases.documents(spark, 5, 150)
    mixes = [{r["doc_id"]: r["taken"] for r in mixing.mix(df, share=s).collect()} for s in (0.1, 0.4, 1.0, 1.7)]
    for small, large in zip(mixes, mixes[1:], strict=False):
        assert all(small[k] <= large[k] for k in small)


def test_mixed_documents_are_repeated(spark):
    df, _ = cases.documents(spark, 6, 80)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(df).where("size > 0").collect()}
    out = mixing.apply_mix(df)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in taken.items() if v}


def test_empty_tables_and_blank_texts(spark):
    assert mixing.mix(cases.empty(spark)).collect() == []
    assert mixing.apply_mix(cases.empty(spark)).collect() == []
    blank = spark.createDataFrame([(1, None, None, "s", 0), (2, " ", None, None, 1)], cases.SCHEMA)
    assert sorted(tuple(r) for r in mixing.mix(blank).collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.apply_mix(blank).count() == 0


def test_very_long_text(spark):
    rows = [(1, "w " * 300_000, None, "s", 600_000), (2, "one two", None, "t", 7)]
    assert sorted(tuple(r) for r in mixing.mix(spark.createDataFrame(rows, cases.SCHEMA)).collect()) == sorted(brute(rows))
