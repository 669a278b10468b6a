"""Places against brute force over sorted groups; wide pairs, ties, nulls and repeated rows."""

import random
from itertools import groupby

import pytest

from ledgerleaf.llm import ranking

PAIR = [("a", True), ("b", False)]


def last(*values):
    return tuple((v is None, v or 0) for v in values)


def brute(rows, top):
    """(g, h, pos, place, a, b, c, d, tied) of rows (g, h, a, b, c, d); larger a first, smaller b first."""
    out = []
    for _, group in groupby(sorted(rows, key=lambda r: last(r[0], r[1])), key=lambda r: r[:2]):
        group = sorted(group, key=lambda r: ((r[2] is None, -(r[2] or 0)), last(r[3], r[4], r[5])))
        pairs = list(dict.fromkeys(r[2:4] for r in group))
        for pos, r in enumerate(group, 1):
            if (place := pairs.index(r[2:4]) + 1) <= top:
                out.append((*r[:2], pos, place, *r[2:], sum(x[2:4] == r[2:4] for x in group)))
    return sorted(out, key=repr)


def table(spark, rows):
    kinds = ", ".join(f"{c} long" for c in "ghabcd")
    return spark.createDataFrame(rows, kinds).selectExpr("*", "'x' AS code", "1 AS `pos`", "2 AS tied", "3 AS Ahead", "4 AS key_0").repartition(3)


def places(df, top=5):
    out = ranking.ranked(df, ["g", "h"], PAIR, ["c", "d"], top)
    assert {"code", "Ahead", "key_0"} < set(out.columns)
    return sorted((tuple(r) for r in out.select("g", "h", "pos", "place", "a", "b", "c", "d", "tied").collect()), key=repr)


def random_rows(seed, n, values):
    r = random.Random(seed)
    some = lambda xs: None if r.random() < 0.05 else r.choice(xs)
    rows = [(some([0, 1, 2]), some([0, 7]), some(values), some(values), some([1, 2]), some([3])) for _ in range(n)]
    return rows + rows[: n // 5]


@pytest.mark.parametrize("values", [[0, 1, 2, -3], [0, 5, 10**6, -(10**7)], [0, 3, 2**58, -(2**57)]], ids=["few codes", "long codes", "decimal codes"])
def test_places_equal_brute_force(spark, values):
    rows = random_rows(len(str(values)), 300, values)
    assert places(table(spark, rows)) == brute(rows, 5)


def test_many_levels_and_one_hot_group(spark, monkeypatch):
    """Small cells, so that the bisection goes down several levels, and a group with most rows and pairs."""
    monkeypatch.setattr(ranking, "CELLS", 5)
    r = random.Random(1)
    rows = [(1, None, r.randint(-50, 50), r.randint(0, 40), r.randint(0, 9), 0) for _ in range(800)] + random_rows(2, 100, list(range(20)))
    for top in (1, 5, 300):
        assert places(table(spark, rows), top) == brute(rows, top)


def test_equal_rows_have_positions_of_their_own(spark):
    rows = [(None, None, None, None, None, None)] * 400 + [(None, None, 1, None, None, None)] * 3
    got = places(table(spark, rows))
    assert got == brute(rows, 5)
    assert sorted(x[2] for x in got) == list(range(1, 404))


def test_empty_and_all_null(spark):
    assert places(table(spark, [(1, 1, 1, 1, 1, 1)]).where("g = 2")) == []
    assert places(table(spark, [(1, 1, None, None, 1, 1)])) == [(1, 1, 1, 1, None, None, 1, 1, 1)]


def test_too_wide_ranges_are_refused(spark):
    with pytest.raises(ValueError, match="too wide"):
        places(table(spark, [(1, 1, 2**63 - 1, -(2**63), 1, 1), (1, 1, -(2**63), 2**63 - 1, 1, 1)]))
