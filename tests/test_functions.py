"""Scalar functions against case tables, geometry and matching against plain Python."""

import datetime
import random
from difflib import SequenceMatcher

import pytest
from ledgerleaf.functions import geometry, matching, scalars
from pyspark.sql import functions as F


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


NUMBERS = [  # text, as float, as int, as share
    ("1.234", 1.234, 1234, 0.01234),
    ("1,234", 1.234, 1234, 0.01234),
    ("1.234,56", 1234.56, None, 12.3456),
    ("1,234,567", 1234567.0, 1234567, 12345.67),
    ("12 345", 12345.0, 12345, 123.45),
    ("-5", 5.0, 5, 0.05),
    ("(5.0)", 5.0, 5, 0.05),
    ("1e5", 100000.0, None, 1000.0),
    ("1d", None, None, None),
    ("abc", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
    ("0.50", 0.5, None, 0.005),
    ("12.50%", 12.5, None, 0.125),
    ("3 %", 3.0, 3, 0.03),
    ("0.123.456", None, None, None),
]


def test_numbers(spark):
    texts = [x[0] for x in NUMBERS]
    assert apply(spark, scalars.to_float, texts) == [x[1] for x in NUMBERS]
    assert apply(spark, scalars.to_int, texts) == [x[2] for x in NUMBERS]
    assert apply(spark, scalars.perc_to_float, texts) == pytest.approx([x[3] for x in NUMBERS])
    assert apply(spark, lambda c: scalars.perc_to_float(c, norm=False), ["5", "5%"]) == [5.0, 0.05]


def test_dates(spark):
    d = datetime.date
    cases = {"2025-07-02": d(2025, 7, 2), "02/07/2025": d(2025, 7, 2), "02/07/25": d(2025, 7, 2), "07-02-2025": d(2025, 7, 2), "01-05-25": d(2025, 5, 1), "15-03-2027": None, "03-04-2027": d(2027, 3, 4), "2025/01/02": None, "31/02/2024": None, "1/2/70": d(1970, 2, 1), "1/2/68": d(2068, 2, 1), " 2025-7-2": d(2025, 7, 2), "": None}
    assert apply(spark, scalars.to_date, list(cases)) == list(cases.values())


def test_texts(spark):
    assert apply(spark, scalars.normalize_string, ["  A  b\t\x1cC ", None, ""]) == ["a b c", None, ""]
    assert apply(spark, scalars.normalize_word, [" A b C"]) == ["AbC"]
    assert apply(spark, scalars.to_str, [" A  b "]) == ["A b"]
    assert apply(spark, scalars.to_currency, [" dkk ", "CNY", "aud", "XXX", "Eur", None]) == ["SEK", "JPY", "USD", None, "EUR", None]
    assert apply(spark, lambda c: scalars.to_currency(c, canonical=False), ["dkk"]) == ["DKK"]
    assert apply(spark, scalars.str_to_bool, [" Yes", "OFF", "1", "n", "maybe", None]) == [True, False, True, False, None, None]


def test_bonds(spark):
    texts = ["Foo 12.50% 15/03/2027 x", "Foo\n3,5 %\nbar", "Foo 2027-01-02", "Foo 01/02/27", "Foo 5%", "Foo"]
    assert apply(spark, scalars.interest_rate, texts) == ["2.50%", "3,5 %", None, None, None, None]
    assert apply(spark, scalars.maturity, texts) == ["15/03/2027", None, "2027-01-02", "01/02/27", None, None]
    assert apply(spark, scalars.instrument, texts) == ["BOND", "BOND", "BOND", "BOND", "EQUITY", "EQUITY"]


def test_matches(spark):
    r = random.Random(0)
    word = lambda: "".join(r.choice("abcA ") for _ in range(r.randint(0, 8)))
    pairs = [(word(), word()) for _ in range(300)]
    norm = lambda s: " ".join(s.lower().split())

    def prefix(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n / len(a) if a else 1.0

    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, t string, g string")
    t, g = F.col("t"), F.col("g")
    got = df.select("i", matching.target_match(t, g).alias("m"), matching.target_fuzzy_match(0.65)(t, g).alias("f"), matching.target_prefix_match(0.3)(t, g).alias("p"), matching.prefix_similarity(t, g).alias("s"), matching.both(matching.target_prefix_match(0.3), matching.target_fuzzy_match(0.65))(t, g).alias("b")).orderBy("i").collect()
    for (text, target), row in zip(pairs, got, strict=True):
        a, b = norm(text), norm(target)
        assert row.m == (b in a)
        assert row.f == (SequenceMatcher(None, b, a).ratio() >= 0.65)
        assert row.p == (prefix(b, a) >= 0.3)
        assert row.s == pytest.approx(prefix(text, target))
        assert row.b == (row.p and row.f)


def test_geometry(spark):
    df = spark.createDataFrame([("1 2 5 10",), ("bad",), ("1 2 3",), (None,)], "bbox string").select(geometry.bounds(F.col("bbox")).alias("b"))
    assert [r.b and tuple(r.b) for r in df.collect()] == [(1.0, 2.0, 5.0, 10.0), None, None, None]
    b = F.col("b")
    row = df.limit(1).select(geometry.centre(b).alias("c"), geometry.size(b).alias("s"), geometry.corners(b).alias("k"), geometry.area_text(b).alias("t"), geometry.is_contained(b, (1, 5), (None, 10)).alias("in"), geometry.is_contained(b, (2, None), (None, None)).alias("out"), geometry.is_positioned(b, (3, 3), (6, 6)).alias("at"), geometry.is_inside(b, y=(7, None)).alias("below"), geometry.range_text(geometry.range_struct(1, None)).alias("r"), geometry.range_size(geometry.range_struct(1, 4)).alias("n")).first()
    assert tuple(row.c) == (3.0, 6.0) and tuple(row.s) == (4.0, 8.0) and len(row.k) == 4
    assert (row["in"], row.out, row.at, row.below, row.r, row.n) == (True, False, True, False, "[1.0:-]", 3.0)
    with pytest.raises(ValueError):
        geometry.is_positioned(b, (None, 1), (0, 1))
    with pytest.raises(ValueError):
        geometry.range_struct(2, 1)
