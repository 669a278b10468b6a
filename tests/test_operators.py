"""Layout and extraction against plain-Python models of the walk."""

import random

import pytest
from ledgerleaf.operators import holdings
from ledgerleaf.operators.extract import Positions, extract_holdings
from ledgerleaf.operators.layout import table_positions
from ledgerleaf.operators.lines import lines_with_text_and_font, page_gate, select_inside, select_outside
from pyspark.sql import functions as F


def greedy_columns(boxes, small_rule, use_ruler_pos):
    """Repeatedly the narrowest line without a ruler makes one and takes all lines that fit it."""
    left, rulers, at = dict(enumerate(boxes)), [], {}
    while left:
        k = (min if small_rule else max)(left, key=lambda i: (left[i][1] - left[i][0]) * 1.0)
        lo, hi = boxes[k]
        ruler = (lo + hi) / 2
        rulers.append(ruler)
        fits = [i for i, (a, b) in left.items() if (a <= ruler <= b if use_ruler_pos else lo <= (a + b) / 2 <= hi)]
        for i in fits:
            at[i] = ruler
            del left[i]
    order = sorted(rulers)
    return [order.index(at[i]) for i in range(len(boxes))]


@pytest.mark.parametrize(("small_rule", "use_ruler_pos", "columns"), [(True, True, True), (False, True, True), (True, False, True), (True, True, False)])
def test_table_positions(spark, small_rule, use_ruler_pos, columns):
    r = random.Random(1)
    pages = [[(float(a := r.randint(0, 60)), float(a + r.randint(1, 25))) for _ in range(r.randint(1, 9))] for _ in range(80)]
    rows = [(p, 0, i, ((a, 0.0, b, 1.0) if columns else (0.0, a, 1.0, b))) for p, page in enumerate(pages) for i, (a, b) in enumerate(page)]
    lines = spark.createDataFrame(rows, "doc_id int, page_idx int, ord int, box struct<x0:double,y0:double,x1:double,y1:double>")
    got = {(x.doc_id, x.ord): x.table_col for x in table_positions(lines, columns, small_rule, use_ruler_pos).collect()}
    for p, page in enumerate(pages):
        assert [got[p, i] for i in range(len(page))] == greedy_columns(page, small_rule, use_ruler_pos), page


def walk(blocks, targets, offsets):
    """The walk, one block after the other: blocks are (column, content)."""
    blocks, out, i = [list(b) for b in blocks], [], 0
    first = lambda text: next((t for t in targets if t in text), None)
    field = lambda k: blocks[k][1] if 0 <= k < len(blocks) else None
    while i < len(blocks) - 1:
        joint = blocks[i][0] == blocks[i + 1][0]
        content = blocks[i][1] + (blocks[i + 1][1] if joint else "")
        hit = first(content)
        if hit:
            if joint:
                blocks[i][1] = content
                blocks.pop(i + 1)
            out.append((hit, content, *[field(i + o) for o in offsets]))
        i += 1
    if i == len(blocks) - 1:
        out += [(t, blocks[i][1], *[field(i + o) for o in offsets]) for t in targets if t in blocks[i][1]]
    return out


@pytest.mark.parametrize("offsets", [(1, 2, -1), (-1, -2, 3), (2, -1, 1)])
def test_extraction(spark, offsets):
    r = random.Random(sum(offsets) + 50)
    documents = [[(r.randint(0, 1), r.choice(["ab", "a", "b", "x", "c", "xyz"])) for _ in range(r.randint(1, 9))] for _ in range(150)]
    rows = [(d, 0, i, c, t, "s") for d, doc in enumerate(documents) for i, (c, t) in enumerate(doc)]
    blocks = spark.createDataFrame(rows, "doc_id int, page_idx int, ord int, table_col int, content string, subfund string")
    targets = ["ab", "c", " "]
    found = extract_holdings(blocks, targets, Positions(*offsets))
    got = {}
    for x in found.orderBy("doc_id", "ord").collect():
        got.setdefault(x.doc_id, []).append((x.company, x.content, x.raw_quantity, x.raw_market_value, x.raw_net_assets))
        assert x.out_of_range == (None in (x.raw_quantity, x.raw_market_value, x.raw_net_assets))
    for d, doc in enumerate(documents):
        want = walk(doc, targets[:2], offsets)
        assert sorted(got.get(d, []), key=str) == sorted(want, key=str), doc


def test_positions_are_checked():
    with pytest.raises(ValueError, match="non-zero"):
        Positions(0, 1, 2)
    with pytest.raises(ValueError, match="different"):
        Positions(1, 1, 2)


def raw(spark, **over):
    base = {"page_idx": 1, "company": "Acme", "subfund": " F  und ", "instrument": "BOND", "raw_quantity": "1.000", "raw_market_value": "2,000", "raw_net_assets": "5 %", "raw_currency": "nok", "raw_acquisition_cost": None, "raw_interest_rate": "2.5%", "raw_maturity": "01/02/2030"} | over
    kinds = ", ".join(f"{k} {'int' if k == 'page_idx' else 'string'}" for k in base)
    return spark.createDataFrame([tuple(base.values())], kinds)


def test_holdings(spark):
    table = holdings.to_table(holdings.handle_errors(holdings.validate(holdings.deserialize(raw(spark)), ["Acme"])))
    row = table.first()
    assert tuple(row)[:9] == (3, "Acme", "BOND", "F und", 1000, 2000.0, "SEK", 0.05, None) and str(row["Maturity"]) == "2030-02-01" and row["Interest rate"] == pytest.approx(0.025)
    assert "Acme" in table.select(holdings.describe().alias("d")).first().d
    floats = holdings.deserialize(raw(spark, raw_quantity="12,7", raw_market_value="3,25"), cost_and_value_interpret_int=False, quantity_interpret_float=True).first()
    assert (floats.quantity, floats.market_value) == (12, 3.25)


@pytest.mark.parametrize(("over", "message"), [({"raw_quantity": "n/a"}, "quantity"), ({"raw_currency": "zzz"}, "currency"), ({"raw_net_assets": "150%"}, "share"), ({"company": "Other"}, "target"), ({"raw_maturity": "2030/01/01"}, "maturity")])
def test_error_modes(spark, over, message):
    rows = holdings.validate(holdings.deserialize(raw(spark, **over)), ["Acme"])
    assert message in holdings.errors(rows).first().error
    sentinel = holdings.to_table(holdings.handle_errors(rows)).first()
    assert (sentinel["Page report"], sentinel["Financial instrument"], sentinel["Currency"], sentinel["% Net Assets"]) == (9999, "EQUITY", "EUR", 0.0)
    assert holdings.handle_errors(rows, holdings.DROPMALFORMED).count() == 0
    with pytest.raises(Exception, match=message):
        holdings.handle_errors(rows, holdings.FAILFAST).collect()


def test_warning_for_odd_rates(spark):
    assert holdings.validate(holdings.deserialize(raw(spark, raw_interest_rate="250%"))).first().warning


def test_lines(spark):
    rows = [(1, 0, i, (0.0, float(i), 1.0, i + 1.0), f, [f, "Z"], t) for i, (t, f) in enumerate([("Head", "A"), ("x", "B"), ("Head 2", "A")])] + [(1, 1, 0, (0.0, 0.0, 1.0, 1.0), "A", ["A"], "none")]
    lines = spark.createDataFrame(rows, "doc_id int, page_idx int, ord int, box struct<x0:double,y0:double,x1:double,y1:double>, font string, fonts array<string>, text string")
    assert page_gate(lines, F.col("text").contains("Head")).count() == 3
    assert [r.text for r in lines_with_text_and_font(lines, "Head", "Z", first=True).collect()] == ["Head"]
    assert select_inside(lines, y=(1, None)).count() == 2 and select_outside(lines, y=(1, None)).count() == 2
