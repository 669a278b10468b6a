"""Pages read by patterns give what the tree gives, and lines are read once."""

import random
import re

import pytest
from ledgerleaf.plans import rendered
from ledgerleaf.sources import pages
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(repr(r) for r in df.collect())


def made_page(r):
    odd = r.random() < 0.5
    usual = lambda x, y: y if odd and r.random() < 0.02 else x
    gap = lambda: r.choice(["", "", "\n", " \r\n\t"])
    value = lambda: "".join(r.choice(["a", "Z", " ", "é", "&amp;", "&lt;", "&gt;", "&quot;", "&apos;", "&#233;", "&#x20ac;", "&amp;lt;", "'", "1", "𝒳"]) for _ in range(r.randint(0, 4)))
    out = gap() + usual("<page", "<page id='x'") + r.choice(["", ' id="page0" width="5"']) + ">" + gap()
    for _ in range(r.randint(0, 2)):
        out += "<block" + r.choice(["", ' bbox="1 2 3 4" justify="l"']) + ">" + gap()
        for _ in range(r.randint(0, 3)):
            out += f'<line bbox="{r.choice(["1 2 3 4", " 1.5  2 3 4e1 ", "1 2 3", "", "1 2 x 4" if odd else "0 0 0 0"])}"{r.choice(["", ' wmode="0" dir="1 0"'])} text="{usual(value(), "a\tb")}">' + gap() + usual("", "<!-- <line> -->")
            for _ in range(r.randint(usual(1, 0), 3)):
                out += f'<font name="{value()}" size="{usual(r.choice(["8.5", "9", "0008.25"]), r.choice(["x", "1e1", ""]))}">' + gap()
                for _ in range(r.randint(0, 5)):
                    char = usual(r.choice(["a", "b", " ", "&amp;", "&lt;", "&#xe9;", "é", "", "𝒳", ">" if odd else "g"]), "<")
                    out += f'<char{r.choice(["", ' quad="1 2" x="3" alpha="#ff" flags="1"'])} c="{char}"/>' + gap()
                out += usual("</font>", "<b/></font>") + gap()
            out += usual("</line>", "") + gap()
        out += "</block>" + gap()
    return out + usual("</page>", "") + gap()


def test_plain_pages_are_read_as_trees_are(spark):
    r = random.Random(3)
    df = spark.createDataFrame([(i, 0, made_page(r)) for i in range(1500)], "doc_id int, page_idx int, xml string").localCheckpoint()
    assert 200 < df.where(pages.is_plain(F.col("xml")) & F.col("xml").contains("<line")).count() < 1400
    want = df.select("doc_id", "page_idx", pages.lines_of_tree(pages.readable(F.col("xml"))).alias("lines"))
    assert rows(pages.with_lines(df)) == rows(want)
    assert rows(pages.lines_of(df)) == rows(want.select("doc_id", "page_idx", F.inline("lines")))
    assert rows(pages.unreadable(df)) == rows(pages.parsed(df).where(pages.is_broken(F.col("page"))).select("doc_id", "page_idx"))


def test_a_large_page_is_read_without_a_tree(spark):
    line = '<line bbox="1 2 3 4" text="x"><font name="A" size="8">' + '<char c="x"/>' * 40 + "</font></line>"
    one = spark.range(1).select(F.lit(1).alias("doc_id"), F.lit(0).alias("page_idx"), F.concat(F.lit("<page><block>"), F.repeat(F.lit(line), 50_000), F.lit("</block></page>")).alias("xml"))
    assert pages.lines_of(one).agg(F.count("*"), F.max("ord"), F.sum(F.length("content"))).first() == (50_000, 49_999, 41 * 50_000)
    assert one.where(pages.is_plain(F.col("xml"))).count() == 1


@pytest.mark.parametrize(("name", "scans"), [("lines_by_area", 2), ("lines_by_font", 4)])
def test_lines_are_read_once_for_several_conditions(spark, name, scans):
    assert len(re.findall(r"FileScan|Scan parquet", plan(rendered.QUERIES[name](spark, SF)))) == scans
