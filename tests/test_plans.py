"""What plans look like, and that they give the same rows as plainer ways."""

import random
import re
from difflib import SequenceMatcher
from functools import reduce

import pytest
from ledgerleaf.fixed_values import TARGETS
from ledgerleaf.functions.matching import Likeness
from ledgerleaf.operators import page
from ledgerleaf.operators.extract import Positions, Walk, extract_holdings
from ledgerleaf.operators.layout import table_positions
from ledgerleaf.operators.lines import page_gate
from ledgerleaf.operators.matching import all_targets
from ledgerleaf.plans import formats, rendered
from ledgerleaf.plans.documents import all_holdings_of, all_rows_of, blocks_of, holdings_of
from ledgerleaf.plans.formats import SPECS
from ledgerleaf.sources.pages import lines_of, with_lines
from ledgerleaf.streaming import blocks_stream, pages_stream
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df: DataFrame) -> list:
    return sorted((repr(r) for r in df.collect()))


@pytest.fixture(scope="module")
def anima(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("pages") / "anima")
    rendered.report_pages(spark, SF, "ANIMA").write.parquet(at)
    return at


def test_page_stage_has_no_exchange(spark, anima):
    pages = spark.read.parquet(anima)
    blocks = blocks_of(with_lines(pages), SPECS["ANIMA"])
    assert "Exchange" not in plan(blocks) and "Window" not in plan(blocks)
    assert rows(blocks.drop("metadata")) == rows(blocks_of(lines_of(pages), SPECS["ANIMA"]).drop("metadata"))


def test_page_stage_equals_the_operators_over_lines(spark, anima):
    pages = spark.read.parquet(anima)
    lines = lines_of(pages)
    text, font = SPECS["ANIMA"].header
    gated = page.gate_pages(with_lines(pages), lambda x: page.holds(x, text, font))
    assert rows(gated.select("doc_id", "page_idx", F.inline("lines")).select("doc_id", "page_idx", "ord")) == rows(page_gate(lines, F.col("text").contains(text) & F.array_contains("fonts", font)).select("doc_id", "page_idx", "ord"))
    for columns in (True, False):
        placed = with_lines(pages).select("doc_id", "page_idx", F.inline(page.with_columns(F.col("lines"), columns))).select("doc_id", "page_idx", "line.ord", "table_col")
        assert rows(placed) == rows(table_positions(lines, columns).select("doc_id", "page_idx", "ord", "table_col"))


def test_page_stage_runs_on_a_stream(spark, anima, tmp_path):
    stream = blocks_stream(pages_stream(spark, anima), "ANIMA").drop("metadata")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    want = blocks_of(with_lines(spark.read.parquet(anima)), SPECS["ANIMA"]).drop("metadata")
    assert want.count() > 0 and rows(spark.read.parquet(str(tmp_path / "out"))) == rows(want)


def test_specifications_as_a_table(spark):
    made = {r["format"]: r["spec"].asDict(True) for r in formats.table(spark, SPECS.values()).collect()}
    assert set(made) == set(SPECS) and all(made[n]["format"] == n for n in SPECS)
    assert made["ARCA"]["prefix"] == 0.3 and made["ARCA"]["currency"] is None and made["ARCA"]["offsets"]["currency"] == 1
    assert made["ANIMA"]["switch_top"] == {"at": None, "text": "Holdings", "font": "Helvetica-Bold"} and made["AMUNDI"]["switch"] == {"text": None, "font": None}


def test_one_plan_for_any_number_of_reports(spark, tmp_path):
    names = ["ANIMA", "ARCA", "FIDEURAM"]
    made = [rendered.report_pages(spark, SF, n).withColumns({"format": F.lit(n), "report": F.concat_ws("/", F.lit(n), "doc_id")}) for n in names]
    reduce(DataFrame.unionByName, [*made, made[0].withColumn("format", F.lit("NONE"))]).write.parquet(str(tmp_path / "few"))
    few = spark.read.parquet(str(tmp_path / "few"))
    few.withColumn("report", F.explode(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda k: F.concat_ws("#", "report", k.cast("string"))))).write.parquet(str(tmp_path / "many"))
    one, all_of_them = (all_holdings_of(spark.read.parquet(str(tmp_path / x)), rendered.ISSUERS, "report") for x in ("few", "many"))
    nodes = lambda df: re.findall(r"(?m)^[\s:+*()\d-]*([A-Z][A-Za-z]+)", plan(df))
    assert nodes(one) == nodes(all_of_them) and "Union" not in "".join(nodes(all_holdings_of(few, rendered.ISSUERS, "report", specs=[SPECS["ANIMA"], SPECS["FIDEURAM"]])))
    want = [holdings_of(m.drop("format", "report"), n, rendered.ISSUERS).withColumn("Format", F.lit(n)) for m, n in zip(made, names, strict=True)]
    assert rows(one.drop("Report identifier")) == rows(reduce(DataFrame.unionByName, want))
    assert all_of_them.count() == 9 * one.count()


def test_similarity_is_one_python_node_behind_a_join(spark, anima):
    pages = spark.read.parquet(anima).withColumn("format", F.when(F.col("page_idx") % 2 == 0, "ARCA").otherwise("ANIMA"))
    for specs in ([SPECS["ARCA"]], list(SPECS.values())):
        text = plan(all_rows_of(pages, TARGETS[:20], specs))
        assert text.count("ArrowEvalPython") == 1 and "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


WORDS = ["alder", "works", "birch", "co", "a", "ab", "é", "holdings", "cedar", "x-y", "group"]


def texts_and_targets(seed):
    r = random.Random(seed)

    def some(n):
        picked = [r.choice(WORDS) for _ in range(r.randint(1, n))]
        return " ".join("".join(r.sample(w, len(w))) if r.random() < 0.2 else w for w in picked)

    texts = [None, "", " ", "ALDER  works", *[some(4) + r.choice(["", "s", " \n"]) for _ in range(150)]]
    return [(i, t) for i, t in enumerate(texts)], ["", " ", "Alder", "b", *[some(2) for _ in range(30)]]


LIKENESSES = [Likeness(), Likeness(0.3), Likeness(None, 0.6), Likeness(None, 0.9), Likeness(0.3, 0.65), Likeness(0.5, 0.8)]


def norm(text):
    return " ".join(text.lower().split())


def is_match(like, text, target):
    t, g = norm(text), norm(target)
    if like == Likeness():
        return g in t
    k = -int(-(len(g) * (like.prefix or 0) - 1e-9) // 1)
    return (like.prefix is None or (len(t) >= k and t[:k] == g[:k])) and (like.ratio is None or SequenceMatcher(None, g, t).ratio() >= like.ratio)


@pytest.mark.parametrize("like", LIKENESSES, ids=str)
def test_candidate_joins_lose_no_match(spark, like):
    data, names = texts_and_targets(LIKENESSES.index(like))
    texts = spark.createDataFrame(data, "id int, text string")
    targets = spark.createDataFrame(list(enumerate(names)), "ord int, target string")
    found = all_targets(texts, F.col("text"), targets, like)
    got = sorted((r["id"], r["target_ord"]) for r in found.select("id", "target_ord").collect())
    want = sorted((i, k) for i, t in data if t is not None for k, g in enumerate(names) if norm(g) and is_match(like, t, g))
    assert got == want and (want or like.ratio)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found) and plan(found).count("ArrowEvalPython") == (like.ratio is not None)


@pytest.mark.parametrize("n", [58, 50_000])
def test_no_nested_loop_whatever_the_number_of_targets(spark, n):
    names = [f"issuer {k} of {k % 97} funds" for k in range(n)]
    texts = spark.range(300).select("id", F.concat(F.lit("The  Issuer "), (F.col("id") * 7).cast("string"), F.lit(" of "), (F.col("id") * 7 % 97).cast("string"), F.lit(" Funds, plc")).alias("text"))
    targets = spark.createDataFrame(list(enumerate(names)), "ord int, target string")
    found = all_targets(texts, F.col("text"), targets)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    # 'issuer 7 of 7 funds' is also in 'issuer 7 of 7 funds', never in 'issuer 77 of ...'
    assert sorted((r["id"], r["target_ord"]) for r in found.collect()) == [(i, 7 * i) for i in range(300) if 7 * i < n]


@pytest.mark.parametrize("like", [Likeness(), Likeness(0.3, 0.65)], ids=str)
def test_walk_by_joins_equals_walk_by_expressions(spark, like):
    r = random.Random(4)
    blocks = [(d, 0, i, r.randint(0, 1), r.choice(["alder ", "works", "birch & co", "x", "alder works", "birsh co"]), "s") for d in range(60) for i in range(r.randint(1, 8))]
    df = spark.createDataFrame(blocks, "doc_id int, page_idx int, ord int, table_col int, content string, subfund string")
    targets = ["Alder Works", "Birch & Co", "works"]
    many = targets + [f"nobody {k}" for k in range(300)]
    by_expression = extract_holdings(df, targets, Positions(1, -1, 2), Walk(match=like.predicate()))
    by_join = extract_holdings(df, many, Positions(1, -1, 2), Walk(match=like if like.ratio else like.predicate()))
    assert by_join.count() > 0 and rows(by_join.select(*by_expression.columns)) == rows(by_expression)
    assert "NestedLoop" not in plan(by_join)
