"""Reports and batches from files to CSV, with a stub in place of the PDF decoder."""

import csv
import io
import logging
import tarfile

import pandas as pd
import pytest
from ledgerleaf.operators import holdings
from ledgerleaf.plans import documents
from ledgerleaf.sources import control, pages, sinks
from pyspark.sql import functions as F
from test_documents import fideuram_page, line, page

DECODER = "stub_decoder:decode"


@pytest.fixture
def report(tmp_path):
    path = tmp_path / "r.pdf"
    path.write_text("\n".join([page(line("Nothing", "Arial", 0, 0)), fideuram_page(), page(), fideuram_page().replace('c="1"/><char c="."/><char c="5"/>', 'c="n"/>')]))
    return str(path)


def test_pages_are_decoded_by_tasks(spark, report, tmp_path):
    for parts in (1, 3, 7):
        df = pages.read_documents(spark, [pages.Document("a", report), pages.Document("b", report)], DECODER, parts)
        assert df.rdd.getNumPartitions() == 2 * parts
        assert sorted((r["doc_id"], r["page_idx"]) for r in df.collect()) == [(d, i) for d in "ab" for i in range(4)]
    # an address, saved where the report names it, by one of the tasks
    got = pages.read_documents(spark, [pages.Document("a", str(tmp_path / "saved.pdf"), f"file://{report}", True)], DECODER)
    assert got.count() == 4 and (tmp_path / "saved.pdf").read_text() == open(report).read()
    with pytest.raises(Exception, match="not a report"):
        (tmp_path / "x.pdf").write_text("broken")
        pages.read_documents(spark, [pages.Document("x", str(tmp_path / "x.pdf"))], DECODER).collect()


def settings(**values):
    return control.Settings().overlay(values, "test")


def test_one_report(spark, report, tmp_path, caplog):
    with caplog.at_level(logging.DEBUG, logger="ledgerleaf"):
        documents.run(spark, settings(pdf=report, format="FIDEURAM", out=str(tmp_path / "o.csv")), DECODER)
    rows = list(csv.DictReader(open(tmp_path / "o.csv")))
    assert [r["Page report"] for r in rows] == ["3", "3", "9999", "5"] and rows[2]["Company"] == "net_assets can't be read"
    want = documents.holdings_of(pages.read_documents(spark, [pages.Document("0", report)], DECODER), "FIDEURAM", control.target_list(control.targets(spark)))
    text = io.StringIO()
    want.toPandas().to_csv(text, index=False)
    assert sorted(text.getvalue().splitlines()) == sorted(open(tmp_path / "o.csv").read().splitlines())
    assert any("1 of 4 rows have errors, the first on page 5" in m for m in caplog.messages) and any("format='FIDEURAM' (test)" in m for m in caplog.messages)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["o.csv", "r.pdf"]


def test_batch_in_one_plan(spark, report, tmp_path):
    (tmp_path / "jobs.csv").write_text(f"pdf,format,prefix out\n{report},FIDEURAM,one\n{report},ANIMA,\n{report},FIDEURAM,\n{report},FIDEURAM,one\n")
    jobs = {"batch": str(tmp_path / "jobs.csv"), "pdf": "x"}
    documents.run(spark, settings(**jobs, out=str(tmp_path / "m.csv")), DECODER)
    merged = pd.read_csv(tmp_path / "m.csv", keep_default_na=False)
    assert list(merged.columns[-2:]) == ["Report identifier", "Format"] and list(merged["Report identifier"]) == ["one"] * 4 + [""] * 4 + ["one"] * 4
    documents.run(spark, settings(**jobs, out=str(tmp_path / "all.tar.gz"), separate_out=True), DECODER)
    with tarfile.open(tmp_path / "all.tar.gz") as tar:
        lines = {m.name: len(tar.extractfile(m).read().splitlines()) for m in tar.getmembers() if m.isfile()}
    assert lines == {"all/one-FIDEURAM.csv": 5, "all/ANIMA.csv": 1, "all/FIDEURAM.csv": 5}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["all.tar.gz", "jobs.csv", "m.csv", "r.pdf"]


def test_local_file_needs_no_known_address(report):
    assert documents.chosen_format(settings(pdf=report, url="https://nowhere", format="ANIMA")) == "ANIMA"
    with pytest.raises(control.NoFormatDetected):
        documents.chosen_format(settings(pdf=report, url="https://www.amundi.it/x"))
    assert documents.chosen_format(settings(url="https://www.amundi.it/x")) == "AMUNDI2"


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    table = spark.range(100, numPartitions=4).select((F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id"))).cast("long").alias("n"))
    with pytest.raises(Exception, match="no"):
        sinks.write_one(table, str(tmp_path / "o.csv"))
    with pytest.raises(Exception, match="no"):
        sinks.write_files(table.withColumn(sinks.FILE, F.lit("a.csv")), str(tmp_path / "o.tar.gz"), ["a.csv"])
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_bytes_are_those_of_pandas(spark, tmp_path):
    table = spark.range(50, numPartitions=3).select((F.col("id") * 3).alias("whole"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("some"), (F.col("id") / 7).alias("part"), F.when(F.col("id") % 5 > 0, F.concat(F.lit('a,"b" '), F.col("id").cast("string"))).alias("text"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    sinks.write_one(table.withColumn(sinks.ORDER, F.col("whole")), str(tmp_path / "o.csv"))
    text = io.StringIO()
    table.orderBy("whole").toPandas().to_csv(text, index=False)
    assert open(tmp_path / "o.csv").read() == text.getvalue()
    sinks.write_one(table.where("whole < 0"), str(tmp_path / "none.csv"))
    assert open(tmp_path / "none.csv").read() == "whole,some,part,text,day\n"


def test_counts_equal_an_aggregate(spark):
    rows = spark.range(1000).select(F.col("id").cast("int").alias("page_idx"), F.when(F.col("id") % 10 == 3, "bad").alias("error"), F.when(F.col("id") % 4 == 0, "odd").alias("warning"), F.when(F.col("id") % 3 > 0, "F").alias("subfund"))
    counted, seen = holdings.observed(rows, {"even": F.col("page_idx") % 2 == 0})
    counted.write.format("noop").mode("overwrite").save()
    for name, part in (("all", rows), ("even", rows.where("page_idx % 2 = 0"))):
        want = part.agg(F.count(F.lit(1)), F.count("error"), F.count("warning"), F.count_if(F.col("subfund").isNull()), F.min(F.when(F.col("error").isNotNull(), F.col("page_idx")))).first()
        assert [seen.get[f"{name}: {x}"] for x in ("rows", "errors", "warnings", "without sub-fund", "first page with an error")] == list(want)


def test_unknown_types_fail_or_become_sentinels(spark):
    typed = spark.createDataFrame([("EQUITY_TARGET", None), ("NOTE", None), (None, None), ("CASH", "odd")], "block_type string, error string").withColumn("instrument", F.lit("EQUITY"))
    got = {r["block_type"]: (r["instrument"], r["error"]) for r in holdings.dispatch(typed, {"CASH": {"instrument": F.lit("CASH")}}).collect()}
    assert got == {"EQUITY_TARGET": ("EQUITY", None), "CASH": ("CASH", None), "NOTE": ("EQUITY", "expected bond or equity blocks, found NOTE"), None: ("EQUITY", "expected bond or equity blocks, found none")}


def test_damaged_pages_keep_their_lines(spark):
    whole = line("a b ", "F", 1, 2)
    xml = ["<page><block>" + whole + line("c", "G", 3, 4)[:-20], "<page><block>" + whole + '<line bbox="1 2 3 4" text="d"><font name="F" size="8"><char c="d"/></line>' + line("e", "F", 1, 2) + "</block></page>", "<page", "", None, "<page><block>" + whole + '<line bbox="1 2 3 4', page(whole)]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(xml)], "doc_id string, page_idx int, xml string")
    got = {}
    for r in pages.lines_of(df).orderBy("page_idx", "ord").collect():
        got.setdefault(r["page_idx"], []).append((r["ord"], r["text"], r["content"]))
    assert got == {0: [(0, "a b ", "a b \n"), (1, "c", "\n")], 1: [(0, "a b ", "a b \n"), (1, "d", "d\n"), (2, "e", "e\n")], 5: [(0, "a b ", "a b \n")], 6: [(0, "a b ", "a b \n")]} or got[0] == [(0, "a b ", "a b \n"), (1, "c", "c\n")]
    assert sorted(r["page_idx"] for r in pages.unreadable(df).collect()) == [0, 1, 2, 3, 4, 5]
