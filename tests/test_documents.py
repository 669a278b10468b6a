"""From synthetic page XML to the output files."""

import csv
import tarfile
from xml.sax.saxutils import quoteattr

import pytest
from ledgerleaf.fixed_values import HOLDINGS_COLUMNS, TARGETS
from ledgerleaf.plans.documents import blocks_of, holdings_of, rows_of
from ledgerleaf.plans.formats import SPECS
from ledgerleaf.sources import control, pages, sinks
from ledgerleaf.streaming import holdings_stream, pages_stream


def line(text, font, x, y, width=40):
    chars = "".join(f"<char c={quoteattr(c)}/>" for c in text)
    return f'<line bbox="{x} {y} {x + width} {y + 8}" text={quoteattr(text)}><font name={quoteattr(font)} size="8">{chars}</font></line>'


def page(*lines):
    return f"<page><block>{''.join(lines)}</block></page>"


def fideuram_page():
    """Currency, quantity, name, value, share: a row of a table; names in two lines, a deselected heading, a foot outside the body."""
    head = [line("Country", "Arial", 10, 95), line("Fund One", "Arial-Bold", 10, 40), line("INVESTMENT FUNDS", "Arial", 10, 120)]
    row = lambda y, cells: [line(t, "Arial", 10 + 100 * i, y) for i, t in enumerate(cells)]
    body = row(150, ["EUR", "1.000", "Carlsberg 2.50% 01/02/2030", "2,000", "1.5%"]) + row(170, ["USD", "50", "Unknown", "1", "1%"])
    body += row(190, ["NOK", "300", "Booking "])[:3] + [line("Holdings", "Arial", 210, 198)] + row(190, ["", "", "", "4.000", "0.5"])[3:]
    return page(*head, *body, line("Siemens foot", "Arial", 10, 800))


def documents(spark):
    return spark.createDataFrame([("r", 0, page(line("Nothing", "Arial", 0, 0))), ("r", 1, fideuram_page())], "doc_id string, page_idx int, xml string")


def test_lines_keep_spaces_and_survive_bad_pages(spark):
    bad = spark.createDataFrame([("r", 0, page(line("a b ", "F", 1, 2))), ("r", 1, page(line("c\x01d", "F", 1, 2))), ("r", 2, "<page><block>"), ("r", 3, page())], "doc_id string, page_idx int, xml string")
    got = {x.page_idx: (x.content, tuple(x.box), x.font, x.size) for x in pages.lines_of(bad).collect()}
    assert got[0] == ("a b \n", (1.0, 2.0, 41.0, 10.0), "F", 8.0) and got[1][0] == "cd\n" and set(got) == {0, 1}
    assert [x.page_idx for x in pages.unreadable(bad).collect()] == [2]


def test_holdings_of_a_page(spark):
    table = holdings_of(documents(spark), "FIDEURAM", TARGETS)
    assert [(f.name, f.dataType.simpleString()) for f in table.schema] == [(n, "bigint" if k == "bigint" else k) for n, k in HOLDINGS_COLUMNS]
    got = sorted(tuple(r) for r in table.select("Page report", "Company", "Financial instrument", "Sub-fund", "Nominal/Quantity", "Market value", "Currency", "% Net Assets", "Interest rate").collect())
    assert got == [(3, "Booking Holdings", "EQUITY", "Fund One", 300, 4000.0, "SEK", pytest.approx(0.005), None), (3, "Carlsberg", "BOND", "Fund One", 1000, 2000.0, "EUR", pytest.approx(0.015), pytest.approx(0.025))]
    columns = {r.content.strip(): r.table_col for r in blocks_of(pages.lines_of(documents(spark)), SPECS["FIDEURAM"]).collect()}
    assert columns["EUR"] == 0 and columns["Carlsberg 2.50% 01/02/2030"] == columns["Holdings"] == 2 and "INVESTMENT FUNDS" not in columns


@pytest.mark.parametrize("name", sorted(SPECS))
def test_every_format_plans_and_keeps_its_schema(spark, name):
    assert holdings_of(documents(spark).limit(1), name, ["Carlsberg"]).count() == 0


def test_missing_subfund(spark):
    no = spark.createDataFrame([("r", 0, page(line("Country", "Arial", 10, 95), line("x", "Arial", 10, 150)))], "doc_id string, page_idx int, xml string")
    assert blocks_of(pages.lines_of(no), SPECS["FIDEURAM"]).first().subfund is None
    with pytest.raises(Exception, match="sub-fund"):
        blocks_of(pages.lines_of(no), SPECS["FIDEURAM"], strict=True).collect()


def test_switch_and_page_currency(spark):
    anima = page(line("Holdings", "Helvetica-Bold", 0, 100), line("Fund", "Helvetica-Condensed-Blac", 0, 70), line("above", "Helvetica-Light", 0, 90), line("inside", "Helvetica-Light", 0, 200), line("Futures contracts", "Helvetica-Bold", 0, 300), line("below", "Helvetica-Light", 0, 400))
    df = spark.createDataFrame([("r", 0, anima)], "doc_id string, page_idx int, xml string")
    assert [r.content for r in blocks_of(pages.lines_of(df), SPECS["ANIMA"]).collect()] == ["inside\n"]
    amundi = page(line("Securities Portfolio as at", "ArialNarrow-BoldItalic", 0, 20), line("Fund", "ArialMT", 0, 10), line("CHF", "ArialNarrow", 0, 100), line("1%", "ArialNarrow", 0, 300), line("7", "ArialNarrow", 100, 300), line("Siemens", "ArialNarrow", 200, 300), line("9", "ArialNarrow", 300, 300))
    row = rows_of(spark.createDataFrame([("r", 0, amundi)], "doc_id string, page_idx int, xml string"), "AMUNDI", TARGETS).first()
    assert (row.company, row.currency, row.quantity, row.market_value, row.net_assets) == ("Siemens", "CHF", 9, 7.0, 0.01)


def test_sinks(spark, tmp_path):
    table = holdings_of(documents(spark), "FIDEURAM", TARGETS)
    jobs = [(table, "FIDEURAM", "one"), (table, "FIDEURAM", None)]
    sinks.write_csv(table, str(tmp_path / "o.csv"))
    assert next(csv.reader(open(tmp_path / "o.csv"))) == [n for n, _ in HOLDINGS_COLUMNS]
    sinks.write_merged(jobs, str(tmp_path / "m.csv"))
    merged = list(csv.DictReader(open(tmp_path / "m.csv")))
    assert len(merged) == 4 and {x["Format"] for x in merged} == {"FIDEURAM"} and {x["Report identifier"] for x in merged} == {"one", ""}
    assert sinks.write_separate(jobs, str(tmp_path / "all.tar.gz")) == ["one-FIDEURAM.csv", "FIDEURAM.csv"]
    assert sorted(m.name for m in tarfile.open(tmp_path / "all.tar.gz").getmembers() if m.isfile()) == ["all/FIDEURAM.csv", "all/one-FIDEURAM.csv"]
    assert not (tmp_path / "all").exists()


def test_stream(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "in"))
    holdings_stream(pages_stream(spark, str(tmp_path / "in")), "FIDEURAM", TARGETS, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("verbosity: 1\nformat: ANIMA\nout_path: /dev/stdout\nsave_pdf: false\n")
    s = control.configure(["--config", str(tmp_path / "c.yaml"), "-vv", "--pdf", "x.pdf", "-j", "0"], {"LEDGERLEAF_FORMAT": "ARCA", "LEDGERLEAF_SEPARATE_OUT": "no"})
    assert (s.verbosity, s.format, s.pdf, s.save_pdf, s.separate_out) == (3, "ARCA", "x.pdf", False, False) and s.n_workers > 0
    assert (s.origin["format"], s.origin["save_pdf"], s.origin["pdf"]) == ("environment", "file", "command line")
    assert s.validated().log_level() == 20
    (tmp_path / "jobs.csv").write_text(" URL ,Format,prefix out,save pdf\nhttps://www.amundi.it/x,,a,\n,ANIMA,,yes\n")
    jobs = control.batch_jobs(str(tmp_path / "jobs.csv"), s)
    assert [(j.url, j.format, j.prefix_out, j.save_pdf) for j in jobs] == [("https://www.amundi.it/x", "ARCA", "a", False), (None, "ANIMA", None, True)]
    with pytest.raises(Exception, match="exclude"):
        control.configure(["-v", "-q"], {})
    with pytest.raises(ValueError):
        control.Settings().validated()
    with pytest.raises(control.NoFormatDetected):
        control.reconcile_format(None, None)
    with pytest.raises(ValueError):
        control.to_bool("perhaps")


def test_targets_and_formats(spark, tmp_path):
    assert control.target_list(control.targets(spark)) == TARGETS and len(TARGETS) == 58
    (tmp_path / "t.csv").write_text("NAME\nOne\n\n  \nTwo\n")
    assert control.target_list(control.targets(spark, str(tmp_path / "t.csv"))) == ["One", "Two"]
    urls = spark.createDataFrame([("https://www.fundsquare.net/a/aKxRJLzQbOPf89pUHU0Jbso",), ("https://www.amundi.it/x",), ("https://nowhere",)], "u string")
    assert [r[0] for r in urls.select(control.detect_format(urls.u)).collect()] == ["EURIZON_OLD", "AMUNDI2", None]


def test_local_file_comes_first(tmp_path):
    (tmp_path / "r.pdf").write_bytes(b"%PDF")
    assert pages.document_bytes(str(tmp_path / "r.pdf"), "http://127.0.0.1:9/none") == b"%PDF"
    with pytest.raises(OSError):
        pages.download("http://127.0.0.1:9/none", timeout=1)


def test_settings_files_are_found(tmp_path):
    here, home, shared = (tmp_path / x for x in ("here", "home", "shared"))
    for d in (here, home / ".config", shared):
        d.mkdir(parents=True)
    env = {"XDG_CONFIG_DIRS": f"/nowhere:{shared}"}
    find = lambda: control.find_config(str(home), str(here), env, windows=False)
    assert find() is None
    (shared / "ledgerleaf.yml").write_text("")
    assert find() == str(shared / "ledgerleaf.yml")
    (home / ".config" / "ledgerleaf.yaml").write_text("")
    assert find() == str(home / ".config" / "ledgerleaf.yaml")
    for name in ("ledgerleaf.yaml", "config-other.yaml", "xconf.ledgerleaf.yaml"):
        (here / name).write_text("")
    assert find() == str(home / ".config" / "ledgerleaf.yaml")
    for name in (".ConfLedgerleaf.yml", "LEDGERLEAF_config.yaml", "config.ledgerleaf.YAML"):
        (here / name).write_text("")
        assert find() == str(here / name)
        (here / name).unlink()
    (home / "AppData" / "Local").mkdir(parents=True)
    (home / "AppData" / "Local" / "ledgerleaf.yml").write_text("")
    assert control.find_config(str(home), str(here), {}, windows=True) == str(home / "AppData" / "Local" / "ledgerleaf.yml")
