"""From pages to the holdings table, as one lazy plan for any number of reports and formats.

A page stays one row until its blocks are found (`operators.page`): gate, sub-fund, anchors, body and columns are
expressions over the page's array of lines, without an exchange. Formats are constants that pages look up by name, so
the plan is the same for one report and for a thousand. The walk over blocks is a window over a document.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.matching import Likeness
from ledgerleaf.operators import holdings, page
from ledgerleaf.operators.extract import FIELDS, SHORT_LIST, Walk, joined_targets, listed_targets, merged_rows, reach_of, read_names, target_table, targets_in, with_fields, with_neighbours
from ledgerleaf.operators.page import PAGE
from ledgerleaf.plans import formats
from ledgerleaf.plans.formats import SPECS, FormatSpec
from ledgerleaf.sources import control, pages as page_source

log = logging.getLogger("ledgerleaf")


class ExpectedBlockNotFound(Exception):
    """A page that should have a sub-fund has none."""


def page_blocks(pages: DataFrame, spec: Column, strict: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """(keep, doc_id, page_idx, ord, table_col, content, subfund, metadata) of pages with lines, by a format's struct; no exchange.

    strict: a page without a sub-fund fails the query; else its sub-fund is null.
    """
    missing = F.raise_error(F.lit(f"{ExpectedBlockNotFound.__name__}: a page has no sub-fund")).cast("string") if strict else None
    # no filter, which would go below the reading of lines and read them once more
    lines = F.col("lines")
    return pages.select(*keep, *PAGE, F.inline(F.when(page.is_wanted(lines, spec), page.blocks(lines, spec, missing))))


def blocks_of(lines: DataFrame, spec: FormatSpec, strict: bool = False) -> DataFrame:
    """The blocks of pages of one format, given as pages with lines (`with_lines`) or as a row a line, which takes an exchange."""
    return page_blocks(lines if "lines" in lines.columns else page.paged(lines), formats.as_column(spec), strict)


def all_rows_of(pages: DataFrame, targets: list[str], specs: Collection[FormatSpec] | None = None, mode: str = holdings.PERMISSIVE, page_offset: int = 2, canonical_currency: bool = True, strict: bool = False, keep: Collection[str] = (), others: Mapping[str, Mapping[str, Column]] | None = None) -> DataFrame:
    """Typed rows with their errors of pages (doc_id, page_idx, xml, format): all formats in one plan.

    specs: the formats that there may be, by default all known ones; pages of others, or of none, give no rows. keep:
    further columns of pages that stay, and tell documents apart. others: see `holdings.dispatch`.
    """
    specs = list(SPECS.values()) if specs is None else list(specs)
    one = specs[0] if len(specs) == 1 else None
    spec = formats.as_column(one) if one else formats.chosen(F.col("format"), specs)
    known = pages.select(*keep, "format", *PAGE, "xml").where(F.col("format") == one.name if one else F.col("format").isin([s.name for s in specs]))
    # a row of a page holds its format, a row of a block only its name
    blocks = page_blocks(page_source.with_lines(known).withColumn("spec", spec), F.col("spec"), strict, [*keep, "format"])
    walk = Walk(key=(*keep, "format", "doc_id"))
    kinds = {s.likeness for s in specs}
    rows = with_neighbours(blocks, walk)
    if kinds == {Likeness()} and len(targets) <= SHORT_LIST:
        found = {f"_{x}_targets": F.when(F.col(f"_{x}").isNotNull(), targets_in(F.col(f"_{x}"), targets)) for x in ("joint", "own")}
        rows = rows.withColumns(found)
    else:
        rows = rows.withColumn("_spec", spec).withColumns({"_prefix": F.col("_spec.prefix"), "_ratio": F.col("_spec.ratio")}).drop("_spec")
        rows = listed_targets(rows, targets, kinds) if len(targets) <= SHORT_LIST else joined_targets(rows, target_table(pages.sparkSession, targets), kinds)
        rows = rows.drop("_prefix", "_ratio")
    rows = with_fields(merged_rows(rows, walk).withColumn("spec", spec), F.col("spec.offsets"), reach_of([s.positions.offsets() for s in specs]), walk)
    # what the page says once stands for the field in each of its rows
    raw = {name: F.col(f"raw_{name}") if name != "currency" else F.coalesce("raw_currency", "spec.currency") for name in FIELDS}
    rows = rows.withColumns({f"raw_{name}": F.when(F.map_contains_key("metadata", name), F.try_element_at("metadata", F.lit(name))).otherwise(value) for name, value in raw.items()})
    typed = holdings.deserialize(read_names(rows), F.col("spec.cost_and_value_interpret_int"), F.col("spec.quantity_interpret_float"), canonical_currency, page_offset)
    return holdings.handle_errors(holdings.validate(holdings.dispatch(typed, others), targets), mode)


def rows_of(pages: DataFrame, format_name: str, targets: list[str], **options) -> DataFrame:
    """Typed rows of pages (doc_id, page_idx, xml) of one format, before they become the table."""
    return all_rows_of(pages.withColumn("format", F.lit(format_name)), targets, [SPECS[format_name]], **options)


def holdings_of(pages: DataFrame, format_name: str, targets: list[str], **options) -> DataFrame:
    """The holdings table of pages (doc_id, page_idx, xml) of one format."""
    return holdings.to_table(rows_of(pages, format_name, targets, **options))


def all_holdings_of(pages: DataFrame, targets: list[str], report: str | None = None, **options) -> DataFrame:
    """The holdings table of pages (doc_id, page_idx, xml, format) of any formats, with the format and, named by `report`, a column that identifies reports."""
    return tabled(all_rows_of(pages, targets, keep=[report] if report else [], **options), report)


def tabled(rows: DataFrame, report: str | None) -> DataFrame:
    more = ([F.col(report).alias("Report identifier")] if report else []) + [F.col("format").alias("Format")]
    return holdings.to_table(rows, more)


def chosen_format(settings: control.Settings) -> str:
    """The format that is selected or that the address tells; a file that is there is read without looking at the address."""
    local = settings.pdf and (settings.url is None or os.path.exists(settings.pdf))
    found = None if local else control.format_of(settings.url)
    if found and settings.format and found != settings.format:
        log.warning("the selected format %s is not the detected %s", settings.format, found)
    return control.reconcile_format(settings.format, found)


def job_pages(spark: SparkSession, jobs: list[control.Settings], decoder: str | None = None) -> DataFrame:
    """(job, report, format, doc_id, page_idx, xml) of the reports of all jobs, decoded by tasks."""
    documents = [page_source.Document(str(k), j.pdf, j.url, j.save_pdf) for k, j in enumerate(jobs)]
    rows = [(str(k), j.prefix_out, chosen_format(j)) for k, j in enumerate(jobs)]
    listed = spark.createDataFrame(rows, "doc_id string, report string, format string")
    return page_source.read_documents(spark, documents, decoder).join(listed, "doc_id").withColumn("job", F.col("doc_id"))


def run(spark: SparkSession, settings: control.Settings, decoder: str | None = None) -> None:
    """One report, or all jobs of a batch, to its output: one plan, whose rows are counted as they are written."""
    from ledgerleaf.sources import sinks

    jobs = [j.validated() for j in (control.batch_jobs(settings.batch, settings) if settings.batch else [settings])]
    log.debug("settings: %s", settings.described())
    names = [sinks.file_name(chosen_format(j), j.prefix_out) for j in jobs]
    pages = job_pages(spark, jobs, decoder)
    rows = all_rows_of(pages, control.target_list(control.targets(spark)), keep=["job", "report"])
    # the counts are taken above the sort, below which rows are read once more to find its ranges
    rows = rows.orderBy(F.col("job").cast("int"), "page_idx", "ord")
    rows, seen = holdings.observed(rows, {f"job {k} ({j.pdf or j.url})": F.col("job") == str(k) for k, j in enumerate(jobs)})
    if settings.batch and settings.separate_out:
        last = {name: str(k) for k, name in enumerate(names)}  # of jobs whose files have one name the last one stays
        file = F.when(F.col("job").isin(list(last.values())), F.get(F.array(*[F.lit(n) for n in names]), F.col("job").cast("int")))
        sinks.write_files(holdings.to_table(rows.where(file.isNotNull()), [file.alias(sinks.FILE)]), settings.out, list(last))
    else:
        more = [F.col("format").alias("Format")] if settings.batch else []
        if settings.batch and any(j.prefix_out is not None for j in jobs):
            more.insert(jobs[0].prefix_out is None, F.col("report").alias("Report identifier"))
        sinks.write_one(holdings.to_table(rows, more), settings.out)
    holdings.log_observed(seen, log)


def main(argv: list[str] | None = None) -> None:
    settings = control.configure(argv)
    logging.basicConfig(level=settings.log_level())
    run(SparkSession.builder.appName("ledgerleaf").getOrCreate(), settings)


if __name__ == "__main__":
    main()
