"""A page as one row: gates, anchors, bodies and table columns as functions of the page's array of lines.

The lines are those of `sources.pages.with_lines`. Nothing here needs another row, so there is no exchange and no state,
and the same expressions run on a stream of pages. What a format asks for is a struct column (`plans.formats`), a
constant or a column of the page: pages of different formats go through one plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.scalars import bind
from ledgerleaf.operators.layout import belongs, rulers

PAGE = ["doc_id", "page_idx"]
LINE = ("ord", "box", "font", "size", "fonts", "text", "content")


def has_font(line: Column, font: Column | str) -> Column:
    """Any part of the line is set in the font, not only the first."""
    return F.array_contains(line["fonts"], font)


def holds(line: Column, text: Column | str, font: Column | str) -> Column:
    return line["text"].contains(text) & has_font(line, font)


def middle(line: Column) -> Column:
    return (line["box"]["y0"] + line["box"]["y1"]) / 2


def between(value: Column, start: Column, end: Column) -> Column:
    """A null side is open."""
    return (start.isNull() | (start <= value)) & (end.isNull() | (value <= end))


def some(lines: Column, condition: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(lines, condition), F.lit(False))


def first(lines: Column, condition: Callable[[Column], Column]) -> Column:
    """The first line that meets the condition, null without one."""
    return F.get(F.filter(lines, condition), F.lit(0))


def paged(lines: DataFrame) -> DataFrame:
    """Pages with their array of lines, from a row a line: for lines that come so; it takes an exchange."""
    line = F.struct(*[c for c in LINE if c in lines.columns])
    return lines.groupBy(*PAGE).agg(F.array_sort(F.collect_list(line)).alias("lines"))


def gate_pages(pages: DataFrame, qualifies: Callable[[Column], Column]) -> DataFrame:
    """The pages that have a qualifying line."""
    return pages.where(some(F.col("lines"), qualifies))


def with_columns(lines: Column, return_columns: bool = True, small_rule: bool = True, use_ruler_pos: bool = True) -> Column:
    """The lines as (line, table_col): the number of the table's column (or row) that each is in, from 0 by position."""
    low, high = ("x0", "x1") if return_columns else ("y0", "y1")

    def numbered(x: Column) -> Column:
        spans = F.transform(x, lambda s: F.struct(s["box"][low].alias("lo"), s["box"][high].alias("hi"), s["ord"].alias("ord")))

        def placed(made: Column) -> Column:
            sides = F.array_sort(F.transform(made, lambda r: r["at"]))

            def place(line: Column) -> Column:
                own = F.get(F.filter(made, lambda r: belongs(line["box"][low], line["box"][high], r, use_ruler_pos)), F.lit(0))
                return F.struct(line.alias("line"), (F.array_position(sides, own["at"]) - 1).cast("int").alias("table_col"))

            return F.transform(x, place)

        return bind(rulers(spans, small_rule, use_ruler_pos), placed)

    return bind(lines, numbered)


def edge(lines: Column, bound: Column, side: str) -> Column:
    """A bound (at, text, font): the height, or the side of the first line with the anchor; null where open or missing."""
    return F.coalesce(bound["at"], first(lines, lambda x: holds(x, bound["text"], bound["font"]))["box"][side])


def blocks(lines: Column, spec: Column, missing_subfund: Column | None = None) -> Column:
    """The body of a page as an array of (ord, table_col, content, subfund, metadata). missing_subfund stands for a sub-fund that isn't there."""
    switched = some(lines, lambda x: holds(x, spec["switch"]["text"], spec["switch"]["font"]))
    top, bottom = (F.when(switched, edge(lines, spec[f"switch_{name}"], side)).otherwise(edge(lines, spec[name], side)) for name, side in (("top", "y1"), ("bottom", "y0")))
    subfund = first(lines, lambda x: has_font(x, spec["subfund"]["font"]) & between(middle(x), spec["subfund"]["start"], spec["subfund"]["end"]))["text"]
    fields = F.transform(spec["page_fields"], lambda f: F.struct(f["name"], first(lines, lambda x: has_font(x, f["font"]) & between(middle(x), f["start"], f["end"]))["text"]))
    page = F.struct(top.alias("top"), bottom.alias("bottom"), (subfund if missing_subfund is None else F.coalesce(subfund, missing_subfund)).alias("subfund"), F.map_from_entries(fields).alias("metadata"))

    def of_page(p: Column) -> Column:
        deselected = lambda x: F.exists(spec["deselect"], lambda d: d["text"].eqNullSafe(x["text"]) & d["font"].eqNullSafe(x["font"]))
        body = F.filter(lines, lambda x: has_font(x, spec["body_font"]) & between(middle(x), p["top"], p["bottom"]) & ~deselected(x))
        return F.transform(with_columns(body), lambda b: F.struct(b["line"]["ord"].alias("ord"), b["table_col"].alias("table_col"), b["line"]["content"].alias("content"), p["subfund"].alias("subfund"), p["metadata"].alias("metadata")))

    return bind(page, of_page)


def is_wanted(lines: Column, spec: Column) -> Column:
    """The page has the format's header."""
    return some(lines, lambda x: holds(x, spec["header"]["text"], spec["header"]["font"]))
