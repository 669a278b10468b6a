"""Operators over the lines of pages: (doc_id, page_idx, ord, box, font, size, fonts, text, content)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.geometry import Range, is_contained, is_inside

PAGE = ["doc_id", "page_idx"]


def has_font(font: str) -> Column:
    """Any part of the line is set in the font, not only the first."""
    return F.array_contains("fonts", font)


def with_text_and_font(text: str, font: str) -> Column:
    return F.col("text").contains(text) & has_font(font)


def lines_with_font(lines: DataFrame, font: str) -> DataFrame:
    return lines.where(has_font(font))


def lines_with_text_and_font(lines: DataFrame, text: str, font: str, first: bool = False) -> DataFrame:
    """All lines that hold the text and the font, or the first of each page."""
    found = lines.where(with_text_and_font(text, font))
    return first_of_page(found) if first else found


def kinds_of(lines: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """lines with `kind`, a row for each of the named conditions that a line meets: the lines are read once for all of them."""
    met = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()]))
    return lines.withColumn("kind", F.explode(met))


def first_of_page(lines: DataFrame) -> DataFrame:
    one = lines.groupBy(*PAGE).agg(F.min_by(F.struct(*lines.columns), "ord").alias("first"))
    return one.select("first.*")


def page_gate(lines: DataFrame, qualifies: Column) -> DataFrame:
    """The lines of pages that have a qualifying line."""
    return lines.withColumn("_gate", F.max(qualifies).over(Window.partitionBy(*PAGE))).where("_gate").drop("_gate")


def select_inside(lines: DataFrame, x: Range = (None, None), y: Range = (None, None)) -> DataFrame:
    return lines.where(is_inside(F.col("box"), x, y))


def select_outside(lines: DataFrame, x: Range = (None, None), y: Range = (None, None)) -> DataFrame:
    return lines.where(~is_inside(F.col("box"), x, y))


def lines_contained(lines: DataFrame, x: Range = (None, None), y: Range = (None, None)) -> DataFrame:
    return lines.where(is_contained(F.col("box"), x, y))


def deselect(lines: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Without the lines whose text and first font are exactly one of the pairs."""
    if not pairs:
        return lines
    # the pairs are part of a format's specification, a handful
    gone = lines.sparkSession.createDataFrame(list(pairs), "text string, font string")
    return lines.join(F.broadcast(gone), ["text", "font"], "left_anti").select(*lines.columns)


def first_value_where(value: Column, condition: Column) -> Column:
    """Over a page: the value of its first line that meets the condition."""
    return F.min_by(F.when(condition, value), F.when(condition, F.col("ord"))).over(Window.partitionBy(*PAGE))
