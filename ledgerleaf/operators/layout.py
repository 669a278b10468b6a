"""Table columns from geometry: greedy one-dimensional clustering, as a fold over each page's lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators.lines import PAGE


def rulers(spans: Column, small_rule: bool = True, use_ruler_pos: bool = True) -> Column:
    """The rulers of an array of (lo, hi, ord), as (at, lo, hi) in the order of their creation.

    The narrowest line (widest without small_rule) that belongs to no ruler yet makes one, of its own centre; a line
    belongs to a ruler whose centre lies within the line, or (without use_ruler_pos) whose bounds hold its own centre.
    Going through the lines by width and making a ruler of each that belongs to none comes to the same.
    """
    width = lambda s: s["hi"] - s["lo"] if small_rule else s["lo"] - s["hi"]
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(width(s).alias("w"), s["ord"].alias("ord"), s["lo"].alias("lo"), s["hi"].alias("hi"))))
    none = F.array().cast("array<struct<at:double,lo:double,hi:double>>")

    def step(made: Column, s: Column) -> Column:
        new = F.struct(((s["lo"] + s["hi"]) / 2).alias("at"), s["lo"].alias("lo"), s["hi"].alias("hi"))
        return F.when(F.exists(made, lambda r: belongs(s["lo"], s["hi"], r, use_ruler_pos)), made).otherwise(F.array_append(made, new))

    return F.aggregate(ordered, none, step)


def belongs(lo: Column, hi: Column, ruler: Column, use_ruler_pos: bool) -> Column:
    if use_ruler_pos:
        return (lo <= ruler["at"]) & (ruler["at"] <= hi)
    return (ruler["lo"] <= (lo + hi) / 2) & ((lo + hi) / 2 <= ruler["hi"])


def table_positions(lines: DataFrame, return_columns: bool = True, small_rule: bool = True, use_ruler_pos: bool = True, output: str = "table_col") -> DataFrame:
    """lines with the number of the column (or row) of its page that each is in, from 0 by position.

    A page's rulers are one aggregate, joined back: the size of a page bounds both.
    """
    lo, hi = (F.col("box.x0"), F.col("box.x1")) if return_columns else (F.col("box.y0"), F.col("box.y1"))
    spans = lines.groupBy(*PAGE).agg(F.collect_list(F.struct(lo.alias("lo"), hi.alias("hi"), F.col("ord").alias("ord"))).alias("spans"))
    made = spans.select(*PAGE, rulers(F.col("spans"), small_rule, use_ruler_pos).alias("_rulers"))
    joined = lines.join(made, PAGE)
    first = F.get(F.filter("_rulers", lambda r: belongs(lo, hi, r, use_ruler_pos)), F.lit(0))
    place = (F.array_position(F.array_sort(F.transform("_rulers", lambda r: r["at"])), first["at"]) - 1).cast("int")
    return joined.withColumn(output, place).drop("_rulers")
