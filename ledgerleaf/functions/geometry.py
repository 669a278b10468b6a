"""Ranges, areas and positions as columns. A range is (start, end), a null side is open, both ends belong to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf.functions.scalars import bind

Range = tuple[float | Column | None, float | Column | None]


def _side(x: float | Column | None) -> Column | None:
    return x if x is None or isinstance(x, Column) else F.lit(float(x))


def in_range(value: Column, bounds: Range) -> Column:
    start, end = (_side(x) for x in bounds)
    out = F.lit(True)
    if start is not None:
        out = out & (start.isNull() | (start <= value))
    if end is not None:
        out = out & (end.isNull() | (value <= end))
    return out


def range_struct(start: float | None, end: float | None) -> Column:
    if start is not None and end is not None and start > end:
        raise ValueError("a range must not end before it starts")
    return F.struct(F.lit(start).cast("double").alias("start"), F.lit(end).cast("double").alias("end"))


def range_size(r: Column) -> Column:
    """Null for a range with an open side."""
    return r["end"] - r["start"]


def range_text(r: Column) -> Column:
    show = lambda x: F.coalesce(x.cast("string"), F.lit("-"))
    return F.format_string("[%s:%s]", show(r["start"]), show(r["end"]))


def bounds(bbox: Column) -> Column:
    """(x0, y0, x1, y1) of the four numbers in a bbox attribute; null if it has not four."""


    def of(part: Column) -> Column:
        number = [F.get(part, F.lit(i)).try_cast("double") for i in range(4)]
        return F.when(F.size(part) == 4, F.struct(*[n.alias(k) for n, k in zip(number, ("x0", "y0", "x1", "y1"), strict=True)]))

    return bind(F.split(F.trim(bbox), r"\s+"), of)


def centre(b: Column) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"))


def corners(b: Column) -> Column:
    return F.array(*[F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x0", "y1"), ("x1", "y1"))])


def position(b: Column, mean: bool = True) -> Column:
    return centre(b) if mean else corners(b)


def size(b: Column) -> Column:
    return F.struct((b["x1"] - b["x0"]).alias("width"), (b["y1"] - b["y0"]).alias("height"))


def area_text(b: Column) -> Column:
    return F.format_string("(%s,%s)-(%s,%s)", b["x0"], b["y0"], b["x1"], b["y1"])


def is_contained(b: Column, x: Range, y: Range) -> Column:
    """The whole box lies in both ranges."""
    return in_range(b["x0"], x) & in_range(b["x1"], x) & in_range(b["y0"], y) & in_range(b["y1"], y)


def is_positioned(b: Column, x: tuple[float, float], y: tuple[float, float]) -> Column:
    """The centre lies in both ranges, whose sides must all be given."""
    if None in (*x, *y):
        raise ValueError("all sides of both ranges are needed")
    c = centre(b)
    return in_range(c["x"], x) & in_range(c["y"], y)


def is_inside(b: Column, x: Range = (None, None), y: Range = (None, None)) -> Column:
    """The centre lies in both ranges."""
    c = centre(b)
    return in_range(c["x"], x) & in_range(c["y"], y)
