"""Ranking with ties inside groups by distributed multi-select: the first places of every group, no group in one task.

A row's pair is two whole numbers, each in its own direction, nulls last. Pairs are encoded as one number, in order, over
the ranges that the numbers have in the input. One aggregation counts the rows of each group and pair. Then the code of
the pair at place `top` is searched by bisection for all groups at once: a pass counts, in every group, the pairs up to
the middle of the group's interval, and halves the interval. Where there are more codes than `CELLS`, the bisection
first goes over counts of `CELLS` equal ranges of codes, level by level, so that no window holds more than those and
`top` rows. The codes at the end cut the rows down to those with a place of at most `top`; these are sorted by ranges
over all tasks and numbered within a task, and what earlier tasks hold of the same group and pair is added.

What grows with the input is only shuffled: to the driver go four numbers, the ranges, and what Spark samples to deal by
ranges (a hundred keys a partition), and a task holds a range. The cut comes back to the rows in a join by group and pair.

Defined cases: a null key is a value of its own; null parts of a pair come last and are equal to each other; nulls in
the order columns come last; rows equal in all order columns get different positions; fewer than `top` pairs keep the
whole group; an empty table gives an empty table; other columns are kept, also those with the names used here; texts are
not read. The rows must be read from a table, whose rows keep their places when a task runs again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerleaf.llm.common import fresh, shuffle_partitions, written

#: So many ranges of codes of a group are counted at once.
CELLS = 4096
#: Up to so many codes they are long integers, beyond it decimals.
LONG_CODES = 1 << 62
MOST_CODES = 10**37
SALTS = 16


class Encoding:
    """Pairs as one number each, in order, given the least and the largest of either part (None without values)."""

    def __init__(self, pair: Sequence[tuple[str, bool]], ranges: Sequence[tuple[int | None, int | None]]) -> None:
        self.pair, self.ranges = pair, [(low or 0, high or 0) for low, high in ranges]
        spans = [high - low + 2 for low, high in self.ranges]
        self.codes = spans[0] * spans[1]
        if self.codes > MOST_CODES:
            raise ValueError("the ranges of a pair's parts are too wide together")
        self.kind = "long" if self.codes <= LONG_CODES else "decimal(38,0)"
        self.second = spans[1]
        first, second = (self._part(k) for k in (0, 1))
        self.code = (first * self.number(self.second) + second).cast(self.kind)

    def number(self, n: int) -> Column:
        return F.lit(str(n)).cast(self.kind)

    def _part(self, k: int) -> Column:
        (name, descending), (low, high) = self.pair[k], self.ranges[k]
        value = F.col(f"`{name}`").cast(self.kind)
        return F.coalesce(self.number(high) - value if descending else value - self.number(low), self.number(high - low + 1))

    def decoded(self, code: Column, k: int, kind: DataType) -> Column:
        """Part k of the pair with this code."""
        (_, descending), (low, high) = self.pair[k], self.ranges[k]
        rest = code % self.number(self.second)
        n = rest if k else F.call_function("div", code - rest, self.number(self.second)).cast(self.kind)
        value = self.number(high) - n if descending else n + self.number(low)
        return F.when(n <= self.number(high - low), value).cast(kind)


def bisected(counts: DataFrame, keys: Sequence[str], top: int, cells: int) -> DataFrame:
    """counts (keys, cell, pairs) with chosen: the first cell up to which the group has `top` pairs, the last where it never has."""
    group = Window.partitionBy(*keys)
    out = counts.withColumns({"low": F.lit(0), "high": F.lit(cells - 1)})
    for _ in range((cells - 1).bit_length()):
        out = out.withColumn("middle", F.shiftright(F.col("low") + F.col("high"), 1))
        enough = F.sum(F.when(F.col("cell") <= F.col("middle"), F.col("pairs")).otherwise(0)).over(group) >= top
        out = out.withColumn("enough", enough)
        out = out.withColumns({"low": F.when(F.col("enough"), F.col("low")).otherwise(F.least(F.col("middle") + 1, "high")), "high": F.when(F.col("enough"), F.col("middle")).otherwise(F.col("high"))})
    return out.withColumn("chosen", F.col("low")).drop("low", "high", "middle", "enough")


def first_places(pairs: DataFrame, keys: Sequence[str], top: int, encoding: Encoding) -> DataFrame:
    """Of pairs (keys, code, tied): those at a place of at most `top`, with place and with ahead, the rows in earlier places of the group."""
    base, width = encoding.number(0), -(-encoding.codes // CELLS)
    rows = pairs.withColumn("base", base)
    while width > 1:
        place = F.when(F.col("code") < F.col("base"), F.lit(-1)).otherwise(F.call_function("div", F.col("code") - F.col("base"), encoding.number(width)))
        cells = rows.withColumn("cell", place.cast("int"))
        chosen = bisected(cells.groupBy(*keys, "base", "cell").agg(F.count(F.lit(1)).alias("pairs")), keys, top, CELLS).groupBy(*keys, "base").agg(F.max("chosen").alias("chosen"))
        start = (F.col("base") + F.col("chosen").cast(encoding.kind) * encoding.number(width)).cast(encoding.kind)
        salted = chosen.select(*keys, start.alias("base"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        rows = rows.drop("base").withColumn("salt", F.pmod(F.xxhash64("code"), F.lit(SALTS)).cast("int")).join(salted, [*keys, "salt"])
        rows = written(rows.where(F.col("code") < F.col("base") + encoding.number(width)).drop("salt"), "rank-cells")
        width = -(-width // CELLS)
    cells = rows.withColumns({"cell": F.greatest(F.col("code") - F.col("base"), encoding.number(-1)).cast("int"), "pairs": F.lit(1)})
    kept = bisected(cells, keys, top, min(CELLS, encoding.codes)).where("cell <= chosen")
    order = Window.partitionBy(*keys).orderBy("code")
    return kept.select(*keys, "code", "tied", F.row_number().over(order).alias("place"), (F.sum("tied").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tied")).alias("ahead"))


def numbered(kept: DataFrame, same: Sequence[str], order: Sequence[Column], partitions: int, names: Sequence[str]) -> DataFrame:
    """kept with its rows' numbers, from 1, among rows that agree in `same`, in the given order. names: of the number, a task, a count."""
    number, task, count = names
    ranges = kept.repartitionByRange(partitions, *[F.col(f"`{k}`") for k in same], *order).withColumn(task, F.spark_partition_id())
    dealt = written(ranges, "rank-ranges")
    here = [*same, task]
    sums = dealt.groupBy(*here).agg(F.count(F.lit(1)).alias(count))
    earlier = F.sum(count).over(Window.partitionBy(*same).orderBy(task)) - F.col(count)
    local = dealt.withColumn(number, F.row_number().over(Window.partitionBy(*here).orderBy(*order)))
    out = local.join(sums.select(*here, earlier.alias(count)), here)
    return out.withColumn(number, F.col(number) + F.col(count)).drop(task, count)


def ranked(lines: DataFrame, keys: Sequence[str], pair: Sequence[tuple[str, bool]], order: Sequence[str], top: int) -> DataFrame:
    """The lines at a place of at most `top` in their group, with pos, place and tied (lines of the group with the same pair).

    keys and both parts of the pair (name, whether larger ones come first) are whole numbers, keys of any type.
    """
    (a, _), (b, _) = pair
    code, row, nulls, number, task, count = fresh(lines, "code", "row", "nulls", "number", "task", "count")
    own = fresh(lines, *["key"] * len(keys))
    own = [f"{x}_{k}" for k, x in enumerate(own)]
    ends = lines.agg(F.min(f"`{a}`"), F.max(f"`{a}`"), F.min(f"`{b}`"), F.max(f"`{b}`")).first()
    encoding = Encoding(pair, [ends[:2], ends[2:]])
    # keys without nulls, and which of them are null as one number; the code says the pair: neither is shuffled twice
    null_keys = reduce(lambda x, y: x + y, [F.when(F.col(f"`{k}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(keys)])
    zeros = {name: F.coalesce(F.col(f"`{k}`"), F.lit(0).cast(lines.schema[k].dataType)) for name, k in zip(own, keys, strict=True)}
    coded = lines.withColumns(zeros | {nulls: null_keys, code: encoding.code})
    group = [nulls, *own]
    pairs = coded.select(*group, F.col(code).alias("code")).groupBy(*group, "code").agg(F.count(F.lit(1)).alias("tied"))
    pairs = written(pairs, "rank-pairs") if encoding.codes > CELLS else pairs
    places = first_places(pairs, group, top, encoding).withColumnRenamed("code", code)
    renamed = dict(zip(["tied", "place", "ahead"], fresh(lines, "tied", "place", "ahead"), strict=True))
    kept = coded.drop(*[c for c in (*keys, a, b) if c not in order]).withColumn(row, F.monotonically_increasing_id()).join(places.withColumnsRenamed(renamed), [*group, code])
    by = [F.col(f"`{c}`").asc_nulls_last() for c in order] + [F.col(row).asc()]
    out = numbered(kept, [*group, code], by, shuffle_partitions(lines.sparkSession), [number, task, count])
    pos = F.col(renamed["ahead"]) + F.col(number)
    back = {k: F.when(F.col(nulls).bitwiseAND(1 << i) == 0, F.col(name)) for i, (k, name) in enumerate(zip(keys, own, strict=True))}
    back |= {x: encoding.decoded(F.col(code), i, lines.schema[x].dataType) for i, x in enumerate((a, b))}
    held = [F.col(f"`{c}`") if c in order else back.get(c, F.col(f"`{c}`")).alias(c) for c in lines.columns if c not in ("pos", "place", "tied")]
    return out.select(*held, pos.cast("long").alias("pos"), F.col(renamed["place"]).cast("long").alias("place"), F.col(renamed["tied"]).cast("long").alias("tied"))
