"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

A document's size is its number of words. Sources, by code point and null last, take turns at the given weights and
share `share` of all words; a source's target stops at `limit` times its own words, and what is over goes to the
others by weight until none is above. A source is taken whole `target // size` times; of the rest, each document has a
place, a hash of its id and text, and the places below a threshold give their documents once more. As all budgets of a
source cut the same order, a smaller mix is part of every larger one.

The threshold is found without a sort of documents: words are summed by source and the first bits of the place, the
bucket that the budget ends in is summed by further bits, and so on (`LEVELS`); what is then left is a few places,
which are added up one by one. The document at the threshold is taken if that brings the source nearer to its target.
A source that holds a third of all rows is at most 2^14 sums a task and level, and the last join is salted.

Defined cases: a null text is the empty text, whose size is 0, and such documents take nothing; a null source is a
source of its own; rows that agree in id and text share a place, and as many of them are taken as come nearest to
the target; sources without words have the target 0; an empty table gives an empty table; a very long text counts
whole, and where one is at the threshold its source can miss the target by half its size; other columns are kept by
`apply_mix` and not read by `mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import fresh, select_required, shuffle_partitions, written
from ledgerleaf.llm.line_rules import n_words_of

WEIGHTS = (1, 2, 3)
LIMIT = 3
#: Bits of a place that one histogram divides by, first to last; a place has 60.
LEVELS = (14, 14)
PLACE_BITS = 60
SALTS = 32
KEEP = ["doc_id", "text", "source"]


def place_of(doc_id: Column, text: Column) -> Column:
    """60 bits of a hash that SQL engines share; Spark's own hashes are Spark's alone."""
    said = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text)
    return F.conv(F.substring(F.md5(F.encode(said, "utf-8")), 1, PLACE_BITS // 4), 16, 10).cast("long")


def numbered(docs: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """The given columns with key (of the source, in order of the sources), size, place and row, a number of its own; written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.concat(F.lit("a"), F.col("source")), F.lit("b"))
    return written(docs.select(*columns, key.alias("key"), n_words_of(text).cast("long").alias("size"), place_of(F.col("doc_id"), text).alias("place"), F.monotonically_increasing_id().alias("row")), "mix-rows")


def ranked(sources: DataFrame) -> DataFrame:
    """sources (key, ...) with rank, from 0 in order of key: dealt by ranges, so that no task sees all of them."""
    dealt = written(sources.repartitionByRange(shuffle_partitions(sources.sparkSession), "key").withColumn("part", F.spark_partition_id()), "mix-sources")
    first = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    first = first.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))  # one row a partition
    inside = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    return dealt.withColumn("inside", inside).join(first, "part").select(*sources.columns, (F.col("first") + F.col("inside")).alias("rank"))


def targets(rows: DataFrame, weights: Sequence[float], limit: float, share: float) -> DataFrame:
    """(key, source_size, target) of each source; the level that all uncapped sources share is found in rounds of two sums."""
    sizes = ranked(rows.groupBy("key").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    sources = written(sizes.select("key", "source_size", weight.alias("weight")), "mix-targets")
    most = limit * F.col("source_size")
    words, weigh = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    words = (words or 0) * share
    left, among, before = words, weigh or 0.0, None
    while among:
        own = F.lit(float(left)) * F.col("weight") / F.lit(float(among))
        n, taken, weigh = sources.agg(F.count(F.when(most <= own, 1)), F.sum(F.when(most <= own, most)), F.sum(F.when(most > own, F.col("weight")))).first()
        if n == before:
            break
        left, among, before = words - (taken or 0), weigh or 0.0, n
    own = F.lit(float(left)) * F.col("weight") / F.lit(float(among or 1))
    target = F.when(most <= own, most).otherwise(own) if among else most
    return sources.select("key", "source_size", target.cast("double").alias("target"))


def bits(level: int) -> Column:
    """The bits of a place that the histogram of this level divides by."""
    below = PLACE_BITS - sum(LEVELS[: level + 1])
    return F.shiftright("place", below).bitwiseAND((1 << LEVELS[level]) - 1).cast("int")


def crossing(sums: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of sums (keys, order, rest, before, words): the one row of each key that the budget `rest` ends in, with what stands before it."""
    earlier = F.sum("words").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = sums.withColumn("before", F.col("before") + F.coalesce(earlier, F.lit(0)))
    return placed.where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words")))


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(key, cut_place, cut_size, cut_row) of each source whose target isn't a multiple of its size: the last row taken once more."""
    whole = F.floor(F.col("target") / F.col("source_size"))
    cells = sources.where("source_size > 0").select("key", (F.col("target") - whole * F.col("source_size")).alias("rest"), F.lit(0).cast("long").alias("before")).where("rest > 0")
    keys = ["key"]
    for level in range(len(LEVELS)):
        bit = f"bits_{level}"
        inside = rows.withColumns({f"bits_{k}": bits(k) for k in range(level + 1)})
        inside = inside.join(cells.select(*keys), keys, "left_semi") if level else inside
        sums = inside.groupBy(*keys, bit).agg(F.sum("size").alias("words"))
        cells = crossing(sums.join(cells, keys), ["key"], [bit]).drop("words")
        keys.append(bit)
    inside = rows.withColumns({f"bits_{k}": bits(k) for k in range(len(LEVELS))}).join(cells, keys)
    each = inside.where("size > 0").groupBy("key", "rest", "before", "place", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("words", F.col("n") * F.col("size"))
    ends = crossing(each, ["key"], ["place", "size"])
    take = F.least(F.floor((F.col("rest") - F.col("before")) / F.col("size") + 0.5), F.col("n"))
    ends = written(ends.select("key", F.col("place").alias("cut_place"), F.col("size").alias("cut_size"), "n", take.alias("take")), "mix-ends")
    # of rows with one place, as many as wanted: counted by the task that wrote them, then within the task that the count ends in
    tied = rows.join(ends.where("take > 0 AND take < n"), (rows["key"] == ends["key"]) & (rows["place"] == ends["cut_place"]) & (rows["size"] == ends["cut_size"])).select(ends["key"], "row", "take", F.shiftright("row", 33).alias("part"))
    parts = tied.groupBy("key", "take", "part").agg(F.count(F.lit(1)).alias("words")).withColumn("before", F.lit(0).cast("long")).withColumnRenamed("take", "rest")
    last = crossing(parts, ["key"], ["part"]).select("key", "part", "rest", "before")
    at = tied.join(last, ["key", "part"]).withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("row"))).where("k = rest - before").select("key", F.col("row").alias("tie_row"))
    row = F.when(F.col("take") == 0, F.lit(-1)).when(F.col("take") == F.col("n"), F.lit((1 << 63) - 1)).otherwise(F.col("tie_row"))
    return ends.join(at, "key", "left").select("key", "cut_place", "cut_size", row.alias("cut_row"))


def decided(rows: DataFrame, weights: Sequence[float], limit: float, share: float) -> DataFrame:
    """rows with source_size, target and times: how often each document is taken."""
    sources = targets(rows, weights, limit, share)
    known = sources.join(thresholds(rows, sources), "key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod("place", F.lit(SALTS)).cast("int"))
    earlier = (F.col("place") < F.col("cut_place")) | ((F.col("place") == F.col("cut_place")) & ((F.col("size") < F.col("cut_size")) | ((F.col("size") == F.col("cut_size")) & (F.col("row") <= F.col("cut_row")))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    times = F.when(F.col("size") > 0, whole + F.when(earlier, 1).otherwise(0)).otherwise(F.lit(0))
    return salted.join(known, ["key", "salt"]).withColumn("times", times.cast("long"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: float = LIMIT, share: float = 1.0) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target (of its source), taken (words, repeats counted)."""
    rows = numbered(select_required(docs, KEEP), [F.col("doc_id")])
    return decided(rows, weights, limit, share).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def apply_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, limit: float = LIMIT, share: float = 1.0) -> DataFrame:
    """The mixed documents: docs' columns, a row for each time that a document is taken. Writes docs once, to number its rows."""
    held, n = fresh(docs, "held", "copy")
    named = docs.select(*[F.col(f"`{c}`") for c in KEEP], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(held))
    out = decided(numbered(named, [F.col(held)]), weights, limit, share).where("times > 0")
    return out.select(held, F.explode(F.sequence(F.lit(1), F.col("times"))).alias(n)).select(f"{held}.*")
