"""Holdings from ordered blocks: merge of neighbours that are one cell, target match, fields at relative offsets.

blocks: (doc_id, page_idx, ord, table_col, content, ...). Going through a document's blocks in order, a block is merged
with the next one where both are in one table column and the two together name a target; the next one is then gone.
In a run of such blocks every other one merges, so the walk is a matter of parity and of windows over the document.

A field at an offset is the content so many blocks further: blocks further on are not merged yet when a block is
visited, blocks before it are. An offset beyond the document gives null and `out_of_range`. Offsets are data, a map of
fields in each row: a window gives each block the contents around it, as far as the farthest offset, and the fields
are taken from these.

Targets are found by expressions where they are few (with a Python function for those that must be alike as well), else
by the candidate joins of `operators.matching`, each different text once.

A document is one window partition, as its blocks form one sequence.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.functions.matching import Likeness, Match, alike_by, target_match
from ledgerleaf.functions.scalars import bind, instrument_of, interest_rate, maturity, normalize_string
from ledgerleaf.operators.matching import SHORT_LIST, beginning_size, matches

#: The raw fields of a holding.
FIELDS = ("quantity", "market_value", "net_assets", "currency", "acquisition_cost")


@dataclass(frozen=True)
class Positions:
    """Offsets of a holding's fields from its name; currency is an offset, a code, or None."""

    quantity: int
    market_value: int
    net_assets: int
    currency: int | str | None = None
    acquisition_cost: int | None = None

    def __post_init__(self) -> None:
        own = (self.quantity, self.market_value, self.net_assets)
        if 0 in own:
            raise ValueError("all positions must be non-zero")
        if len(set(own)) < 3:
            raise ValueError("all positions must be different")

    def offsets(self) -> dict[str, int]:
        out = {"quantity": self.quantity, "market_value": self.market_value, "net_assets": self.net_assets}
        if isinstance(self.currency, int):
            out["currency"] = self.currency
        if self.acquisition_cost is not None:
            out["acquisition_cost"] = self.acquisition_cost
        return out


@dataclass(frozen=True)
class Walk:
    """How blocks are put in order and matched: by a likeness, or by any predicate of a text and a target."""

    key: Sequence[str] = ("doc_id",)
    order: Sequence[str] = ("page_idx", "ord")
    match: Match | Likeness = field(default=target_match)

    def window(self):
        return Window.partitionBy(*self.key).orderBy(*self.order)


def target_table(spark: SparkSession, targets: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(targets)), "ord int, target string")


def targets_in(text: Column, targets: Sequence[str], match: Match = target_match) -> Column:
    """The targets that match, in order; an empty array for none. Contained ones are sought in a text that is normalised once."""
    usable = [t for t in targets if t.strip()]
    if not usable:
        return F.array().cast("array<string>")
    if match is not target_match:
        return F.array_compact(F.array(*[F.when(match(text, F.lit(t)), F.lit(t)) for t in usable]))
    pairs = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(" ".join(t.lower().split())).alias("norm")) for t in usable])
    return bind(normalize_string(text), lambda norm: F.transform(F.filter(pairs, lambda t: norm.contains(t["norm"])), lambda t: t["target"]))


def listed_targets(rows: DataFrame, targets: Sequence[str], kinds: Collection[Likeness]) -> DataFrame:
    """rows (with _joint, _own, _prefix and _ratio) with the targets of both texts, for a short list: without a join.

    What the text contains, or begins with, is told by an expression; a Python function sees only texts with candidates
    that still must be alike, and compares each different pair of a batch once.
    """
    usable = [(i, t, " ".join(t.lower().split())) for i, t in enumerate(targets) if t.strip()]
    none = F.array().cast("array<struct<ord:int,target:string,norm:string>>")
    pairs = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(t).alias("target"), F.lit(n).alias("norm")) for i, t, n in usable]) if usable else none
    prefix, ratio = F.col("_prefix"), F.col("_ratio")

    def candidates(norm: Column) -> Column:
        def begins(t: Column) -> Column:
            size = beginning_size(t["norm"], prefix)
            return prefix.isNull() | (F.left(norm, size) == F.left(t["norm"], size))

        could = lambda t: ratio.isNull() | (2 * F.least(F.length(norm), F.length(t["norm"])) >= ratio * (F.length(norm) + F.length(t["norm"])) - 1e-9)
        liked = F.filter(pairs, lambda t: begins(t) & could(t))
        return F.when(prefix.isNull() & ratio.isNull(), F.filter(pairs, lambda t: norm.contains(t["norm"]))).otherwise(liked)

    rows = rows.withColumn("_norm", normalize_string(F.coalesce("_joint", "_own")))
    rows = rows.withColumn("_found", F.when(F.col("_norm").isNotNull(), bind(F.col("_norm"), candidates)))
    if any(k.ratio is not None for k in kinds):
        # null where nothing is left to be compared
        asked = ratio.isNotNull() & (F.size("_found") > 0)
        alike = alike_by(F.when(asked, F.col("_norm")), F.when(asked, F.transform("_found", lambda t: t["norm"])), F.when(asked, ratio))
        rows = rows.withColumn("_alike", alike)
        rows = rows.withColumn("_found", F.when(asked, F.filter("_found", lambda t: F.array_contains("_alike", t["norm"]))).otherwise(F.col("_found"))).drop("_alike")
    names = F.transform("_found", lambda t: t["target"])
    return rows.withColumns({f"_{x}_targets": F.when(F.col(f"_{x}").isNotNull(), names) for x in ("joint", "own")}).drop("_norm", "_found")


def with_neighbours(blocks: DataFrame, walk: Walk) -> DataFrame:
    """blocks with _rn, last, _joint (the content with the next one's, where both are in one column) and _own (the content where they aren't)."""
    w = walk.window()
    rows = blocks.withColumns({"_next": F.lead("content").over(w), "_next_col": F.lead("table_col").over(w), "_rn": F.row_number().over(w), "last": F.lead(F.lit(1)).over(w).isNull()})
    together = ~F.col("last") & F.col("table_col").eqNullSafe(F.col("_next_col")) & F.col("table_col").isNotNull()
    return rows.withColumns({"_joint": F.when(together, F.concat("content", "_next")), "_own": F.when(~together, F.col("content"))}).drop("_next", "_next_col")


def merged_rows(rows: DataFrame, walk: Walk) -> DataFrame:
    """From rows with _joint_targets and _own_targets: merged, popped, companies, and the contents as they are visited."""
    w = walk.window()
    candidate = F.coalesce(F.size("_joint_targets") > 0, F.lit(False))
    # the place in a run of candidates: since the last row that isn't one
    rows = rows.withColumn("_candidate", candidate).withColumn("_stop", F.max(F.when(~candidate, F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("merged", F.col("_candidate") & ((F.col("_rn") - F.coalesce("_stop", F.lit(0))) % 2 == 1))
    rows = rows.withColumn("popped", F.coalesce(F.lag("merged").over(w), F.lit(False)))
    none = F.array().cast("array<string>")
    # the last block of a document gives a row for each of its targets, others for the first
    companies = F.when(F.col("merged"), F.slice("_joint_targets", 1, 1)).when(F.col("popped"), none).when(F.col("last"), F.coalesce("_own_targets", none)).otherwise(F.coalesce(F.slice("_own_targets", 1, 1), none))
    content = F.when(F.col("merged"), F.col("_joint")).otherwise(F.col("content"))
    return rows.withColumns({"companies": companies, "raw_content": F.col("content"), "content": content}).drop("_joint_targets", "_own_targets", "_candidate", "_stop", "_joint", "_own")


def merge_adjacent(blocks: DataFrame, targets: Sequence[str], walk: Walk = Walk()) -> DataFrame:
    """blocks with merged, popped, last, companies (the targets that a row stands for) and content as it is visited.

    Rows that were merged away stay, marked popped, as offsets still count over them.
    """
    rows = with_neighbours(blocks, walk)
    by_likeness = isinstance(walk.match, Likeness)
    if by_likeness or (walk.match is target_match and len(targets) > SHORT_LIST):
        likeness = walk.match if by_likeness else Likeness()
        columns = {"_prefix": F.lit(likeness.prefix).cast("double"), "_ratio": F.lit(likeness.ratio).cast("double")}
        rows = joined_targets(rows.withColumns(columns), target_table(blocks.sparkSession, targets), {likeness}).drop(*columns)
    else:
        rows = rows.withColumns({"_joint_targets": F.when(F.col("_joint").isNotNull(), targets_in(F.col("_joint"), targets, walk.match)), "_own_targets": F.when(F.col("_own").isNotNull(), targets_in(F.col("_own"), targets, walk.match))})
    return merged_rows(rows, walk)


def joined_targets(rows: DataFrame, targets: DataFrame, kinds: Collection[Likeness]) -> DataFrame:
    """rows (with _joint, _own, _prefix and _ratio) with the targets of both texts, found once for each different text."""
    rows = rows.withColumns({"_joint_norm": normalize_string(F.col("_joint")), "_own_norm": normalize_string(F.col("_own"))})
    # a block has one of the two texts
    texts = rows.select(F.coalesce("_joint_norm", "_own_norm").alias("norm"), F.col("_prefix").alias("prefix"), F.col("_ratio").alias("ratio")).where("norm IS NOT NULL").distinct()
    found = matches(texts, targets, kinds).groupBy("norm", "prefix", "ratio").agg(F.transform(F.array_sort(F.collect_list(F.struct("target_ord", "target"))), lambda t: t["target"]).alias("_found"))
    found = found.withColumnsRenamed({"norm": "_norm", "prefix": "_found_prefix", "ratio": "_found_ratio"})
    same = (F.coalesce("_joint_norm", "_own_norm") == F.col("_norm")) & F.col("_prefix").eqNullSafe(F.col("_found_prefix")) & F.col("_ratio").eqNullSafe(F.col("_found_ratio"))
    rows = rows.join(found, same, "left")
    rows = rows.withColumns({"_joint_targets": F.when(F.col("_joint").isNotNull(), F.col("_found")), "_own_targets": F.when(F.col("_own").isNotNull(), F.col("_found"))})
    return rows.drop("_joint_norm", "_own_norm", "_norm", "_found", "_found_prefix", "_found_ratio")


def with_fields(rows: DataFrame, offsets: Column, reach: tuple[int, int], walk: Walk) -> DataFrame:
    """The rows that a walk visits with raw_<field> for FIELDS at their offsets (a map) and out_of_range. reach: the farthest offsets back and on."""
    w = walk.window()
    back, on = reach
    rows = rows.withColumn("_ahead", F.collect_list(F.struct("raw_content")).over(w.rowsBetween(1, on + 1))).where(~F.col("popped"))
    rows = rows.withColumn("_behind", F.collect_list(F.struct("content")).over(w.rowsBetween(-max(back, 1), -1))).where(F.size("companies") > 0)

    def at(name: str) -> Column:
        n = F.try_element_at(offsets, F.lit(name))
        ahead = F.get("_ahead", n - 1 + F.when(F.col("merged"), 1).otherwise(0))["raw_content"]
        return F.when(n > 0, ahead).when(n < 0, F.get("_behind", F.size("_behind") + n)["content"])

    wanted = [F.try_element_at(offsets, F.lit(name)).isNotNull() & F.col(f"raw_{name}").isNull() for name in FIELDS]
    rows = rows.withColumns({f"raw_{name}": at(name) for name in FIELDS})
    return rows.withColumn("out_of_range", F.greatest(F.lit(False), *wanted)).drop("_ahead", "_behind")


def read_names(rows: DataFrame) -> DataFrame:
    """A row for each company of a block, with what the name says: interest rate, maturity, instrument, the type of block."""
    rows = rows.withColumn("company", F.explode("companies"))
    rows = rows.withColumns({"raw_interest_rate": interest_rate(F.col("content")), "raw_maturity": maturity(F.col("content"))})
    rows = rows.withColumn("instrument", instrument_of(F.col("raw_interest_rate"), F.col("raw_maturity")))
    return rows.withColumn("block_type", F.concat("instrument", F.lit("_TARGET"))).drop("merged", "popped", "last", "_rn", "raw_content", "companies")


def extract_holdings(blocks: DataFrame, targets: Sequence[str], positions: Positions, walk: Walk = Walk()) -> DataFrame:
    """One row for each block that names a target: company, instrument, raw fields, out_of_range; the last block of a document gives one for each target."""
    own = positions.offsets()
    offsets = F.create_map(*[x for k, n in own.items() for x in (F.lit(k), F.lit(n))])
    rows = with_fields(merge_adjacent(blocks, targets, walk), offsets, reach_of([own]), walk)
    if isinstance(positions.currency, str):
        rows = rows.withColumn("raw_currency", F.lit(positions.currency))
    return read_names(rows)


def reach_of(offsets: Collection[dict[str, int]]) -> tuple[int, int]:
    """The farthest offsets back and on."""
    every = [n for x in offsets for n in x.values()]
    return max([0, *[-n for n in every]]), max([0, *every])
