"""Typed holdings from raw fields: casts, validation, error modes, the output table and its rendering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from logging import Logger

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerleaf.fixed_values import HOLDINGS_COLUMNS
from ledgerleaf.functions.scalars import perc_to_float, to_currency, to_date, to_float, to_int, to_str

PERMISSIVE, DROPMALFORMED, FAILFAST = "PERMISSIVE", "DROPMALFORMED", "FAILFAST"
#: The types of blocks: what a page gives, and what a walk over blocks makes of them.
RELEVANT_BLOCK, EQUITY_TARGET, BOND_TARGET = "RELEVANT_BLOCK", "EQUITY_TARGET", "BOND_TARGET"
#: What a row that can't be cast becomes in the PERMISSIVE mode.
SENTINEL_PAGE = 9999


def deserialize(rows: DataFrame, cost_and_value_interpret_int: bool | Column = True, quantity_interpret_float: bool | Column = False, canonical_currency: bool = True, page_offset: int = 2) -> DataFrame:
    """rows with typed fields and `error`: the first field that can't be cast, or null. How numbers are read may be a column, of each row's format."""

    def either(flag: bool | Column, yes: Column, no: Column) -> Column:
        return F.when(flag, yes).otherwise(no) if isinstance(flag, Column) else yes if flag else no

    money = lambda c: either(cost_and_value_interpret_int, to_int(c).cast("double"), to_float(c))
    quantity = either(quantity_interpret_float, to_float(F.col("raw_quantity")).cast("bigint"), to_int(F.col("raw_quantity")))
    typed = {
        "quantity": ("raw_quantity", quantity),
        "market_value": ("raw_market_value", money(F.col("raw_market_value"))),
        "net_assets": ("raw_net_assets", perc_to_float(F.col("raw_net_assets"))),
        "currency": ("raw_currency", to_currency(F.col("raw_currency"), canonical_currency)),
        "acquisition_cost": ("raw_acquisition_cost", money(F.col("raw_acquisition_cost"))),
        "interest_rate": ("raw_interest_rate", perc_to_float(F.col("raw_interest_rate"))),
        "maturity": ("raw_maturity", to_date(F.col("raw_maturity"))),
    }
    optional = {"acquisition_cost", "interest_rate", "maturity"}
    rows = rows.withColumns({name: column for name, (_, column) in typed.items()})
    failed = [F.when(F.col(name).isNull() & (F.col(raw).isNotNull() if name in optional else F.lit(True)), F.lit(f"{name} can't be read")) for name, (raw, _) in typed.items()]
    return rows.withColumns({"subfund": to_str(F.col("subfund")), "page": F.col("page_idx") + page_offset, "error": F.coalesce(*failed)})


def dispatch(rows: DataFrame, others: Mapping[str, Mapping[str, Column]] | None = None) -> DataFrame:
    """Typed rows with a block_type, each type read in its own way.

    Equities and bonds stay as they are. others has, by further types, the columns that replace typed ones in their rows
    (`error` too, else theirs is null). A row of no known type, or of none, gets an error, for an error mode to handle.
    """
    others = dict(others or {})
    kind = F.col("block_type")
    replaced = sorted({name for columns in others.values() for name in columns} | {"error"})
    made = {}
    for name in replaced:
        out = F.when(kind.isin(EQUITY_TARGET, BOND_TARGET), F.col(name))
        for tag, columns in others.items():
            out = out.when(kind == tag, columns.get(name, F.lit(None) if name == "error" else F.col(name)))
        unknown = F.concat(F.lit("expected bond or equity blocks, found "), F.coalesce(kind, F.lit("none")))
        made[name] = out.otherwise(unknown if name == "error" else F.col(name))
    return rows.withColumns(made)


def validate(rows: DataFrame, targets: list[str] | None = None) -> DataFrame:
    """error is set where the share of assets isn't in [0, 1], the page isn't positive or the company is no target; warning where a rate isn't in [0, 1]."""
    share, page = F.col("net_assets"), F.col("page")
    wrong = F.when(~share.between(0, 1), "the share of net assets is not in [0, 1]").when(page <= 0, "the page is not positive")
    if targets is not None:
        wrong = wrong.when(~F.col("company").isin(targets), "the company is no target")
    return rows.withColumn("error", F.coalesce(F.col("error"), wrong)).withColumn("warning", F.when(~F.col("interest_rate").between(0, 1), "the interest rate is not in [0, 1]"))


def handle_errors(rows: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    """Rows with an error become sentinels, are dropped, or fail the query."""
    if mode == DROPMALFORMED:
        return rows.where("error IS NULL")
    bad = F.col("error").isNotNull()
    if mode == FAILFAST:
        return rows.withColumn("error", F.when(bad, F.raise_error(F.col("error"))).otherwise(F.col("error"))).where(F.col("error").isNull())
    if mode != PERMISSIVE:
        raise ValueError(f"unknown mode {mode}")
    put = {"page": F.lit(SENTINEL_PAGE), "company": F.col("error"), "instrument": F.lit("EQUITY"), "currency": F.lit("EUR"), "net_assets": F.lit(0.0), "subfund": F.lit(""), "quantity": F.lit(None), "market_value": F.lit(None), "acquisition_cost": F.lit(None), "maturity": F.lit(None), "interest_rate": F.lit(None)}
    return rows.withColumns({name: F.when(bad, value).otherwise(F.col(name)) for name, value in put.items()})


def observed(rows: DataFrame, reports: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """Rows that count themselves while they are used: how many there are, have an error, a warning, or no sub-fund, and the first page with an error.

    reports: conditions, by name, of the reports that are counted one by one beside the whole. No second pass is needed;
    the counts are there once an action has run over all rows. A sort above would read the rows twice and double them:
    sort first.
    """
    counts = []
    for name, held in ({"all": F.lit(True)} | dict(reports or {})).items():
        bad = held & F.col("error").isNotNull()
        counts += [F.count_if(held).alias(f"{name}: rows"), F.count_if(bad).alias(f"{name}: errors"), F.count_if(held & F.col("warning").isNotNull()).alias(f"{name}: warnings")]
        counts += [F.count_if(held & F.col("subfund").isNull()).alias(f"{name}: without sub-fund"), F.min(F.when(bad, F.col("page_idx"))).alias(f"{name}: first page with an error")]
    seen = Observation()
    return rows.observe(seen, *counts), seen


def log_observed(seen: Observation, log: Logger, page_offset: int = 2) -> None:
    """What was counted, as log lines of each report: errors with the first page that has one, warnings, missing sub-funds."""
    counts = seen.get
    for name in dict.fromkeys(x.rsplit(": ", 1)[0] for x in counts):
        of = lambda what: counts[f"{name}: {what}"]  # noqa: B023, E731
        if of("errors"):
            log.error("%s: %d of %d rows have errors, the first on page %d", name, of("errors"), of("rows"), of("first page with an error") + page_offset)
        if of("warnings"):
            log.warning("%s: %d rows have warnings", name, of("warnings"))
        if of("without sub-fund"):
            log.warning("%s: %d rows have no sub-fund", name, of("without sub-fund"))
        log.info("%s: %d rows", name, of("rows"))


def errors(rows: DataFrame) -> DataFrame:
    return rows.where("error IS NOT NULL")


def to_table(rows: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """The holdings table, its columns in their fixed order and types, and more behind them; maturity and rate are of bonds alone."""
    bond = F.col("instrument") == "BOND"
    source = [F.col("page"), F.col("company"), F.col("instrument"), F.col("subfund"), F.col("quantity"), F.col("market_value"), F.col("currency"), F.col("net_assets"), F.col("acquisition_cost"), F.when(bond, F.col("maturity")), F.when(bond, F.col("interest_rate"))]
    return rows.select(*[c.cast(kind).alias(name) for c, (name, kind) in zip(source, HOLDINGS_COLUMNS, strict=True)], *more)


def describe() -> Column:
    """A line about a holding of the table."""
    part = lambda label, name: F.concat(F.lit(f"{label}: "), F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("-")))
    return F.concat_ws("; ", F.concat_ws(" ", "`Financial instrument`", "Company"), part("sub-fund", "Sub-fund"), part("quantity", "Nominal/Quantity"), F.concat_ws(" ", part("value", "Market value"), F.col("Currency")), part("share", "% Net Assets"), part("maturity", "Maturity"), part("rate", "Interest rate"), part("page", "Page report"))


def describe_block() -> Column:
    return F.format_string("[page %s, column %s] %s", F.col("page_idx"), F.col("table_col"), F.trim("content"))


def equal_rows(left: Column | str, right: Column | str, names: list[str]) -> Column:
    """Whether two structs agree in all the named fields, null with null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (left, right))
    out = F.lit(True)
    for n in names:
        out = out & a[n].eqNullSafe(b[n])
    return out


def union_jobs(tables: list[tuple[DataFrame, str, str | None]]) -> DataFrame:
    """All jobs' tables (table, format, report identifier) one after the other; columns that some lack are null."""
    out = None
    for df, name, prefix in tables:
        df = df.withColumn("Report identifier", F.lit(prefix)) if prefix is not None else df
        df = df.withColumn("Format", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables")
    return out
