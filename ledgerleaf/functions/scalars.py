"""Scalar functions over text columns: white space, numbers, percentages, dates, currencies, and what a holding's text says.

A cast that fails gives null. White space is Unicode's and the separators U+001C to U+001F.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf.fixed_values import CURRENCIES, FALSE_WORDS, TRUE_WORDS

WHITE = r"(?U)[\s\x1c-\x1f]+"

CANONICAL = {code: next(c for c, s in CURRENCIES if s == sign) for code, sign in CURRENCIES}

INTEREST_RATE = r"(?s)^.*((\d+[.,]\d+)\s*%).*"
#: In order of precedence; a greedy prefix takes the last one of a text.
MATURITIES = [r"(?s)^.*(\d{2}[/-]\d{2}[/-]\d{4}).*", r"(?s)^.*(\d{4}[/-]\d{2}[/-]\d{2}).*", r"(?s)^.*(\d{2}[/-]\d{2}[/-]\d{2}).*"]


def normalize_string(text: Column, lower: bool = True) -> Column:
    """Runs of white space become one space, none at the ends; in lower case unless told otherwise."""
    return F.trim(F.regexp_replace(F.lower(text) if lower else text, WHITE, " "))


def normalize_word(text: Column, lower: bool = False) -> Column:
    """No white space at all."""
    return F.regexp_replace(F.lower(text) if lower else text, WHITE, "")


def to_str(text: Column) -> Column:
    return normalize_string(text, lower=False)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once; written out at each use, nested readings would outgrow generated code."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(text: Column, grouped: str) -> Column:
    """Digits with a decimal point at most. grouped: what a number whose points all separate thousands looks like."""

    def forced(word: Column) -> Column:
        return F.when(word.rlike(r"^\d+([.,]\d+)*$"), word).otherwise(F.regexp_replace(word, r"[^a-zA-Z.,0-9]+", ""))

    def pointed(word: Column) -> Column:
        # of two kinds of separators the one that comes first separates thousands
        dot, comma = F.instr(word, "."), F.instr(word, ",")
        drop = F.when((dot > 0) & (comma > 0), F.when(dot < comma, F.lit(".")).otherwise(F.lit(",")))
        return F.replace(F.when(drop.isNull(), word).otherwise(F.replace(word, F.coalesce(drop, F.lit(".")), F.lit(""))), F.lit(","), F.lit("."))

    def whole(word: Column) -> Column:
        return F.when(word.rlike(grouped), F.replace(word, F.lit("."), F.lit(""))).otherwise(word)

    return bind(bind(bind(normalize_word(text), forced), pointed), whole)


def to_float(text: Column) -> Column:
    """A lenient number: signs and brackets are dropped, one point is a decimal point, several separate thousands."""
    # a letter for the type after the digits is no number
    return bind(_number(text, r"^[1-9]\d{0,2}\.\d{3}(\.\d{3})+$"), lambda word: F.when(~word.rlike(r"[\d.][dDfF]$"), word.try_cast("double")))


def to_int(text: Column) -> Column:
    """A lenient whole number: one point before three digits separates thousands; a fraction other than 0 fails."""
    return bind(_number(text, r"^[1-9]\d{0,2}(\.\d{3})+$"), lambda word: F.when(word.rlike(r"^\d+(\.0+)?$"), F.substring_index(word, ".", 1).try_cast("bigint")))


def perc_to_float(text: Column, norm: bool = True) -> Column:
    """A share; a percent sign, or norm, divides by 100."""

    def of(word: Column) -> Column:
        return bind(to_float(F.replace(word, F.lit("%"), F.lit(""))), lambda number: F.when(word.contains("%") | F.lit(norm), number / 100.0).otherwise(number))

    return bind(normalize_word(text), of)


def to_currency(text: Column, canonical: bool = True) -> Column:
    """A known currency code; with canonical, the first of the codes that share its sign."""
    pairs = [F.lit(x) for code in CANONICAL for x in (code, CANONICAL[code] if canonical else code)]
    return F.try_element_at(F.create_map(*pairs), F.upper(normalize_word(text)))


def to_date(text: Column) -> Column:
    """y-m-d, d/m/y, d/m/yy, m-d-y or d-m-yy, the first that fits; two-digit years from 69 on are of the last century."""

    def of(word: Column, pattern: str, order: str) -> Column:
        part = {k: F.regexp_extract(word, pattern, i + 1) for i, k in enumerate(order.lower())}
        year = part["y"].try_cast("int")
        if "Y" not in order:
            year = F.when(year >= 69, year + 1900).otherwise(year + 2000)
        # a month or a day that doesn't exist, 0 included, gives null
        return F.when(word.rlike(pattern), F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(part["m"], 2, "0"), F.lpad(part["d"], 2, "0")).try_cast("date"))

    layouts = [(r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "Ymd"), (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "dmY"), (r"^(\d{1,2})/(\d{1,2})/(\d{2})$", "dmy"), (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "mdY"), (r"^(\d{1,2})-(\d{1,2})-(\d{2})$", "dmy")]
    return bind(normalize_word(text), lambda word: F.coalesce(*[of(word, p, o) for p, o in layouts]))


def interest_rate(text: Column) -> Column:
    """The raw interest rate in a holding's text, its percent sign included; of a number's digits before the separator only the last."""
    return F.nullif(F.regexp_extract(text, INTEREST_RATE, 1), F.lit(""))


def maturity(text: Column) -> Column:
    """The raw maturity date in a holding's text."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in MATURITIES])


def instrument(text: Column) -> Column:
    return instrument_of(interest_rate(text), maturity(text))


def instrument_of(rate: Column, due: Column) -> Column:
    """By the raw interest rate and maturity of a holding's text: what has either is a bond."""
    return F.when(rate.isNotNull() | due.isNotNull(), "BOND").otherwise("EQUITY")


def str_to_bool(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)
