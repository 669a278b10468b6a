"""Predicates that compare a text with a target: (text, target) -> boolean column."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from ledgerleaf.functions.scalars import normalize_string

Match = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Likeness:
    """How a target has to be like a text, both normalised: a share `prefix` of it begins the text, and it is alike by `ratio`; with neither, the text contains it."""

    prefix: float | None = None
    ratio: float | None = None

    def predicate(self) -> Match:
        """The same as a predicate of one text and one target."""
        tests = ([] if self.prefix is None else [target_prefix_match(self.prefix)]) + ([] if self.ratio is None else [target_fuzzy_match(self.ratio)])
        return both(*tests) if len(tests) > 1 else tests[0] if tests else target_match


def target_match(text: Column, target: Column) -> Column:
    """The target is in the text, both normalised."""
    return normalize_string(text).contains(normalize_string(target))


def prefix_similarity(a: Column, b: Column) -> Column:
    """The share of a that is a prefix of b; 1 for an empty a."""
    n = F.length(a)
    # the longest common prefix: how many lengths agree, as shorter prefixes of equal prefixes are equal
    common = F.size(F.filter(F.sequence(F.lit(0), F.least(n, F.length(b))), lambda k: F.left(a, k) == F.left(b, k))) - 1
    return F.when(n == 0, F.lit(1.0)).otherwise(common / n)


def target_prefix_match(ratio: float) -> Match:
    """A share of at least ratio of the target begins the text, both normalised."""

    def match(text: Column, target: Column) -> Column:
        t, g = normalize_string(text), normalize_string(target)
        k = F.ceil(F.length(g) * F.lit(ratio) - 1e-9).cast("int")
        return (F.length(t) >= k) & (F.left(t, k) == F.left(g, k))

    return match


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp: twice the length of matching blocks over the total length. Not symmetric."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(ArrayType(StringType()))
def alike_by(text: pd.Series, targets: pd.Series, ratio: pd.Series) -> pd.Series:
    """Of each text's targets, those that are alike by at least its ratio; null texts are passed over."""
    seen: dict[tuple[str, str], float] = {}

    def likeness(target: str, of: str) -> float:
        if (target, of) not in seen:
            seen[target, of] = SequenceMatcher(None, target, of).ratio()
        return seen[target, of]

    return pd.Series([None if x is None else [t for t in every if likeness(t, x) >= r] for x, every, r in zip(text, targets, ratio, strict=True)], dtype="object")


def target_fuzzy_match(ratio: float) -> Match:
    """The target and the text are alike by at least ratio, both normalised.

    The bound by lengths decides alone where it can, but spares no call: Spark evaluates a Python function for every row
    before the expression around it.
    """

    def match(text: Column, target: Column) -> Column:
        t, g = normalize_string(text), normalize_string(target)
        could = 2 * F.least(F.length(t), F.length(g)) >= ratio * (F.length(t) + F.length(g))
        return F.when(could, similarity(g, t) >= ratio).otherwise(False)

    return match


def both(first: Match, second: Match) -> Match:
    """Put the cheaper one first."""
    return lambda text, target: F.when(first(text, target), second(text, target)).otherwise(False)
