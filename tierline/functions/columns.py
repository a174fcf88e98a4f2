"""Column helpers: ladders, guarded ratios, scores of flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(value: Column, steps: Sequence[tuple[object, str]], otherwise: str, least: bool = True) -> Column:
    """The label of the first step whose bound value reaches (least) or exceeds; null goes to otherwise."""
    out = None
    for bound, label in steps:
        hit = value >= F.lit(bound) if least else value > F.lit(bound)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def ratio(over: Column, under: Column) -> Column:
    """over / under as a double; null where under is null or 0."""
    return over.cast("double") / F.nullif(under.cast("double"), F.lit(0.0))


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition is 0."""
    return F.when(condition, 1).otherwise(0)


def score(flags: Sequence[tuple[Column, int]]) -> Column:
    out = F.lit(0)
    for f, weight in flags:
        out = out + f * F.lit(weight)
    return out


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def zero(value: Column) -> Column:
    """A sum of money, 0 where there is nothing to sum."""
    return money(F.coalesce(value, F.lit(0)))
