"""Numeric expressions whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Binary half-even rounding; ``round`` would round decimal ties up."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def scaled(value: Column, digits: int) -> Column:
    """A reading with at most ``digits`` decimals as a whole number; null if it is out of range."""
    return F.rint(value * F.lit(float(10**digits))).try_cast("bigint")


def exact(value: Column, digits: int) -> Column:
    """A reading as a decimal, so that sums do not depend on order; null if it is out of range.

    There is room for 18 digits before the point: sums of 10 billion such values fit.
    """
    return value.try_cast(f"decimal({18 + digits},{digits})")


def exact_sum(value: Column, digits: int | None) -> Column:
    """Sum over whole numbers: equal for every order of rows and partials."""
    if digits is None:
        return F.sum(value)
    return F.sum(scaled(value, digits))


def mean_of(total: Column, count: Column, digits: int | None) -> Column:
    """Mean from an ``exact_sum`` and a count; null for an empty group."""
    count = F.nullif(count.cast("double"), F.lit(0.0))
    if digits is None:
        return total / count
    return total.cast("double") / F.lit(float(10**digits)) / count


def exact_mean(value: Column, digits: int | None = 2) -> Column:
    """Aggregate mean of ``value``; ``digits=None`` is the plain average."""
    if digits is None:
        return F.avg(value)
    return mean_of(exact_sum(value, digits), F.count(value), digits)


def clip_low(value: Column) -> Column:
    """Lower bound 0, null stays null, and negative zero becomes zero."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value) + F.lit(0.0)


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
