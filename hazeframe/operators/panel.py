"""Fill, rolling and lag operators over a panel of time series.

All frames count rows of one series, not hours: a missing hour is not bridged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.numeric import exact
from . import segments

# Decimals that count; readings have far fewer.
DEFAULT_DIGITS = 10


def fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    backward: bool = True,
) -> DataFrame:
    """Forward fill, then backward fill, per series.

    The backward fill only ever concerns rows before the first known value, so
    it is the first known value of the whole series.  A frame that looks ahead
    row by row would be quadratic.
    """
    df = segments.with_carry(df, keys, order, cols)
    seen = segments.series(df, keys, order)
    past = seen.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = seen.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {}
    for c in cols:
        value = F.last(c, ignorenulls=True).over(past)
        if backward:
            value = F.coalesce(value, F.first(c, ignorenulls=True).over(whole))
        filled[c] = value
    return segments.drop_extra(df.withColumns(filled))


class Roll(NamedTuple):
    """A rolling statistic: null with fewer than ``min_rows`` known values."""

    column: str
    rows: int
    min_rows: int
    how: str = "mean"


def rolling(
    df: DataFrame,
    window: WindowSpec,
    rolls: Mapping[str, Roll],
    digits: int | None = DEFAULT_DIGITS,
) -> DataFrame:
    """Add rolling means and maxima over the last rows of a series.

    A moving frame visits every row as often as the frame is long.  Counts, and
    sums over decimals, are exact differences of running totals instead: two
    passes of constant work per row over the same sorted rows, and a mean that
    does not depend on the order of additions.  Values of 1e18 and more, and
    infinite ones, are unknown to the mean.  ``digits=None`` is the plain average
    over a moving frame, for values with any number of decimals.
    """
    past = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {}
    for col in dict.fromkeys(r.column for r in rolls.values()):
        value = F.col(col)
        if digits is not None and any(r.how == "mean" for r in rolls.values() if r.column == col):
            value = exact(value, digits)
            # 0, not null, before the first known value: it is subtracted below
            totals[f"_total_{col}"] = F.sum(F.coalesce(value, F.lit(0))).over(past)
        totals[f"_known_{col}"] = F.count(value).over(past)

    def last_rows(total: str, rows: int) -> Column:
        return F.col(total) - F.lag(total, rows, 0).over(window)

    # Counts of the frames in columns of their own: each is asked for twice.
    counts = {f"_in_{r.column}_{r.rows}": last_rows(f"_known_{r.column}", r.rows) for r in rolls.values()}
    made = {}
    for name, r in rolls.items():
        frame = window.rowsBetween(1 - r.rows, Window.currentRow)
        known = F.col(f"_in_{r.column}_{r.rows}")
        if r.how == "max":
            value = F.max(r.column).over(frame)
        elif digits is None:
            value = F.avg(r.column).over(frame)
        else:
            total = last_rows(f"_total_{r.column}", r.rows).cast("double")
            value = F.try_divide(total, known.cast("double"))
        made[name] = F.when(known >= r.min_rows, value)
    return df.withColumns(totals).withColumns(counts).withColumns(made).drop(*totals, *counts)


MICROS = "_micros"
HOUR = 3_600_000_000


def with_micros(df: DataFrame, time: str) -> DataFrame:
    """Adds the time without a zone as microseconds, a number that frames of time can count in."""
    return df.withColumn(MICROS, F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(time)))


def rolling_hours(
    df: DataFrame, keys: Sequence[str], rolls: Mapping[str, Roll], digits: int | None = DEFAULT_DIGITS
) -> DataFrame:
    """Rolling statistics over hours instead of rows.

    ``rows`` of a roll are hours: its frame goes from ``rows - 1`` hours before a row to
    the row, with all rows of the same time, so on gapless hourly data it is that of
    ``rolling``.  ``df`` comes from ``with_micros``, cut (if at all) along that column.
    Each frame is added up anew; it holds a day of one station at most.
    """
    columns = list(dict.fromkeys(r.column for r in rolls.values()))
    longest = max((r.rows for r in rolls.values()), default=1)
    df = segments.with_time_halo(df, keys, MICROS, columns, max(1, longest - 1) * HOUR)
    # The halo stands before the segment in time, so its side is no matter here.
    parts = [*keys, segments.SEG] if segments.SEG in df.columns else list(keys)
    ordered = Window.partitionBy(*parts).orderBy(MICROS)
    made = {}
    for name, r in rolls.items():
        frame = ordered.rangeBetween((1 - r.rows) * HOUR, Window.currentRow)
        if r.how == "max":
            value, known = F.max(r.column).over(frame), F.count(r.column).over(frame)
        else:
            one = F.col(r.column) if digits is None else exact(F.col(r.column), digits)
            known = F.count(one).over(frame)
            value = F.sum(one).over(frame).cast("double") / F.nullif(known.cast("double"), F.lit(0.0))
        made[name] = F.when(known >= r.min_rows, value)
    return segments.drop_extra(df.withColumns(made))


def lags(col: str, window: WindowSpec, names: Mapping[str, int]) -> dict[str, Column]:
    return {name: F.lag(col, n).over(window) for name, n in names.items()}


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``.

    The filter on the row number lets Spark keep one row per key and task before
    the shuffle, so any number of copies of a key is fine.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
