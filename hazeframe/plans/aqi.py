"""Exposures, sub-indices, the air-quality index and its category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import BREAKPOINTS, EXPOSURES
from ..functions import index
from ..functions.numeric import round_even
from ..operators import panel, segments
from ..operators.lookup import lookup
from .clean import KEY, SERIES_ORDER


def exposures(
    df: DataFrame,
    tie: Sequence[str] = (),
    digits: int | None = panel.DEFAULT_DIGITS,
    segmented: bool = False,
) -> DataFrame:
    """Rolling exposure of every pollutant; half of the frame must be known.

    A pollutant the frame does not have gives an all-null exposure.
    """
    order = [*SERIES_ORDER, *tie]
    if not segmented:
        df = segments.split_hot(df, KEY, order)
    have = [e for e in EXPOSURES if e.pollutant in df.columns]
    longest = max((e.rows for e in have), default=1)
    df = segments.with_halo(df, KEY, order, [e.pollutant for e in have], longest - 1)
    window = segments.series(df, KEY, order)
    rolls = {e.column: panel.Roll(e.pollutant, e.rows, e.rows // 2, e.how) for e in have}
    df = segments.drop_extra(panel.rolling(df, window, rolls, digits))
    absent = {e.column: F.lit(None).cast("double") for e in EXPOSURES if e not in have}
    df = df.withColumns(absent) if absent else df
    return df if segmented else segments.drop_segments(df)


def exposures_by_time(df: DataFrame, digits: int | None = panel.DEFAULT_DIGITS, least: float = 0.5) -> DataFrame:
    """Exposures over hours of the clock instead of rows: a missing hour is not bridged.

    ``least`` of a frame's hours, and one at least, must have a known reading (counted
    as readings).  A hot station is cut along time.
    """
    have = [e for e in EXPOSURES if e.pollutant in df.columns]
    timed = panel.with_micros(df, *SERIES_ORDER)
    cut = segments.split_hot(timed, KEY, [panel.MICROS])
    rolls = {e.column: panel.Roll(e.pollutant, e.rows, max(1, int(e.rows * least)), e.how) for e in have}
    out = panel.rolling_hours(cut, KEY, rolls, digits).drop(panel.MICROS)
    absent = {e.column: F.lit(None).cast("double") for e in EXPOSURES if e not in have}
    return segments.drop_segments(out.withColumns(absent) if absent else out)


def sub_indices(df: DataFrame) -> DataFrame:
    # The number of a band in a column of its own is looked up once for its line.
    bands = index.band_numbers(df.columns)
    numbered = df.withColumns(bands) if bands else df
    return numbered.withColumns(index.sub_indices(numbered.columns)).drop(*bands)


def with_index(df: DataFrame) -> DataFrame:
    """Rows that will have an index: a reported one, or an exposure in a band.

    The bands of a pollutant leave no gap, so an exposure from the first edge on
    has a sub-index.  Asked before the bands are looked up, the test is cheap;
    on ``AQI_Final`` Spark would copy the whole computation into the filter.
    """
    tests = [
        f"`{e.column}` >= {float(BREAKPOINTS[e.pollutant][0][0])!r}D"
        for e in EXPOSURES
        if e.pollutant in df.columns
    ]
    if "AQI" in df.columns:
        tests.append("AQI IS NOT NULL")
    return df.where(" OR ".join(tests) or "false")


def calculated(df: DataFrame) -> DataFrame:
    """``AQI_Calculated``: the worst sub-index of the row."""
    parts = [e.index for e in EXPOSURES if e.index in df.columns]
    return df.withColumn("AQI_Calculated", index.row_max(parts))


def final(df: DataFrame) -> DataFrame:
    """``AQI_Final``: the reported index if there is one, to 2 decimals."""
    value = F.col("AQI_Calculated")
    if "AQI" in df.columns:
        value = F.coalesce(F.col("AQI"), value)
    return df.withColumn("AQI_Final", round_even(value, 2))


def categorise(df: DataFrame) -> DataFrame:
    return df.withColumn("AQI_Category", index.category("AQI_Final"))


def dominant_pollutant(df: DataFrame) -> DataFrame:
    return df.withColumn("DominantPollutant", index.dominant(df.columns))


def calculate(
    df: DataFrame,
    tie: Sequence[str] = (),
    digits: int | None = panel.DEFAULT_DIGITS,
    segmented: bool = False,
) -> DataFrame:
    """The index of every row; rows without any index drop out."""
    df = with_index(exposures(df, tie, digits, segmented))
    return categorise(final(calculated(sub_indices(df))))


def breakpoint_table(spark, pollutant: str) -> DataFrame:
    rows = [(i, *map(float, band)) for i, band in enumerate(BREAKPOINTS[pollutant])]
    return spark.createDataFrame(rows, "band int, c_lo double, c_hi double, i_lo double, i_hi double")


def sub_index_by_lookup(df: DataFrame, value: str, pollutant: str, name: str) -> DataFrame:
    """The sub-index through an equi-join with the breakpoint table.

    The band number is found by comparing the value with the upper edges; it is
    the join key of a table with six rows.
    """
    bands = BREAKPOINTS[pollutant]
    v = F.col(value)
    number = F.when(v < float(bands[0][0]), F.lit(None).cast("int"))
    for i, band in enumerate(bands):
        number = number.when(v <= float(band[1]), F.lit(i))
    table = breakpoint_table(df.sparkSession, pollutant)
    found = lookup(df.withColumn("band", number), table, "band")
    slope = (F.col("i_hi") - F.col("i_lo")) / (F.col("c_hi") - F.col("c_lo"))
    result = F.when(v > float(bands[-1][1]), F.lit(500.0)).otherwise(
        slope * (v - F.col("c_lo")) + F.col("i_lo")
    )
    return found.withColumn(name, result).drop("band", "c_lo", "c_hi", "i_lo", "i_hi")
