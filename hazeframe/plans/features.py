"""Lag, rolling, calendar and state features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CYCLES, DELTAS, EXPOSURES, INDEX_POLLUTANTS, LAGS, NORTH_INDIA, ROLLS, Region, state_column,
)
from ..functions.calendar import calendar_parts, crop_burning, cyclic, season, season_code
from ..operators import panel, segments
from .clean import KEY, SERIES_ORDER

TARGET = "AQI_Final"


def history(
    df: DataFrame, tie: Sequence[str] = (), horizon: int = 0, segmented: bool = False
) -> DataFrame:
    """Lags, rolling means (current row included) and deltas of the index.

    ``horizon`` > 0 adds ``Target``, the index that many rows ahead; with 0 the
    target of the models is the current index.
    """
    order = [*SERIES_ORDER, *tie]
    if not segmented:
        df = segments.split_hot(df, KEY, order)
    if horizon:
        df = _ahead(df, order, horizon)
    halo = max(*LAGS, *(n - 1 for n in ROLLS))
    df = segments.with_halo(df, KEY, order, [TARGET], halo)
    window = segments.series(df, KEY, order)
    df = df.withColumns(panel.lags(TARGET, window, {f"AQI_Lag{n}": n for n in LAGS}))
    rolls = {f"AQI_Roll{n}": panel.Roll(TARGET, n, least) for n, least in ROLLS.items()}
    df = panel.rolling(df, window, rolls, digits=2)
    df = df.withColumns({f"AQI_Delta{n}": F.col(TARGET) - F.col(f"AQI_Lag{n}") for n in DELTAS})
    df = segments.drop_extra(df)
    return df if segmented else segments.drop_segments(df)


def _ahead(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """``Target``: the index some rows ahead, over cuts of a series too."""
    df = segments.with_halo(df, KEY, order, [TARGET], rows, after=True)
    window = segments.series(df, KEY, order)
    return segments.drop_extra(df.withColumn("Target", F.lead(TARGET, rows).over(window)))


def encode_calendar(df: DataFrame, region: Region = NORTH_INDIA) -> DataFrame:
    """Season code and cyclic encodings; missing calendar columns are made."""
    parts = calendar_parts("Datetime")
    wanted = ["Year", "Month", "Hour", "DayOfWeek", "IsWeekend"]
    df = df.withColumns({c: parts[c] for c in wanted if c not in df.columns})
    if "CropBurning" not in df.columns:
        burning = crop_burning(F.col("Month"), F.col("State"), region.burning)
        df = df.withColumn("CropBurning", burning)
    if "Season" not in df.columns:
        df = df.withColumn("Season", season("Month"))
    made = {"Season_Enc": season_code("Season")}
    for label, (col, period) in CYCLES.items():
        made[f"{label}_Sin"], made[f"{label}_Cos"] = cyclic(F.col(col), period)
    return df.withColumns(made)


def one_hot_states(df: DataFrame, states: Sequence[str] = NORTH_INDIA.states) -> DataFrame:
    """0/1 column per state of a fixed list; a null state is all 0."""
    hit = {state_column(s): F.coalesce(F.col("State") == s, F.lit(False)).cast("int") for s in states}
    return df.withColumns(hit)


def engineer(
    df: DataFrame,
    region: Region = NORTH_INDIA,
    tie: Sequence[str] = (),
    horizon: int = 0,
    segmented: bool = False,
) -> DataFrame:
    """All features; rows without a full lag history drop out."""
    df = history(df, tie, horizon, segmented)
    df = one_hot_states(encode_calendar(df, region), region.states)
    return df.dropna(how="any", subset=[f"AQI_Lag{n}" for n in LAGS])


def columns(
    df: DataFrame, region: Region = NORTH_INDIA, include_pollutants: bool = True
) -> list[str]:
    """Names of the model inputs, in model order."""
    names = [f"AQI_Lag{n}" for n in LAGS]
    names += [f"AQI_Roll{n}" for n in ROLLS]
    names += [f"AQI_Delta{n}" for n in DELTAS]
    names += [f"{c}_{f}" for c in CYCLES for f in ("Sin", "Cos")]
    names += ["Season_Enc", "IsWeekend", "CropBurning", "Year"]
    names += [state_column(s) for s in region.states]
    if include_pollutants:
        names += INDEX_POLLUTANTS
        names += [e.column for e in EXPOSURES]
    return [n for n in names if n in df.columns]
