"""Readings and stations to one clean hourly panel.

Order of steps, which decides the result: join, state filter, calendar, fill,
clip, drop, dedup.  The fill precedes the dedup, so a copy can feed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CORE_POLLUTANTS, ID_COLUMNS, NORTH_INDIA, POLLUTANTS, Region
from ..functions.calendar import calendar_parts, crop_burning
from ..functions.numeric import clip_low
from ..operators import panel, segments
from ..operators.lookup import lookup
from ..sources.tables import ORDINAL, checkpoint

KEY = ("StationId",)
SERIES_ORDER = ("Datetime",)
# Besides ISO; the day stands first where a text leaves it open.
TIME_FORMATS = ("dd-MM-yyyy HH:mm[:ss]", "dd/MM/yyyy HH:mm[:ss]", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy/MM/dd HH:mm[:ss]")


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def tie_break(df: DataFrame, given: Sequence[str] | None = None) -> list[str]:
    """Columns that order rows of one station and time; file order if known."""
    return list(given) if given is not None else present(df, ORDINAL)


def attach_stations(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join on the station id, which may be called ``StationCode``."""
    if "StationId" not in stations.columns and "StationCode" in stations.columns:
        stations = stations.withColumnRenamed("StationCode", "StationId")
    return lookup(readings, stations, "StationId")


def filter_states(df: DataFrame, states: Sequence[str] = NORTH_INDIA.states) -> DataFrame:
    return df.where(F.col("State").isin(*states))


def moment_of(name: str, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """Text as a zone-free timestamp: ISO, else the first format that fits; else null."""
    tried = [F.try_to_timestamp(F.col(name).cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(F.col(name).try_cast("timestamp_ntz"), *tried)


def parse_datetime(df: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> DataFrame:
    """``Datetime`` (or ``Date``) as a zone-free timestamp; bad ones drop out.

    ``lost_times`` counts those that will.
    """
    name = "Datetime" if "Datetime" in df.columns else "Date"
    df = df.withColumnRenamed(name, "Datetime")
    if not isinstance(df.schema["Datetime"].dataType, T.StringType):
        formats = ()
    return df.withColumn("Datetime", moment_of("Datetime", formats)).where(F.col("Datetime").isNotNull())


def lost_times(df: DataFrame, formats: Sequence[str] = TIME_FORMATS) -> int:
    """Rows whose time no format fits, and so are dropped."""
    name = "Datetime" if "Datetime" in df.columns else "Date"
    return df.where(F.col(name).isNotNull() & moment_of(name, formats).isNull()).count()


def add_calendar(df: DataFrame, region: Region = NORTH_INDIA) -> DataFrame:
    parts = calendar_parts("Datetime")
    df = df.withColumns(parts)
    return df.withColumn("CropBurning", crop_burning(F.col("Month"), F.col("State"), region.burning))


def fill_order(df: DataFrame, tie: Sequence[str] | None = None) -> list[str]:
    """Order of a station's rows; copies of one time without a tie-break are ordered by their values."""
    ties = tie_break(df, tie) or present(df, [*POLLUTANTS, "AQI"])
    return [*SERIES_ORDER, *ties]


def impute(
    df: DataFrame,
    tie: Sequence[str] | None = None,
    backward: bool = True,
    segmented: bool = False,
) -> DataFrame:
    """Fill per station, clip at 0, drop rows without any core pollutant."""
    order = fill_order(df, tie)
    if not segmented:
        df = segments.split_hot(df, KEY, order)
    cols = present(df, POLLUTANTS)
    df = clip_negative(drop_core_null(panel.fill(df, KEY, order, cols, backward)))
    return df if segmented else segments.drop_segments(df)


def clip_negative(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clip_low(F.col(c)) for c in present(df, POLLUTANTS)})


def drop_core_null(df: DataFrame) -> DataFrame:
    return df.dropna(how="all", subset=present(df, CORE_POLLUTANTS))


def dedup(df: DataFrame, tie: Sequence[str] | None = None) -> DataFrame:
    """First row of every (station, time)."""
    order = tie_break(df, tie) or [c for c in df.columns if c not in ("StationId", "Datetime")]
    return panel.keep_first(df, ["StationId", "Datetime"], order)


def finalise(df: DataFrame, drop: Sequence[str] = ORDINAL) -> DataFrame:
    """Ids, pollutants, reported index, everything else; no helper columns."""
    first = present(df, ID_COLUMNS) + present(df, [*POLLUTANTS, "AQI"])
    rest = [c for c in df.columns if c not in first and c not in drop]
    return df.select(*first, *rest)


def preprocess(
    readings: DataFrame,
    stations: DataFrame,
    region: Region = NORTH_INDIA,
    tie: Sequence[str] | None = None,
    keep_segments: bool = False,
) -> DataFrame:
    """The clean panel.

    The panel is measured once, on the raw rows.  With ``keep_segments`` the cut
    of hot stations stays in the frame for the windows that follow; the frame is
    then checkpointed when there is a cut, since those windows read it twice.
    """
    joined = filter_states(attach_stations(readings, stations), region.states)
    dated = add_calendar(parse_datetime(joined), region)
    ties = tie_break(dated, tie)
    dated = segments.split_hot(dated, KEY, fill_order(dated, tie))
    filled = impute(dated, tie, segmented=True)
    clean = finalise(dedup(filled, ties), drop=[*ORDINAL, *ties])
    if segments.SEG not in clean.columns:
        return clean
    return checkpoint(clean) if keep_segments else segments.drop_segments(clean)
