"""Checks of the options beside the published plans: frames of time, sketches, splits by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.operators import position, sketch
from hazeframe.plans import aqi, batch, eda, reports
from hazeframe.sources import tables

from . import sql as S
from .catalog import A, B, CASES, IDS, MAXES, MEANS, ORACLES, _cases, check
from .panels import REGION, SENSOR_TIE, daily, sensor

# --- frames of time -----------------------------------------------------------


def _exposures_time_sql() -> str:
    made = []
    for p in S.INDEX_COLS:
        name, hours, _ = S.EXPO[p]
        frame = f"OVER w{hours}"
        if hours == 24:
            made.append(f"CAST(sum(CAST({p} AS DECIMAL(18, 4))) {frame} AS DOUBLE) / nullif(count({p}) {frame}, 0) AS {name}")
        else:
            made.append(f"max({p}) {frame} AS {name}")
    frames = ", ".join(f"w{n} AS (PARTITION BY StationId ORDER BY Datetime RANGE BETWEEN INTERVAL {n - 1} HOURS PRECEDING AND CURRENT ROW)" for n in (24, 8))
    return S.chain("sensor", "clean") + f" SELECT StationId, Datetime, {', '.join(made)} FROM clean WINDOW {frames}"


check(
    "exposures_time",
    lambda s, d: aqi.exposures_by_time(sensor(s, d).clean, least=0).select(*IDS, *MEANS, *MAXES),
    _exposures_time_sql(),
)

# --- sketches -----------------------------------------------------------------

# The stated bound holds with 99 % for one group; there are many.
SLACK = 2


def _sketch_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rank of the estimate in all values is a median's, up to the bound."""
    rows = tables.checkpoint(daily(spark, sf_dir).indexed.select("State", "Datetime", "PM25").withColumn("MonthEnd", F.last_day("Datetime")))
    estimate = eda.monthly_median_approx(rows, "PM25")
    error = SLACK * sketch.rank_error()
    value, guess = F.col("PM25"), F.col("Median_PM25")
    below, upto = F.count_if(value < guess) / F.count(value), F.count_if(value <= guess) / F.count(value)
    within = ((below <= 0.5 + error) & (upto >= 0.5 - error)).cast("int")
    ranked = rows.where(value.isNotNull()).join(estimate, ["State", "MonthEnd"])
    return ranked.groupBy("State", "MonthEnd").agg(F.count(value).alias("Count"), within.alias("WithinBound"))


check(
    "sketch_medians", _sketch_medians,
    B + " SELECT State, last_day(Datetime) AS MonthEnd, count(PM25) AS Count, CAST(1 AS INTEGER) AS WithinBound FROM aqi WHERE PM25 IS NOT NULL GROUP BY ALL",
)


def _sketch_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts per state and in all, and whether merged sketches are within three standard errors."""
    rows = tables.checkpoint(sensor(spark, sf_dir).indexed.select("State", "City", "StationId", "Datetime"))
    days = tables.checkpoint(reports.distinct_sketches(rows))
    guess = reports.distinct_approx(days, ["State"]).unionByName(reports.distinct_approx(days).withColumn("State", F.lit("all")))
    each = rows.withColumn("State", F.explode(F.array("State", F.lit("all"))))
    exact = each.groupBy("State").agg(F.countDistinct("StationId").alias("Stations"), F.countDistinct("City").alias("Cities"))
    near = lambda c: (F.abs(F.col(f"g.{c}") - F.col(f"e.{c}")) <= 3 * sketch.distinct_error() * F.col(f"e.{c}")).cast("int").alias(f"{c}Within")
    return exact.alias("e").join(guess.alias("g"), "State").select("State", "e.Stations", "e.Cities", near("Stations"), near("Cities"))


check(
    "sketch_distinct", _sketch_distinct,
    A + """ SELECT State, count(DISTINCT StationId) AS Stations, count(DISTINCT City) AS Cities, CAST(1 AS INTEGER) AS StationsWithin, CAST(1 AS INTEGER) AS CitiesWithin
      FROM (SELECT State, StationId, City FROM aqi UNION ALL SELECT 'all', StationId, City FROM aqi) GROUP BY State""",
)

# --- split by position --------------------------------------------------------


def _exact_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = position.split_at(_cases(spark, sf_dir).select(*IDS, "AQI_Final"), 0.8, ["Datetime", "StationId"])
    return parts[0].withColumn("Part", F.lit("train")).unionByName(parts[1].withColumn("Part", F.lit("test")))


check(
    "exact_split", _exact_split,
    CASES + """ SELECT StationId, Datetime, AQI_Final, CASE WHEN pos < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS Part
      FROM (SELECT *, row_number() OVER (ORDER BY Datetime, StationId) - 1 AS pos, count(*) OVER () AS n FROM cases)""",
)

# --- observed metrics ---------------------------------------------------------

check(
    "quality_observed",
    lambda s, d: batch.observed_quality(sensor(s, d).readings, sensor(s, d).stations, REGION, SENSOR_TIE),
    ORACLES["quality_profile"],
)
