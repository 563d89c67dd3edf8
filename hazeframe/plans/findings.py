"""Ratios, uplifts and changes: the findings drawn from the index table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import in_burn_window
from ..functions.numeric import exact_mean
from ..operators.distribution import pearson
from . import eda
from .eda import AQI, rounded


def _mean_if(condition: Column) -> Column:
    return exact_mean(F.when(condition, F.col(AQI)))


def _percent(new: str, old: str) -> Column:
    return 100 * (F.col(new) - F.col(old)) / F.nullif(F.col(old), F.lit(0.0))


def state_ratio(df: DataFrame, base: str) -> DataFrame:
    """Mean index of every state as a multiple of a base state."""
    means = df.groupBy("State").agg(exact_mean(F.col(AQI)).alias("Mean"))
    base_mean = df.where(F.col("State") == base).agg(exact_mean(F.col(AQI)).alias("m")).scalar()
    return means.select(
        "State", rounded(F.col("Mean")).alias("Mean"), rounded(F.col("Mean") / base_mean).alias("Ratio")
    )


def burn_uplift(df: DataFrame) -> DataFrame:
    """Mean index inside and outside the burning window."""
    flagged = in_burn_window(F.col("Datetime")) == 1
    out = df.groupBy("State").agg(
        _mean_if(flagged).alias("Inside"), _mean_if(~flagged).alias("Outside")
    )
    return out.select(
        "State",
        rounded(F.col("Inside")).alias("Inside"),
        rounded(F.col("Outside")).alias("Outside"),
        rounded(F.col("Inside") / F.nullif(F.col("Outside"), F.lit(0.0))).alias("Ratio"),
    )


def lag_correlation(df: DataFrame, sources: Sequence[str], target: str, max_days: int = 5) -> DataFrame:
    """Correlation of the daily mean of burning states with a state k days later."""
    dated = df.withColumn("Date", F.to_date("Datetime"))
    mean = exact_mean(F.col(AQI))
    source = dated.where(F.col("State").isin(*sources)).groupBy("Date").agg(mean.alias("Source"))
    shifted = source.select(
        F.explode(F.sequence(F.lit(0), F.lit(max_days))).alias("LagDays"), "Date", "Source"
    ).withColumn("Date", F.date_add("Date", F.col("LagDays")))
    later = dated.where(F.col("State") == target).groupBy("Date").agg(mean.alias("Later"))
    return (
        shifted.join(later, "Date")
        .groupBy("LagDays")
        .agg(F.count(F.lit(1)).alias("Days"), rounded(pearson(F.col("Source"), F.col("Later"))).alias("Corr"))
    )


def limit_exceedance(df: DataFrame, limits: Sequence[float] = (15.0, 60.0)) -> DataFrame:
    """Months per year and state with a median PM2.5 above each limit."""
    months = eda.monthly_median(df, "PM25").withColumn("Year", F.year("MonthEnd"))
    over = [
        F.count(F.when(F.col("Median_PM25") > x, 1)).alias(f"MonthsAbove{int(x)}") for x in limits
    ]
    return months.groupBy("State", "Year").agg(F.count(F.lit(1)).alias("Months"), *over)


def period_drop(df: DataFrame, year: int = 2020, months: Sequence[int] = (3, 4, 5)) -> DataFrame:
    """Change of the mean of some months against the same months of earlier years."""
    part = df.where(F.col("Month").isin(*months) & (F.col("Year") <= year))
    out = part.groupBy("State").agg(
        _mean_if(F.col("Year") < year).alias("Before"),
        _mean_if(F.col("Year") == year).alias("During"),
    )
    return out.select(
        "State",
        rounded(F.col("Before")).alias("Before"),
        rounded(F.col("During")).alias("During"),
        rounded(_percent("During", "Before")).alias("ChangePct"),
    )


def trend_excluding(df: DataFrame, year: int = 2020) -> DataFrame:
    return eda.yearly_trend(df.where(F.col("Year") != year))


def peak_month(df: DataFrame) -> DataFrame:
    """Month with the highest mean, the earlier one on a tie."""
    means = df.groupBy("State", "Month").agg(rounded(exact_mean(F.col(AQI))).alias("Mean"))
    rank = F.struct(F.col("Mean"), -F.col("Month"))
    return means.groupBy("State").agg(
        F.max_by("Month", rank).alias("PeakMonth"), F.max("Mean").alias("PeakMean")
    )


def season_ratio(df: DataFrame) -> DataFrame:
    out = df.groupBy("State").agg(
        _mean_if(F.col("Season") == "Winter").alias("Winter"),
        _mean_if(F.col("Season") == "Monsoon").alias("Monsoon"),
    )
    return out.select(
        "State",
        rounded(F.col("Winter")).alias("Winter"),
        rounded(F.col("Monsoon")).alias("Monsoon"),
        rounded(F.col("Winter") / F.nullif(F.col("Monsoon"), F.lit(0.0))).alias("Ratio"),
    )
