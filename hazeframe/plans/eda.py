"""The fifteen descriptive analyses, each as the table behind its chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (
    BURN_CHART_MONTHS, BURN_WINDOW_YEARS, CATEGORIES, CPCB_PM10_LIMIT, CPCB_PM25_LIMIT,
    INDEX_POLLUTANTS, NORTH_INDIA, Region, SEASONS, WHO_PM25_LIMIT,
)
from ..functions.calendar import in_burn_window
from ..functions.index import category, category_rank
from ..functions.numeric import exact_mean
from ..operators import distribution as dist
from ..operators import sketch
from .clean import present

DIGITS = 6
AQI = "AQI_Final"


def rounded(value: Column, digits: int = DIGITS) -> Column:
    return F.round(value, digits)


# --- distribution -------------------------------------------------------------

def aqi_histogram(df: DataFrame, bins: int = 60) -> DataFrame:
    """Density histogram of the index, with its mean and median on every row."""
    counts = dist.value_counts(df, (), AQI)
    middle = dist.quantiles_of(counts, (), {"Median": 0.5}, DIGITS).drop("_rows")
    mean = dist.moments_of(counts, ()).select(rounded(F.col("Mean")))
    return dist.histogram(counts, (), bins).withColumns(
        {"Mean": mean.scalar(), "Median": middle.scalar()}
    )


def aqi_density(df: DataFrame, points: int = 200) -> DataFrame:
    return dist.density(dist.value_counts(df, (), AQI), (), points)


def band_shares(df: DataFrame) -> DataFrame:
    """Rows and share of every band of the histogram background."""
    counts = df.groupBy(category(AQI).alias("Band")).agg(F.count(F.lit(1)).alias("Count"))
    counts = counts.where("Band is not null")
    total = F.sum("Count").over(Window.partitionBy())
    return counts.withColumn("Pct", rounded(100 * F.col("Count") / total))


# --- trends -------------------------------------------------------------------

def monthly_median(df: DataFrame, col: str = AQI, name: str | None = None) -> DataFrame:
    """Median per state and calendar month, labelled by the last day of the month."""
    dated = df.withColumn("MonthEnd", F.last_day("Datetime"))
    return dist.median(dated, ["State", "MonthEnd"], col, name or f"Median_{col}", DIGITS)


def monthly_median_approx(df: DataFrame, col: str, name: str | None = None, size: int = sketch.KLL_SIZE) -> DataFrame:
    """``monthly_median`` from a sketch per state and day; its rank is off by ``sketch.rank_error`` at most."""
    days = sketch.by_group(df, ["State", F.to_date("Datetime").alias("Day")], [col], size=size)
    months = sketch.merge(days.withColumn("MonthEnd", F.last_day("Day")), ["State", "MonthEnd"], size)
    return sketch.estimates(months, {name or f"Median_{col}": (col, 0.5)})


def monthly_median_pm25(df: DataFrame) -> DataFrame:
    out = monthly_median(df, "PM25")
    value = F.col("Median_PM25")
    return out.withColumns(
        {
            "WhoLimit": F.lit(WHO_PM25_LIMIT),
            "CpcbLimit": F.lit(CPCB_PM25_LIMIT),
            "AboveWho": (value > WHO_PM25_LIMIT).cast("int"),
            "AboveCpcb": (value > CPCB_PM25_LIMIT).cast("int"),
        }
    )


def monthly_median_pm10(df: DataFrame) -> DataFrame:
    out = monthly_median(df, "PM10")
    return out.withColumns(
        {
            "CpcbLimit": F.lit(CPCB_PM10_LIMIT),
            "AboveCpcb": (F.col("Median_PM10") > CPCB_PM10_LIMIT).cast("int"),
        }
    )


def month_box(df: DataFrame) -> DataFrame:
    return dist.box(dist.value_counts(df, ["Month"], AQI), ["Month"])


def season_violin(df: DataFrame, points: int = 100, cut: float = 2.0) -> DataFrame:
    """Density curve and quartiles of the index per season."""
    counts = dist.value_counts(df.where(F.col("Season").isin(*SEASONS)), ["Season"], AQI)
    return _violin(counts, ["Season"], points, cut)


def _violin(counts: DataFrame, keys: Sequence[str], points: int, cut: float) -> DataFrame:
    curve = dist.density(counts, keys, points, cut)
    quarts = dist.quantiles_of(
        counts, keys, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75}, DIGITS
    ).drop("_rows")
    return dist.join_groups(curve, quarts, keys)


def winter_vs_spring_box(df: DataFrame) -> DataFrame:
    two = df.where(F.col("Season").isin("Winter", "Spring"))
    return dist.box(dist.value_counts(two, ["State", "Season"], AQI), ["State", "Season"])


# --- states, cities -----------------------------------------------------------

def state_mean_ci(df: DataFrame) -> DataFrame:
    """Mean, standard deviation, rows and 95 % half-width, worst state first."""
    value = F.col(AQI)
    stats = df.groupBy("State").agg(
        exact_mean(value).alias("Mean"),
        F.stddev_samp(value).alias("Std"),
        F.count(value).alias("Count"),
    )
    half = 1.96 * F.col("Std") / F.sqrt("Count")
    return stats.select(
        "State",
        rounded(F.col("Mean")).alias("Mean"),
        rounded(F.col("Std")).alias("Std"),
        "Count",
        rounded(half).alias("CI95"),
    ).orderBy(F.desc("Mean"), "State")


def top_cities(df: DataFrame, n: int) -> DataFrame:
    means = df.groupBy("City", "State").agg(rounded(exact_mean(F.col(AQI))).alias("Mean"))
    return means.orderBy(F.desc("Mean"), "City", "State").limit(n)


def top_cities_labelled(df: DataFrame, n: int = 10) -> DataFrame:
    """Top cities with the two-letter tag of their state in the label."""
    tag = F.concat(F.col("City"), F.lit(" ("), F.substring("State", 1, 2), F.lit(")"))
    return top_cities(df, n).withColumn("Label", tag).orderBy(F.desc("Mean"), "City", "State")


# --- pollutants ---------------------------------------------------------------

def long_pollutants(df: DataFrame, cols: Sequence[str] = INDEX_POLLUTANTS) -> DataFrame:
    cols = present(df, cols)
    return df.select(*cols).unpivot([], cols, "Pollutant", "Value")


def pollutant_counts(df: DataFrame, prob: float = 0.99) -> DataFrame:
    counts = dist.value_counts(long_pollutants(df), ["Pollutant"], "Value")
    return dist.trim_counts(counts, prob, ["Pollutant"])


def trimmed_summary(df: DataFrame, prob: float = 0.99) -> DataFrame:
    """Rows, cap and median of every pollutant up to its 99th percentile."""
    kept = pollutant_counts(df, prob)
    middle = dist.quantiles_of(kept, ["Pollutant"], {"Median": 0.5}, DIGITS)
    top = kept.groupBy("Pollutant").agg(F.max("_v").alias("Largest"))
    out = dist.join_groups(middle, top, ["Pollutant"])
    return out.select("Pollutant", F.col("_rows").alias("Kept"), rounded(F.col("Largest")).alias("Largest"), "Median")


def pollutant_histograms(df: DataFrame, bins: int = 50) -> DataFrame:
    return dist.histogram(pollutant_counts(df), ["Pollutant"], bins)


def pollutant_densities(df: DataFrame, points: int = 1000) -> DataFrame:
    """Density curves over the range widened by half on both sides."""
    return dist.density(pollutant_counts(df), ["Pollutant"], points, extend=0.5)


def correlation(df: DataFrame) -> DataFrame:
    """Lower triangle of the Pearson matrix of index, pollutants and time parts."""
    cols = present(df, [AQI, *INDEX_POLLUTANTS, "Month", "Hour", "Year"])
    return dist.correlations(df, cols)


# --- categories ---------------------------------------------------------------

def _category_cells(df: DataFrame) -> DataFrame:
    """Rows per state and category; a state has all six cells."""
    hits = [F.count(F.when(F.col("AQI_Category") == c, 1)).alias(c) for c in CATEGORIES]
    wide = df.where(F.col("State").isNotNull()).groupBy("State").agg(*hits)
    return wide.unpivot(["State"], list(CATEGORIES), "AQI_Category", "Count")


def category_share(df: DataFrame, include_empty: bool = True) -> DataFrame:
    """Count and percentage of every category of a state."""
    cells = _category_cells(df)
    if not include_empty:
        cells = cells.where("Count > 0")
    total = F.sum("Count").over(Window.partitionBy("State"))
    share = 100 * F.col("Count") / F.nullif(total, F.lit(0))
    return cells.withColumns(
        {"Pct": rounded(share), "Rank": category_rank("AQI_Category")}
    )


def category_pivot(df: DataFrame) -> DataFrame:
    """One row per state, one percentage column per category, absent ones 0."""
    shares = category_share(df)
    wide = shares.groupBy("State").pivot("AQI_Category", list(CATEGORIES)).agg(F.first("Pct"))
    return wide.na.fill(0.0, list(CATEGORIES))


def category_counts(df: DataFrame) -> DataFrame:
    known = df.where(F.col("AQI_Category").isNotNull())
    counts = known.groupBy("AQI_Category").agg(F.count(F.lit(1)).alias("Count"))
    return counts.orderBy(F.desc("Count"), "AQI_Category")


# --- burning season -----------------------------------------------------------

Years = tuple[int, int] | None


def burn_by_timestamp(df: DataFrame, region: Region = NORTH_INDIA, years: Years = BURN_WINDOW_YEARS) -> DataFrame:
    """Median per state and time stamp in the burning months, with the window flag."""
    season = df.where(F.col("State").isin(*region.burn_chart) & F.col("Month").isin(*BURN_CHART_MONTHS))
    out = dist.median(season, ["State", "Datetime"], AQI, "Median_AQI", DIGITS)
    return out.withColumn("InBurnWindow", in_burn_window(F.col("Datetime"), years))


def burn_daily(df: DataFrame, col: str = AQI, years: Years = BURN_WINDOW_YEARS) -> DataFrame:
    """Daily median of a column per state in the burning months, with the window flag."""
    season = df.where(F.col("Month").isin(*BURN_CHART_MONTHS))
    dated = season.withColumn("Date", F.to_date("Datetime"))
    out = dist.median(dated, ["State", "Date"], col, f"Median_{col}", DIGITS)
    return out.withColumn("InBurnWindow", in_burn_window(F.col("Date"), years))


def burn_window_flag(df: DataFrame, years: Years = BURN_WINDOW_YEARS) -> DataFrame:
    return df.withColumn("InBurnWindow", in_burn_window(F.col("Datetime"), years))


# --- years --------------------------------------------------------------------

def yearly_stats(df: DataFrame) -> DataFrame:
    """Unrounded mean and standard error per state and year."""
    value = F.col(AQI)
    return df.groupBy("State", "Year").agg(
        exact_mean(value).alias("Mean"),
        (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("Sem"),
    )


def yearly_mean_sem(df: DataFrame) -> DataFrame:
    out = yearly_stats(df)
    return out.select(
        "State",
        "Year",
        rounded(F.col("Mean")).alias("Mean"),
        rounded(F.col("Sem")).alias("Sem"),
        rounded(1.96 * F.col("Sem")).alias("Bar"),
    )


def yearly_trend(df: DataFrame, min_years: int = 3) -> DataFrame:
    """Least-squares line through the yearly means of a state, and its values."""
    years = yearly_stats(df).withColumn("Year", F.col("Year").cast("double"))
    state = Window.partitionBy("State")
    fitted = years.select(
        "State",
        F.col("Year"),
        "Mean",
        F.count(F.lit(1)).over(state).alias("Years"),
        F.regr_slope("Mean", "Year").over(state).alias("Slope"),
        F.regr_intercept("Mean", "Year").over(state).alias("Intercept"),
    ).where(F.col("Years") >= min_years)
    line = F.col("Intercept") + F.col("Slope") * F.col("Year")
    return fitted.select(
        "State",
        F.col("Year").cast("int").alias("Year"),
        rounded(F.col("Mean")).alias("Mean"),
        rounded(F.col("Slope")).alias("Slope"),
        rounded(F.col("Intercept"), 4).alias("Intercept"),
        rounded(line).alias("Fitted"),
    )


def run_all(df: DataFrame, region: Region = NORTH_INDIA) -> dict[str, DataFrame]:
    """The table behind every chart, by chart name; nothing runs yet."""
    out = {
        "01_aqi_distribution": aqi_histogram(df),
        "02_aqi_trend_over_time": monthly_median(df),
        "03_monthly_aqi_trends": month_box(df),
        "04_seasonal_aqi_trends": season_violin(df),
        "05_statewise_aqi_comparison": state_mean_ci(df),
        "06_citywise_aqi_comparison": top_cities(df, 15),
        "07_pollutant_distributions": pollutant_histograms(df),
        "08_correlation_heatmap": correlation(df),
        "11_winter_vs_summer": winter_vs_spring_box(df),
        "12_crop_burning_season": burn_by_timestamp(df, region),
        "13_top10_polluted_cities": top_cities_labelled(df),
        "14_aqi_category_distribution": category_pivot(df),
        "15_yearly_aqi_trend": yearly_mean_sem(df),
    }
    if "PM25" in df.columns:
        out["09_pm25_trend"] = monthly_median_pm25(df)
    if "PM10" in df.columns:
        out["10_pm10_trend"] = monthly_median_pm10(df)
    return out
