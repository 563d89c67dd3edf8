"""Parameterised queries behind the six report pages, and data profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import INDEX_POLLUTANTS, NORTH_INDIA, Region
from ..functions.calendar import season_code
from ..functions.numeric import exact_mean, exact_sum, mean_of, round_even
from ..operators import distribution as dist
from ..operators import sketch
from ..sources import tables
from . import eda
from .clean import present
from .eda import AQI, DIGITS, rounded


# --- filters ------------------------------------------------------------------

def state_year_filter(
    df: DataFrame, states: Sequence[str], years: tuple[int, int]
) -> DataFrame:
    """States of a list, years of a closed range; without ``Year`` states only."""
    chosen = df.where(F.col("State").isin(*states))
    return chosen.where(F.col("Year").between(*years)) if "Year" in df.columns else chosen


def filter_domains(df: DataFrame) -> DataFrame:
    """The values the filters offer: every state with its first and last year."""
    known = df.where(F.col("State").isNotNull())
    out = known.groupBy("State").agg(
        F.min("Year").alias("FirstYear"), F.max("Year").alias("LastYear")
    )
    return out.orderBy("State")


# --- page 1 -------------------------------------------------------------------

def distinct_sketches(df: DataFrame) -> DataFrame:
    """Sketches of stations and cities per state and day, to be stored and merged as asked."""
    return sketch.by_group(df, ["State", F.to_date("Datetime").alias("Day")], distinct=["StationId", "City"])


def distinct_approx(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Stations and cities of groups of ``distinct_sketches``, with a relative error of ``sketch.distinct_error``."""
    return sketch.estimates(sketch.merge(sketches, list(keys)), distinct={"Stations": "StationId", "Cities": "City"})


def kpis(df: DataFrame) -> DataFrame:
    """Stations, cities, rows, year range and mean index.

    Rows are combined per station and city first, so that the two distinct
    counts run over that small table and not over copies of all rows.
    """
    per_station = df.groupBy("StationId", "City").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("Datetime").alias("first"),
        F.max("Datetime").alias("last"),
        exact_sum(F.col(AQI), 2).alias("total"),
        F.count(AQI).alias("known"),
    )
    return per_station.agg(
        F.countDistinct("StationId").alias("Stations"),
        F.countDistinct("City").alias("Cities"),
        F.sum("n").alias("Records"),
        F.year(F.min("first")).alias("FirstYear"),
        F.year(F.max("last")).alias("LastYear"),
        rounded(mean_of(F.sum("total"), F.sum("known"), 2)).alias("MeanAQI"),
    )


def state_map(df: DataFrame, region: Region = NORTH_INDIA) -> DataFrame:
    """Mean index at the centroid of every state of the study area."""
    rows = [(s, *region.centroids[s]) for s in region.states]
    places = df.sparkSession.createDataFrame(rows, "State string, Lat double, Lon double")
    means = df.where(F.col("State").isin(*region.states)).groupBy("State")
    means = means.agg(rounded(exact_mean(F.col(AQI))).alias("AQI"))
    # at most one row per state of the fixed list on both sides
    return places.join(F.broadcast(means), "State", "left")


def overview(df: DataFrame, region: Region = NORTH_INDIA) -> dict[str, DataFrame]:
    return {
        "kpis": kpis(df),
        "categories": eda.category_counts(df),
        "map": state_map(df, region),
    }


# --- page 2 -------------------------------------------------------------------

def hourly_pattern(df: DataFrame) -> DataFrame:
    return df.groupBy("State", "Hour").agg(rounded(exact_mean(F.col(AQI))).alias("Mean"))


def yearly_mean(df: DataFrame) -> DataFrame:
    return df.groupBy("State", "Year").agg(rounded(exact_mean(F.col(AQI))).alias("Mean"))


def trends(df: DataFrame, states: Sequence[str], years: tuple[int, int]) -> dict[str, DataFrame]:
    chosen = state_year_filter(df, states, years)
    return {
        "monthly": eda.monthly_median(chosen),
        "hourly": hourly_pattern(chosen),
        "yearly": yearly_mean(chosen),
    }


# --- page 3 -------------------------------------------------------------------

def state_box(df: DataFrame) -> DataFrame:
    return dist.box(dist.value_counts(df, ["State"], AQI), ["State"])


def _summary(df: DataFrame, keys: Sequence[str], with_spread: bool) -> DataFrame:
    """Statistics to one decimal, all from one table of value counts."""
    counts = dist.value_counts(df, keys, AQI)
    middle = dist.quantiles_of(counts, keys, {"Median": 0.5}, DIGITS).drop("_rows")
    joined = dist.join_groups(dist.moments_of(counts, keys), middle, keys)
    order = ["Mean", "Median", "Std", "Min", "Max"] if with_spread else ["Mean", "Median", "Max"]
    # 9 decimals first: noise of the last bits must not decide a tie
    cut = [round_even(F.round(c, 9), 1).alias(c) for c in order]
    return joined.select(*keys, *cut, "Count")


def state_summary(df: DataFrame) -> DataFrame:
    return _summary(df, ["State"], True)


def season_state_mean(df: DataFrame) -> DataFrame:
    means = df.groupBy("State", "Season").agg(rounded(exact_mean(F.col(AQI))).alias("Mean"))
    means = means.withColumn("SeasonRank", season_code("Season"))
    return means.orderBy("State", "SeasonRank")


def state_comparison(df: DataFrame, states: Sequence[str], years: tuple[int, int]) -> dict[str, DataFrame]:
    chosen = state_year_filter(df, states, years)
    return {
        "box": state_box(chosen),
        "categories": eda.category_share(chosen, include_empty=False),
        "summary": state_summary(chosen),
        "seasons": season_state_mean(chosen),
    }


# --- page 4 -------------------------------------------------------------------

def pollutant_violin(
    df: DataFrame, pollutant: str, prob: float = 0.99, points: int = 100, cut: float = 2.0
) -> DataFrame:
    """Density curve per state up to the 99th percentile over all states."""
    return dist.density(_state_counts(df, pollutant, prob), ["State"], points, cut)


def pollutant_box(df: DataFrame, pollutant: str, prob: float = 0.99) -> DataFrame:
    return dist.box(_state_counts(df, pollutant, prob), ["State"])


def _state_counts(df: DataFrame, pollutant: str, prob: float) -> DataFrame:
    return dist.trim_counts(dist.value_counts(df, ["State"], pollutant), prob)


def correlation_of(df: DataFrame, pollutants: Sequence[str] = INDEX_POLLUTANTS) -> DataFrame:
    """Correlation of the index and pollutants, to 2 decimals."""
    pairs = dist.correlations(df, [AQI, *present(df, pollutants)], digits=9)
    return pairs.withColumn("Corr", round_even(F.col("Corr"), 2))


def pollutants(
    df: DataFrame, states: Sequence[str], years: tuple[int, int], pollutant: str
) -> dict[str, DataFrame]:
    chosen = state_year_filter(df, states, years)
    return {
        "monthly": eda.monthly_median(chosen, pollutant),
        "violin": pollutant_violin(chosen, pollutant),
        "box": pollutant_box(chosen, pollutant),
        "correlation": correlation_of(chosen),
        "burn_daily": eda.burn_daily(chosen, pollutant),
    }


# --- page 6 -------------------------------------------------------------------

def city_summary(df: DataFrame) -> DataFrame:
    return _summary(df, ["City", "State"], False).orderBy(F.desc("Mean"), "City", "State")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First rows in station and time order: a top-k, not a full sort."""
    return df.orderBy("StationId", "Datetime").limit(n)


def export(df: DataFrame, results: DataFrame | None, folder: str) -> dict[str, str]:
    """The three CSV exports; model results only when there are some."""
    paths = {"data": f"{folder}/aqi_clean", "cities": f"{folder}/city_aqi_summary"}
    tables.write_csv(df, paths["data"])
    tables.write_csv(city_summary(df), paths["cities"])
    if results is not None:
        paths["models"] = f"{folder}/ml_results"
        tables.write_results(results, paths["models"])
    return paths


# --- profiles -----------------------------------------------------------------

def null_profile(df: DataFrame, cols: Sequence[str], n: int | None = 10) -> DataFrame:
    """Nulls per column, most first; one aggregate over the rows."""
    hits = [F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]
    long = df.agg(*hits).unpivot([], list(cols), "Column", "Nulls")
    long = long.orderBy(F.desc("Nulls"), "Column")
    return long if n is None else long.limit(n)


def quality_profile(stages: Mapping[str, DataFrame], cols: Sequence[str]) -> DataFrame:
    """Per stage: rows, rows lost since the stage before, null cells, time range,
    states and cities."""
    parts = []
    for rank, (name, df) in enumerate(stages.items()):
        nulls = [F.when(F.col(c).isNull(), 1).otherwise(0) for c in present(df, cols)]
        per_city = df.groupBy("State", "City").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(sum(nulls, F.lit(0))).alias("nulls"),
            F.min("Datetime").alias("first"),
            F.max("Datetime").alias("last"),
        )
        parts.append(
            per_city.agg(
                F.lit(rank).alias("Step"),
                F.lit(name).alias("Stage"),
                F.sum("n").alias("Rows"),
                F.sum("nulls").alias("NullCells"),
                F.min("first").alias("FirstTime"),
                F.max("last").alias("LastTime"),
                F.countDistinct("State").alias("States"),
                F.countDistinct("City").alias("Cities"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    before = F.lag("Rows").over(Window.orderBy("Step"))  # one row per stage
    return out.withColumn("Dropped", F.coalesce(before - F.col("Rows"), F.lit(0)))


class Watch:
    """The same figures gathered while a plan runs, by observed metrics.

    Put on a frame at each stage, ``watch`` adds nothing to the plan but sums in passing;
    ``table`` has them once an action has run the last frame.  States and cities are
    counted by sketches: exact as long as there are some hundreds, beyond that with a
    relative error of ``sketch.distinct_error``.
    """

    def __init__(self, cols: Sequence[str]):
        self.cols = cols
        self.stages: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        nulls = [F.when(F.col(c).isNull(), 1).otherwise(0) for c in present(df, self.cols)]
        moment = F.col("Datetime").try_cast("timestamp_ntz")
        several = [F.hll_sketch_estimate(F.hll_sketch_agg(F.col(c), F.lit(sketch.HLL_BITS))).alias(c) for c in ("State", "City")]
        self.stages[stage] = Observation(f"stage {stage}")
        return df.observe(
            self.stages[stage], F.count(F.lit(1)).alias("rows"), F.sum(sum(nulls, F.lit(0))).alias("nulls"),
            F.min(moment).alias("first"), F.max(moment).alias("last"), *several,
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows, before = [], None
        for step, (stage, seen) in enumerate(self.stages.items()):
            # What Spark finds to be empty before it runs gives no figures.
            got = seen.get if seen._jo.getRow().length() else dict.fromkeys(("rows", "nulls", "first", "last", "State", "City"))
            n = got["rows"] or 0
            rows.append((step, stage, n, got["nulls"] if n else None, got["first"], got["last"], got["State"] or 0, got["City"] or 0, 0 if before is None else before - n))
            before = n
        schema = "Step int, Stage string, Rows long, NullCells long, FirstTime timestamp_ntz, LastTime timestamp_ntz, States long, Cities long, Dropped long"
        return spark.createDataFrame(rows, schema)
