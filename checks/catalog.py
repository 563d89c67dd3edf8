"""Every check: a Spark query over a panel and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.constants import BREAKPOINTS, CATEGORIES, INDEX_POLLUTANTS, POLLUTANTS
from hazeframe.functions import index
from hazeframe.operators import distribution as dist
from hazeframe.operators import panel, segments
from hazeframe.plans import aqi, batch, clean, eda, features, findings, ml, reports
from hazeframe.sources import tables

from . import sql as S
from .panels import DAILY_TIE, REGION, SENSOR_TIE, Panel, daily, sensor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

IDS = ["StationId", "Datetime"]
NEAR = ["event_id", "StationId"]


def check(name: str, make: Callable[[SparkSession, str], DataFrame], oracle: str | None = None) -> None:
    QUERIES[name] = make
    if oracle is not None:
        ORACLES[name] = oracle


def on(kind: str, stage: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    """Query over one stage of a panel."""
    return lambda spark, sf_dir: f(getattr(Panel(spark, sf_dir, kind), stage))


def rounded(df: DataFrame, digits: int, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- clean --------------------------------------------------------------------

RAW_A = ["PM25", "PM10", "NOx", "NH3", "CO", "SO2", "O3", "AQI"]
raw_a = ", ".join(RAW_A)

check(
    "join_stations",
    on("sensor", "joined", lambda df: df.select(*NEAR, "Datetime", "StationName", "City", "State", "PM25")),
    S.chain("sensor", "joined") + " SELECT event_id, StationId, Datetime, StationName, City, State, PM25 FROM joined",
)
check(
    "join_filter_states",
    on("sensor", "in_states", lambda df: df.select(*NEAR, "Datetime", "City", "State", *RAW_A)),
    S.chain("sensor", "kept") + f" SELECT event_id, StationId, Datetime, City, State, {raw_a} FROM kept",
)
check(
    "filter_states",
    on("daily", "joined", lambda df: clean.filter_states(df, ("ASIA", "EUROPE")).select("StationId", "State", "Datetime", "PM10")),
    S.chain("daily", "joined") + " SELECT StationId, State, Datetime, PM10 FROM joined WHERE State IN ('ASIA', 'EUROPE')",
)
check(
    "parse_datetime",
    lambda s, d: clean.parse_datetime(sensor(s, d).readings).select(*NEAR, "Datetime"),
    S.chain("sensor", "raw") + " SELECT event_id, StationId, TRY_CAST(Datetime AS TIMESTAMP) AS Datetime FROM raw "
    "WHERE TRY_CAST(Datetime AS TIMESTAMP) IS NOT NULL",
)
CAL = ["Year", "Month", "Day", "Hour", "DayOfWeek", "IsWeekend", "Season", "CropBurning"]
for kind in ("sensor", "daily"):
    check(
        "calendar" if kind == "sensor" else "calendar_daily",
        on(kind, "dated", lambda df: df.select(*IDS, "State", *CAL)),
        S.chain(kind, "dated") + f" SELECT StationId, Datetime, State, {', '.join(CAL)} FROM dated",
    )


def _fill(backward: bool) -> Query:
    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = sensor(spark, sf_dir).dated
        order = ["Datetime", *SENSOR_TIE]
        cut = segments.split_hot(df, clean.KEY, order)
        cols = clean.present(df, POLLUTANTS)
        return panel.fill(cut, clean.KEY, order, cols, backward).select(*NEAR, "Datetime", *cols)

    return make


PAST = "PARTITION BY StationId ORDER BY Datetime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
a_cols = ", ".join(S.COLS["sensor"])
check(
    "ffill", _fill(False),
    S.chain("sensor", "dated") + " SELECT event_id, StationId, Datetime, "
    + ", ".join(f"last_value({c} IGNORE NULLS) OVER past AS {c}" for c in S.COLS["sensor"])
    + f" FROM dated WINDOW past AS ({PAST})",
)
check("ffill_bfill", _fill(True), S.chain("sensor", "filled") + f" SELECT event_id, StationId, Datetime, {a_cols} FROM filled")
clip_a = ", ".join(f"(CASE WHEN {c} < 0 THEN {S.d(0)} ELSE {c} END) + {S.d(0)} AS {c}" for c in S.COLS["sensor"])
check(
    "clip_negative",
    lambda s, d: clean.clip_negative(sensor(s, d).readings).select("event_id", *S.COLS["sensor"]),
    S.chain("sensor", "raw") + f" SELECT event_id, {clip_a} FROM raw",
)
check(
    "drop_core_null",
    lambda s, d: clean.drop_core_null(sensor(s, d).readings).select("event_id", *S.COLS["sensor"]),
    S.chain("sensor", "raw") + f" SELECT event_id, {a_cols} FROM raw WHERE PM25 IS NOT NULL OR PM10 IS NOT NULL OR SO2 IS NOT NULL OR NOx IS NOT NULL",
)
check(
    "impute_daily",
    on("daily", "dated", lambda df: clean.impute(df, DAILY_TIE).select("l_orderkey", "l_linenumber", *IDS, *S.COLS["daily"])),
    S.chain("daily", "clipped") + f" SELECT l_orderkey, l_linenumber, StationId, Datetime, {', '.join(S.COLS['daily'])} FROM clipped",
)
check(
    "dedup",
    lambda s, d: clean.dedup(daily(s, d).readings, DAILY_TIE).select(*IDS, "l_orderkey", "l_linenumber", *S.COLS["daily"]),
    S.chain("daily", "raw") + f""" SELECT StationId, Datetime, l_orderkey, l_linenumber, {', '.join(S.COLS['daily'])}
    FROM (SELECT *, row_number() OVER (PARTITION BY StationId, Datetime ORDER BY {S.TIES['daily']}) AS rn FROM raw) WHERE rn = 1""",
)
check("finalise", on("daily", "clean", lambda df: df), S.chain("daily", "clean") + " SELECT * FROM clean")
check("clean_panel", on("sensor", "clean", lambda df: df), S.chain("sensor", "clean") + " SELECT * FROM clean")

# --- index --------------------------------------------------------------------

MEANS = ["PM25_24h", "PM10_24h", "SO2_24h", "NOx_24h", "NH3_24h"]
MAXES = ["CO_8h", "O3_8h"]
SI = [f"SI_{p}" for p in S.INDEX_COLS]
check(
    "rolling_mean_24", on("sensor", "exposed", lambda df: df.select(*IDS, *MEANS)),
    S.chain("sensor", "expo") + f" SELECT StationId, Datetime, {', '.join(MEANS)} FROM expo",
)
check(
    "rolling_max_8", on("sensor", "exposed", lambda df: df.select(*IDS, *MAXES)),
    S.chain("sensor", "expo") + f" SELECT StationId, Datetime, {', '.join(MAXES)} FROM expo",
)
check(
    "exposures_daily", on("daily", "exposed", lambda df: df.select(*IDS, *MEANS, *MAXES)),
    S.chain("daily", "expo") + f" SELECT StationId, Datetime, {', '.join(MEANS + MAXES)} FROM expo",
)
check(
    "sub_index", on("sensor", "exposed", lambda df: aqi.sub_indices(df).select(*IDS, *SI)),
    S.chain("sensor", "si") + f" SELECT StationId, Datetime, {', '.join(SI)} FROM si",
)


def _sub_index_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sensor(spark, sf_dir).readings
    made = [index.sub_index(p, BREAKPOINTS[p]).alias(f"SI_{p}") for p in INDEX_POLLUTANTS]
    return df.select("event_id", *made)


check(
    "sub_index_raw", _sub_index_raw,
    S.chain("sensor", "raw") + " SELECT event_id, "
    + ", ".join(f"{S.sub_index(p, p)} AS SI_{p}" for p in S.INDEX_COLS) + " FROM raw",
)
check(
    "sub_index_rangejoin",
    lambda s, d: aqi.sub_index_by_lookup(sensor(s, d).readings, "O3", "O3", "SI_O3").select("event_id", "O3", "SI_O3"),
    S.chain("sensor", "raw") + f" SELECT event_id, O3, {S.sub_index('O3', 'O3')} AS SI_O3 FROM raw",
)
check(
    "aqi_calculated", on("sensor", "exposed", lambda df: aqi.calculated(aqi.sub_indices(df)).select(*IDS, "AQI_Calculated")),
    S.chain("sensor", "si") + f" SELECT StationId, Datetime, greatest({', '.join(SI)}) AS AQI_Calculated FROM si",
)
check(
    "aqi_final", on("sensor", "indexed", lambda df: df.select(*IDS, "AQI", "AQI_Calculated", "AQI_Final")),
    S.chain("sensor", "aqi") + " SELECT StationId, Datetime, AQI, AQI_Calculated, AQI_Final FROM aqi",
)
check(
    "aqi_category", on("sensor", "indexed", lambda df: df.select(*IDS, "AQI_Final", "AQI_Category")),
    S.chain("sensor", "aqi") + " SELECT StationId, Datetime, AQI_Final, AQI_Category FROM aqi",
)
check(
    "dominant_pollutant", on("sensor", "indexed", lambda df: df.select(*IDS, "DominantPollutant")),
    S.chain("sensor", "aqi") + " SELECT StationId, Datetime, DominantPollutant FROM aqi",
)
check("aqi_table", on("sensor", "indexed", lambda df: df), S.chain("sensor", "aqi") + " SELECT * FROM aqi")
check("aqi_table_daily", on("daily", "indexed", lambda df: df), S.chain("daily", "aqi") + " SELECT * FROM aqi")

A = S.chain("sensor", "aqi")
B = S.chain("daily", "aqi")

# --- profiles -----------------------------------------------------------------

check(
    "preview",
    on("sensor", "indexed", lambda df: reports.preview(df, 500).select(*IDS, "City", "State", "AQI_Final", "AQI_Category", "DominantPollutant")),
    A + " SELECT StationId, Datetime, City, State, AQI_Final, AQI_Category, DominantPollutant FROM aqi ORDER BY StationId, Datetime LIMIT 500",
)
# Every column of the feature table, helper columns of the check panel aside.
check(
    "null_profile", on("sensor", "featured", lambda df: reports.null_profile(df, S.feature_names("sensor"), None)),
    S.chain("sensor", "feat") + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"Column\", count(*) FILTER (WHERE {c} IS NULL) AS Nulls FROM feat" for c in S.feature_names("sensor")
    ),
)
NULLED = ["AQI", "AQI_Category", "DominantPollutant", *IDS, "City", "State", *MEANS, *MAXES, *SI, "PM25", "PM10", "NOx"]
check(
    "null_profile_index", on("sensor", "indexed", lambda df: reports.null_profile(df, NULLED)),
    A + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"Column\", count(*) FILTER (WHERE {c} IS NULL) AS Nulls FROM aqi" for c in NULLED
    ) + ") ORDER BY Nulls DESC, \"Column\" LIMIT 10",
)


def _quality_oracle() -> str:
    parts = []
    stages = [("joined", "joined"), ("states", "kept"), ("dated", "dated"), ("filled", "clipped"),
              ("clean", "clean"), ("index", "aqi"), ("features", "feat")]
    for i, (label, source) in enumerate(stages):
        nulls = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in S.COLS["sensor"])
        t = "TRY_CAST(Datetime AS TIMESTAMP)"
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS Step, '{label}' AS Stage, count(*) AS Rows, CAST(sum({nulls}) AS BIGINT) AS NullCells, "
            f"min({t}) AS FirstTime, max({t}) AS LastTime, count(DISTINCT State) AS States, count(DISTINCT City) AS Cities FROM {source}"
        )
    union = " UNION ALL ".join(parts)
    return S.chain("sensor", "feat") + f" SELECT *, coalesce(lag(Rows) OVER (ORDER BY Step) - Rows, 0) AS Dropped FROM ({union})"


check(
    "quality_profile",
    lambda s, d: batch.quality(sensor(s, d).readings, sensor(s, d).stations, REGION, SENSOR_TIE),
    _quality_oracle(),
)

# --- group analyses -----------------------------------------------------------

check(
    "monthly_median_aqi", on("daily", "indexed", eda.monthly_median),
    B + f" SELECT State, last_day(Datetime) AS MonthEnd, {S.median('AQI_Final')} AS Median_AQI_Final FROM aqi GROUP BY ALL",
)
check(
    "monthly_median_pm25", on("daily", "indexed", eda.monthly_median_pm25),
    B + f""" SELECT *, CAST(15 AS DOUBLE) AS WhoLimit, CAST(60 AS DOUBLE) AS CpcbLimit,
      CAST(CASE WHEN Median_PM25 > 15 THEN 1 ELSE 0 END AS INTEGER) AS AboveWho,
      CAST(CASE WHEN Median_PM25 > 60 THEN 1 ELSE 0 END AS INTEGER) AS AboveCpcb
    FROM (SELECT State, last_day(Datetime) AS MonthEnd, {S.median('PM25')} AS Median_PM25 FROM aqi WHERE PM25 IS NOT NULL GROUP BY ALL)""",
)
check(
    "monthly_median_pm10", on("daily", "indexed", eda.monthly_median_pm10),
    B + f""" SELECT *, CAST(100 AS DOUBLE) AS CpcbLimit,
      CAST(CASE WHEN Median_PM10 > 100 THEN 1 ELSE 0 END AS INTEGER) AS AboveCpcb
    FROM (SELECT State, last_day(Datetime) AS MonthEnd, {S.median('PM10')} AS Median_PM10 FROM aqi WHERE PM10 IS NOT NULL GROUP BY ALL)""",
)
check(
    "monthly_median_pollutant", on("daily", "indexed", lambda df: eda.monthly_median(df, "NOx")),
    B + f" SELECT State, last_day(Datetime) AS MonthEnd, {S.median('NOx')} AS Median_NOx FROM aqi WHERE NOx IS NOT NULL GROUP BY ALL",
)
check(
    "state_mean_ci", on("sensor", "indexed", eda.state_mean_ci),
    A + f""" SELECT State, {S.r6(S.mean())} AS Mean, {S.r6('stddev_samp(AQI_Final)')} AS Std, count(AQI_Final) AS Count,
      {S.r6('1.96 * stddev_samp(AQI_Final) / sqrt(count(AQI_Final))')} AS CI95 FROM aqi GROUP BY State""",
)
for n in (15, 10):
    tag = ", City || ' (' || substr(State, 1, 2) || ')' AS Label" if n == 10 else ""
    check(
        f"top{n}_cities",
        on("sensor", "indexed", (lambda df: eda.top_cities(df, 15)) if n == 15 else eda.top_cities_labelled),
        A + f" SELECT City, State, Mean{tag} FROM (SELECT City, State, {S.r6(S.mean())} AS Mean FROM aqi GROUP BY City, State) ORDER BY Mean DESC, City, State LIMIT {n}",
    )
CELLS = """cells AS (SELECT s.State, c.AQI_Category, count(a.State) AS Count
  FROM (SELECT DISTINCT State FROM aqi) s
  CROSS JOIN (SELECT unnest(['Good', 'Satisfactory', 'Moderate', 'Poor', 'Very Poor', 'Severe']) AS AQI_Category) c
  LEFT JOIN aqi a ON a.State = s.State AND a.AQI_Category = c.AQI_Category GROUP BY ALL)"""
SHARE = f"""SELECT State, AQI_Category, Count,
  round(100 * Count / nullif(CAST(sum(Count) OVER (PARTITION BY State) AS DOUBLE), 0), 6) AS Pct, CAST({S.CAT_RANK} AS INTEGER) AS Rank FROM cells"""
check("category_share", on("daily", "indexed", eda.category_share), B + f", {CELLS} {SHARE}")
check(
    "category_share_observed", on("daily", "indexed", lambda df: eda.category_share(df, include_empty=False)),
    B + f", {CELLS} SELECT * FROM ({SHARE}) WHERE Count > 0",
)
check(
    "category_pivot", on("daily", "indexed", eda.category_pivot),
    B + f", {CELLS}, shares AS ({SHARE}) SELECT State, " + ", ".join(
        f"coalesce(max(Pct) FILTER (WHERE AQI_Category = '{c}'), 0) AS \"{c}\"" for c in CATEGORIES
    ) + " FROM shares GROUP BY State",
)
check(
    "category_counts", on("sensor", "indexed", eda.category_counts),
    A + " SELECT AQI_Category, count(*) AS Count FROM aqi WHERE AQI_Category IS NOT NULL GROUP BY AQI_Category",
)
check(
    "band_shares", on("sensor", "indexed", eda.band_shares),
    A + " SELECT AQI_Category AS Band, count(*) AS Count, round(100 * count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS Pct "
    "FROM aqi WHERE AQI_Category IS NOT NULL GROUP BY AQI_Category",
)
YEARLY = f"yearly AS (SELECT State, Year, {S.mean()} AS M, stddev_samp(AQI_Final) / sqrt(count(AQI_Final)) AS E FROM aqi GROUP BY State, Year)"
check(
    "yearly_mean_sem", on("daily", "indexed", eda.yearly_mean_sem),
    B + f", {YEARLY} SELECT State, Year, {S.r6('M')} AS Mean, {S.r6('E')} AS Sem, {S.r6('1.96 * E')} AS Bar FROM yearly",
)


def _trend_oracle(where: str = "TRUE") -> str:
    return (
        B + f", {YEARLY}, fit AS (SELECT State, regr_slope(M, Year) AS sl, regr_intercept(M, Year) AS ic FROM yearly WHERE {where} GROUP BY State HAVING count(*) > 2)"
        f" SELECT State, Year, {S.r6('M')} AS Mean, {S.r6('sl')} AS Slope, round(ic, 4) AS Intercept, {S.r6('ic + sl * Year')} AS Fitted"
        f" FROM yearly JOIN fit USING (State) WHERE {where}"
    )


check("yearly_trend_fit", on("daily", "indexed", eda.yearly_trend), _trend_oracle())
check(
    "yearly_mean", on("daily", "indexed", reports.yearly_mean),
    B + f" SELECT State, Year, {S.r6(S.mean())} AS Mean FROM aqi GROUP BY State, Year",
)
check(
    "hourly_pattern", on("sensor", "indexed", reports.hourly_pattern),
    A + f" SELECT State, Hour, {S.r6(S.mean())} AS Mean FROM aqi GROUP BY State, Hour",
)
check(
    "season_state_mean", on("daily", "indexed", reports.season_state_mean),
    B + f" SELECT State, Season, {S.r6(S.mean())} AS Mean, CAST({S.SEASON_CODE} AS INTEGER) AS SeasonRank FROM aqi GROUP BY State, Season",
)


def _summary_oracle(keys: str, spread: bool) -> str:
    one = lambda e: f"round_even(round({e}, 9), 1)"
    more = f", {one('stddev_samp(AQI_Final)')} AS Std, {one('min(AQI_Final)')} AS Min" if spread else ""
    return (
        f" SELECT {keys}, {one(S.mean())} AS Mean, {one(S.median('AQI_Final'))} AS Median, "
        f"{one('max(AQI_Final)')} AS Max{more}, count(AQI_Final) AS Count FROM aqi GROUP BY {keys}"
    )


check("state_summary", on("daily", "indexed", reports.state_summary), B + _summary_oracle("State", True))
check("city_summary", on("sensor", "indexed", reports.city_summary), A + _summary_oracle("City, State", False))
check(
    "burn_by_timestamp", on("daily", "indexed", lambda df: eda.burn_by_timestamp(df, REGION, (1994, 1997))),
    B + f""" SELECT State, Datetime, {S.median('AQI_Final')} AS Median_AQI,
      CAST(CASE WHEN month(Datetime) * 100 + day(Datetime) BETWEEN 1015 AND 1130
      AND year(Datetime) BETWEEN 1994 AND 1997 THEN 1 ELSE 0 END AS INTEGER) AS InBurnWindow
    FROM aqi WHERE State IN {S.BURN_CHART} AND Month IN (9, 10, 11, 12) GROUP BY State, Datetime""",
)
check(
    "burn_daily", on("daily", "indexed", lambda df: eda.burn_daily(df, "PM25", None)),
    B + f""" SELECT *, CAST(CASE WHEN month(Date) * 100 + day(Date) BETWEEN 1015 AND 1130 THEN 1 ELSE 0 END AS INTEGER) AS InBurnWindow
    FROM (SELECT State, CAST(Datetime AS DATE) AS Date, {S.median('PM25')} AS Median_PM25 FROM aqi
      WHERE Month IN (9, 10, 11, 12) AND PM25 IS NOT NULL GROUP BY ALL)""",
)
check(
    "burn_window_flag",
    on("daily", "indexed", lambda df: eda.burn_window_flag(df, (1996, 2000)).select(*IDS, "InBurnWindow")),
    B + """ SELECT StationId, Datetime, CAST(CASE WHEN month(Datetime) * 100 + day(Datetime) BETWEEN 1015 AND 1130
      AND Year BETWEEN 1996 AND 2000 THEN 1 ELSE 0 END AS INTEGER) AS InBurnWindow FROM aqi""",
)
check(
    "kpis", on("sensor", "indexed", reports.kpis),
    A + f""" SELECT count(DISTINCT StationId) AS Stations, count(DISTINCT City) AS Cities, count(*) AS Records,
      CAST(min(Year) AS INTEGER) AS FirstYear, CAST(max(Year) AS INTEGER) AS LastYear, {S.r6(S.mean())} AS MeanAQI FROM aqi""",
)
check(
    "filter_domains", on("daily", "indexed", reports.filter_domains),
    B + " SELECT State, min(Year) AS FirstYear, max(Year) AS LastYear FROM aqi GROUP BY State",
)
check(
    "state_map", on("sensor", "indexed", lambda df: reports.state_map(df, REGION)),
    A + f""" SELECT p.State, Lat, Lon, m.AQI FROM (VALUES ('AFRICA', {S.d(2)}, {S.d(16)}), ('AMERICA', {S.d(39)}, {S.d(-98)}),
      ('ASIA', {S.d(34)}, {S.d(100)}), ('EUROPE', {S.d(54)}, {S.d(15)})) AS p(State, Lat, Lon)
    LEFT JOIN (SELECT State, {S.r6(S.mean())} AS AQI FROM aqi GROUP BY State) m ON p.State = m.State""",
)
check(
    "state_year_filter",
    on("daily", "indexed", lambda df: reports.state_year_filter(df, ["AFRICA", "ASIA"], (1997, 1999)).select(*IDS, "State", "Year", "AQI_Final")),
    B + " SELECT StationId, Datetime, State, Year, AQI_Final FROM aqi WHERE State IN ('AFRICA', 'ASIA') AND Year BETWEEN 1997 AND 1999",
)

# --- distributions ------------------------------------------------------------


def _histogram_oracle(source: str, keys: list[str], value: str, bins: int, where: str = "TRUE") -> str:
    """CTEs ``vals`` .. ``binned`` of a histogram per key (or of everything)."""
    k = ", ".join(keys)
    sel = f"{k}, " if keys else ""
    using = f"JOIN rng USING ({k})" if keys else "CROSS JOIN rng"
    grp = f" GROUP BY {k}" if keys else ""
    of = "".join(f"rng.{c}, " for c in keys)
    same = "".join(f"bin_counts.{c} = rng.{c} AND " for c in keys)
    return f"""vals AS (SELECT {sel}{value} AS v FROM {source} WHERE {value} IS NOT NULL AND {where}),
rng0 AS (SELECT {sel}min(v) AS lo0, max(v) AS hi0, count(*) AS n FROM vals{grp}),
rng AS (SELECT {sel}n, CASE WHEN lo0 < hi0 THEN lo0 ELSE lo0 - 0.5 END AS lo,
    (CASE WHEN lo0 < hi0 THEN hi0 - lo0 ELSE 1 END) / CAST({bins} AS DOUBLE) AS w FROM rng0),
bin_counts AS (SELECT {sel}CAST(least(floor((v - lo) / w), {bins - 1}) AS INTEGER) AS Bin, count(*) AS c FROM vals {using} GROUP BY ALL),
binned AS (SELECT {of}CAST(b AS INTEGER) AS Bin, coalesce(c, 0) AS Count, lo, w, n
    FROM rng CROSS JOIN range(0, {bins}) AS r(b) LEFT JOIN bin_counts ON {same}bin_counts.Bin = b)"""


def _hist_select(keys: list[str], more: str = "") -> str:
    sel = "".join(f"{k}, " for k in keys)
    return (
        f" SELECT {sel}Bin, round(lo + w * Bin, 8) AS BinLow, round(lo + w * (Bin + 1), 8) AS BinHigh, Count, "
        f"round(Count / (n * w), 8) AS Density{more} FROM binned"
    )


def _density_oracle(vals: str, keys: list[str], points: int, cut: float, extend: float) -> str:
    """CTEs over ``vals(keys, v)`` ending in ``curve``."""
    k = ", ".join(keys)
    sel = f"{k}, " if keys else ""
    using = f"JOIN grid USING ({k})" if keys else "CROSS JOIN grid"
    grp = f" GROUP BY {k}" if keys else ""
    return f"""distinct_vals AS (SELECT {sel}v, count(*) AS n FROM {vals} GROUP BY ALL),
grid0 AS (SELECT {sel}min(v) AS lo, max(v) AS hi, count(*) AS cnt, nullif(stddev_samp(v), 0) * pow(count(*), -0.2) AS bw FROM {vals}{grp}),
grid AS (SELECT {sel}cnt, bw, lo - bw * {S.d(cut)} - (hi - lo) * {S.d(extend)} AS g0,
   ((hi - lo) + 2 * (bw * {S.d(cut)} + (hi - lo) * {S.d(extend)})) / {S.d(points - 1)} AS step FROM grid0),
curve AS (SELECT {sel}CAST(p AS INTEGER) AS Point, round(any_value(g0) + any_value(step) * p, 8) AS X,
   round(sum(n * exp(-0.5 * pow((g0 + step * p - v) / bw, 2))) / (any_value(cnt) * any_value(bw) * sqrt(2 * pi())), 8) AS Density
   FROM distinct_vals {using} CROSS JOIN range(0, {points}) AS r(p) WHERE bw IS NOT NULL GROUP BY {sel}p)"""


check(
    "aqi_histogram", on("sensor", "indexed", eda.aqi_histogram),
    A + ", " + _histogram_oracle("aqi", [], "AQI_Final", 60)
    + f", mid AS (SELECT {S.r6(S.mean())} AS Mean, {S.median('AQI_Final')} AS Median FROM aqi)"
    + _hist_select([], ", Mean, Median") + " CROSS JOIN mid",
)
check(
    "aqi_kde", on("sensor", "indexed", eda.aqi_density),
    A + ", vals AS (SELECT AQI_Final AS v FROM aqi), " + _density_oracle("vals", [], 200, 0, 0) + " SELECT * FROM curve",
)


def _box_oracle(keys: list[str], source: str = "aqi", value: str = "AQI_Final", where: str = "TRUE") -> str:
    k = ", ".join(keys)
    ins = "v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f""", bx AS (SELECT {k}, {value} AS v FROM {source} WHERE {value} IS NOT NULL AND {where}),
qs AS (SELECT {k}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3, count(*) AS n FROM bx GROUP BY {k})
SELECT {k}, round(q1, 6) AS Q1, round(q2, 6) AS Median, round(q3, 6) AS Q3, n AS Count,
  round(min(v) FILTER (WHERE {ins}), 6) AS WhiskerLow, round(max(v) FILTER (WHERE {ins}), 6) AS WhiskerHigh,
  count(*) FILTER (WHERE NOT ({ins})) AS Outliers,
  round(q2 - 1.57 * (q3 - q1) / sqrt(n), 6) AS NotchLow, round(q2 + 1.57 * (q3 - q1) / sqrt(n), 6) AS NotchHigh
FROM bx JOIN qs USING ({k}) GROUP BY {k}, q1, q2, q3, n"""


check("month_box", on("daily", "indexed", eda.month_box), B + _box_oracle(["Month"]))
check(
    "winter_vs_spring_box", on("daily", "indexed", eda.winter_vs_spring_box),
    B + _box_oracle(["State", "Season"], where="Season IN ('Winter', 'Spring')"),
)
check("state_box", on("daily", "indexed", reports.state_box), B + _box_oracle(["State"]))
check(
    "season_violin", on("daily", "indexed", eda.season_violin),
    B + ", vals AS (SELECT Season, AQI_Final AS v FROM aqi), " + _density_oracle("vals", ["Season"], 100, 2, 0)
    + """, qs AS (SELECT Season, round(quantile_cont(v, 0.25), 6) AS Q1, round(quantile_cont(v, 0.5), 6) AS Median,
      round(quantile_cont(v, 0.75), 6) AS Q3 FROM vals GROUP BY Season) SELECT * FROM curve JOIN qs USING (Season)""",
)
TRIM = ", cap AS (SELECT quantile_cont(PM10, 0.99) AS c FROM aqi), vals AS (SELECT State, PM10 AS v FROM aqi CROSS JOIN cap WHERE PM10 <= c)"
check(
    "pollutant_violin", on("daily", "indexed", lambda df: reports.pollutant_violin(df, "PM10")),
    B + TRIM + ", " + _density_oracle("vals", ["State"], 100, 2, 0) + " SELECT * FROM curve",
)
check("pollutant_box", on("daily", "indexed", lambda df: reports.pollutant_box(df, "PM10")), B + TRIM + _box_oracle(["State"], "vals", "v"))
LONG = ", long AS (" + " UNION ALL ".join(
    f"SELECT '{p}' AS Pollutant, {p} AS Value FROM aqi WHERE {p} IS NOT NULL" for p in S.INDEX_COLS
) + """), caps AS (SELECT Pollutant, quantile_cont(Value, 0.99) AS c FROM long GROUP BY Pollutant),
trimmed AS (SELECT Pollutant, Value FROM long JOIN caps USING (Pollutant) WHERE Value <= c)"""
check(
    "p99_trim", on("sensor", "indexed", eda.trimmed_summary),
    A + LONG + f" SELECT Pollutant, count(*) AS Kept, round(max(Value), 6) AS Largest, {S.median('Value')} AS Median FROM trimmed GROUP BY Pollutant",
)
check(
    "p99_trim_rows", on("daily", "indexed", lambda df: dist.trim_above(df, "PM25").select(*IDS, "PM25")),
    B + " SELECT StationId, Datetime, PM25 FROM aqi WHERE PM25 <= (SELECT quantile_cont(PM25, 0.99) FROM aqi)",
)
check(
    "pollutant_histograms", on("sensor", "indexed", eda.pollutant_histograms),
    A + LONG + ", " + _histogram_oracle("trimmed", ["Pollutant"], "Value", 50) + _hist_select(["Pollutant"]),
)
check(
    "pollutant_densities", on("sensor", "indexed", eda.pollutant_densities),
    A + LONG + ", vals AS (SELECT Pollutant, Value AS v FROM trimmed), "
    + _density_oracle("vals", ["Pollutant"], 1000, 0, 0.5) + " SELECT * FROM curve",
)


def _corr_oracle(cols: list[str], how: str) -> str:
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    both = "CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    parts = []
    for a, b in pairs:
        x, y = both.format(a=a, b=b), both.format(a=b, b=a)
        flat = f"min({x}) = max({x}) OR min({y}) = max({y})"
        parts.append(
            f"SELECT '{a}' AS ColA, '{b}' AS ColB, CASE WHEN {flat} THEN NULL ELSE {how.format(c=f'corr({x}, {y})')} END AS Corr FROM aqi"
        )
    return " " + " UNION ALL ".join(parts)


COR_A = ["AQI_Final", *S.INDEX_COLS, "Month", "Hour", "Year"]
COR_B = ["AQI_Final", "PM25", "PM10", "SO2", "NOx", "Month", "Hour", "Year"]
check("correlation", on("sensor", "indexed", eda.correlation), A + _corr_oracle(COR_A, "round({c}, 6)"))
check("correlation_daily", on("daily", "indexed", eda.correlation), B + _corr_oracle(COR_B, "round({c}, 6)"))
check(
    "correlation_filtered",
    on("daily", "indexed", lambda df: reports.correlation_of(reports.state_year_filter(df, ["AFRICA", "ASIA"], (1997, 1999)))),
    B.replace("aqi AS MATERIALIZED", "whole AS MATERIALIZED")
    + ", aqi AS (SELECT * FROM whole WHERE State IN ('AFRICA', 'ASIA') AND Year BETWEEN 1997 AND 1999)"
    + _corr_oracle(["AQI_Final", "PM25", "PM10", "SO2", "NOx"], "round_even(round({c}, 9), 2)"),
)

# --- features -----------------------------------------------------------------

LAGS = ["AQI_Lag1", "AQI_Lag3", "AQI_Lag6", "AQI_Lag24"]
ROLLS = ["AQI_Roll3", "AQI_Roll6", "AQI_Roll24"]
DELTAS = ["AQI_Delta1", "AQI_Delta6"]
CYC = ["Month_Sin", "Month_Cos", "Hour_Sin", "Hour_Cos", "DoW_Sin", "DoW_Cos"]
HIST = S.chain("sensor", "hist")


def _history(cols: list[str]) -> Query:
    return on("sensor", "indexed", lambda df: features.history(df).select(*IDS, *cols))


for name, cols in (("aqi_lags", LAGS), ("aqi_rolls", ROLLS), ("aqi_deltas", DELTAS)):
    check(name, _history(cols), HIST + f" SELECT StationId, Datetime, {', '.join(cols)} FROM hist")
check(
    "aqi_next_hour", on("sensor", "indexed", lambda df: features.history(df, horizon=1).select(*IDS, "AQI_Final", "Target")),
    A + " SELECT StationId, Datetime, AQI_Final, lead(AQI_Final) OVER (PARTITION BY StationId ORDER BY Datetime) AS Target FROM aqi",
)


def _feature_select(kind: str) -> str:
    cols = [f"round({c}, 9) AS {c}" if c in CYC else c for c in S.feature_names(kind)]
    return f" SELECT StationId, Datetime, AQI_Final, {', '.join(cols)} FROM feat"


def _matrix(df: DataFrame) -> DataFrame:
    return rounded(df.select(*IDS, "AQI_Final", *features.columns(df, REGION)), 9, CYC)


check("features", on("sensor", "featured", _matrix), S.chain("sensor", "feat") + _feature_select("sensor"))
check("features_daily", on("daily", "featured", _matrix), S.chain("daily", "feat") + _feature_select("daily"))
check(
    "feature_matrix",
    on("sensor", "featured", lambda df: rounded(df.select(*IDS, *features.columns(df, REGION, include_pollutants=False)), 9, CYC)),
    S.chain("sensor", "feat") + " SELECT StationId, Datetime, "
    + ", ".join(f"round({c}, 9) AS {c}" if c in CYC else c for c in S.feature_names("sensor")[:23]) + " FROM feat",
)
check(
    "cyclical", on("daily", "dated", lambda df: rounded(features.encode_calendar(df, REGION).select(*IDS, *CYC, "Season_Enc"), 9, CYC)),
    S.chain("daily", "dated") + " SELECT StationId, Datetime, "
    + ", ".join(
        f"round({f}(2 * pi() * {c} / {n}), 9) AS {lab}_{f.capitalize()}"
        for lab, c, n in (("Month", "Month", 12), ("Hour", "Hour", 24), ("DoW", "DayOfWeek", 7)) for f in ("sin", "cos")
    ) + f", CAST({S.SEASON_CODE} AS INTEGER) AS Season_Enc FROM dated",
)
ONE_HOT = [f"State_{s}" for s in REGION.states]
check(
    "state_onehot", on("sensor", "joined", lambda df: features.one_hot_states(df, REGION.states).select("event_id", *ONE_HOT)),
    S.chain("sensor", "joined") + " SELECT event_id, "
    + ", ".join(f"CAST(CASE WHEN State = '{s}' THEN 1 ELSE 0 END AS INTEGER) AS State_{s}" for s in REGION.states) + " FROM joined",
)

# --- models: what SQL can check -----------------------------------------------

FEAT_A = S.chain("sensor", "feat")
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in S.feature_names("sensor"))
CASES = FEAT_A + f", cases AS MATERIALIZED (SELECT * FROM feat WHERE {COMPLETE})"
SPLIT = CASES + """, cut AS (SELECT Datetime AS c FROM (SELECT Datetime, row_number() OVER (ORDER BY Datetime) - 1 AS pos,
    count(*) OVER () AS n FROM cases) WHERE pos = CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT)),
  test AS MATERIALIZED (SELECT cases.* FROM cases CROSS JOIN cut WHERE Datetime >= c)"""


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sensor(spark, sf_dir).featured
    return ml.complete_cases(df, features.columns(df, REGION))


def _naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with two forecasts that need no model: last value and last mean."""
    test = ml.temporal_split(tables.checkpoint(_cases(spark, sf_dir)))[1]
    return test.withColumns({"Pred_Last_Value": F.col("AQI_Lag1"), "Pred_Last_Day": F.col("AQI_Lag24")})


NAIVE = ["Last Value", "Last Day"]
check(
    "ml_complete_cases", lambda s, d: _cases(s, d).select(*IDS, "AQI_Final"),
    CASES + " SELECT StationId, Datetime, AQI_Final FROM cases",
)


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = ml.temporal_split(tables.checkpoint(_cases(spark, sf_dir)))
    parts = [p.select(*IDS, F.lit(n).alias("Part")) for n, p in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


check(
    "temporal_split", _split,
    SPLIT + " SELECT StationId, Datetime, CASE WHEN Datetime < c THEN 'train' ELSE 'test' END AS Part FROM cases CROSS JOIN cut",
)


def _metrics_sql(name: str, col: str) -> str:
    return (
        f"SELECT '{name}' AS Model, round(sqrt(avg(pow(AQI_Final - {col}, 2))), 6) AS RMSE, round(avg(abs(AQI_Final - {col})), 6) AS MAE, "
        f"round(1 - sum(pow(AQI_Final - {col}, 2)) / (var_pop(AQI_Final) * count(*)), 6) AS R2 FROM test"
    )


METRICS = ["RMSE", "MAE", "R2"]
check(
    "ml_metrics", lambda s, d: rounded(ml.evaluate(_naive(s, d), "Pred_Last_Value", "Last Value"), 6, METRICS),
    SPLIT + " " + _metrics_sql("Last Value", "AQI_Lag1"),
)
BOTH = _metrics_sql("Last Value", "AQI_Lag1") + " UNION ALL " + _metrics_sql("Last Day", "AQI_Lag24")
check(
    "ml_comparison", lambda s, d: rounded(ml.comparison(_naive(s, d), NAIVE), 6, METRICS), SPLIT + " " + BOTH,
)
check(
    "best_model", lambda s, d: rounded(ml.best_model(ml.comparison(_naive(s, d), NAIVE)), 6, METRICS),
    SPLIT + f" SELECT * FROM ({BOTH}) ORDER BY RMSE, Model LIMIT 1",
)
check(
    "ml_actual_vs_predicted", lambda s, d: rounded(ml.actual_vs_predicted(_naive(s, d), NAIVE), 6, ["R2"]),
    SPLIT + " " + " UNION ALL ".join(
        f"""SELECT '{n}' AS Model, count({c}) AS Pairs, least(min(AQI_Final), min({c})) AS Low, greatest(max(AQI_Final), max({c})) AS High,
        round(1 - sum(pow(AQI_Final - {c}, 2)) / (var_pop(AQI_Final) * count(*)), 6) AS R2 FROM test"""
        for n, c in (("Last Value", "AQI_Lag1"), ("Last Day", "AQI_Lag24"))
    ),
)
RESID = ", res AS (SELECT round(AQI_Final - AQI_Lag1, 6) AS v FROM test)"
check(
    "ml_residuals", lambda s, d: rounded(ml.residual_summary(_naive(s, d), "Last Value"), 6, ["Mean", "Std"]),
    SPLIT + " SELECT 'Last Value' AS Model, count(*) AS Count, round(avg(AQI_Final - AQI_Lag1), 6) AS Mean, "
    "round(stddev_pop(AQI_Final - AQI_Lag1), 6) AS Std FROM test",
)
check(
    "ml_residual_histogram", lambda s, d: ml.residual_histogram(_naive(s, d), "Last Value"),
    SPLIT + RESID + ", " + _histogram_oracle("res", [], "v", 60) + _hist_select([]),
)
check(
    "ml_residual_kde", lambda s, d: ml.residual_density(_naive(s, d), "Last Value"),
    SPLIT + RESID + ", " + _density_oracle("res", [], 200, 0, 0) + " SELECT * FROM curve",
)


def _requests(df: DataFrame) -> DataFrame:
    return df.select(
        *IDS, "State", F.col("Month").alias("month"), F.col("Hour").alias("hour"), F.col("DayOfWeek").alias("dow"),
        *[F.col(f"AQI_Lag{n}").alias(f"aqi_lag{n}") for n in (1, 3, 6, 24)],
    )


REQUEST = ["AQI_Roll3", "AQI_Roll6", "AQI_Roll24", "AQI_Delta1", "AQI_Delta6", *CYC, "Season_Enc", "IsWeekend", "CropBurning", "Year", *ONE_HOT]
check(
    "ml_request_features",
    on("sensor", "featured", lambda df: rounded(
        ml.request_features(_requests(df), REGION).select(*IDS, *LAGS, *REQUEST), 9, [*CYC, *REQUEST[:5]])),
    FEAT_A + f""" SELECT StationId, Datetime, {', '.join(LAGS)},
      round((AQI_Lag1 + AQI_Lag3) / 2, 9) AS AQI_Roll3, round((AQI_Lag1 + AQI_Lag3 + AQI_Lag6) / 3, 9) AS AQI_Roll6,
      round((AQI_Lag1 + AQI_Lag3 + AQI_Lag6 + AQI_Lag24) / 4, 9) AS AQI_Roll24,
      round(AQI_Lag1 - AQI_Lag3, 9) AS AQI_Delta1, round(AQI_Lag1 - AQI_Lag6, 9) AS AQI_Delta6,
      {', '.join(f'round({c}, 9) AS {c}' for c in CYC)}, Season_Enc, IsWeekend, CropBurning, CAST(2024 AS INTEGER) AS Year,
      {', '.join(ONE_HOT)} FROM feat""",
)

# --- models -------------------------------------------------------------------
# Small tree sizes; the library defaults are the published ones.

TREES, DEPTH, ROUNDS, BOOST_DEPTH = 20, 5, 10, 4


def _train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str]]:
    df = _cases(spark, sf_dir)
    names = features.columns(df, REGION)
    cases = tables.checkpoint(df.select(*IDS, "State", "Month", "Hour", "DayOfWeek", "AQI_Final", *[
        n for n in names if n not in ("Month", "Hour")]))
    return *ml.temporal_split(cases), names


def _fit(which: str, train: DataFrame, names: list[str]):
    if which == ml.LINEAR:
        return ml.train_linear(train, names)
    if which == ml.FOREST:
        return ml.train_forest(train, names, trees=TREES, depth=DEPTH)
    return ml.train_boosted(train, names, rounds=ROUNDS, depth=BOOST_DEPTH)


def _trained(which: str, after: Callable) -> Query:
    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test, names = _train_test(spark, sf_dir)
        return after(_fit(which, train, names), train, test)

    return make


def _scored_metrics(which: str) -> Query:
    return _trained(which, lambda m, train, test: rounded(
        ml.evaluate(ml.score(m, test, which), ml.prediction_column(which), which), 4, METRICS))


# The published features hold the target (first lag plus first delta), so the linear
# model is exact, and its scores follow from the target and the clip.
EXACT = "least(greatest(AQI_Final, 0), 500)"
LINEAR_METRICS = _metrics_sql("Linear Regression", EXACT).replace(", 6)", ", 4)")
check("ml_linear", _scored_metrics(ml.LINEAR), SPLIT + " " + LINEAR_METRICS)
check("ml_forest", _scored_metrics(ml.FOREST))
check("ml_boosted", _scored_metrics(ml.BOOSTED))
check(
    "ml_score",
    _trained(ml.LINEAR, lambda m, train, test: rounded(ml.score(m, test, ml.LINEAR), 2, ["Pred_Linear_Regression"]).select(
        *IDS, "AQI_Final", "Pred_Linear_Regression", index.forecast_category("Pred_Linear_Regression").alias("Category"))),
    SPLIT + f" SELECT *, {S.category("Pred_Linear_Regression")} AS Category FROM (SELECT StationId, Datetime, AQI_Final, CAST(round({EXACT}, 2) AS DOUBLE) AS Pred_Linear_Regression FROM test)",
)
check(
    "ml_prediction_pairs", lambda s, d: ml.prediction_pairs(_naive(s, d), NAIVE),
    SPLIT + " " + " UNION ALL ".join(f"SELECT '{n}' AS Model, AQI_Final AS Actual, {c} AS Predicted FROM test" for n, c in (("Last Value", "AQI_Lag1"), ("Last Day", "AQI_Lag24"))),
)
check(
    "ml_importance",
    _trained(ml.FOREST, lambda m, train, test: ml.importance(m, train.sparkSession)),
)
check(
    "ml_request_score",
    _trained(ml.FOREST, lambda m, train, test: ml.score_requests(m, _requests(test), REGION)),
)


def _cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, names = _train_test(spark, sf_dir)
    return rounded(ml.cross_validate(ml.linear(names), train, ml.LINEAR), 6, ["MeanR2", "StdR2"])


def _cv_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, names = _train_test(spark, sf_dir)
    return ml.cross_validate_boosted(ml.boosted(names, rounds=5, depth=3), train)


check("ml_cv", _cv, "SELECT 'Linear Regression' AS Model, CAST(1 AS DOUBLE) AS MeanR2, CAST(0 AS DOUBLE) AS StdR2")


def _cv_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five folds, dealt by a hash of the row's key, of a line through the first lag."""
    train, _, _ = _train_test(spark, sf_dir)
    key = F.concat_ws("|", "StationId", F.date_format("Datetime", "yyyy-MM-dd HH"))
    fold = F.conv(F.substring(F.md5(key), 1, 4), 16, 10).cast("int") % 5
    scores = ml.cross_validate(ml.linear(["AQI_Lag1"]), train.withColumn("Fold", fold), ml.LINEAR)
    return rounded(scores, 6, ["MeanR2", "StdR2"])


check(
    "ml_cv_lag", _cv_lag,
    SPLIT + """, train AS MATERIALIZED (SELECT CAST(AQI_Final AS DOUBLE) AS y, CAST(AQI_Lag1 AS DOUBLE) AS x,
      CAST('0x' || substr(md5(StationId || '|' || strftime(Datetime, '%Y-%m-%d %H')), 1, 4) AS INTEGER) % 5 AS Fold FROM cases CROSS JOIN cut WHERE Datetime < c),
    fits AS (SELECT k, regr_slope(y, x) AS m, regr_intercept(y, x) AS b FROM train JOIN range(5) AS t(k) ON Fold <> k GROUP BY k),
    scores AS (SELECT k, 1 - sum((y - m * x - b) ** 2) / (var_pop(y) * count(*)) AS r2 FROM train JOIN fits ON Fold = k GROUP BY k)
    SELECT 'Linear Regression' AS Model, round(avg(r2), 6) AS MeanR2, round(stddev_pop(r2), 6) AS StdR2 FROM scores""",
)


def _request_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored by a linear model of the first lag and delta, which is their sum."""
    train, test, _ = _train_test(spark, sf_dir)
    model = ml.train_linear(train, ["AQI_Lag1", "AQI_Delta1"])
    scored = ml.score(model, ml.request_features(_requests(test), REGION), ml.LINEAR)
    return rounded(scored, 2, ["Pred_Linear_Regression"]).select(*IDS, "Pred_Linear_Regression")


check(
    "ml_request_linear", _request_linear,
    SPLIT + """ SELECT StationId, Datetime, CAST(round(least(greatest(2 * AQI_Lag1 - AQI_Lag3, 0), 500), 2) AS DOUBLE) AS Pred_Linear_Regression FROM test""",
)


def _tree_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of tree models: all rows scored, within bounds, better than the mean of training."""
    train, test, names = _train_test(spark, sf_dir)
    mean = train.agg(F.avg("AQI_Final")).first()[0]
    rows = []
    for which in (ml.FOREST, ml.BOOSTED):
        model = _fit(which, train, names)
        p, t = F.col(ml.prediction_column(which)), F.col("AQI_Final")
        listed = ml.importance(model, spark, len(names))
        weights = listed.agg(F.round(F.sum("Importance"), 6).alias("w"), F.countDistinct("Feature").alias("f")).first()
        rows.append(ml.score(model, test, which).agg(
            F.lit(which).alias("Model"), F.count(p).alias("Rows"), F.min(p.between(0, 500).cast("int")).alias("InBounds"),
            (F.avg((p - t) * (p - t)) < F.avg((t - mean) * (t - mean))).cast("int").alias("BetterThanMean"),
            F.lit(weights["w"]).alias("ImportanceSum"), F.lit(int(weights["f"] == len(names))).alias("EachFeatureOnce")))
    return rows[0].unionByName(rows[1])


check(
    "ml_tree_invariants", _tree_invariants,
    SPLIT + " SELECT m AS Model, (SELECT count(*) FROM test) AS Rows, CAST(1 AS INTEGER) AS InBounds, CAST(1 AS INTEGER) AS BetterThanMean, "
    "CAST(1 AS DOUBLE) AS ImportanceSum, CAST(1 AS INTEGER) AS EachFeatureOnce FROM (VALUES ('Random Forest'), ('Boosted Trees')) AS v(m)",
)
check("ml_cv_boosted", _cv_boosted)

# --- findings -----------------------------------------------------------------

check(
    "state_ratio", on("sensor", "indexed", lambda df: findings.state_ratio(df, "ASIA")),
    A + f", m AS (SELECT State, {S.mean()} AS x FROM aqi GROUP BY State) SELECT State, {S.r6('x')} AS Mean, "
    f"{S.r6('''x / (SELECT x FROM m WHERE State = 'ASIA')''')} AS Ratio FROM m",
)
BW = "month(Datetime) * 100 + day(Datetime) BETWEEN 1015 AND 1130"
check(
    "burn_uplift", on("daily", "indexed", findings.burn_uplift),
    B + f""" SELECT State, {S.r6('i')} AS Inside, {S.r6('o')} AS Outside, {S.r6('i / nullif(o, 0)')} AS Ratio FROM (
      SELECT State, {S.mean(where=BW)} AS i, {S.mean(where=f'NOT ({BW})')} AS o FROM aqi GROUP BY State)""",
)
check(
    "lag_correlation", on("daily", "indexed", lambda df: findings.lag_correlation(df, REGION.burning, "ASIA")),
    B + f""", src AS (SELECT CAST(Datetime AS DATE) AS dt, {S.mean()} AS x FROM aqi WHERE State IN {S.BURNING} GROUP BY ALL),
    dst AS (SELECT CAST(Datetime AS DATE) AS dt, {S.mean()} AS y FROM aqi WHERE State = 'ASIA' GROUP BY ALL)
    SELECT CAST(k AS INTEGER) AS LagDays, count(*) AS Days, round(corr(x, y), 6) AS Corr
    FROM src CROSS JOIN range(0, 6) AS r(k) JOIN dst ON dst.dt = src.dt + CAST(k AS INTEGER) GROUP BY k""",
)
check(
    "limit_exceedance", on("daily", "indexed", findings.limit_exceedance),
    B + """ SELECT State, CAST(year(m) AS INTEGER) AS Year, count(*) AS Months, count(*) FILTER (WHERE v > 15) AS MonthsAbove15,
      count(*) FILTER (WHERE v > 60) AS MonthsAbove60
    FROM (SELECT State, last_day(Datetime) AS m, round(quantile_cont(PM25, 0.5), 6) AS v FROM aqi WHERE PM25 IS NOT NULL GROUP BY ALL) GROUP BY ALL""",
)
check(
    "period_drop", on("daily", "indexed", lambda df: findings.period_drop(df, 2000)),
    B + f""" SELECT State, {S.r6('b')} AS Before, {S.r6('a')} AS During, {S.r6('100 * (a - b) / nullif(b, 0)')} AS ChangePct FROM (
      SELECT State, {S.mean(where='Year < 2000')} AS b, {S.mean(where='Year = 2000')} AS a
      FROM aqi WHERE Month IN (3, 4, 5) AND Year <= 2000 GROUP BY State)""",
)
check("trend_excluding", on("daily", "indexed", lambda df: findings.trend_excluding(df, 2000)), _trend_oracle("Year <> 2000"))
check(
    "peak_month", on("daily", "indexed", findings.peak_month),
    B + f""" SELECT State, Month AS PeakMonth, x AS PeakMean FROM (
      SELECT *, row_number() OVER (PARTITION BY State ORDER BY x DESC, Month) AS rn FROM (
        SELECT State, Month, {S.r6(S.mean())} AS x FROM aqi GROUP BY State, Month)) WHERE rn = 1""",
)
check(
    "season_ratio", on("daily", "indexed", findings.season_ratio),
    B + f""" SELECT State, {S.r6('w')} AS Winter, {S.r6('m')} AS Monsoon, {S.r6('w / nullif(m, 0)')} AS Ratio FROM (
      SELECT State, {S.mean(where="Season = 'Winter'")} AS w, {S.mean(where="Season = 'Monsoon'")} AS m FROM aqi GROUP BY State)""",
)
