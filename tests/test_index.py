"""Hand-computed sub-indices, categories, windows and cleaning steps."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazeframe.constants import BREAKPOINTS, NORTH_INDIA
from hazeframe.functions import index
from hazeframe.functions.numeric import clip_low, round_even
from hazeframe.plans import aqi, clean, features
from tests.helpers import bag, column

T0 = datetime(2020, 1, 1)


def hours(spark, values, station="S", **extra):
    rows = [(station, T0 + timedelta(hours=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "StationId string, Datetime timestamp_ntz, PM25 double")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.mark.parametrize(
    "pollutant, value, want",
    [
        ("PM25", 0.0, 0.0), ("PM25", 30.0, 50.0), ("PM25", 45.0, 75.5), ("PM25", 60.0, 100.0),
        ("PM25", 500.0, 500.0), ("PM25", 501.0, 500.0), ("PM25", -1.0, None), ("PM25", None, None),
        ("CO", 1.5, 75.5), ("CO", 46.5, 500.0), ("O3", 150.0, 99 / 68 * 50 + 101), ("O3", 988.0, 500.0),
    ],
)
def test_sub_index(spark, pollutant, value, want):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(index.sub_index("v", BREAKPOINTS[pollutant])).first()[0] == want
    other = aqi.sub_index_by_lookup(df, "v", pollutant, "si").first()["si"]
    assert other == (pytest.approx(want) if want is not None else None)


def test_every_edge_belongs_to_the_lower_band(spark):
    for pollutant, bands in BREAKPOINTS.items():
        edges = [(float(b[1]), float(b[3])) for b in bands]
        df = spark.createDataFrame(edges, "v double, want double")
        off = F.abs(index.sub_index("v", bands) - F.col("want")) > 1e-9
        assert df.where(off).isEmpty(), pollutant


def test_categories(spark):
    cases = [
        (-0.01, None, "Good"), (0.0, "Good", "Good"), (50.0, "Good", "Good"),
        (50.01, "Satisfactory", "Satisfactory"), (400.0, "Very Poor", "Very Poor"),
        (500.0, "Severe", "Severe"), (500.01, None, "Severe"), (None, None, None),
    ]
    df = spark.createDataFrame(cases, "v double, a string, b string")
    got = df.select(index.category("v"), index.forecast_category("v")).collect()
    assert [tuple(r) for r in got] == [(a, b) for _, a, b in cases]


def test_rounding_and_clipping(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,), (-0.0,), (-3.0,)], "v double")
    assert [r[0] for r in df.select(round_even(F.col("v"), 2)).collect()][:3] == [1.0, 2.68, 0.12]
    assert [str(r[0]) for r in df.select(clip_low(F.col("v"))).collect()][3:] == ["0.0", "0.0"]


def test_rolling_counts_known_values_and_stays_in_its_station(spark):
    both = hours(spark, [10.0] * 12 + [None] * 3).union(hours(spark, [99.0] * 5, station="Z"))
    got = aqi.exposures(both)
    assert column(got.where("StationId = 'S'"), "Datetime", "PM25_24h") == [None] * 11 + [10.0] * 4
    assert column(got.where("StationId = 'Z'"), "Datetime", "PM25_24h") == [None] * 5
    assert got.schema["CO_8h"].dataType.simpleString() == "double"


def test_rolling_after_a_start_without_values(spark):
    got = aqi.exposures(hours(spark, [None] * 3 + [6.0] * 24))
    assert column(got, "Datetime", "PM25_24h") == [None] * 14 + [6.0] * 13


def test_fill_and_core_null(spark):
    df = hours(spark, [None, 3.0, None, -4.0, None]).union(hours(spark, [None, None], station="Z"))
    got = clean.impute(df)
    assert column(got, "Datetime", "PM25") == [3.0, 3.0, 3.0, 0.0, 0.0]
    forward = clean.impute(df, backward=False)
    assert column(forward, "Datetime", "PM25") == [3.0, 3.0, 0.0, 0.0]


def test_dominant_takes_the_first_on_a_tie(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 10.0, 3.0), (2, None, 5.0, 7.0), (3, None, None, None)],
        "id int, SI_PM25 double, SI_PM10 double, SI_CO double",
    )
    assert column(aqi.dominant_pollutant(df), "id", "DominantPollutant") == ["PM2.5", "CO", None]


def test_reported_index_wins_and_may_lie_above_the_scale(spark):
    df = hours(spark, [20.0] * 13).withColumn("AQI", F.when(F.hour("Datetime") == 0, 600.004))
    got = aqi.calculate(df).orderBy("Datetime").collect()
    assert [(r["AQI_Final"], r["AQI_Category"]) for r in got] == [
        (600.0, None), (33.33, "Good"), (33.33, "Good")
    ]


def test_calendar(spark):
    rows = [("2020-11-01 05:30:00", "Punjab"), ("2020-03-02 00:00:00", "Delhi"), ("2020-10-05 00:00:00", None), ("bad", "Delhi")]
    df = spark.createDataFrame(rows, "Date string, State string")
    got = clean.add_calendar(clean.parse_datetime(df)).orderBy("Month").collect()
    cols = ["Month", "Hour", "DayOfWeek", "IsWeekend", "Season", "CropBurning"]
    assert [tuple(r[c] for c in cols) for r in got] == [
        (3, 0, 0, 0, "Spring", 0), (10, 0, 0, 0, "Autumn", 0), (11, 5, 6, 1, "Autumn", 1)
    ]


def test_dedup_keeps_the_first_and_is_idempotent(spark):
    rows = [("S", T0, 2, 5.0), ("S", T0, 1, 7.0), ("S", T0 + timedelta(hours=1), 3, 9.0)]
    df = spark.createDataFrame(rows, "StationId string, Datetime timestamp_ntz, seq int, PM25 double")
    once = clean.dedup(df, ["seq"])
    assert column(once, "Datetime", "PM25") == [7.0, 9.0]
    assert bag(clean.dedup(once, ["seq"])) == bag(once)


def test_features(spark):
    df = hours(spark, [float(i % 50) for i in range(60)], State="Uttar Pradesh")
    made = features.engineer(aqi.calculate(df), NORTH_INDIA)
    names = features.columns(made)
    assert len(names) == 19 + 5 + 1 + 7 and "State_Uttar_Pradesh" in names
    assert len(features.columns(made, include_pollutants=False)) == 24
    assert made.where("abs(AQI_Lag1 + AQI_Delta1 - AQI_Final) > 1e-9").isEmpty()
    # 11 rows have no index yet, then 24 have no full history
    assert made.count() == 60 - 11 - 24


def test_empty_in_empty_out(spark):
    empty = hours(spark, [1.0], State="Delhi").where("false")
    assert features.engineer(aqi.calculate(clean.impute(empty))).isEmpty()


def test_a_sub_index_is_short_enough_for_the_compiler_and_equals_the_bands(spark):
    from hazeframe.constants import BREAKPOINTS, EXPOSURES
    from hazeframe.functions import index

    for e in EXPOSURES:
        bands = BREAKPOINTS[e.pollutant]
        edges = [float(v) for b in bands for v in b[:2]]
        values = [v + d for v in edges for d in (-1e-9, 0.0, 1e-9)] + [None, float("nan"), float("inf"), float("-inf"), -0.0, -1.0]
        df = spark.createDataFrame([(v,) for v in values], f"{e.column} double")
        old, new = index._sub_index_by_case(e.column, bands), index.sub_index(e.column, bands)
        assert df.where(~old.eqNullSafe(new)).isEmpty()
        assert "WHEN" not in str(new).split("THEN", 1)[1]
    gap = [(0.0, 1.0, 0.0, 50.0), (2.0, 3.0, 51.0, 100.0)]
    got = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.0, 4.0)], "x double").select(index.sub_index("x", gap).alias("i"))
    assert [r["i"] for r in got.collect()] == [25.0, None, 51.0, 500.0]


def test_sub_indices_by_number_equal_the_bands(spark):
    from hazeframe.constants import EXPOSURES

    values = [v + d for bands in BREAKPOINTS.values() for b in bands for v in map(float, b[:2]) for d in (-1e-9, 0.0, 1e-9)]
    values += [None, float("nan"), float("inf"), float("-inf"), -0.0, -1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(*[F.col("v").alias(e.column) for e in EXPOSURES])
    got = aqi.sub_indices(df)
    assert got.columns == [*df.columns, *[e.index for e in EXPOSURES]]
    for e in EXPOSURES:
        want = index._sub_index_by_case(e.column, BREAKPOINTS[e.pollutant])
        assert got.where(~F.col(e.index).eqNullSafe(want)).isEmpty()


def test_the_index_over_all_pollutants_makes_no_very_long_method(spark, capsys):
    import re

    from hazeframe.constants import EXPOSURES, INDEX_POLLUTANTS

    values = [*INDEX_POLLUTANTS, "AQI"]
    df = spark.createDataFrame([("S", T0, *map(float, range(len(values))))], f"StationId string, Datetime timestamp_ntz, {', '.join(f'{c} double' for c in values)}")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        aqi.calculate(df).select("StationId", "Datetime", "AQI_Final", *values, *[e.column for e in EXPOSURES]).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:([0-9]+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 15_000
