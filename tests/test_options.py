"""Frames of time, sketches and positions, whatever the cuts and partitions are."""

import pytest
from pyspark.sql import functions as F

from checks import catalog, compare, options  # noqa: F401
from hazeframe.operators import panel, position, segments, sketch
from hazeframe.plans import aqi, batch, eda, reports

from .helpers import bag

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.oracle_connection(SF)


@pytest.mark.parametrize("name", ["exposures_time", "sketch_medians", "sketch_distinct", "exact_split", "quality_observed"])
def test_oracle(spark, con, name):
    assert compare.difference(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name]) is None


def irregular(spark):
    """Two stations and a null one: gaps, rows of one time, times apart by microseconds, nulls."""
    at = "timestamp_micros(1704067200000000 + CAST(pow(id % 150, 1.7) * 700000000 AS BIGINT) + id % 3)"
    station = "CASE WHEN id % 7 = 0 THEN 'b' WHEN id % 31 = 0 THEN NULL ELSE 'a' END"
    return spark.range(600).selectExpr(
        f"{station} AS StationId", f"CAST({at} AS TIMESTAMP_NTZ) AS Datetime", "id AS n", "CASE WHEN id % 5 > 0 THEN CAST(id % 97 AS DOUBLE) END AS PM25", "CAST(id % 13 AS DOUBLE) AS O3"
    )


@pytest.mark.parametrize("rows", [4, 33, 250])
def test_time_frames_are_the_same_for_any_cut(spark, rows):
    df = irregular(spark)
    want = bag(aqi.exposures_by_time(df, least=0.2))
    spark.conf.set(segments.SEGMENT_ROWS, str(rows))
    try:
        assert segments.SEG in segments.split_hot(panel.with_micros(df, "Datetime"), ["StationId"], [panel.MICROS]).columns
        assert bag(aqi.exposures_by_time(df, least=0.2)) == want
    finally:
        spark.conf.unset(segments.SEGMENT_ROWS)


def test_time_frames_by_brute_force(spark):
    df = irregular(spark)
    rows = [r for r in df.collect()]
    got = {r["n"]: r for r in aqi.exposures_by_time(df, least=0).collect()}
    for r in rows:
        near = lambda hours: [x for x in rows if x["StationId"] == r["StationId"] and 0 <= (r["Datetime"] - x["Datetime"]).total_seconds() <= 3600 * (hours - 1)]  # noqa: E731, B023
        known = [x["PM25"] for x in near(24) if x["PM25"] is not None]
        assert got[r["n"]]["PM25_24h"] == (sum(known) / len(known) if known else None)
        assert got[r["n"]]["O3_8h"] == max(x["O3"] for x in near(8))
        assert got[r["n"]]["SO2_24h"] is None


def test_gapless_hours_are_rows(spark):
    df = spark.range(200).selectExpr("'a' AS StationId", "CAST(timestamp_seconds(1704067200 + id * 3600) AS TIMESTAMP_NTZ) AS Datetime", "CASE WHEN id % 3 > 0 THEN CAST(id AS DOUBLE) END AS PM25")
    assert bag(aqi.exposures_by_time(df)) == bag(aqi.exposures(df))
    assert aqi.exposures_by_time(df.limit(0)).count() == 0


def test_quantile_sketches_merge_within_their_bound(spark):
    df = spark.range(0, 200_000, 1, 16).selectExpr("'x' AS State", "date_add(DATE '2024-01-01', CAST(id % 31 AS INT)) AS Datetime", "CAST(id * 7919 % 200000 AS DOUBLE) AS v")
    for size in (50, 200, 1000):
        guess = eda.monthly_median_approx(df, "v", size=size).first()["Median_v"]
        assert abs(guess / 200_000 - 0.5) <= 2 * sketch.rank_error(size)
    assert sketch.rank_error(1000) < 0.005 < sketch.rank_error(200) < 0.02


def test_sketches_take_nulls_nan_and_empty_tables(spark):
    df = spark.createDataFrame([("x", None), ("x", float("nan")), ("y", 3.0), ("y", None)], "State string, v double").withColumn("Datetime", F.lit("2024-05-05").cast("timestamp_ntz"))
    assert {r["State"]: r["Median_v"] for r in eda.monthly_median_approx(df, "v").collect()} == {"x": None, "y": 3.0}
    assert eda.monthly_median_approx(df.limit(0), "v").count() == 0


def test_distinct_sketches_merge_to_any_group(spark):
    df = spark.range(60_000).selectExpr("concat('S', id % 3) AS State", "date_add(DATE '2024-01-01', CAST(id % 60 AS INT)) AS Datetime", "CAST(id % 5000 AS STRING) AS StationId", "IF(id % 2 = 0, NULL, CAST(id % 40 AS STRING)) AS City")
    days = reports.distinct_sketches(df)
    assert days.count() == 60
    for keys, want in (([], [5000]), (["State"], [5000] * 3)):
        got = reports.distinct_approx(days, keys).collect()
        assert len(got) == len(want) and all(abs(r["Stations"] - n) <= 3 * sketch.distinct_error() * n for r, n in zip(got, want))
        assert all(r["Cities"] == 20 for r in got)


def test_positions_are_exact(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("id % 10 AS a", "(id * 37) % 5000 AS k", "id")
    got = position.with_position(df, ["a", F.desc("k")]).collect()
    want = sorted(((r["a"], -r["k"], r["id"]) for r in df.collect()))
    assert [r["id"] for r in sorted(got, key=lambda r: r["Position"])] == [w[2] for w in want]
    assert sorted(r["Position"] for r in got) == list(range(5000))
    first, rest = position.split_at(df, 0.33333, ["a", "k"])
    assert (first.count(), rest.count()) == (int(5000 * 0.33333), 5000 - int(5000 * 0.33333))
    assert position.with_position(df.limit(0), ["a"]).count() == 0
    same = spark.range(100).selectExpr("1 AS a")
    assert sorted(r["Position"] for r in position.with_position(same, ["a"]).collect()) == list(range(100))


def test_observed_profile_is_the_same_for_cut_stations_and_comes_from_the_run(spark):
    panel_of = options.sensor(spark, SF)
    want = bag(catalog.QUERIES["quality_profile"](spark, SF))
    written = []
    spark.conf.set(segments.SEGMENT_ROWS, "20")
    try:
        found = batch.observed_quality(panel_of.readings, panel_of.stations, options.REGION, options.SENSOR_TIE, run=lambda df: written.append(df.count()))
        assert bag(found) == want
    finally:
        spark.conf.unset(segments.SEGMENT_ROWS)
    assert written == [r["Rows"] for r in found.collect() if r["Stage"] == "features"]


def test_observed_profile_reads_raw_rows_once(spark):
    """But for the count of rows per station, which every plan takes first."""
    panel_of, plans = options.sensor(spark, SF), []
    run = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df.write.format("noop").mode("overwrite").save()
    assert batch.observed_quality(panel_of.readings, panel_of.stations, options.REGION, options.SENSOR_TIE, run=run).count() == 7
    assert plans[0].split("== Initial Plan ==")[-1].count("events.parquet") == 1 and plans[0].count("CollectMetrics") >= 7


def test_observed_profile_of_no_rows(spark):
    panel_of = options.sensor(spark, SF)
    found = batch.observed_quality(panel_of.readings.limit(0), panel_of.stations, options.REGION, options.SENSOR_TIE).collect()
    assert [(r["Rows"], r["Dropped"], r["FirstTime"]) for r in found] == [(0, 0, None)] * 7
