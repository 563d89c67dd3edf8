"""A hot station is cut into segments; results are those of the whole series."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazeframe.operators import lookup, panel, segments
from hazeframe.plans import aqi, clean, features
from tests.helpers import bag

SCHEMA = "StationId string, Datetime timestamp_ntz, seq long, PM25 double, CO double, AQI_Final double"
KEY, ORDER = ["StationId"], ["Datetime", "seq"]


@pytest.fixture(scope="module")
def hot(spark):
    """Station A: a burst, a block of copies of one time, a long tail; B, C small."""
    rng = random.Random(7)
    start = datetime(2020, 1, 1)
    rows, seq = [], 0

    def add(station, when, value):
        nonlocal seq
        seq += 1
        co = round(rng.uniform(0, 40), 2) if rng.random() < 0.6 else None
        rows.append((station, when, seq, value, co, round(rng.uniform(0, 500), 2)))

    def value():
        return round(rng.uniform(-5, 200), 2) if rng.random() < 0.3 else None

    for i in range(400):
        add("A", start + timedelta(seconds=i), value())
    for _ in range(300):
        add("A", start + timedelta(days=3), value())
    for i in range(200):
        add("A", start + timedelta(days=10, hours=i), None if 40 < i < 120 else value())
    for i in range(60):
        add("B", start + timedelta(hours=i), value())
    for i in range(30):
        add("C", start + timedelta(hours=i), None)
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def cut(hot):
    return segments.split_hot(hot, KEY, ORDER, rows=50)


def test_segments_are_small_ordered_and_only_for_hot_keys(hot, cut):
    sizes = cut.groupBy("StationId", segments.SEG).count()
    hot_sizes = [r["count"] for r in sizes.where("StationId = 'A'").collect()]
    assert max(hot_sizes) <= 50 and sum(hot_sizes) == 900
    assert sizes.where(f"StationId = 'C' and {segments.SEG} is not null").isEmpty()
    # segments follow the order of the series
    ranked = cut.where("StationId = 'A'").orderBy(*ORDER).select(segments.SEG).collect()
    segs = [r[0] for r in ranked]
    assert segs == sorted(segs)


def test_nothing_is_cut_without_a_hot_key(hot):
    assert segments.split_hot(hot, KEY, ORDER, rows=10_000).columns == hot.columns


@pytest.mark.parametrize("backward", [True, False])
def test_fill(hot, cut, backward):
    want = panel.fill(hot, KEY, ORDER, ["PM25", "CO"], backward)
    got = panel.fill(cut, KEY, ORDER, ["PM25", "CO"], backward)
    assert bag(segments.drop_segments(got)) == bag(want)


def test_exposures(hot, cut):
    want = aqi.exposures(hot, tie=["seq"], segmented=True)
    got = aqi.exposures(cut, tie=["seq"], segmented=True)
    assert bag(segments.drop_segments(got)) == bag(want)
    plain = aqi.exposures(hot, tie=["seq"], digits=None, segmented=True)
    close = want.join(plain.select("seq", F.col("PM25_24h").alias("p")), "seq")
    assert close.where("abs(PM25_24h - p) > 1e-9 or (PM25_24h is null) <> (p is null)").isEmpty()


@pytest.mark.parametrize("horizon", [0, 1, 3])
def test_history(hot, cut, horizon):
    want = features.history(hot, ["seq"], horizon, segmented=True)
    got = features.history(cut, ["seq"], horizon, segmented=True)
    assert bag(segments.drop_segments(got)) == bag(want)


def test_whole_plan_with_a_hot_station(spark, hot):
    stations = spark.createDataFrame(
        [("A", "a", "X", "Delhi"), ("B", "b", "Y", "Punjab"), ("C", "c", "Z", "Nowhere")],
        "StationId string, StationName string, City string, State string",
    )
    raw = hot.drop("AQI_Final").withColumn("Datetime", F.col("Datetime").cast("string"))

    def run():
        df = clean.preprocess(raw, stations, tie=["seq"], keep_segments=True)
        df = aqi.dominant_pollutant(aqi.calculate(df, segmented=True))
        return segments.drop_segments(features.engineer(df, segmented=True))

    want = bag(run())
    spark.conf.set(segments.SEGMENT_ROWS, "40")
    try:
        assert bag(run()) == want
    finally:
        spark.conf.unset(segments.SEGMENT_ROWS)


def test_lookup_of_a_large_dimension(spark, hot):
    stations = spark.createDataFrame(
        [("A", "Delhi"), ("B", "Punjab"), ("B", "Twice")], "StationId string, State string"
    )
    want = bag(hot.join(stations, "StationId", "left"))
    assert bag(lookup.lookup(hot, stations, "StationId")) == want
    assert bag(lookup.lookup(hot, stations, "StationId", max_rows=1)) == want
    spark.conf.set(segments.SEGMENT_ROWS, "100")
    try:
        assert bag(lookup.lookup(hot, stations, "StationId", max_rows=1)) == want
    finally:
        spark.conf.unset(segments.SEGMENT_ROWS)
    with pytest.raises(ValueError):
        lookup.require_unique(stations, "StationId")
