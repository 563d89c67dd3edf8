"""Results do not depend on where a hot station is cut."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hazeframe.operators import lookup, panel, segments
from hazeframe.plans import aqi, batch, clean, features
from hazeframe.sources import tables

from .helpers import bag

START = datetime(2020, 1, 1)


def rows(seed, tie):
    rng = random.Random(seed)
    out = []
    for k in range(400):
        t = None if rng.random() < 0.2 else tie(rng, k)
        out.append((rng.choice(["A", "A", "A", "B", None]), START + timedelta(hours=rng.randrange(12)), t, k, None if rng.random() < 0.4 else float(rng.randrange(90))))
    return out


TIES = {
    "long": ("bigint", lambda rng, k: k),
    "large": ("bigint", lambda rng, k: (1 << 60) + k),
    "string": ("string", lambda rng, k: rng.choice(["f1", "f2", "g"]) + str(k)),
    "date": ("date", lambda rng, k: date(2020, 1, 1) + timedelta(days=k)),
}


@pytest.mark.parametrize("kind", list(TIES))
@pytest.mark.parametrize("limit", [7, 40])
def test_fill_roll_and_lead_over_cuts(spark, kind, limit):
    sql, tie = TIES[kind]
    df = spark.createDataFrame(rows(1, tie), f"StationId string, Datetime timestamp_ntz, tie {sql}, id bigint, v double")
    order = ["Datetime", "tie", "id"]

    def run(cut):
        cut = segments.split_hot(df, ["StationId"], order, cut)
        filled = panel.fill(cut, ["StationId"], order, ["v"])
        halo = segments.with_halo(filled, ["StationId"], order, ["v"], 5)
        rolled = panel.rolling(halo, segments.series(halo, ["StationId"], order), {"r": panel.Roll("v", 6, 1)})
        done = segments.drop_extra(rolled).withColumnRenamed("v", "AQI_Final")
        ahead = features._ahead(done, order, 3)
        return ahead.select("StationId", "id", F.round("AQI_Final", 6).alias("v"), F.round("r", 6).alias("r"), "Target"), cut

    whole, uncut = run(10**9)
    parts, cut = run(limit)
    assert segments.SEG not in uncut.columns
    assert cut.groupBy("StationId", segments.SEG).count().agg(F.max("count")).first()[0] <= limit
    assert bag(parts) == bag(whole)


def test_csv_copies_of_one_time_are_cut(spark, tmp_path):
    for f in range(3):
        lines = ["StationId,Datetime,PM2.5"] + [f"S,2020-01-01 05:00:00,{f * 100 + k}" for k in range(60)]
        (tmp_path / f"part{f}.csv").write_text("\n".join(lines))
    raw = tables.read_readings(spark, str(tmp_path))
    dated = clean.parse_datetime(raw)
    cut = segments.split_hot(dated, ["StationId"], ["Datetime", *clean.tie_break(dated)], 20)
    assert cut.groupBy("StationId", segments.SEG).count().agg(F.max("count")).first()[0] <= 20


def test_small_values_large_values_and_infinity(spark):
    values = [0.00004, 0.00004, 1e16, float("inf"), None, 5.0]
    df = spark.createDataFrame([("A", START + timedelta(hours=k), v) for k, v in enumerate(values)], "StationId string, Datetime timestamp_ntz, v double")
    window = segments.series(df, ["StationId"], ["Datetime"])
    got = [r["m"] for r in panel.rolling(df, window, {"m": panel.Roll("v", 2, 1)}).orderBy("Datetime").collect()]
    assert got[:3] == [0.00004, 0.00004, pytest.approx(5e15)] and got[3] == 1e16 and got[4] is None and got[5] == 5.0
    text = spark.createDataFrame([("Infinity",), ("1e16",), ("x",), ("NaN",), ("-2",)], "t string")
    assert [r[0] for r in text.select(tables.number(F.col("t"))).collect()] == [None, 1e16, None, None, -2.0]


def test_lookup_deals_out_hot_and_null_keys(spark):
    facts = spark.createDataFrame([("hot" if k % 3 else None if k % 2 else f"k{k}", k) for k in range(300)], "StationId string, v bigint")
    dimension = spark.createDataFrame([(s, s.upper()) for s in ["hot", *[f"k{k}" for k in range(0, 300, 4)]]], "StationId string, name string")
    spark.conf.set(segments.SEGMENT_ROWS, "50")
    try:
        for how in ("left", "inner"):
            got = lookup.lookup(facts, dimension, "StationId", how, max_rows=5).select("StationId", "v", "name")
            assert bag(got) == bag(facts.join(dimension, "StationId", how))
    finally:
        spark.conf.unset(segments.SEGMENT_ROWS)
    assert not lookup.is_small(dimension, size=100) and lookup.is_small(dimension)


def test_public_path_is_the_same_for_any_cut(spark):
    rng = random.Random(2)
    data = [("S", START + timedelta(hours=k % 40), rng.choice([None, k % 7]), k, float(k % 50) if rng.random() < 0.6 else None) for k in range(200)]
    readings = spark.createDataFrame(data, "StationId string, Datetime timestamp_ntz, tie bigint, id bigint, PM25 double")
    stations = spark.createDataFrame([("S", "s", "c", "Delhi")], "StationId string, StationName string, City string, State string")

    def run(limit):
        spark.conf.set(segments.SEGMENT_ROWS, str(limit))
        try:
            return bag(aqi.calculate(clean.preprocess(readings, stations, tie=["tie", "id"])))
        finally:
            spark.conf.unset(segments.SEGMENT_ROWS)

    assert run(4) == run(20) == run(4_000_000)


def test_usual_time_texts_are_read(spark):
    texts = ["2020-01-02 05:00:00", "02-01-2020 05:00", "02/01/2020 05:00:00", "2020/01/02 05:00", "soon", None]
    df = spark.createDataFrame([("S", t) for t in texts], "StationId string, Datetime string")
    assert {r["Datetime"] for r in clean.parse_datetime(df).collect()} == {datetime(2020, 1, 2, 5)}
    assert clean.parse_datetime(df).count() == 4 and clean.lost_times(df) == 1 and clean.lost_times(df, ()) == 4


def test_saved_panel_keeps_its_column_order(spark, tmp_path):
    (tmp_path / "r.csv").write_text("StationId,Datetime,PM2.5\nS,2020-01-01 05:00:00,3\n")
    (tmp_path / "s.csv").write_text("StationId,StationName,City,State,Status\nS,n,c,Delhi,x\n")
    paths = str(tmp_path / "r.csv"), str(tmp_path / "s.csv")
    plain = batch.load_and_preprocess(spark, *paths)
    saved = batch.load_and_preprocess(spark, *paths, save_path=str(tmp_path / "out"))
    assert saved.columns == plain.columns and bag(saved) == bag(plain)


def test_a_table_that_cannot_be_read_is_left_alone(spark, tmp_path):
    damaged = tmp_path / "damaged"
    damaged.mkdir()
    (damaged / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="parquet|Parquet"):
        tables.load_or_build(spark, str(damaged), lambda: spark.range(1)).count()
    assert (damaged / "part-0.parquet").read_text() == "no parquet"
    csv = tmp_path / "csv"
    spark.createDataFrame([("S", "2020-01-01 05:00:00", "7")], "StationId string, Datetime string, AQI string").write.csv(str(csv), header=True)
    assert tables.load_or_build(spark, str(csv), lambda: spark.range(1)).first()["AQI"] == 7.0
