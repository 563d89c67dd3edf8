"""Dirty CSV input, the batch run, exports and stored models."""

import math

import pytest
from pyspark.sql import functions as F

from hazeframe.plans import aqi, batch, clean, ml, reports
from hazeframe.sources import tables


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    lines = ["StationId,Datetime,PM2.5,PM10,NOx,SO2,NH3,CO,O3,AQI"]
    for s, base in (("D1", 60), ("P1", 30), ("X9", 10)):
        for i in range(24 * 12):
            wave = base + 20 * math.sin(i / 9)
            lines.append(
                f"{s},2019-10-{1 + i // 24:02d} {i % 24:02d}:00:00,{wave:.2f},{wave * 2:.2f},"
                f"{base / 2:.2f},{wave / 4:.2f},{base:.2f},{wave / 50:.2f},{wave:.2f},{'' if i % 5 else round(wave * 2, 1)}"
            )
    lines += ["D1,2019-10-01 00:00:00,999,,,,,,,", "D1,not a date,1,1,1,1,1,1,1,1", "P1,2019-10-01 03:00:00,NaN,-5,,,,,,"]
    readings = write(folder / "station_hour.csv", lines)
    stations = write(
        folder / "stations.csv",
        ["StationCode,StationName,City,State", "D1,North,Delhi,Delhi", "P1,East,Ludhiana,Punjab", "X9,Far,Pune,Maharashtra"],
    )
    return readings, stations


def test_readings_are_typed_and_numbered(spark, inputs):
    df = tables.read_readings(spark, inputs[0])
    assert dict(df.dtypes)["PM25"] == "double" and dict(df.dtypes)["Datetime"] == "string"
    last = df.orderBy(F.desc("_row")).first()
    assert last["StationId"] == "P1" and last["PM25"] is None and last["PM10"] == -5.0


def test_clean_keeps_the_first_of_the_file(spark, inputs):
    df = batch.load_and_preprocess(spark, *inputs)
    assert df.count() == 2 * 288
    assert df.columns[:5] == ["StationId", "StationName", "City", "State", "Datetime"]
    assert not set(tables.ORDINAL) & set(df.columns)
    first = df.where("StationId = 'D1'").orderBy("Datetime").first()
    assert first["PM25"] == 60.0
    assert df.where("PM10 < 0 or isnan(PM25)").isEmpty()


def test_batch_run(spark, inputs, tmp_path):
    out = str(tmp_path)
    done = batch.run(
        spark, *inputs, out, csv=True, trees=4, tree_depth=3, rounds=3, boost_depth=2, folds=2
    )
    assert len(done.analyses) == 15
    assert all(not d.isEmpty() for n, d in done.analyses.items() if n != "11_winter_vs_summer")
    stored = tables.read_aqi(spark, f"{out}/aqi")
    # two hours of each station have neither a reported index nor an exposure
    assert stored.count() == done.aqi.count() == 2 * 286
    assert spark.read.csv(f"{out}/csv/clean", header=True).columns.count("PM2.5") == 1
    again = tables.read_aqi(spark, f"{out}/csv/aqi_clean")
    assert again.count() == 572 and dict(again.dtypes)["Datetime"] == "timestamp_ntz"

    results = tables.read_results(spark, f"{out}/ml_results")
    assert results.count() == 3
    assert done.training.cross_validation.count() == 3
    best = results.orderBy("RMSE").first()["Model"]
    assert best == done.training.best
    model, names = ml.load(spark, f"{out}/models")
    assert names == done.feature_names
    scored = ml.score(model, done.training.scored, "again")
    column = ml.prediction_column(best)
    assert scored.where(F.abs(F.col(column) - F.col("Pred_again")) > 1e-9).isEmpty()
    # better than the mean of the training rows
    mean = results.where("Model = 'Random Forest'").first()
    assert mean["R2"] > 0
    requests = done.features.select(
        "State", F.col("Month").alias("month"), F.col("Hour").alias("hour"), F.col("DayOfWeek").alias("dow"),
        *[F.col(f"AQI_Lag{n}").alias(f"aqi_lag{n}") for n in (1, 3, 6, 24)],
    )
    answers = ml.score_requests(model, requests)
    assert answers.where("Prediction < 0 or Prediction > 500 or Category is null").isEmpty()


def test_rebuild_when_missing(spark, inputs, tmp_path):
    path = f"{tmp_path}/aqi"
    first = batch.load_index_table(spark, path, *inputs)
    assert first.count() == 572 and tables.exists(spark, path)
    calls = []
    tables.load_or_build(spark, path, lambda: calls.append(1))
    assert not calls


def test_absent_results_and_models(spark, tmp_path):
    assert tables.read_results(spark, f"{tmp_path}/none") is None
    assert ml.load(spark, f"{tmp_path}/none") == (None, None)


def test_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    rows = [(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (8.0, 7.0)]
    df = spark.createDataFrame(rows, "AQI_Final double, Pred_m double")
    got = ml.evaluate(df, "Pred_m", "m").first()
    for name in ("rmse", "mae", "r2"):
        e = RegressionEvaluator(labelCol="AQI_Final", predictionCol="Pred_m", metricName=name)
        assert got[name.upper()] == pytest.approx(e.evaluate(df))


def test_station_without_metadata_is_joined_but_not_kept(spark, inputs):
    readings = tables.read_readings(spark, inputs[0])
    few = tables.read_stations(spark, inputs[1]).where("StationCode <> 'P1'")
    joined = clean.attach_stations(readings, few)
    assert joined.where("State is null").count() == 289
    assert clean.filter_states(joined).select("StationId").distinct().count() == 1


def test_preview_and_filter(spark, inputs):
    df = aqi.calculate(batch.load_and_preprocess(spark, *inputs))
    assert reports.preview(df, 7).count() == 7
    assert reports.state_year_filter(df, ["Delhi"], (2019, 2019)).count() == 286
    assert reports.state_year_filter(df, ["Delhi"], (2020, 2021)).isEmpty()
