import numpy as np
import pytest

from hazeframe.plans import ml


@pytest.mark.parametrize(
    ("curve", "patience", "kept"),
    [([5, 4, 3], 50, 3), ([5, 4, 6, 6, 6, 1], 3, 2), ([5, 4, 6, 6, 6, 1], 4, 6), ([1], 1, 1), ([2, 2, 2], 2, 1)],
)
def test_best_prefix(curve, patience, kept):
    assert ml.best_prefix(curve, patience) == kept


def test_boosting_stops_at_the_best_round(spark):
    rows = [("S", f"2020-01-{1 + k // 24:02d} {k % 24:02d}:00:00", float(k % 7), float(k * k % 11), float(k % 7) * 3 + (k * 37 % 5)) for k in range(300)]
    df = spark.createDataFrame(rows, "StationId string, Datetime string, a double, b double, AQI_Final double")
    df = df.withColumn("Datetime", df["Datetime"].cast("timestamp_ntz")).cache()
    marked = ml.mark_validation(df)
    whole = ml.boosted(["a", "b"], rounds=12, depth=2).fit(marked.where("NOT Validation"))
    curve = ml.validation_curve(whole, marked.where("Validation"))
    model = ml.train_boosted(df, ["a", "b"], rounds=12, depth=2, patience=3)
    assert len(curve) == 12 and ml.rounds_kept(model) == ml.best_prefix(curve, 3)
    again = ml.validation_curve(model, marked.where("Validation"))
    assert again == pytest.approx(curve[: len(again)])


def test_folds_of_a_column_are_kept(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=200)
    y = 3 * x + rng.normal(size=200)
    fold = np.arange(200) % 4
    df = spark.createDataFrame([(float(a), float(b), int(f)) for a, b, f in zip(x, y, fold, strict=True)], "x double, y double, Fold int")
    row = ml.cross_validate(ml.linear(["x"], "y"), df, "line", folds=4, target="y").first()
    scores = []
    for k in range(4):
        slope, start = np.polyfit(x[fold != k], y[fold != k], 1)
        a, b = x[fold == k], y[fold == k]
        scores.append(1 - np.sum((b - slope * a - start) ** 2) / np.sum((b - b.mean()) ** 2))
    assert row["MeanR2"] == pytest.approx(np.mean(scores), abs=1e-8)
    assert row["StdR2"] == pytest.approx(np.std(scores), abs=1e-8)


def _gains(x, y, depth):
    """Variance taken away by each feature in a regression tree grown greedily."""
    out = np.zeros(x.shape[1])
    best = (0.0, 0, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            gain = y.var() * len(y) - y[left].var() * left.sum() - y[~left].var() * (~left).sum()
            best = max(best, (gain, f, left), key=lambda one: one[0])
    gain, f, left = best
    if depth and left is not None and gain > 1e-9:
        out[f] += gain
        out += _gains(x[left], y[left], depth - 1) + _gains(x[~left], y[~left], depth - 1)
    return out


def test_importances_equal_a_tree_grown_by_hand(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    y = 10 * (x[:, 0] > 6) + 3 * (x[:, 1] > 2) * (x[:, 0] > 6) + 0.5 * x[:, 2] + rng.normal(size=400) / 10
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double")
    pipeline = ml.boosted(["a", "b", "c"], "y", rounds=1, depth=3)
    # All rows and features, so that the tree is the greedy one.
    pipeline.getStages()[-1].setSubsamplingRate(1.0).setFeatureSubsetStrategy("all")
    model = pipeline.fit(df)
    got = {r["Feature"]: r["Importance"] for r in ml.importance(model, spark, 3).collect()}
    want = _gains(x, y, 3)
    assert got == pytest.approx(dict(zip("abc", want / want.sum(), strict=True)), abs=1e-6)


def test_cross_validation_fits_each_fold_and_assembles_once(spark, monkeypatch):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = [(float(k % 7), float(k * k % 11), float(k % 7) * 3 + (k * 37 % 5), k * 13 % 4) for k in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, AQI_Final double, Fold int").repartition(3, "Fold").cache()
    estimator = ml.boosted(["a", "b"], rounds=3, depth=2)
    whole = CrossValidator(
        estimator=estimator, estimatorParamMaps=ParamGridBuilder().build(), numFolds=4, foldCol="Fold",
        evaluator=RegressionEvaluator(labelCol="AQI_Final", metricName="rmse"),
    ).fit(df)
    calls = {"fit": 0, "assemble": 0}

    def counted(kind, method, name):
        before = getattr(kind, method)

        def after(self, *args):
            calls[name] += 1
            return before(self, *args)

        monkeypatch.setattr(kind, method, after)

    counted(GBTRegressor, "_fit", "fit")
    counted(VectorAssembler, "_transform", "assemble")
    row = ml.cross_validate_boosted(estimator, df, folds=4).first()
    assert row["MeanRMSE"] == pytest.approx(whole.avgMetrics[0], rel=1e-12)
    assert calls == {"fit": 4, "assemble": 1}


def test_folds_out_of_range_and_empty_ones_are_refused(spark):
    rows = [(float(k), float(k % 5), k % 3) for k in range(60)]
    df = spark.createDataFrame(rows, "x double, y double, Fold int")
    with pytest.raises(ValueError, match="fold 3 is empty"):
        ml.cross_validate(ml.linear(["x"], "y"), df, "line", folds=4, target="y")
    with pytest.raises(Exception, match="Fold number must be in range"):
        ml.cross_validate(ml.linear(["x"], "y"), df, "line", folds=2, target="y")
