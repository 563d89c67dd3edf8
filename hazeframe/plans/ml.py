"""Split, regression models, metrics, cross-validation, importance, scoring.

The target is the current index (``horizon=0`` of the features), as in the
published pipeline.  Then the first lag plus the first delta equal the target,
so near-perfect scores say nothing about forecasting; train on features with
``horizon=1`` and ``target="Target"`` for an honest next-hour model.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import CYCLES, NORTH_INDIA, REQUEST_YEAR, Region, state_column
from ..functions.calendar import crop_burning, cyclic, season, season_code
from ..functions.index import forecast_category
from ..functions.numeric import clip
from ..operators import distribution as dist
from ..sources import tables

TARGET = "AQI_Final"
SEED = 42
LOW, HIGH = 0.0, 500.0
# Rounds without a gain after which boosting ends.
PATIENCE = 50

LINEAR, FOREST, BOOSTED = "Linear Regression", "Random Forest", "Boosted Trees"


# --- data ---------------------------------------------------------------------

def complete_cases(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    return df.dropna(how="any", subset=[*features, target])


def cutoff(df: DataFrame, share: float) -> DataFrame:
    """One row: the time at position ``int(rows * share)`` of the timeline.

    Found from counts per time stamp and day, without sorting the rows.
    """
    counts = dist.value_counts(df, (), "Datetime", dist.day_bucket)
    at = dist.at_positions(counts, (), {"Cutoff": lambda n: F.floor(n * F.lit(share))})
    return at.select("Cutoff")


def temporal_split(df: DataFrame, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Earlier rows to train, later rows to test; one time is never in both."""
    # One value, taken now: a literal is pushed down to the scan, and the many
    # jobs of a training run do not look for it again.
    at = _cutoff_literal(df, 1 - test_size)
    return df.where(F.col("Datetime") < at), df.where(F.col("Datetime") >= at)


def _cutoff_literal(df: DataFrame, share: float) -> Column:
    """The cutoff as text of the column's own type, free of any session zone."""
    row = cutoff(df, share).select(F.col("Cutoff").cast("string")).first()
    if row is None:
        raise ValueError("no rows to split")
    return F.lit(row[0]).cast(df.schema["Datetime"].dataType)


def mark_validation(train: DataFrame, share: float = 0.1) -> DataFrame:
    """``Validation`` is true for the last part of the training timeline."""
    at = _cutoff_literal(train, 1 - share)
    return train.withColumn("Validation", F.col("Datetime") >= at)


# --- models -------------------------------------------------------------------

def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def linear(features: Sequence[str], target: str = TARGET) -> Pipeline:
    """Standardised least squares."""
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled")
    model = LinearRegression(
        featuresCol="scaled", labelCol=target, regParam=0.0, tol=1e-12, maxIter=1000
    )
    return Pipeline(stages=[_assembler(features), scaler, model])


def forest(
    features: Sequence[str], target: str = TARGET, trees: int = 300, depth: int = 20
) -> Pipeline:
    model = RandomForestRegressor(
        labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=10,
        featureSubsetStrategy="sqrt", seed=SEED,
    )
    return Pipeline(stages=[_assembler(features), model])


def boosted(
    features: Sequence[str], target: str = TARGET, rounds: int = 1000, depth: int = 7
) -> Pipeline:
    """Gradient-boosted trees, all rounds of them."""
    model = GBTRegressor(
        labelCol=target, maxIter=rounds, stepSize=0.05, maxDepth=depth,
        subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=SEED,
    )
    return Pipeline(stages=[_assembler(features), model])


def train_linear(train: DataFrame, features: Sequence[str], target: str = TARGET) -> PipelineModel:
    return linear(features, target).fit(train)


def train_forest(
    train: DataFrame, features: Sequence[str], target: str = TARGET, **size: int
) -> PipelineModel:
    return forest(features, target, **size).fit(train)


def validation_curve(model: PipelineModel, df: DataFrame) -> list[float]:
    """Squared error on ``df`` after each round of a boosted model."""
    return list(model.stages[-1].evaluateEachIteration(model.stages[0].transform(df), "squared"))


def best_prefix(curve: Sequence[float], patience: int) -> int:
    """Rounds up to the best one, looking no further than ``patience`` rounds without a better."""
    best = 0
    for i, error in enumerate(curve):
        if error < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def train_boosted(
    train: DataFrame, features: Sequence[str], target: str = TARGET, rounds: int = 1000, depth: int = 7,
    patience: int = PATIENCE,
) -> PipelineModel:
    """Boosted trees, stopped where the last tenth of the timeline gains no more.

    The rounds before the cut are those of the longer training: each has a seed of
    its own, so training again to the best round gives its first trees.
    """
    marked = mark_validation(train)
    rows = marked.where(~F.col("Validation"))
    model = boosted(features, target, rounds, depth).fit(rows)
    kept = best_prefix(validation_curve(model, marked.where("Validation")), patience)
    return model if kept == rounds else boosted(features, target, kept, depth).fit(rows)


def rounds_kept(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


# --- scoring and metrics ------------------------------------------------------

def prediction_column(name: str) -> str:
    return "Pred_" + name.replace(" ", "_")


def score(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """``df`` with the clipped prediction of the model in ``Pred_<name>``."""
    out = model.transform(df)
    value = clip(F.col("prediction"), LOW, HIGH)
    extra = [c for c in out.columns if c not in df.columns]
    return out.withColumn(prediction_column(name), value).drop(*extra)


def evaluate(df: DataFrame, prediction: str, name: str, target: str = TARGET) -> DataFrame:
    """One row: ``Model``, ``RMSE``, ``MAE``, ``R2``."""
    error = F.col(target) - F.col(prediction)
    total = F.var_pop(target) * F.count(target)
    return df.agg(
        F.lit(name).alias("Model"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.avg(F.abs(error)).alias("MAE"),
        (1 - F.sum(error * error) / F.nullif(total, F.lit(0.0))).alias("R2"),
    )


def comparison(df: DataFrame, names: Sequence[str], target: str = TARGET) -> DataFrame:
    """Metrics of several models whose predictions are columns of ``df``.

    One pass: the predictions are turned into rows, then grouped by model.
    """
    cols = {prediction_column(n): n for n in names}
    long = df.select(target, *cols).unpivot([target], list(cols), "_column", "_prediction")
    error = F.col(target) - F.col("_prediction")
    total = F.var_pop(target) * F.count(target)
    label = reduce(
        lambda expr, item: expr.when(F.col("_column") == item[0], F.lit(item[1])), cols.items(), F
    )
    return (
        long.groupBy(label.alias("Model"))
        .agg(
            F.sqrt(F.avg(error * error)).alias("RMSE"),
            F.avg(F.abs(error)).alias("MAE"),
            (1 - F.sum(error * error) / F.nullif(total, F.lit(0.0))).alias("R2"),
        )
    )


def best_model(results: DataFrame) -> DataFrame:
    """The row with the least RMSE, by name on a tie."""
    best = F.min_by(F.struct("Model", "RMSE", "MAE", "R2"), F.struct("RMSE", "Model"))
    return results.agg(best.alias("b")).select("b.*")


def prediction_pairs(df: DataFrame, names: Sequence[str], target: str = TARGET) -> DataFrame:
    """``Model``, ``Actual``, ``Predicted``: a row per test row and model."""
    cols = {prediction_column(n): n for n in names}
    long = df.select(target, *cols).unpivot([target], list(cols), "_column", "Predicted")
    label = reduce(lambda expr, item: expr.when(F.col("_column") == item[0], F.lit(item[1])), cols.items(), F)
    return long.select(label.alias("Model"), F.col(target).alias("Actual"), "Predicted")


def actual_vs_predicted(
    df: DataFrame, names: Sequence[str], target: str = TARGET
) -> DataFrame:
    """Range of both axes and R² per model, in one pass; the points are ``prediction_pairs``."""
    error = F.col("Actual") - F.col("Predicted")
    total = F.var_pop("Actual") * F.count("Actual")
    return prediction_pairs(df, names, target).groupBy("Model").agg(
        F.count("Predicted").alias("Pairs"),
        F.least(F.min("Actual"), F.min("Predicted")).alias("Low"),
        F.greatest(F.max("Actual"), F.max("Predicted")).alias("High"),
        (1 - F.sum(error * error) / F.nullif(total, F.lit(0.0))).alias("R2"),
    )


def residuals(df: DataFrame, name: str, target: str = TARGET) -> DataFrame:
    return df.withColumn("Residual", F.col(target) - F.col(prediction_column(name)))


def residual_summary(df: DataFrame, name: str, target: str = TARGET) -> DataFrame:
    rest = residuals(df, name, target)
    return rest.agg(
        F.lit(name).alias("Model"),
        F.count("Residual").alias("Count"),
        F.avg("Residual").alias("Mean"),
        F.stddev_pop("Residual").alias("Std"),
    )


def residual_histogram(
    df: DataFrame, name: str, target: str = TARGET, bins: int = 60, decimals: int = 6
) -> DataFrame:
    """Histogram of the residuals, rounded so that equal ones combine."""
    rest = residuals(df, name, target)
    counts = dist.value_counts(rest.withColumn("Residual", F.round("Residual", decimals)), (), "Residual")
    return dist.histogram(counts, (), bins)


def residual_density(
    df: DataFrame, name: str, target: str = TARGET, points: int = 200, decimals: int = 6
) -> DataFrame:
    rest = residuals(df, name, target)
    counts = dist.value_counts(rest.withColumn("Residual", F.round("Residual", decimals)), (), "Residual")
    return dist.density(counts, (), points)


def importance(model: PipelineModel, spark: SparkSession, top_n: int = 20) -> DataFrame | None:
    """Largest feature importances of a tree model; ``None`` for a linear one."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return None
    names = model.stages[0].getInputCols()
    rows = [(n, float(v)) for n, v in zip(names, last.featureImportances.toArray(), strict=True)]
    table = spark.createDataFrame(rows, "Feature string, Importance double")
    return table.orderBy(F.desc("Importance"), "Feature").limit(top_n)


# --- cross-validation ---------------------------------------------------------

def with_folds(df: DataFrame, folds: int = 5, seed: int = SEED) -> DataFrame:
    """``Fold`` from a hash of the row key: the same after any recomputation."""
    key = F.xxhash64(F.lit(seed), "StationId", "Datetime")
    return df.withColumn("Fold", F.pmod(key, F.lit(folds)).cast("int"))


def _checked_folds(df: DataFrame, folds: int) -> DataFrame:
    fold = F.col("Fold")
    wrong = F.raise_error(F.printf(F.lit(f"Fold number must be in range [0, {folds}), but got %s"), fold))
    return df.withColumn("Fold", F.when((fold >= 0) & (fold < folds), fold).otherwise(wrong))


def _cross_validate(
    estimator: Pipeline, train: DataFrame, metric: str, folds: int, target: str
) -> list[float]:
    """The metric on every fold, of a model fitted on the other folds.

    Stages ahead that learn nothing, such as the assembling of the inputs, run once for
    all folds; their output is kept without its order or partitions changing, so every
    model is what the whole estimator gives on its folds.  No model of all rows is
    fitted, as nothing is asked of one.
    """
    stages = estimator.getStages()
    ahead = next((i for i, stage in enumerate(stages) if isinstance(stage, Estimator)), len(stages))
    data = _checked_folds(train if "Fold" in train.columns else with_folds(train, folds), folds)
    data = PipelineModel(stages[:ahead]).transform(data)
    made = [stage.getOutputCol() for stage in stages[:ahead]]
    evaluator = RegressionEvaluator(labelCol=target, metricName=metric)
    with _persisted(data.select(*made, target, "Fold")) as data:
        # Also fills the store, all partitions at once.
        sizes = {row["Fold"]: row["count"] for row in data.groupBy("Fold").count().collect()}
        scores = []
        for k in range(folds):
            if not sizes.get(k):
                raise ValueError(f"The validation data at fold {k} is empty.")
            if sizes[k] == sum(sizes.values()):
                raise ValueError(f"The training data at fold {k} is empty.")
            model = Pipeline(stages=stages[ahead:]).fit(data.where(F.col("Fold") != k))
            scores.append(float(evaluator.evaluate(model.transform(data.where(F.col("Fold") == k)))))
    return scores


@contextmanager
def _persisted(df: DataFrame) -> Iterator[DataFrame]:
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def cross_validate(
    estimator: Pipeline, train: DataFrame, name: str, folds: int = 5, target: str = TARGET
) -> DataFrame:
    """Mean and standard deviation of R² over shuffled folds, or those of a column ``Fold`` (0 on)."""
    scores = _cross_validate(estimator, train, "r2", folds, target)
    row = (name, float(np.mean(scores)), float(np.std(scores)))
    return train.sparkSession.createDataFrame([row], "Model string, MeanR2 double, StdR2 double")


def cross_validate_boosted(
    estimator: Pipeline, train: DataFrame, name: str = BOOSTED, folds: int = 5, target: str = TARGET
) -> DataFrame:
    """R² taken from the mean RMSE of the folds and the variance of the target."""
    rmse = float(np.mean(_cross_validate(estimator, train, "rmse", folds, target)))
    return train.agg(
        F.lit(name).alias("Model"),
        F.lit(rmse).alias("MeanRMSE"),
        (1 - F.lit(rmse * rmse) / F.nullif(F.var_pop(target), F.lit(0.0))).alias("MeanR2"),
    )


# --- requests -----------------------------------------------------------------

def request_features(requests: DataFrame, region: Region = NORTH_INDIA) -> DataFrame:
    """Model inputs from short requests: state, month, hour, weekday and four lags.

    Rolls and deltas are rough stand-ins made from the lags, the year is fixed.
    """
    l1, l3, l6, l24 = (F.col(f"aqi_lag{n}") for n in (1, 3, 6, 24))
    month, state = F.col("month"), F.col("State")
    made: dict[str, Column] = {
        "AQI_Lag1": l1, "AQI_Lag3": l3, "AQI_Lag6": l6, "AQI_Lag24": l24,
        "AQI_Roll3": (l1 + l3) / 2,
        "AQI_Roll6": (l1 + l3 + l6) / 3,
        "AQI_Roll24": (l1 + l3 + l6 + l24) / 4,
        "AQI_Delta1": l1 - l3,
        "AQI_Delta6": l1 - l6,
    }
    moment = {"Month": month, "Hour": F.col("hour"), "DoW": F.col("dow")}
    for label, (_, period) in CYCLES.items():
        made[f"{label}_Sin"], made[f"{label}_Cos"] = cyclic(moment[label], period)
    requests = requests.withColumn("_season", season("month"))
    made["Season_Enc"] = F.coalesce(season_code("_season"), F.lit(0))
    made["IsWeekend"] = (F.col("dow") >= 5).cast("int")
    made["CropBurning"] = crop_burning(month, state, region.burning)
    made["Year"] = F.lit(REQUEST_YEAR)
    for s in region.states:
        made[state_column(s)] = F.coalesce(state == s, F.lit(False)).cast("int")
    taken = {n.lower() for n in made}
    rest = [c for c in requests.columns if c != "_season" and c.lower() not in taken]
    return requests.select(*rest, *[c.alias(n) for n, c in made.items()])


def score_requests(
    model: PipelineModel, requests: DataFrame, region: Region = NORTH_INDIA
) -> DataFrame:
    """Prediction and category per request; inputs a request lacks are 0."""
    names = model.stages[0].getInputCols()
    df = request_features(requests, region)
    df = df.withColumns({n: F.lit(0.0) for n in names if n not in df.columns})
    out = model.transform(df.na.fill(0.0, names))
    out = out.select(*requests.columns, clip(F.col("prediction"), LOW, HIGH).alias("Prediction"))
    return out.withColumn("Category", forecast_category("Prediction"))


# --- storage ------------------------------------------------------------------

def model_folder(name: str) -> str:
    return name.lower().replace(" ", "_")


def save(models: Mapping[str, PipelineModel], best: str, folder: str) -> None:
    """Every model under its name, and the best one again as ``best_model``."""
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/{model_folder(name)}")
    models[best].write().overwrite().save(f"{folder}/best_model")


def load(
    spark: SparkSession, folder: str, name: str = "best_model"
) -> tuple[PipelineModel | None, list[str] | None]:
    """A stored model and its inputs; ``(None, None)`` when there is none."""
    path = f"{folder}/{model_folder(name)}"
    if not tables.exists(spark, f"{path}/metadata"):
        return None, None
    model = PipelineModel.load(path)
    return model, list(model.stages[0].getInputCols())


# --- everything ---------------------------------------------------------------

@dataclass
class Run:
    """What a training run leaves: all lazy but the models."""

    results: DataFrame
    cross_validation: DataFrame
    best: str
    models: dict[str, PipelineModel]
    scored: DataFrame


def run(
    df: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    folder: str | None = None,
    trees: int = 300,
    tree_depth: int = 20,
    rounds: int = 1000,
    boost_depth: int = 7,
    folds: int = 5,
) -> Run:
    """Split, train the three models, compare, cross-validate and store.

    The model inputs are stored first: training reads them many times.
    """
    keys = [c for c in ("StationId", "Datetime") if c not in features]
    cases = complete_cases(df, features, target).select(*keys, *features, target)
    train, test = temporal_split(tables.checkpoint(cases))
    models = {
        LINEAR: train_linear(train, features, target),
        FOREST: train_forest(train, features, target, trees=trees, depth=tree_depth),
        BOOSTED: train_boosted(train, features, target, rounds=rounds, depth=boost_depth),
    }
    scored = test
    for name, model in models.items():
        scored = score(model, scored, name)
    results = tables.checkpoint(comparison(scored, list(models), target))
    best = best_model(results).first()["Model"]
    checks = [
        cross_validate(linear(features, target), train, LINEAR, folds, target),
        cross_validate(forest(features, target, trees, tree_depth), train, FOREST, folds, target),
    ]
    kept = max(rounds_kept(models[BOOSTED]), 1)
    again = boosted(features, target, kept, boost_depth)
    checks.append(cross_validate_boosted(again, train, BOOSTED, folds, target))
    cv = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checks)
    if folder:
        save(models, best, f"{folder}/models")
        tables.write_results(results, f"{folder}/ml_results")
    return Run(results, cv, best, models, scored)
