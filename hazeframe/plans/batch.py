"""The whole batch run: CSV files to tables, analyses and models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..constants import NORTH_INDIA, POLLUTANTS, Region
from ..operators import segments
from ..sources import tables
from . import aqi, clean, eda, features, ml, reports


@dataclass
class Output:
    aqi: DataFrame
    analyses: dict[str, DataFrame]
    features: DataFrame
    feature_names: list[str]
    training: ml.Run | None


def index_table(readings: DataFrame, stations: DataFrame, region: Region = NORTH_INDIA, tie=None) -> DataFrame:
    """Raw tables to the index table in one plan: one exchange by station."""
    df = clean.preprocess(readings, stations, region, tie, keep_segments=True)
    return segments.drop_segments(aqi.dominant_pollutant(aqi.calculate(df, segmented=True)))


def feature_table(readings: DataFrame, stations: DataFrame, region: Region = NORTH_INDIA, tie=None, horizon: int = 0) -> DataFrame:
    """Raw tables to model inputs; the cut of hot stations is made once."""
    df = clean.preprocess(readings, stations, region, tie, keep_segments=True)
    df = aqi.dominant_pollutant(aqi.calculate(df, segmented=True))
    if segments.SEG in df.columns:
        df = tables.checkpoint(df)
    df = features.engineer(df, region, horizon=horizon, segmented=True)
    return segments.drop_segments(df)


def load_and_preprocess(
    spark: SparkSession, readings_path: str, stations_path: str,
    save_path: str | None = None, region: Region = NORTH_INDIA,
) -> DataFrame:
    """The clean panel from two CSV files, stored as Parquet when asked to."""
    readings = tables.read_readings(spark, readings_path)
    stations = tables.read_stations(spark, stations_path)
    df = clean.preprocess(readings, stations, region)
    if save_path is None:
        return df
    tables.write_table(df, save_path)
    # Partition columns come back last; the panel has an order of its own.
    return spark.read.parquet(save_path).select(*df.columns)


def load_index_table(
    spark: SparkSession, path: str, readings_path: str, stations_path: str, region: Region = NORTH_INDIA
) -> DataFrame:
    """The stored index table; it is built from the CSV files when missing."""
    def build() -> DataFrame:
        readings = tables.read_readings(spark, readings_path)
        return index_table(readings, tables.read_stations(spark, stations_path), region)

    return tables.load_or_build(spark, path, build)


def run(
    spark: SparkSession, readings_path: str, stations_path: str, out: str,
    region: Region = NORTH_INDIA, train: bool = True, csv: bool = False, **model_sizes: int,
) -> Output:
    """Clean, index, analyses, features and models.

    Every stage is stored and read back, which cuts the lineage and lets the
    analyses prune columns, states and years.  ``csv`` adds the CSV exports.
    """
    cleaned = load_and_preprocess(spark, readings_path, stations_path, f"{out}/clean", region)
    table = aqi.dominant_pollutant(aqi.calculate(cleaned))
    tables.write_table(table, f"{out}/aqi")
    table = tables.read_aqi(spark, f"{out}/aqi").select(*table.columns)
    analyses = eda.run_all(table, region)
    made = features.engineer(table, region)
    names = features.columns(made, region)
    training = ml.run(made, names, folder=out, **model_sizes) if train else None
    if csv:
        tables.write_csv(cleaned, f"{out}/csv/clean")
        reports.export(table, training.results if training else None, f"{out}/csv")
    return Output(table, analyses, made, names, training)


def quality(readings: DataFrame, stations: DataFrame, region: Region = NORTH_INDIA, tie=None) -> DataFrame:
    """Profile of every stage from the joined rows to the features."""
    joined = clean.attach_stations(readings, stations)
    kept = clean.filter_states(joined, region.states)
    dated = clean.add_calendar(clean.parse_datetime(kept), region)
    moment = dated.schema["Datetime"].dataType.simpleString()
    joined, kept = (d.withColumn("Datetime", d["Datetime"].try_cast(moment)) for d in (joined, kept))
    filled = clean.impute(dated, tie)
    cleaned = clean.finalise(clean.dedup(filled, tie), drop=[*tables.ORDINAL, *(tie or [])])
    table = aqi.calculate(cleaned)
    stages = {
        "joined": joined, "states": kept, "dated": dated, "filled": filled,
        "clean": cleaned, "index": table, "features": features.engineer(table, region),
    }
    return reports.quality_profile(stages, POLLUTANTS)


def observed_quality(
    readings: DataFrame, stations: DataFrame, region: Region = NORTH_INDIA, tie=None, run: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """``quality`` from one run of the plan from raw rows to features.

    ``run`` is the action, say a write of the feature table; by default the rows go
    nowhere.  Hot stations are cut as in ``feature_table``.
    """
    seen = reports.Watch(POLLUTANTS)
    joined = seen.watch(clean.attach_stations(readings, stations), "joined")
    kept = seen.watch(clean.filter_states(joined, region.states), "states")
    dated = seen.watch(clean.add_calendar(clean.parse_datetime(kept), region), "dated")
    ties = clean.tie_break(dated, tie)
    cut = segments.split_hot(dated, clean.KEY, clean.fill_order(dated, tie))
    filled = seen.watch(clean.impute(cut, tie, segmented=True), "filled")
    cleaned = seen.watch(clean.finalise(clean.dedup(filled, ties), drop=[*tables.ORDINAL, *ties]), "clean")
    table = seen.watch(aqi.calculate(cleaned, segmented=True), "index")
    made = seen.watch(features.engineer(table, region, segmented=True), "features")
    if run:
        run(segments.drop_segments(made))
    else:
        made.write.format("noop").mode("overwrite").save()
    return seen.table(readings.sparkSession)
