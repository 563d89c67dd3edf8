"""Two check panels in the shape of the raw input, made from the test tables.

* ``sensor``: irregular series of one month from ``events``; natural gaps, bad
  times, negatives, a reported index; all seven index pollutants.
* ``daily``: series over seven years from ``lineitem``; duplicate keys, four
  pollutants, no reported index.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.constants import Region
from hazeframe.operators import segments
from hazeframe.plans import aqi, batch, clean

REGION = Region(
    states=("AFRICA", "AMERICA", "ASIA", "EUROPE"),
    burning=("AFRICA", "AMERICA"),
    burn_chart=("AFRICA", "AMERICA", "ASIA"),
    centroids={
        "AFRICA": (2.0, 16.0),
        "AMERICA": (39.0, -98.0),
        "ASIA": (34.0, 100.0),
        "EUROPE": (54.0, 15.0),
    },
)

SENSOR_TIE = ["event_id"]
DAILY_TIE = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    value, kind = F.col("value"), F.col("event_type")
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("double")
    every = lambda n: F.col("event_id") % n == 0
    return events.select(
        F.col("user_id").cast("string").alias("StationId"),
        F.when(every(97), "bad").otherwise(F.col("ts").cast("string")).alias("Datetime"),
        F.when(kind == "click", value).alias("PM25"),
        F.when(kind == "view", value - 5.0).alias("PM10"),
        F.when(kind == "purchase", value).alias("NOx"),
        F.when(kind == "error", value * 6.0).alias("NH3"),
        F.when(every(60), k / 2.0).otherwise(k / 100.0).alias("CO"),
        F.when(kind == "signup", value).alias("SO2"),
        F.when(every(70), k * 10.0).otherwise(k * F.lit(0.6)).alias("O3"),
        F.when(every(10), value * 2.0).alias("AQI"),
        "event_id",
    )


def _stations(spark: SparkSession, sf_dir: str, name: str, key: str, label: str, nation: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, name)
        .join(places, F.col(nation) == F.col("n_nationkey"))
        .select(
            F.col(key).cast("string").alias("StationId"),
            F.col(label).alias("StationName"),
            F.col("n_name").alias("City"),
            F.col("r_name").alias("State"),
        )
    )


def sensor_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stations(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")


def daily_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stations(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")


def daily_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    month, supp = F.month("l_shipdate"), F.col("l_suppkey")
    season = (
        F.when(month.isin(12, 1, 2), 8.0).when(month.isin(3, 4, 5), 3.0)
        .when(month.isin(6, 7, 8, 9), 1.0).otherwise(5.0)
    )
    place = (
        F.when(supp % 4 == 0, 0.2).when(supp % 4 == 1, 0.5).when(supp % 4 == 2, 1.0).otherwise(3.0)
    )
    dust = F.when(month.isin(5, 6), 3.0).otherwise(0.7)
    size = F.when(supp % 5 == 0, 3.0).otherwise(1.0)
    return table(spark, sf_dir, "lineitem").select(
        supp.cast("string").alias("StationId"),
        F.col("l_shipdate").alias("Datetime"),
        (F.col("l_quantity") * season * place).alias("PM25"),
        F.floor(F.col("l_extendedprice") / 400.0 * size * dust).cast("double").alias("PM10"),
        F.when(F.col("l_returnflag") != "R", F.col("l_discount") * 1000.0).alias("NOx"),
        F.when(F.col("l_linestatus") != "O", F.col("l_tax") * 1000.0).alias("SO2"),
        *DAILY_TIE,
    )


@dataclass
class Panel:
    """A panel at every stage of the plan."""

    spark: SparkSession
    sf_dir: str
    kind: str
    tie: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.tie = SENSOR_TIE if self.kind == "sensor" else DAILY_TIE

    @property
    def readings(self) -> DataFrame:
        make = sensor_readings if self.kind == "sensor" else daily_readings
        return make(self.spark, self.sf_dir)

    @property
    def stations(self) -> DataFrame:
        make = sensor_stations if self.kind == "sensor" else daily_stations
        return make(self.spark, self.sf_dir)

    @property
    def joined(self) -> DataFrame:
        return clean.attach_stations(self.readings, self.stations)

    @property
    def in_states(self) -> DataFrame:
        return clean.filter_states(self.joined, REGION.states)

    @property
    def dated(self) -> DataFrame:
        return clean.add_calendar(clean.parse_datetime(self.in_states), REGION)

    @property
    def clean(self) -> DataFrame:
        return clean.preprocess(self.readings, self.stations, REGION, self.tie)

    @property
    def exposed(self) -> DataFrame:
        cut = clean.preprocess(self.readings, self.stations, REGION, self.tie, keep_segments=True)
        return segments.drop_segments(aqi.exposures(cut, segmented=True))

    @property
    def indexed(self) -> DataFrame:
        return batch.index_table(self.readings, self.stations, REGION, self.tie)

    @property
    def featured(self) -> DataFrame:
        return batch.feature_table(self.readings, self.stations, REGION, self.tie)


def sensor(spark: SparkSession, sf_dir: str) -> Panel:
    return Panel(spark, sf_dir, "sensor")


def daily(spark: SparkSession, sf_dir: str) -> Panel:
    return Panel(spark, sf_dir, "daily")
