"""CSV and Parquet tables: schemas, readers, writers, checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import EXTERNAL, POLLUTANTS

# Position of a CSV row: file, block of the file, number within the block.
ORDINAL = ("_file", "_block", "_row")

STATION_NUMBERS = ("Latitude", "Longitude")
_INNER = {outside: inside for inside, outside in EXTERNAL.items()}


def inner_name(name: str) -> str:
    """Library spelling of an outside column name."""
    return _INNER.get(name, name).replace(" ", "_").replace(".", "_")


def outer_name(name: str) -> str:
    """Outside spelling of a library column name."""
    if name.startswith("State_"):
        return "State_" + name[len("State_"):].replace("_", " ")
    return EXTERNAL.get(name, name)


def number(col: Column) -> Column:
    """Text to a double; text that is no number, NaN and infinity are null."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text and with its library name."""
    raw = spark.read.csv(path, header=True)
    return raw.toDF(*[inner_name(c) for c in raw.columns])


def read_readings(spark: SparkSession, path: str, ordinal: bool = True) -> DataFrame:
    """Hourly readings; only the header is looked at, no type is inferred.

    With ``ordinal`` the row position is kept, so that "first" among copies
    means file order.
    """
    raw = spark.read.csv(path, header=True)
    numeric = [c for c in raw.columns if inner_name(c) in (*POLLUTANTS, "AQI")]
    cols = [
        (number(F.col(f"`{c}`")) if c in numeric else F.col(f"`{c}`")).alias(inner_name(c))
        for c in raw.columns
    ]
    if ordinal:
        cols += [
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        ]
    return raw.select(*cols)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    raw = read_text_csv(spark, path)
    return raw.withColumns({c: number(F.col(c)) for c in STATION_NUMBERS if c in raw.columns})


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV with the outside column names; timestamps without a zone."""
    plain = df.select(*[F.col(c).alias(outer_name(c)) for c in df.columns])
    plain.write.mode(mode).csv(path, header=True)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("State", "Year"), mode: str = "overwrite"
) -> None:
    """Parquet, the working format.

    Rows are range-partitioned on the partition columns and time first: every
    task then writes few directories, and a state with most rows is spread over
    many tasks.
    """
    cols = [c for c in partition_by if c in df.columns]
    if not cols:
        df.write.mode(mode).parquet(path)
        return
    spread = [*cols, *[c for c in ("Datetime", "StationId") if c in df.columns]]
    df.repartitionByRange(*spread).write.mode(mode).partitionBy(*cols).parquet(path)


def read_aqi(spark: SparkSession, path: str) -> DataFrame:
    """The stored index table, Parquet or CSV; bad times become null."""
    if format_of(spark, path) == "parquet":
        return spark.read.parquet(path)
    raw = read_text_csv(spark, path)
    text = {"StationId", "StationName", "City", "State", "Season", "AQI_Category", "DominantPollutant"}
    whole = {"Year", "Month", "Day", "Hour", "DayOfWeek", "IsWeekend", "CropBurning", "Season_Enc"}
    typed = {}
    for c in raw.columns:
        if c == "Datetime":
            typed[c] = F.col(c).try_cast("timestamp_ntz")
        elif c in whole or (c.startswith("State_")):
            typed[c] = F.col(c).try_cast("int")
        elif c not in text:
            typed[c] = number(F.col(c))
    return raw.withColumns(typed)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at the path, readable or not."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def format_of(spark: SparkSession, path: str) -> str:
    """"parquet" or "csv", by the names of the files at the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    names = []
    while found.hasNext() and len(names) < 1000:
        names.append(found.next().getPath().getName())
    # A table whose files say nothing is read as Parquet, which raises if it is none.
    return "csv" if any(n.endswith((".csv", ".csv.gz")) for n in names) else "parquet"


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table, Parquet or CSV; when the path holds nothing it is built and stored first.

    A table that cannot be read raises, and stays as it is.
    """
    if not exists(spark, path):
        write_table(build(), path, mode="error")
    return read_aqi(spark, path)


RESULTS = T.StructType(
    [
        T.StructField("Model", T.StringType()),
        T.StructField("RMSE", T.DoubleType()),
        T.StructField("MAE", T.DoubleType()),
        T.StructField("R2", T.DoubleType()),
    ]
)


def write_results(results: DataFrame, path: str) -> None:
    write_csv(results.select(*RESULTS.names), path)


def read_results(spark: SparkSession, path: str) -> DataFrame | None:
    """Model metrics, ``None`` when they were never written."""
    if not exists(spark, path):
        return None
    return spark.read.csv(path, header=True, schema=RESULTS)


_STORED: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder; ``release`` deletes it."""
    path = f"{shared_folder(spark)}/hazeframe-{uuid.uuid4().hex}"
    _STORED.append(path)
    return path


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the frame to the shared folder and read it back.

    The stored table survives the loss of any executor, is computed once, and
    later reads prune columns and push filters down.  ``release`` deletes it.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what ``checkpoint`` and ``scratch`` stand for; frames that read it end."""
    while _STORED:
        target = spark._jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where that is not set, a folder in the warehouse, which is shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/hazeframe-scratch"
