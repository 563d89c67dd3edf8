"""Numbers of rows in a total order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import checkpoint
from .lookup import lookup


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "Position") -> DataFrame:
    """Adds the position of each row, from 0, in the order.

    The rows are dealt out by range and sorted within their ranges, stored, and
    shifted by the sizes of the ranges before.  Rows that tie in all of ``order`` get
    positions in any order, so it should name a key.
    """
    sort = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # Within a partition the id grows by one from row to row.
    stored = checkpoint(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    # One row per range.
    found = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).orderBy("_part").collect()
    shifts, before = [], 0
    for row in found:
        shifts.append((row["_part"], before - row["first"]))
        before += row["n"]
    table = df.sparkSession.createDataFrame(shifts, "_part int, _shift long")
    return lookup(stored, table, "_part").withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def split_at(df: DataFrame, share: float, order: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """The first ``int(rows * share)`` rows in the order, exactly, and the rest."""
    placed = checkpoint(with_position(df, order, "_position"))
    first = int(placed.count() * share)
    return placed.where(F.col("_position") < first).drop("_position"), placed.where(F.col("_position") >= first).drop("_position")
