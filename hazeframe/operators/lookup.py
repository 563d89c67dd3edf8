"""Join of a fact table to a dimension, safe for large dimensions and hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import segments

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20
# Shares into which rows of hot keys are dealt.
SHARES = 64


def is_small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS, size: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the table has at most ``rows`` rows and ``size`` bytes as text; reads no more rows than that."""
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.select(text.alias("n")).limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size")).first()
    return found["rows"] <= rows and (found["size"] or 0) <= size


def lookup(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``facts`` with the columns of ``dimension``; ``how`` is "left" or "inner".

    A dimension of checked size is broadcast.  A larger one is joined by shuffle.  Hot
    keys of the fact table are dealt into shares then, and their dimension rows
    repeated for each; rows with a null key find nothing and are not shuffled.
    """
    if is_small(dimension, max_rows):
        return facts.join(F.broadcast(dimension), key, how)
    known = facts.where(F.col(key).isNotNull())
    hot = [row[key] for row in segments.hot_keys(known, [key])]
    if hot:
        # At most segments.MAX_HOT keys, so the list is safe to broadcast.
        listed = F.broadcast(facts.sparkSession.createDataFrame([(k,) for k in hot], facts.select(key).schema))
        rest = [c for c in known.columns if c != key]
        dealt = known.join(listed, key, "left_semi").withColumn("_share", F.pmod(F.xxhash64(*rest), F.lit(SHARES)).cast("int"))
        shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
        few = dimension.join(listed, key, "left_semi").withColumn("_share", shares)
        plain = known.join(listed, key, "left_anti").join(dimension, key, how)
        joined = plain.unionByName(dealt.join(few, [key, "_share"], how).drop("_share"))
    else:
        joined = known.join(dimension, key, how)
    if how == "inner":
        return joined
    return joined.unionByName(facts.where(F.col(key).isNull()), allowMissingColumns=True)


def require_unique(dimension: DataFrame, key: str) -> DataFrame:
    """The dimension itself; raises when a key occurs twice."""
    twice = dimension.groupBy(key).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{key} is not unique: {[row[key] for row in twice]}")
    return dimension
