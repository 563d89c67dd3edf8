"""Windows over a panel of time series, one of which may hold most rows.

A Spark window sends a whole partition key to one task.  That is what we want
for ordinary stations, and what we must avoid for a station with a third of all
rows.  So the panel is measured first (one aggregate with map-side combine over
the key and the order columns).  Keys above ``segment_rows`` are cut, along the
window order, into segments of about that size; all other keys stay whole.

* ``split_hot`` adds the column ``_seg`` when there is something to cut.  It is
  null for keys that stay whole and an array of slot numbers otherwise; arrays
  compare in window order.  With no hot key the frame comes back unchanged, and
  the windows need one exchange on the key alone.
* ``with_halo`` gives every segment the last ``k`` rows before it as extra rows,
  so that frames of ``k`` rows are right across the cut.
* ``with_carry`` gives every segment one row with the last known values before
  it and one with the first known values of the key.

Extra rows are flagged and ``drop_extra`` removes them after the windows ran.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import second_of_time
from ..sources.tables import checkpoint

SEG = "_seg"
SIDE = "_side"  # -1 rows before the segment, 0 the segment, 1 rows after it

SEGMENT_ROWS = "hazeframe.segmentRows"
DEFAULT_SEGMENT_ROWS = 4_000_000
# Keys in a list that the driver holds.  By the pigeonhole principle a key outside the
# longest list has fewer than N / MAX_HOT rows.
MAX_HOT = 20_000


def segment_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(SEGMENT_ROWS, str(DEFAULT_SEGMENT_ROWS)))


def _measure(df: DataFrame, name: str) -> Column:
    """An order column as a double that never decreases along the order; null for a type without one."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return second_of_time(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (T.TimestampType, T.NumericType, T.BooleanType)):
        return F.col(name).cast("double")
    return F.lit(None).cast("double")


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int | None = None) -> list:
    """Keys with more than ``rows`` rows, largest first, at most ``MAX_HOT``; a null key is none."""
    return _crowded(df.dropna(how="any", subset=list(keys)), keys, rows).orderBy(F.desc("n"), *keys).limit(MAX_HOT).collect()


def _crowded(df: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    rows = rows or segment_rows(df.sparkSession)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)


def split_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int | None = None
) -> DataFrame:
    """Cut hot keys into segments along ``order``; see the module text.

    A segment that is still too large is cut again, until none is or its rows are
    alike in all of ``order``.  It is cut on the first order column that is not
    constant in it, so copies of one timestamp are cut by the columns that break the
    tie.  Nulls stand first, as in a window, and are cut off from the rest.  Values
    that are no numbers (text), and numbers a double cannot tell apart, are cut into
    the least one and the rest.  Every cut parts the least from the largest.
    """
    rows = rows or segment_rows(df.sparkSession)
    if _crowded(df, keys, rows).isEmpty():
        return df
    while True:
        cuts = checkpoint(_cuts(df, keys, order, rows))
        if cuts.isEmpty():
            return df
        df = _apply_cuts(df, keys, order, cuts)


def _cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int) -> DataFrame:
    """One row per group to cut: key, column number, least value and slot width."""
    group = [*keys, SEG] if SEG in df.columns else list(keys)
    ranges = []
    for i, name in enumerate(order):
        value = _measure(df, name)
        ranges += [F.min(name).alias(f"least{i}"), F.max(name).alias(f"most{i}"), F.count(name).alias(f"known{i}")]
        ranges += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
    stats = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *ranges).where(F.col("n") > rows)
    slots = F.ceil(F.col("n") / rows) * 2
    span = F
    for i in range(len(order)):
        known = F.col(f"known{i}")
        varies = (F.col(f"least{i}") < F.col(f"most{i}")) | ((known > 0) & (known < F.col("n")))
        width = (F.col(f"hi{i}") - F.col(f"lo{i}")) / slots
        cut = F.struct(
            F.lit(i).alias("_on"), F.col(f"least{i}").cast("string").alias("_least"), F.col(f"lo{i}").alias("_lo"), slots.cast("int").alias("_slots"),
            F.when(width > 0, width).alias("_width"),
        )
        span = span.when(varies, cut)
    return stats.select(*group, span.alias("span")).where("span is not null").select(*group, "span.*")


def _apply_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: DataFrame) -> DataFrame:
    again = SEG in df.columns
    group = [*keys, SEG] if again else list(keys)
    names = {name: f"_k{i}" for i, name in enumerate(group)}
    few = cuts.limit(MAX_HOT + 1).count() <= MAX_HOT
    table = cuts.withColumnsRenamed(names)
    same = [F.col(name).eqNullSafe(F.col(renamed)) for name, renamed in names.items()]
    joined = df.join(F.broadcast(table) if few else table, same, "left")
    measure, text, known = F, F, F
    for i, name in enumerate(order):
        on = F.col("_on") == i
        measure, text, known = measure.when(on, _measure(df, name)), text.when(on, F.col(name).cast("string")), known.when(on, F.col(name).isNotNull())
    slot = F.least(F.floor((measure - F.col("_lo")) / F.col("_width")), F.col("_slots") - 1)
    slot = F.when(F.col("_width").isNull(), (text != F.col("_least")).cast("int")).otherwise(slot.cast("int"))
    # A null sorts before every value.
    slot = F.when(known, slot).otherwise(F.lit(-1))
    cut = F.col("_on").isNotNull()
    if again:
        seg = F.when(cut, F.concat(F.col(SEG), F.array(slot))).otherwise(F.col(SEG))
    else:
        seg = F.when(cut, F.array(slot))
    return joined.select(*[c for c in df.columns if c != SEG], seg.alias(SEG))


def series(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """The window of one series (or of one segment of it) in order."""
    if SEG not in df.columns:
        return Window.partitionBy(*keys).orderBy(*order)
    side = [SIDE] if SIDE in df.columns else []
    return Window.partitionBy(*keys, SEG).orderBy(*side, *order)


def _add_side(df: DataFrame, extra: DataFrame) -> DataFrame:
    return df.withColumn(SIDE, F.lit(0)).unionByName(extra, allowMissingColumns=True)


def with_halo(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], k: int, after: bool = False
) -> DataFrame:
    """Add the ``k`` rows before (``after``: behind) each segment; no-op when nothing is cut."""
    if SEG not in df.columns:
        return df
    cut = df.where(F.col(SEG).isNotNull())
    near = Window.partitionBy(*keys, SEG).orderBy(*(order if after else [F.desc(c) for c in order]))
    fields = list(dict.fromkeys([*order, *cols]))
    ends = (
        cut.select(*keys, SEG, *[c for c in fields if c not in keys])
        .withColumn("_r", F.row_number().over(near))
        .where(F.col("_r") <= k)
        .groupBy(*keys, SEG)
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_ends"))
    )
    # One row per segment; each other segment has at least one row, so the k
    # segments next to it hold the k rows next to it.
    by_seg = Window.partitionBy(*keys).orderBy(SEG)
    halo = F.flatten(F.collect_list("_ends").over(by_seg.rowsBetween(1, k) if after else by_seg.rowsBetween(-k, -1)))
    halo = F.slice(halo, 1, k) if after else F.slice(halo, F.greatest(F.size(halo) - k + 1, F.lit(1)), F.lit(k))
    extra = (
        ends.select(*keys, SEG, halo.alias("_halo"))
        .select(*keys, SEG, F.explode("_halo").alias("_row"))
        .select(
            *keys, SEG, *[F.col("_row")[c].alias(c) for c in fields], F.lit(1 if after else -1).alias(SIDE)
        )
    )
    return _add_side(df, extra)


def with_time_halo(
    df: DataFrame, keys: Sequence[str], at: str, cols: Sequence[str], span: int
) -> DataFrame:
    """Add the rows up to ``span`` before the first of each segment; no-op when nothing is cut.

    ``at`` is a whole number that the frame was cut along (so rows equal in it are in
    one segment).  However short segments are, a row is found by all that need it:
    they meet by spans of time, of which a segment's halo touches two.
    """
    if SEG not in df.columns:
        return df
    cut = df.where(F.col(SEG).isNotNull())
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    slot = F.floor(F.col(at) / span).cast("long")
    starts = cut.groupBy(*keys, SEG).agg(F.min(at).alias("_start"))
    starts = starts.withColumn("_slot", F.explode(F.array(F.floor(F.col("_start") / span).cast("long") - 1, F.floor(F.col("_start") / span).cast("long"))))
    starts = starts.withColumnsRenamed({**names, SEG: "_of"})
    rows = cut.select(*keys, SEG, at, *[c for c in cols if c not in (*keys, at)], slot.alias("_slot"))
    same = [F.col(k).eqNullSafe(F.col(renamed)) for k, renamed in names.items()]
    near = (rows["_slot"] == starts["_slot"]) & (F.col(at) < F.col("_start")) & (F.col(at) >= F.col("_start") - span)
    for part in same:
        near = near & part
    extra = rows.join(starts, near).select(*keys, F.col("_of").alias(SEG), at, *[c for c in cols if c not in (*keys, at)], F.lit(-1).alias(SIDE))
    return _add_side(df, extra)


def with_carry(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """Add the last known values before and the first known values of the key."""
    if SEG not in df.columns:
        return df
    moment = F.struct(*order)
    first_last = []
    for c in cols:
        known = F.when(F.col(c).isNotNull(), moment)
        first_last += [F.min_by(c, known).alias(f"_f_{c}"), F.max_by(c, known).alias(f"_l_{c}")]
    ends = df.where(F.col(SEG).isNotNull()).groupBy(*keys, SEG).agg(*first_last)
    by_seg = Window.partitionBy(*keys).orderBy(SEG)
    before = by_seg.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_seg.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = {f"_l_{c}": F.last(f"_l_{c}", True).over(before) for c in cols}
    known |= {f"_f_{c}": F.first(f"_f_{c}", True).over(whole) for c in cols}
    sides = [
        F.struct(F.lit(side).alias(SIDE), *[F.col(f"{mark}{c}").alias(c) for c in cols])
        for side, mark in ((-1, "_l_"), (1, "_f_"))
    ]
    extra = ends.withColumns(known).select(*keys, SEG, F.inline(F.array(*sides)))
    return _add_side(df, extra)


def drop_extra(df: DataFrame) -> DataFrame:
    return df.where(F.col(SIDE) == 0).drop(SIDE) if SIDE in df.columns else df


def drop_segments(df: DataFrame) -> DataFrame:
    return df.drop(SEG)
