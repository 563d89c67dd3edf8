"""Sketches that merge: quantiles (KLL) and distinct counts (HyperLogLog).

A sketch per small group, say a day, is stored once; months, years or any other
grouping then merge sketches instead of reading rows.  The exact operators stay the
default; these are for raw columns with values without number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a quantile sketch, and binary logarithm of the cells of a distinct sketch.
KLL_SIZE = 1000
HLL_BITS = 12


def rank_error(size: int = KLL_SIZE) -> float:
    """Share of the values by which a quantile's rank is off at most, with 99 % confidence."""
    return 2.296 / size**0.9021


def distinct_error(bits: int = HLL_BITS) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / 2 ** (bits / 2)


def by_group(
    df: DataFrame, keys: Sequence[str | Column], quantiles: Sequence[str] = (), distinct: Sequence[str] = (),
    size: int = KLL_SIZE, bits: int = HLL_BITS,
) -> DataFrame:
    """Per group ``Kll_<column>`` and ``Hll_<column>``, binary.  Nulls, and values that are no number, are not counted."""
    aggs = [F.kll_sketch_agg_double(F.when(~F.isnan(c), F.col(c).cast("double")), F.lit(size)).alias(f"Kll_{c}") for c in quantiles]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias(f"Hll_{c}") for c in distinct]
    return df.groupBy(*keys).agg(*aggs)


def merge(sketches: DataFrame, keys: Sequence[str | Column], size: int = KLL_SIZE) -> DataFrame:
    """The sketches of coarser groups."""
    aggs = [F.kll_merge_agg_double(c, F.lit(size)).alias(c) for c in sketches.columns if c.startswith("Kll_")]
    aggs += [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.startswith("Hll_")]
    return sketches.groupBy(*keys).agg(*aggs)


def estimates(sketches: DataFrame, quantiles: Mapping[str, tuple[str, float]] | None = None, distinct: Mapping[str, str] | None = None) -> DataFrame:
    """Sketches replaced by named estimates: a quantile of a column (null without values), distinct values of a column."""
    made = {}
    for name, (column, share) in (quantiles or {}).items():
        some = F.kll_sketch_get_n_double(f"Kll_{column}") > 0
        made[name] = F.when(some, F.kll_sketch_get_quantile_double(f"Kll_{column}", F.lit(float(share))))
    for name, column in (distinct or {}).items():
        made[name] = F.hll_sketch_estimate(f"Hll_{column}")
    rest = [c for c in sketches.columns if not c.startswith(("Kll_", "Hll_"))]
    return sketches.select(*rest, *[value.alias(name) for name, value in made.items()])
