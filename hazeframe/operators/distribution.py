"""Exact order statistics, box statistics, histograms and density curves.

Every statistic starts from ``value_counts``: one row per distinct value and
group.  Equal values are combined before the shuffle, and the shuffle is on
(group, value), so a group with most rows is spread over all tasks.

Exact quantiles then need no sorted group.  The distinct values are counted in
buckets of a fixed scale; running totals over the buckets of a group (a number
bounded by the range of doubles, not by the data) tell which buckets hold the
wanted positions, and only these few buckets are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import mean_of, scaled

ALL = "_all"  # key of the single group of an ungrouped statistic
_BUCKETS_PER_E = 256
# Width of a density's cells in bandwidths, and terms of their expansion.
CELL = 0.5
TERMS = 12


def number_bucket(value: Column) -> Column:
    """Order-keeping bucket of a number: relative width 1/256, linear near 0."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * _BUCKETS_PER_E).cast("int")


def day_bucket(moment: Column) -> Column:
    return F.to_date(moment)


def value_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    bucket: Callable[[Column], Column] = number_bucket,
) -> DataFrame:
    """Columns: keys, ``_b`` bucket, ``_v`` value, ``_n`` rows.

    Null values and rows with a null key do not take part.
    """
    # Counting the value and asking for a positive count keeps nulls out without
    # a test on the value: Spark would copy its whole computation into a filter.
    rows = df.dropna(how="any", subset=list(keys)) if keys else df
    rows = rows.select(*keys, bucket(F.col(value)).alias("_b"), F.col(value).alias("_v"))
    return rows.groupBy(*keys, "_b", "_v").agg(F.count("_v").alias("_n")).where("_n > 0")


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join on group columns, written null-safe.

    A plain join adds null tests below one of its sides; the counts read on both
    sides would then differ and be computed twice.
    """
    names = {k: f"_right{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(names)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(other, same).drop(*names.values())


def _keyed(counts: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (counts, list(keys)) if keys else (counts.withColumn(ALL, F.lit(0)), [ALL])


def at_positions(
    counts: DataFrame, keys: Sequence[str], positions: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Values at 0-based positions of the sorted group.

    ``positions`` maps an output name to a function of the group size.  Result:
    keys, ``_rows`` and one column per name; null for a position outside the group.
    """
    counts, group = _keyed(counts, keys)
    totals = counts.groupBy(*group, "_b").agg(F.sum("_n").alias("_m"))
    run = Window.partitionBy(*group).orderBy("_b")
    whole = Window.partitionBy(*group)
    totals = totals.select(
        *group,
        "_b",
        (F.sum("_m").over(run) - F.col("_m")).alias("_start"),
        F.sum("_m").over(run).alias("_end"),
        F.sum("_m").over(whole).alias("_rows"),
    )
    wanted = [f(F.col("_rows")).cast("bigint") for f in positions.values()]
    holds = F.lit(False)
    for p in wanted:
        holds = holds | ((p >= F.col("_start")) & (p < F.col("_end")))
    targets = totals.where(holds).select(*group, "_b", "_start", "_rows")
    inside = Window.partitionBy(*group, "_b").orderBy("_v")
    placed = join_groups(counts, targets, [*group, "_b"]).withColumn(
        "_hi", F.col("_start") + F.sum("_n").over(inside)
    )
    picks = [
        F.max(F.when((p >= F.col("_hi") - F.col("_n")) & (p < F.col("_hi")), F.col("_v"))).alias(n)
        for n, p in zip(positions, wanted, strict=True)
    ]
    picked = placed.groupBy(*group).agg(F.max("_rows").alias("_rows"), *picks)
    return picked if keys else picked.drop(ALL)


def quantiles_of(
    counts: DataFrame, keys: Sequence[str], probs: Mapping[str, float], digits: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles from ``value_counts``; also ``_rows``."""
    positions = {}
    for name, p in probs.items():
        positions[f"_lo_{name}"] = lambda n, p=p: F.floor((n - 1) * F.lit(p))
        positions[f"_hi_{name}"] = lambda n, p=p: F.ceil((n - 1) * F.lit(p))
    found = at_positions(counts, keys, positions)
    out = []
    for name, p in probs.items():
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        at = (F.col("_rows") - 1) * F.lit(p)
        q = lo + (hi - lo) * (at - F.floor(at))
        out.append((F.round(q, digits) if digits is not None else q).alias(name))
    return found.select(*keys, "_rows", *out)


def moments_of(counts: DataFrame, keys: Sequence[str], digits: int = 2) -> DataFrame:
    """Mean, sample deviation, extremes and rows of values with few decimals.

    Sums run over whole numbers, the squares as decimals: no order of additions
    shows in the result.
    """
    whole, n = scaled(F.col("_v"), digits), F.col("_n")
    square = (whole.cast("decimal(19,0)") * whole).cast("decimal(27,0)") * n.cast("decimal(11,0)")
    sums = counts.groupBy(*keys).agg(
        F.sum("_n").alias("Count"),
        F.sum(whole * n).alias("_s1"),
        F.sum(square).cast("double").alias("_s2"),
        F.min("_v").alias("Min"),
        F.max("_v").alias("Max"),
    )
    rows, total, unit = F.col("Count").cast("double"), F.col("_s1").cast("double"), float(10**digits)
    spread = F.greatest(F.col("_s2") - total * total / rows, F.lit(0.0))
    return sums.select(
        *keys,
        mean_of(F.col("_s1"), F.col("Count"), digits).alias("Mean"),
        (F.sqrt(spread / F.nullif(rows - 1, F.lit(0.0))) / unit).alias("Std"),
        "Min",
        "Max",
        "Count",
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
    digits: int | None = None,
) -> DataFrame:
    return quantiles_of(value_counts(df, keys, value), keys, probs, digits).drop("_rows")


def median(
    df: DataFrame, keys: Sequence[str], value: str, name: str, digits: int | None = None
) -> DataFrame:
    return quantiles(df, keys, value, {name: 0.5}, digits)


def box(counts: DataFrame, keys: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Quartiles, whiskers, notch and outlier count of every group.

    Whiskers reach the extreme values within 1.5 interquartile ranges of the box.
    """
    quarts = quantiles_of(counts, keys, {"Q1": 0.25, "Median": 0.5, "Q3": 0.75})
    v, n = F.col("_v"), F.col("_n")
    low = F.col("Q1") - 1.5 * (F.col("Q3") - F.col("Q1"))
    high = F.col("Q3") + 1.5 * (F.col("Q3") - F.col("Q1"))
    inside = (v >= low) & (v <= high)
    notch = 1.57 * (F.col("Q3") - F.col("Q1")) / F.sqrt(F.col("Count"))
    stats = (
        join_groups(counts, quarts, keys)
        .groupBy(*keys, "Q1", "Median", "Q3", F.col("_rows").alias("Count"))
        .agg(
            F.min(F.when(inside, v)).alias("WhiskerLow"),
            F.max(F.when(inside, v)).alias("WhiskerHigh"),
            F.coalesce(F.sum(F.when(~inside, n)), F.lit(0)).alias("Outliers"),
        )
        .withColumns({"NotchLow": F.col("Median") - notch, "NotchHigh": F.col("Median") + notch})
    )
    return _round(stats, ["Q1", "Median", "Q3", "WhiskerLow", "WhiskerHigh", "NotchLow", "NotchHigh"], digits)


def trim_counts(
    counts: DataFrame, prob: float = 0.99, within: Sequence[str] = ()
) -> DataFrame:
    """Value counts up to the quantile ``prob`` of all values (of ``within``).

    The cap comes from the counts as well, so the rows are read once.
    """
    pooled = counts.groupBy(*within, "_b", "_v").agg(F.sum("_n").alias("_n"))
    cap = quantiles_of(pooled, within, {"_cap": prob}).drop("_rows")
    if within:
        capped = join_groups(counts, cap, within)
    else:
        capped = counts.withColumn("_cap", cap.scalar())
    # Tied to the count, the test stays above the aggregate: pushed below it, the
    # capped counts would no longer be the counts the cap was taken from.
    below = (F.col("_v") <= F.col("_cap")).cast("int")
    return capped.where(F.col("_n") * below > 0).drop("_cap")


def trim_above(df: DataFrame, value: str, prob: float = 0.99) -> DataFrame:
    """Rows whose value is at most the quantile ``prob`` of all rows."""
    return df.where(F.col(value) <= quantiles(df, (), value, {"_cap": prob}).scalar())


def histogram(
    counts: DataFrame, keys: Sequence[str], bins: int, digits: int | None = 8
) -> DataFrame:
    """Equal-width bins over the range of each group, the last one closed.

    Result: keys, ``Bin``, ``BinLow``, ``BinHigh``, ``Count``, ``Density``; every bin
    of a group is there, empty ones with 0.
    """
    ranged = _with_summary(counts, keys)
    # a single value sits in the middle of a range of width 1
    pad = F.when(F.col("_s.lo") < F.col("_s.hi"), 0.0).otherwise(0.5)
    lo, hi = F.col("_s.lo") - pad, F.col("_s.hi") + pad
    width = (hi - lo) / F.lit(float(bins))
    at = F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1))
    filled = ranged.groupBy(*keys, at.cast("int").alias("Bin")).agg(F.sum("_n").alias("_count"), F.first("_s").alias("_s"))
    # At most one row per bin from here on.
    every = F.map_from_entries(F.collect_list(F.struct("Bin", "_count")))
    groups = filled.groupBy(*keys).agg(every.alias("_bins"), F.first("_s").alias("_s"))
    out = groups.withColumn("Bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = out.withColumn("Count", F.coalesce(F.try_element_at("_bins", "Bin"), F.lit(0)))
    out = out.where("_s.n > 0").select(
        *keys,
        "Bin",
        (lo + width * F.col("Bin")).alias("BinLow"),
        (lo + width * (F.col("Bin") + 1)).alias("BinHigh"),
        "Count",
        (F.col("Count") / (F.col("_s.n") * width)).alias("Density"),
    )
    return _round(out, ["BinLow", "BinHigh", "Density"], digits)


def _coefficients() -> list[Column]:
    """Of the polynomial in z that a cell's kernels are: power sums times Hermite polynomials.

    exp(-(z - u)^2 / 2) is exp(-z^2 / 2) times the sum of He_k(z) u^k / k!.
    """
    hermite = [[1.0], [0.0, 1.0]]
    for k in range(2, TERMS):
        ahead = [0.0, *hermite[-1]]
        hermite.append([a - (k - 1) * b for a, b in zip(ahead, [*hermite[-2], 0.0, 0.0], strict=True)])
    out = [F.lit(0.0)] * TERMS
    for k, powers in enumerate(hermite):
        for j, h in enumerate(powers):
            if h:
                out[j] = out[j] + F.col(f"_m{k}") * F.lit(h / math.factorial(k))
    return out


def density(
    counts: DataFrame,
    keys: Sequence[str],
    points: int = 200,
    cut: float = 0.0,
    extend: float = 0.0,
    digits: int | None = 8,
) -> DataFrame:
    """Gaussian kernel density on a grid, bandwidth ``std * n ** (-1/5)``.

    The grid runs over the range of the group, widened by ``cut`` bandwidths and
    by ``extend`` times the range on both sides.  Values are binned into cells of half
    a bandwidth, of which only power sums are kept; around a cell's middle its kernels
    add up to a Gaussian times a polynomial (a Hermite expansion, off by less than
    1e-11 of the peak).  So a point costs what there are cells, however many values.
    A cell adds to the points within 8 bandwidths (further terms are under 1e-13 of
    the peak).  Points that no value reaches are 0.
    """
    ranged = _with_summary(counts, keys)
    s = F.col("_s")
    # standard deviation from sums of centred values, then one grid per group
    centred = F.col("_v") - s["mean"]
    spread = ranged.groupBy(*keys, "_s").agg(F.sum(centred * centred * F.col("_n")).alias("_ss"))
    bw = F.sqrt(F.col("_ss") / F.nullif(s["n"] - 1, F.lit(0))) * F.pow(s["n"], F.lit(-0.2))
    margin = F.col("_bw") * cut + (s["hi"] - s["lo"]) * extend
    grid = (
        spread.withColumn("_bw", F.nullif(bw, F.lit(0.0)))
        .withColumns({"_from": s["lo"] - margin, "_to": s["hi"] + margin})
        .select(
            *keys,
            F.struct(
                F.col("_bw").alias("bw"),
                F.col("_from").alias("from"),
                ((F.col("_to") - F.col("_from")) / F.lit(float(points - 1))).alias("step"),
                s["n"].alias("n"),
            ).alias("_g"),
        )
    )
    with_grid = _attach(counts, grid, keys, "_g")
    g = F.col("_g")
    x = g["from"] + g["step"] * F.col("Point")
    cell = F.floor((F.col("_v") - g["from"]) / (g["bw"] * CELL)).cast("long")
    middle = g["from"] + (F.col("_cell") + 0.5) * (g["bw"] * CELL)
    binned = with_grid.where(g["bw"].isNotNull()).withColumn("_cell", cell).withColumn("_u", (F.col("_v") - middle) / g["bw"])
    sums = [F.sum(F.col("_n") * F.pow("_u", F.lit(float(k)))).alias(f"_m{k}") for k in range(TERMS)]
    cells = binned.groupBy(*keys, "_cell").agg(*sums, F.first("_g").alias("_g"))
    cells = cells.select(*keys, "_g", middle.alias("_c"), *[c.alias(f"_a{j}") for j, c in enumerate(_coefficients())])
    least = F.greatest(F.ceil((F.col("_c") - 8 * g["bw"] - g["from"]) / g["step"]), F.lit(0)).cast("int")
    most = F.least(F.floor((F.col("_c") + 8 * g["bw"] - g["from"]) / g["step"]), F.lit(points - 1)).cast("int")
    near = F.when(least <= most, F.sequence(least, most)).otherwise(F.array().cast("array<int>"))
    exploded = cells.withColumn("Point", F.explode(near)).withColumn("_z", (x - F.col("_c")) / g["bw"])
    value = F.lit(0.0)
    for j in reversed(range(TERMS)):
        value = value * F.col("_z") + F.col(f"_a{j}")
    reached = exploded.select(*keys, "Point", (F.exp(-0.5 * F.col("_z") * F.col("_z")) * value).alias("_k"), "_g")
    every = grid.where(g["bw"].isNotNull()).select(
        *keys, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("Point"), F.lit(0.0).alias("_k"), "_g"
    )
    summed = reached.unionByName(every).groupBy(*keys, "Point").agg(F.sum("_k").alias("_k"), F.first("_g").alias("_g"))
    norm = g["n"] * g["bw"] * F.lit((2 * 3.141592653589793) ** 0.5)
    out = summed.select(*keys, "Point", x.alias("X"), (F.col("_k") / norm).alias("Density"))
    return _round(out, ["X", "Density"], digits)


def _with_summary(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``value_counts`` with the struct ``_s`` (lo, hi, n, mean) of its group."""
    v, n = F.col("_v"), F.col("_n")
    summary = F.struct(
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
        F.sum(n).alias("n"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
    ).alias("_s")
    return _attach(counts, counts.groupBy(*keys).agg(summary), keys, "_s")


def _attach(counts: DataFrame, per_group: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Join one struct per group; a single group is a scalar subquery, no join."""
    if keys:
        return join_groups(counts, per_group, keys)
    return counts.withColumn(name, per_group.select(name).scalar())


def _round(df: DataFrame, cols: Sequence[str], digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.withColumns({c: F.round(c, digits) for c in cols})


def pearson(x: Column, y: Column) -> Column:
    """Correlation aggregate, null for a constant side (``corr`` would raise)."""
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def correlations(
    df: DataFrame, cols: Sequence[str], digits: int | None = 6
) -> DataFrame:
    """Pearson correlation of every pair, over the rows where both are known.

    All pairs in one aggregate, then one row per pair: ``ColA``, ``ColB``, ``Corr``.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    values = [
        pearson(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b)))
        for a, b in pairs
    ]
    one = df.agg(*[v.alias(f"_c{i}") for i, v in enumerate(values)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("ColA"), F.lit(b).alias("ColB"), F.col(f"_c{i}").alias("Corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    out = one.select(F.inline(rows))
    return out if digits is None else out.withColumn("Corr", F.round("Corr", digits))
