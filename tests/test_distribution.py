"""Exact order statistics against numpy, for every shape of group."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeframe.operators import distribution as dist

PROBS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(3)
    rows = [("one", 4.5), ("two", 1.0), ("two", 2.0), ("null", None), (None, 3.0)]
    rows += [("wide", rng.uniform(-1, 1) * 10 ** rng.randint(-3, 6)) for _ in range(700)]
    rows += [("ties", float(rng.randint(0, 5))) for _ in range(500)] + [("ties", None)]
    return spark.createDataFrame(rows, "g string, x double").cache()


def test_quantiles_per_group(values):
    got = {r["g"]: r for r in dist.quantiles(values, ["g"], "x", PROBS).collect()}
    assert set(got) == {"one", "two", "wide", "ties"}
    for g, row in got.items():
        x = [r["x"] for r in values.where(F.col("g") == g).collect() if r["x"] is not None]
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12)


def test_quantiles_of_everything(values):
    x = [r["x"] for r in values.collect() if r["x"] is not None]
    row = dist.quantiles(values, (), "x", PROBS).first()
    assert [row[n] for n in PROBS] == pytest.approx([np.quantile(x, p) for p in PROBS.values()])


def test_moments(spark):
    x = [1.25, 2.5, 2.5, 499.99, 0.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    row = dist.moments_of(dist.value_counts(df, (), "x"), ()).first()
    assert (row["Mean"], row["Std"]) == pytest.approx((np.mean(x), np.std(x, ddof=1)))
    assert (row["Min"], row["Max"], row["Count"]) == (0.0, 499.99, 5)


def test_histogram_and_trim(values):
    x = np.array([r["x"] for r in values.where("g = 'wide'").collect()])
    counts = dist.value_counts(values.where("g = 'wide'"), (), "x")
    want, edges = np.histogram(x, 20)
    got = {r["Bin"]: r for r in dist.histogram(counts, (), 20, digits=None).collect()}
    assert [got[i]["Count"] if i in got else 0 for i in range(20)] == list(want)
    assert sum(r["Density"] * (r["BinHigh"] - r["BinLow"]) for r in got.values()) == pytest.approx(1)
    kept = dist.trim_counts(counts, 0.9).agg(F.sum("_n")).first()[0]
    assert kept == (x <= np.quantile(x, 0.9)).sum()
    per_group = dist.trim_counts(dist.value_counts(values, ["g"], "x"), 0.5, ["g"])
    kept = {r["g"]: r["n"] for r in per_group.groupBy("g").agg(F.sum("_n").alias("n")).collect()}
    assert kept["wide"] == (x <= np.median(x)).sum() and kept["one"] == 1


def test_density_is_the_gaussian_kernel_sum(spark):
    x = np.array([1.0, 2.0, 2.0, 5.0, 9.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = dist.density(dist.value_counts(df, (), "x"), (), points=11, digits=None).orderBy("Point").collect()
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(1, 9, 11)
    want = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(1) / (len(x) * bw * np.sqrt(2 * np.pi))
    assert [r["X"] for r in got] == pytest.approx(list(grid))
    assert [r["Density"] for r in got] == pytest.approx(list(want))


def test_constant_group_has_no_density_but_a_bin(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    counts = dist.value_counts(df, (), "x")
    assert dist.density(counts, ()).isEmpty()
    # The value's own bin, and every empty one beside it.
    rows = sorted((r["Bin"], r["Count"], r["Density"]) for r in dist.histogram(counts, (), 5).collect())
    assert rows == [(0, 0, 0.0), (1, 0, 0.0), (2, 2, 5.0), (3, 0, 0.0), (4, 0, 0.0)]


def test_correlation_skips_pairs_and_constants(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 5.0, 1.0), (5.0, 4.0, 1.0)], "a double, b double, c double"
    )
    got = {(r["ColA"], r["ColB"]): r["Corr"] for r in dist.correlations(df, ["a", "b", "c"]).collect()}
    assert got[("b", "a")] == pytest.approx(np.corrcoef([1, 3, 5], [2, 5, 4])[0, 1], abs=1e-6)
    assert got[("c", "a")] is None


def test_binned_density_is_exact_and_bounded_by_cells(spark):
    """A long tail, a hot value and two groups; the exact curve is summed value by value."""
    df = spark.range(3000).selectExpr("id % 2 AS k", "CASE WHEN id % 3 = 0 THEN 7.0D WHEN id % 101 = 0 THEN CAST(id AS DOUBLE) ELSE sin(id) * (id % 17) END AS x")
    got = dist.density(dist.value_counts(df, ["k"], "x"), ["k"], points=60, cut=2, digits=None).collect()
    rows = df.collect()
    for k in (0, 1):
        xs = [r["x"] for r in rows if r["k"] == k]
        bw = statistics.stdev(xs) * len(xs) ** -0.2
        norm = len(xs) * bw * math.sqrt(2 * math.pi)
        want = {r["Point"]: math.fsum(math.exp(-0.5 * ((r["X"] - x) / bw) ** 2) for x in xs) / norm for r in got if r["k"] == k}
        peak = max(want.values())
        assert len(want) == 60
        assert max(abs(r["Density"] - want[r["Point"]]) for r in got if r["k"] == k) < 1e-10 * peak
