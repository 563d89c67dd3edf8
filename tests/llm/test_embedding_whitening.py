import math

import numpy as np
import pytest

from hazeframe.llm.embedding_whitening import ROUNDING, Whitening, _deviations, fit, leading, pack, whiten


def brute_force(vectors, components=8):
    """The whole covariance, its eigenvectors, and exact deviations."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    off = np.array([[(n * c - s) / n for c, s in zip(row, sums, strict=True)] for row in x])
    values, u = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(values)[::-1][:components]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return n, deviation, off @ u[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def sample(rows, dims, seed):
    rng = np.random.Generator(np.random.PCG64(seed))
    return (rng.normal(size=(rows, dims)) @ rng.normal(size=(dims, dims)) / 40 + rng.normal(size=dims)).astype(np.float32)


def frame(spark, vectors, parts=5):
    return spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(parts)


@pytest.mark.parametrize(("rows", "dims"), [(700, 40), (300, 5), (90, 64)])
def test_whitening_equals_brute_force(spark, rows, dims):
    vectors = sample(rows, dims, rows)
    n, deviation, whitened, explained = brute_force(vectors)
    got = whiten(frame(spark, vectors)).collect()
    k = min(8, dims)
    assert len(got) == rows * k and {r["n"] for r in got} == {n}
    assert {r["component"] for r in got} == set(range(1, k + 1))
    assert all(r["deviation"] == deviation[r["vec_id"]] for r in got)
    assert all(math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9) for r in got)
    assert {r["identity_error"] for r in got} and max(r["identity_error"] for r in got) < 1e-9
    found = np.zeros((rows, k))
    for r in got:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
    sign = np.sign((found * whitened).sum(axis=0))
    assert np.abs(found * sign - whitened).max() < 1e-8


@pytest.mark.parametrize("spectrum", ["even", "steep", "hot", "ties", "low"])
def test_leading_eigenpairs_are_certified(spectrum):
    dims = 120
    values = {
        "even": np.linspace(1, 2, dims),
        "steep": 0.7 ** np.arange(dims),
        "hot": np.append(np.linspace(1, 2, dims - 1), 1e6),
        "ties": np.repeat([1.0, 2.0, 3.0], dims // 3),
        "low": np.append(np.zeros(dims - 5), [1, 2, 3, 4, 5]),
    }[spectrum]
    rng = np.random.Generator(np.random.PCG64(2))
    u = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    v = u * values @ u.T
    found, vectors, passes = leading(lambda q: v @ q, dims, 8)
    want = np.sort(values)[::-1][:8]
    assert np.abs(found - want).max() <= 100 * ROUNDING * want[0]
    assert np.linalg.norm(v @ vectors - vectors * found, axis=0).max() <= 1e-12 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
    assert passes < 150


def test_filter_needs_fewer_passes_than_plain_iteration():
    dims, rng = 100, np.random.Generator(np.random.PCG64(3))
    u = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    v = u * np.linspace(1, 2, dims) @ u.T
    q = np.linalg.qr(rng.normal(size=(dims, 24)))[0]
    _, _, passes = leading(lambda q: v @ q, dims, 8)
    for _ in range(passes):
        q = np.linalg.qr(v @ q)[0]
    values, turn = np.linalg.eigh(q.T @ v @ q)
    plain = (q @ turn)[:, -8:]
    assert np.linalg.norm(v @ plain - plain * values[-8:], axis=0).max() > 1e-3


def test_same_for_any_partitioning_and_repeats(spark):
    vectors = sample(200, 12, 4)
    fits = []
    for parts in (1, 7):
        blocks, dims = pack(frame(spark, vectors, parts))
        fits.append(fit(blocks, dims))
    assert fits[0].sums == fits[1].sums and np.allclose(fits[0].values, fits[1].values, rtol=1e-12)
    assert isinstance(fits[0], Whitening) and fits[0].passes == 1


def test_nulls_odd_lengths_large_entries_and_clashing_columns(spark):
    good = [(k, [float(k % 7), float(k * k % 11), float(k % 3)], "x") for k in range(50)]
    bad = [(100, None, "x"), (101, [1.0, None, 2.0], "x"), (102, [1.0, float("nan"), 2.0], "x"), (103, [float("inf"), 0.0, 0.0], "x"), (104, [], "x"), (105, [1.0, 2.0], "x"), (106, [2.0**33, 0.0, 0.0], "x")]
    df = spark.createDataFrame([*good, good[3], (None, [1.0, 2.0, 0.0], "x"), *bad], "vec_id long, embedding array<double>, component string")
    got = whiten(df).collect()
    assert len(got) == 52 * 3 and {r["n"] for r in got} == {52}
    ids = [r["vec_id"] for r in got]
    assert ids.count(3) == 6 and ids.count(None) == 3 and not {i for i in ids if i is not None and i >= 100}
    wide = spark.createDataFrame([(0, [2.0**31, 1.0]), (1, [-(2.0**31), 5.0]), (2, [0.0, 9.0])], "vec_id long, embedding array<double>")
    n, deviation, _, _ = brute_force([r["embedding"] for r in wide.orderBy("vec_id").collect()])
    assert {r["vec_id"]: r["deviation"] for r in whiten(wide).collect()} == {k: d if d < 1 << 63 else None for k, d in enumerate(deviation)}


def test_no_variance_one_row_and_empty(spark):
    same = spark.createDataFrame([(k, [1.5, 2.5, 3.5]) for k in range(4)], "vec_id long, embedding array<float>")
    for df, rows in ((same, 12), (same.limit(1), 3)):
        got = whiten(df).collect()
        assert len(got) == rows
        assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, 0.0, None)}
    line = spark.createDataFrame([(k, [float(k), 0.0, 7.0]) for k in range(9)], "vec_id long, embedding array<float>")
    got = whiten(line).collect()
    assert {r["component"]: r["whitened"] is None for r in got} == {1: False, 2: True, 3: True}
    assert got[0]["identity_error"] < 1e-12
    assert whiten(same.limit(0)).count() == 0
    assert whiten(same.select("vec_id", "embedding").where("vec_id < 0")).columns[0] == "vec_id"


def test_exact_deviations():
    rng = np.random.Generator(np.random.PCG64(9))
    x = rng.integers(-(1 << 30), 1 << 30, (20, 3))
    sums = tuple(x.sum(axis=0).tolist())
    want = [sum((20 * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert _deviations(x, 20, sums) == [w if w < 1 << 63 else None for w in want]
