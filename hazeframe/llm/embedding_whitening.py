"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance V is never formed.  A few vectors Q are multiplied by it in one pass
over the stored blocks: each task adds up (x - mean)((x - mean)'Q) over its blocks,
the sums of all tasks are added per row of the product, and the driver gets a matrix
of dimensions by columns.  On the driver runs what is as small as that: a polynomial
recurrence that damps the eigenvalues below the smallest one in the subspace, QR,
and Rayleigh-Ritz.  It ends when the residuals certify the eigenvectors.

A Lanczos column rides along in every pass; its Ritz values bound the spectrum from
below, which makes the filter as sharp as the spectrum allows.

Vectors become whole numbers first, so sums and squared deviations are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SCALE = 1024
OFFSET = 100_000
# Entries at and beyond this magnitude count as not finite.
LIMIT = 2.0**32
# Bytes of a stored block.
BLOCK_BYTES = 1 << 20
# Degree of a filter, and what it may amplify the first vector beyond the last wanted one.
DEGREE = 10
RANGE = 1e5
# Angle to an eigenvector that a residual must certify, and the level of rounding errors.
ANGLE = 1e-13
ROUNDING = 16 * float(np.finfo(float).eps)
# Passes after which it is given up.
MOST_PASSES = 1000


def usable(vectors: DataFrame, vector_col: str) -> Column:
    """Whether a vector has entries, and each of them is a finite number."""
    v = F.col(vector_col)
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))


def _packer(dims: int):
    """Vectors to blocks of whole numbers."""
    step = max(1, BLOCK_BYTES // (8 * dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                entries = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.floor(entries * SCALE).astype(np.int64) + OFFSET
                kind = "<i4" if max(-int(x.min()), int(x.max())) < 1 << 31 else "<i8"
                ids = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(0))
                yield pa.record_batch([ids, pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())], names=["ids", "kind", "x"])

    return run


def _arrays(batch: pa.RecordBatch, dims: int) -> Iterator[np.ndarray]:
    for kind, data in zip(batch.column("kind"), batch.column("x"), strict=True):
        yield np.frombuffer(data.as_buffer(), kind.as_py()).reshape(-1, dims).astype(np.int64)


def _totals(dims: int):
    """Exact sums of a task's vectors, and at -1 their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            for x in _arrays(batch, dims):
                n += len(x)
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist(), strict=True)]
        if n:
            yield pa.record_batch([pa.array([-1, *range(dims)], pa.int32()), pa.array([str(t) for t in (n, *total)])], names=["i", "total"])

    return run


@dataclass(frozen=True)
class Centre:
    """The mean as the nearest whole number and the rest, so that centred vectors lose no digits."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def off(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


def _products(dims: int, centre: Centre, q: np.ndarray):
    """A task's share of the covariance times ``q``, by rows; at -1 of its trace."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, trace = np.zeros(q.shape), 0.0
        for batch in batches:
            for x in _arrays(batch, dims):
                off = centre.off(x)
                out += off.T @ (off @ q)
                trace += float((off * off).sum())
        rows = np.vstack([np.full(q.shape[1], trace), out]) / centre.n
        yield _rows(range(-1, dims), rows)

    return run


def _rows(numbers, rows: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(numbers, pa.int32()), pa.array(list(rows), pa.list_(pa.float64()))], names=["i", "y"])


def _summed(blocks: DataFrame, task, columns: int) -> dict[int, list[float]]:
    """Rows of all tasks' matrices, added up: one row per number, each of ``columns`` entries."""
    parts = blocks.select("kind", "x").mapInArrow(task, "i int, y array<double>")
    found = parts.groupBy("i").agg(*[F.sum(F.col("y")[k]).alias(f"y{k}") for k in range(columns)]).collect()
    return {r[0]: list(r)[1:] for r in found}


class Lanczos:
    """One Krylov sequence; a pass at a time."""

    def __init__(self, dims: int, rng: np.random.Generator):
        self.basis = [_unit(rng.normal(size=dims))]
        self.diagonal: list[float] = []
        self.beside: list[float] = []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def advance(self, product: np.ndarray) -> None:
        if len(self.diagonal) == len(self.basis):
            return
        self.diagonal.append(float(self.vector @ product))
        rest = product
        for _ in range(2):
            rest = rest - np.array(self.basis).T @ (np.array(self.basis) @ rest)
        size = float(np.linalg.norm(rest))
        self.beside.append(size)
        if size > 1e-10 * max(abs(np.array(self.diagonal))) and len(self.basis) < len(product):
            self.basis.append(rest / size)

    def least(self) -> float:
        """About the least eigenvalue, from below; never under 0."""
        if len(self.diagonal) < 2:
            return 0.0
        m = np.diag(self.diagonal) + np.diag(self.beside[:-1], 1) + np.diag(self.beside[:-1], -1)
        values, vectors = np.linalg.eigh(m)
        return max(0.0, float(values[0] - 2 * self.beside[-1] * abs(vectors[-1, 0])))


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v)


def _certified(values: np.ndarray, residuals: np.ndarray) -> np.ndarray:
    """Of each wanted eigenpair, whether its angle is proven small or its residual is rounding."""
    gaps = np.abs(values[: len(residuals), None] - values[None, :])
    gaps[np.arange(len(residuals)), np.arange(len(residuals))] = np.inf
    return (residuals <= ANGLE * gaps.min(axis=1)) | (residuals <= ROUNDING * values[0])


def leading(multiply: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """The largest eigenvalues, their vectors as columns, and the passes it took.

    ``multiply`` gives the product of a positive semidefinite matrix with some columns.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    size = min(dims, max(3 * wanted, wanted + 16))
    wanted = min(wanted, dims)
    lanczos = Lanczos(dims, rng)
    passes = 0

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        found = multiply(np.column_stack([q, lanczos.vector]))
        lanczos.advance(found[:, -1])
        return found[:, :-1]

    q = np.linalg.qr(rng.normal(size=(dims, size)))[0]
    worst, calm = np.inf, 0
    while passes < MOST_PASSES:
        vq = times(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        good = _certified(values, residuals)
        now = float(residuals.max())
        # Near the level of rounding, what no longer falls has no more to gain.
        calm = calm + 1 if now > worst / 2 and now <= 1e-11 * values[0] else 0
        worst = min(worst, now)
        if good.all() or calm == 3:
            return values[:wanted], q[:, :wanted], passes
        low, cut = lanczos.least(), float(values[-1])
        if cut <= ROUNDING * values[0] or cut - low <= 1e-9 * values[0]:
            low = 0.0
        if cut <= ROUNDING * values[0]:
            q = np.linalg.qr(vq)[0]
            continue
        # Where more than the block ties with the last wanted value, the damped part ends below the ties.
        cut = min(cut, float(values[wanted - 1] - (values[wanted - 1] - low) / 20))
        centre, half = (cut + low) / 2, (cut - low) / 2
        rates = np.arccosh(np.maximum(1, (values[[0, wanted - 1]] - centre) / half))
        spread = float(rates[0] - rates[1])
        degree = int(np.clip(np.log(RANGE) / spread if spread > 0 else DEGREE, 2, DEGREE))
        # The scaled three-term recurrence; its first step has its product already.
        sigma = first = half / (values[0] - centre)
        before, here = q, (vq - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            ahead = 1 / (2 / first - sigma)
            before, here = here, (times(here) - centre * here) * (2 * ahead / half) - sigma * ahead * before
            sigma = ahead
        q = np.linalg.qr(here)[0]
    raise RuntimeError(f"no certificate after {MOST_PASSES} passes")


@dataclass(frozen=True)
class Whitening:
    """What was fitted: from a vector's deviation to its whitened components."""

    centre: Centre
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None
    passes: int

    @property
    def scaled(self) -> np.ndarray:
        """Columns that whiten; not a number where a component has no variance."""
        flat = self.values <= 4 * ROUNDING * max(self.values[0], 0.0)
        return self.vectors / np.sqrt(np.where(flat, np.nan, self.values))


def _shares(dims: int, centre: Centre, scaled: np.ndarray):
    """A task's share of the second moments of whitened vectors; at -1 of the means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = scaled.shape[1]
        out = np.zeros((k + 1, k))
        for batch in batches:
            for x in _arrays(batch, dims):
                w = centre.off(x) @ scaled
                out[0] += w.sum(axis=0)
                out[1:] += w.T @ w
        yield _rows(range(-1, k), out / centre.n)

    return run


def pack(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Usable vectors as stored blocks (``ids``, ``kind``, ``x``), and their length.

    Vectors of another length than most (ties: the longest) are left out.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(vectors, "v"))
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims"))
    first = lengths.first()
    dims = first["dims"] if first else 0
    if not dims:
        return rows.limit(0), 0
    id_type = vectors.schema[id_col].dataType.simpleString()
    packed = rows.where(F.size("v") == dims).mapInArrow(_packer(dims), f"ids array<{id_type}>, kind string, x binary")
    return common.store(packed, "vectors"), dims


def fit(blocks: DataFrame, dims: int, components: int = 8) -> Whitening:
    """Fit on all vectors of the blocks; some tens of passes over them."""
    found = blocks.select("kind", "x").mapInArrow(_totals(dims), "i int, total string").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = {r["i"]: int(r["total"]) for r in found.collect()}
    n, sums = totals[-1], tuple(totals[i] for i in range(dims))
    whole = [(2 * s + n) // (2 * n) for s in sums]
    centre = Centre(n, np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole, strict=True)]))
    trace = 0.0

    def multiply(q: np.ndarray) -> np.ndarray:
        nonlocal trace
        rows = _summed(blocks, _products(dims, centre, q), q.shape[1])
        trace = rows[-1][0]
        return np.array([rows[i] for i in range(dims)])

    values, vectors, passes = leading(multiply, dims, components)
    plain = Whitening(centre, sums, vectors, values, trace, None, passes)
    real = ~np.isnan(plain.scaled[0])
    if not real.any():
        return plain
    k = int(real.sum())
    rows = _summed(blocks, _shares(dims, centre, plain.scaled[:, real]), k)
    moments = np.array([rows[i] for i in range(k)]) - np.outer(rows[-1], rows[-1])
    return Whitening(centre, sums, vectors, values, trace, float(np.abs(moments - np.eye(k)).max()), passes)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sums of (n x - S) squared, exact; None beyond a long."""
    most = max(abs(v) for v in (int(x.min()), int(x.max())))
    if n * most + max(map(abs, sums)) < 1 << 62:
        off = n * x - np.array(sums, np.int64)
        if x.shape[1] * max(-int(off.min()), int(off.max())) ** 2 < 1 << 62:
            return (off * off).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def _applier(dims: int, fitted: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        explained = fitted.values / fitted.trace if fitted.trace > 0 else np.zeros(k)
        for batch in batches:
            for ids, x in zip(batch.column("ids"), _arrays(batch, dims), strict=True):
                rows = len(x)
                each = lambda column: np.repeat(column, k)
                w = (fitted.centre.off(x) @ fitted.scaled).ravel()
                deviation = pa.array(_deviations(x, fitted.centre.n, fitted.sums), pa.int64())
                yield pa.record_batch(
                    [
                        ids.values.take(pa.array(each(np.arange(rows)))),
                        pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                        pa.array(np.full(rows * k, fitted.centre.n), pa.int64()),
                        deviation.take(pa.array(each(np.arange(rows)))),
                        pa.array(w, pa.float64(), mask=np.isnan(w)),
                        pa.array(np.tile(explained, rows), pa.float64()),
                        pa.array([fitted.identity_error] * (rows * k), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries become whole numbers, ``floor(1024 c) + 100000``.  ``n`` vectors are fitted
    and returned; ``deviation`` is the sum of (n x - S) squared over the dimensions,
    exact (null beyond a long).  ``whitened`` is the centred vector along the unit
    eigenvector of the covariance, over the root of its eigenvalue; ``explained`` the
    eigenvalue's share of the trace; ``identity_error`` the largest entry by which the
    covariance of all whitened vectors differs from the identity.

    Null vectors, empty ones, such with null or non-finite entries (or of 2^32 and
    more), and those of another length than most are left out.  Components number
    from 1 to 8 or the dimensions.  One without variance is whitened to null and
    explains 0; without any, ``identity_error`` is null.  Repeated rows and null ids
    stay as they are, other columns are not looked at, an empty table gives no rows.
    """
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    blocks, dims = pack(vectors, id_col, vector_col)
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema)
    return blocks.mapInArrow(_applier(dims, fit(blocks, dims, components)), schema)
