"""Whitening of vectors by an eigendecomposition that grows by rank-one updates.

A vector becomes whole numbers ``x = floor(scale * c) + offset``. Means and
deviations are exact: ``n * x - S`` is a whole number, and every covariance is
summed over ``(n * x - S) / n``, so the offset never meets a product.

1. Sums ``S`` and the count ``n``: one pass, combined before the shuffle.
2. Every task keeps the spectrum of the scatter of its own vectors and applies
   rank-one updates: deflate (no weight, equal eigenvalues), solve the secular
   equation for the rest, rebuild weights from the roots so that eigenvectors
   stay orthogonal. A block of vectors is first brought to triangular form by
   reflections; its rows have the same scatter, so a block needs as many
   updates as there are dimensions instead of as many as it has vectors.
3. Spectra are combined in a tree of three levels; one spectrum enters another
   as one rank-one update per eigenpair.
4. Rayleigh-Ritz over all rows: the covariance in the basis found, summed per
   task and in the same tree, is diagonalised once more.

What reaches the driver is one spectrum or matrix of dimensions squared; no
table of rows does. Ties, repeated rows and a vector that holds a third of all
rows need no care, because no key is ever shuffled but the number of a task.

Rows whose vector is null, or holds null, NaN, an infinity or an entry of size
2^34 or more (it leaves the range of the fixed point), are dropped; so are
vectors of another length than most have (of equally frequent lengths the
larger counts) and empty ones. Directions without variance give no component,
so an empty table, one row, or equal rows give no result. Of the other columns
only the id is used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, KEEP = 64, 1_000_000, 32
LARGEST = 2.0 ** 40
BLOCK = 1 << 20
NO_VARIANCE = 1e-12
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Fixed:
    """How entries become whole numbers, and the exact sums of all of them."""

    dims: int
    n: int = 0
    sums: tuple[int, ...] = ()
    scale: int = SCALE
    offset: int = OFFSET

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: 64 bits, or Python numbers where they don't suffice."""
        if len(x) and max(map(abs, self.sums)) + self.n * int(np.abs(x).max()) >= 1 << 62:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n


@dataclass(frozen=True)
class Whitener:
    """Components by falling eigenvalue: ``basis`` has one unit column each."""

    fixed: Fixed
    values: np.ndarray
    basis: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def matrix(self) -> np.ndarray:
        return self.basis / np.sqrt(self.values)


def secular_roots(d: np.ndarray, z2: np.ndarray) -> np.ndarray:
    """Differences ``d[j] - root[i]`` (rows: roots) of ``1 + sum(z2 / (d - x)) = 0``, ``d`` rising and distinct.

    A root is kept as its distance from the nearer pole, so differences to both
    neighbours are exact. Steps come from a function with both poles and are
    replaced by halving where they leave the bracket.
    """
    k = len(d)
    at = np.arange(k)
    gap = np.append(np.diff(d), z2.sum())
    middle = (d[None, :] - d[:, None]) - (gap / 2)[:, None]
    right = 1 + (z2 / middle).sum(1) < 0
    right[-1] = False
    origin = np.where(right, at + 1, at)
    shift = d[None, :] - d[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, gap / 2)
    high[-1] = gap[-1] * (1 + 4 * _EPS)
    x = (low + high) / 2
    above = at[None, :] > at[:, None]
    done = np.zeros(k, bool)
    for _ in range(90):
        delta = shift - x[:, None]
        part = z2 / delta
        f = 1 + part.sum(1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        done |= np.abs(f) <= 4 * _EPS * (1 + np.abs(part).sum(1))
        if done.all():
            break
        steep = part / delta
        phi = np.where(above, steep, 0).sum(1)
        psi = steep.sum(1) - phi
        one = delta[at, at]
        two = np.append(delta[at[:-1], at[1:]], 0)
        with np.errstate(all="ignore"):
            a = (one + two) * f - one * two * (psi + phi)
            b = one * two * f
            c = f - one * psi - two * phi
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = one[-1] + one[-1] ** 2 * psi[-1] / (f[-1] - one[-1] * psi[-1])
            done |= np.abs(step) <= 2 * _EPS * np.abs(x)
            new = x + step
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
        x = np.where(done, x, new)
    return shift - x[:, None]


def update(values: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``basis diag(values) basis' + v v'``."""
    z = basis.T @ v
    size = max(values[-1], z @ z)
    if size == 0:
        return values, basis
    # Equal eigenvalues: a reflection moves their weight to the last of them.
    tie = np.diff(values) <= 8 * _EPS * size
    if tie.any():
        basis = basis.copy()
        start = 0
        for end in np.append(np.flatnonzero(~tie), len(z) - 1):
            if end > start:
                w = z[start:end + 1].copy()
                long = np.linalg.norm(w)
                if long > 0:
                    long = -long if w[-1] >= 0 else long
                    w[-1] -= long
                    w /= np.linalg.norm(w)
                    part = basis[:, start:end + 1]
                    basis[:, start:end + 1] = part - 2 * np.outer(part @ w, w)
                    z[start:end + 1] = 0
                    z[end] = long
            start = end + 1
    live = np.abs(z) > 4 * _EPS * np.sqrt(size)
    if not live.any():
        return values, basis
    d, zs = values[live], z[live]
    delta = secular_roots(d, zs * zs)
    found = d - np.diagonal(delta)
    # Weights for which these roots are exact (products of ratios of differences).
    apart = d[None, :] - d[:, None]
    np.fill_diagonal(apart, 1.0)
    ratio = -delta / -apart.T
    own = np.diagonal(delta).copy()
    np.fill_diagonal(ratio, 1.0)
    weight = np.sqrt(np.abs(np.prod(ratio, axis=0) * own)) * np.where(zs < 0, -1.0, 1.0)
    vectors = weight[None, :] / delta
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    values, basis = values.copy(), basis.copy()
    values[live] = found
    basis[:, live] = basis[:, live] @ vectors.T
    order = np.argsort(values, kind="stable")
    return values[order], basis[:, order]


def add_rows(values: np.ndarray, basis: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block of centred vectors into a spectrum."""
    if len(rows) > rows.shape[1]:
        rows = np.linalg.qr(rows, mode="r")
    for row in rows:
        values, basis = update(values, basis, row)
    return values, basis


def _whole(batch: pa.RecordBatch, at: int, fixed: Fixed | None, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of usable vectors of one length, and their whole numbers; all lengths, or the one that ``fixed`` has."""
    column = batch.column(at)
    starts = column.offsets.to_numpy()
    lengths = np.diff(starts)
    there = np.ones(len(column), bool) if not column.null_count else column.is_valid().to_numpy(zero_copy_only=False)
    entries = column.values.to_numpy(zero_copy_only=False).astype(float)
    for length in np.unique(lengths[there & (lengths > 0)]) if fixed is None else [fixed.dims]:
        rows = np.flatnonzero(there & (lengths == length))
        c = entries[starts[rows][:, None] + np.arange(length)] * scale
        usable = (np.abs(c) < LARGEST).all(1)
        yield rows[usable], np.floor(c[usable]).astype(np.int64) + offset


def totals(vectors: DataFrame, column: str, scale: int = SCALE, offset: int = OFFSET) -> Fixed | None:
    """Count and exact sums over all usable vectors; None without any."""

    def sums(batches):
        for batch in batches:
            for _, x in _whole(batch, 0, None, scale, offset):
                if len(x):
                    k = x.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, k)), pa.array(np.arange(k)), pa.array(np.full(k, len(x))), pa.array(x.sum(0))],
                        ["dims", "at", "n", "total"])

    parts = vectors.select(F.col(column).alias("v")).mapInArrow(sums, "dims long, at long, n long, total long")
    table = parts.groupBy("dims", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    best = parts.where("at = 0").groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if best is None:
        return None
    rows = sorted(table.where(F.col("dims") == best.dims).collect(), key=lambda r: r["at"])
    return Fixed(best.dims, best.n, tuple(int(r.total) for r in rows), scale, offset)


def _blocks(batches, fixed: Fixed) -> Iterator[np.ndarray]:
    """Centred vectors in blocks of at least ``BLOCK`` entries, the last one smaller."""
    held, n = [], 0
    for batch in batches:
        for _, x in _whole(batch, 0, fixed, fixed.scale, fixed.offset):
            held.append(fixed.centred(x))
            n += x.size
        if n >= BLOCK:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


_PART = "part long, a array<double>, b array<double>"


def _row(part: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    lists = [pa.array([x.ravel()], pa.list_(pa.float64())) for x in (a, b)]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *lists], ["part", "a", "b"])


def _tree(parts: DataFrame, combine) -> tuple[np.ndarray, np.ndarray] | None:
    """One row of all tasks' rows: three levels, so that no task takes more than a small share of them."""

    def level(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        a, b = combine([(np.array(r["a"]), np.array(r["b"])) for r in rows])
        return pa.Table.from_batches([_row(key[0].as_py(), a, b)])

    for width in (1_024, 32, 1):
        parts = parts.withColumn("part", F.expr(f"pmod(part, {width})")).groupBy("part").applyInArrow(level, _PART)
    row = parts.first()
    return row and (np.array(row.a), np.array(row.b))


def spectrum(vectors: DataFrame, column: str, fixed: Fixed) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of the scatter of all vectors, by rank-one updates alone."""
    d = fixed.dims

    def local(batches):
        values, basis = np.zeros(d), np.eye(d)
        seen = False
        for block in _blocks(batches, fixed):
            values, basis = add_rows(values, basis, block)
            seen = True
        if seen:
            yield _row(TaskContext.get().partitionId(), values, basis)

    def combine(spectra):
        values, basis = spectra[0][0], spectra[0][1].reshape(d, d)
        for other, vectors_ in spectra[1:]:
            for size, v in zip(other, vectors_.reshape(d, d).T, strict=True):
                if size > 0:
                    values, basis = update(values, basis, np.sqrt(size) * v)
        return values, basis

    values, basis = _tree(vectors.select(F.col(column).alias("v")).mapInArrow(local, _PART), combine)
    return values, basis.reshape(d, d)


def projected(vectors: DataFrame, column: str, fixed: Fixed, matrix: np.ndarray) -> np.ndarray:
    """``matrix' V matrix`` for the covariance ``V`` of all vectors, without building it."""
    k = matrix.shape[1]

    def local(batches):
        total = np.zeros((k, k))
        for block in _blocks(batches, fixed):
            y = block @ matrix
            total += y.T @ y
        yield _row(TaskContext.get().partitionId(), total, np.empty(0))

    found, _ = _tree(vectors.select(F.col(column).alias("v")).mapInArrow(local, _PART),
                     lambda rows: (np.sum([a for a, _ in rows], axis=0), np.empty(0)))
    return found.reshape(k, k) / fixed.n


def fit(vectors: DataFrame, column: str = "embedding", keep: int = KEEP, scale: int = SCALE, offset: int = OFFSET) -> Whitener | None:
    """The ``keep`` strongest components of all usable vectors, None if there is no vector."""
    fixed = totals(vectors, column, scale, offset)
    if fixed is None:
        return None
    _, basis = spectrum(vectors, column, fixed)
    basis, _ = np.linalg.qr(basis)
    ritz = projected(vectors, column, fixed, basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-values, kind="stable")
    trace, strongest = float(np.trace(ritz)), float(max(values.max(), 0))
    order = order[values[order] > NO_VARIANCE * strongest][:keep]
    basis = basis @ turn[:, order]
    found = Whitener(fixed, values[order], basis / np.linalg.norm(basis, axis=0), trace)
    if not len(order):
        return found
    error = np.abs(projected(vectors, column, fixed, found.matrix) - np.eye(len(order))).max()
    return Whitener(fixed, found.values, found.basis, trace, float(error))


def whiten(vectors: DataFrame, model: Whitener, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key``, ``deviation`` and the array ``whitened`` of every usable vector.

    ``deviation`` is the exact sum of ``(n * x - S)^2``, null if it exceeds 64 bits.
    """
    fixed, matrix = model.fixed, model.matrix
    source = vectors.select(F.col(column).alias("v"), F.col(key).alias("key"))

    def project(batches):
        for batch in batches:
            for rows, x in _whole(batch, 0, fixed, fixed.scale, fixed.offset):
                exact = fixed.numerators(x)
                if len(x) and int(np.abs(exact).max()) ** 2 * fixed.dims >= 1 << 63:
                    exact = exact.astype(object)
                squares = [s if s < 1 << 63 else None for s in (exact * exact).sum(1).tolist()] if len(x) else []
                y = (exact.astype(float) / fixed.n) @ matrix
                starts = np.arange(len(x) + 1, dtype=np.int32) * matrix.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(rows)), pa.array(squares, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(starts), pa.array(y.ravel()))], ["key", "deviation", "whitened"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(project, f"key {kind}, deviation long, whitened array<double>").withColumnRenamed("key", key)


def components(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", keep: int = KEEP) -> DataFrame:
    """A row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, column, keep)
    if model is None or not len(model.values):
        return vectors.where(F.lit(False)).select(
            key, F.lit(0).alias("component"), *(F.lit(0).cast("long").alias(c) for c in ("n", "deviation")),
            *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")))
    shares = F.array(*(F.lit(float(v)) for v in model.values / model.trace))
    rows = whiten(vectors, model, key, column).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.fixed.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
