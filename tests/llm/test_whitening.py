"""Whitening against a plain eigendecomposition of exact whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilog.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, component string, at string, n string, v string, key string"


def frame(spark, vectors, parts=5):
    rows = [(i, v, "c", "a", "n", "v", "k") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def exact(vectors):
    """Ids, n, deviations and the covariance, from Python's own whole numbers."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in enumerate(vectors) if usable(v)]
    x = np.array([v for _, v in kept], object)
    n = len(kept)
    y = x * n - x.sum(0)
    cov = (y.T.dot(y)).astype(float) / float(n) ** 3
    return [i for i, _ in kept], n, (y * y).sum(1), y.astype(float) / n, cov


def compare(rows, vectors, keep=32):
    ids, n, deviation, y, cov = exact(vectors)
    values, basis = np.linalg.eigh(cov)
    order = [j for j in np.argsort(-values) if values[j] > 1e-12 * values.max()][:keep]
    assert len(rows) == len(ids) * len(order)
    got = {(r.vec_id, r.component): r for r in rows}
    place = {v: k for k, v in enumerate(ids)}
    for c, j in enumerate(order):
        want = y @ basis[:, j] / np.sqrt(values[j])
        mine = np.array([got[i, c + 1].whitened for i in ids])
        alone = min([abs(values[j] - values[k]) for k in order if k != j], default=1) > 1e-3 * values[j]
        if alone:
            assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
        assert abs(mine.var() - 1) < 1e-9
    for r in rows:
        assert r.n == n and r.deviation == deviation[place[r.vec_id]] and 0 <= r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[order[r.component - 1]] / np.trace(cov), rel=1e-9)


@pytest.mark.parametrize("dims,n", [(3, 40), (40, 300), (6, 4)])
def test_components_equal_a_plain_decomposition(spark, dims, n):
    rng = np.random.default_rng(dims)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(n, dims)) * np.linspace(1, 3, dims)]
    vectors[1] = vectors[0]
    vectors += [vectors[2]] * (n // 2)  # one vector holds a third of the rows
    compare(whitening.components(frame(spark, vectors)).collect(), vectors)


def test_unusable_vectors_are_dropped(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(30, 4))]
    odd = [None, [1.0, None, 2.0, 3.0], [float("nan")] * 4, [math.inf, 0.0, 0.0, 0.0], [-math.inf, 0.0, 0.0, 0.0]]
    rows = whitening.components(frame(spark, vectors + odd)).collect()
    compare(rows, vectors + odd)
    others = [[], [1.0], [1e30, 0.0, 0.0, 0.0]]
    again = whitening.components(frame(spark, vectors + odd + others)).collect()
    assert {r.vec_id for r in again} == set(range(30))
    compare(again, vectors + odd)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_no_variance_gives_no_component(spark, vectors):
    got = whitening.components(frame(spark, vectors, 2))
    assert got.count() == 0
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_numbers_leave_64_bits_exactly(spark):
    vectors = [[float(s * 2 ** 33), float(k)] for k, s in enumerate((1, -1, 1, -1, 1))] * 3
    fixed = whitening.totals(frame(spark, vectors), "embedding")
    assert fixed.n == 15 and fixed.sums[0] == 3 * (64 * 2 ** 33) + 15 * 1_000_000
    x = np.array([[64 * 2 ** 33 + 1_000_000, 1_000_000]])
    big = whitening.Fixed(2, 1 << 30, fixed.sums)
    assert big.numerators(x)[0][0] == (64 * 2 ** 33 + 1_000_000) * (1 << 30) - fixed.sums[0]
    assert {r.deviation for r in whitening.components(frame(spark, vectors)).collect()} == {None}


@pytest.mark.parametrize("rows", [
    np.random.default_rng(0).normal(size=(50, 12)), np.random.default_rng(1).integers(-2, 3, (60, 8)).astype(float),
    np.ones((10, 5)), np.zeros((4, 3)), np.array([[2.0], [3.0]]), np.eye(6), np.repeat(np.eye(4), 3, 0),
    np.random.default_rng(2).normal(size=(40, 6)) * 10.0 ** -np.arange(0, 18, 3)])
def test_rank_one_updates(rows):
    d = rows.shape[1]
    for add in (lambda v, b: whitening.add_rows(v, b, rows), lambda v, b: one_by_one(v, b, rows)):
        values, basis = add(np.zeros(d), np.eye(d))
        scatter = rows.T @ rows
        assert np.abs(basis.T @ basis - np.eye(d)).max() < 1e-12
        assert np.abs(basis * values @ basis.T - scatter).max() <= 1e-12 * max(np.abs(scatter).max(), 1e-300)
        assert (np.diff(values) >= 0).all()


def one_by_one(values, basis, rows):
    for row in rows:
        values, basis = whitening.update(values, basis, row)
    return values, basis


def test_roots_lie_between_the_poles():
    d, z2 = np.array([0.0, 1.0, 1.0 + 1e-12, 5.0]), np.array([1e-20, 0.5, 0.5, 2.0])
    delta = whitening.secular_roots(d, z2)
    assert (np.diagonal(delta) < 0).all() and (delta[np.arange(3), np.arange(1, 4)] > 0).all()
    terms = z2 / delta
    assert (np.abs(1 + terms.sum(1)) <= 1e-15 * (1 + np.abs(terms).sum(1))).all()


def test_spectra_by_updates_need_no_refinement(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(c) for c in v] for v in rng.normal(size=(400, 10))]
    df = frame(spark, vectors, 7)
    fixed = whitening.totals(df, "embedding")
    values, basis = whitening.spectrum(df, "embedding", fixed)
    _, n, _, _, cov = exact(vectors)
    assert np.abs(basis * values @ basis.T / n - cov).max() < 1e-10 * np.abs(cov).max()


def test_whole_table(spark, sf_dir):
    df = queries.op11_whitening(spark, sf_dir)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in table] == list(range(table[0].vec_id, table[0].vec_id + len(table)))
    first = table[0].vec_id
    rows = df.withColumn("vec_id", F.col("vec_id") - first).collect()
    compare(rows, [r.embedding for r in table])
