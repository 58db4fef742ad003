import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.llm.whitening import one_sided_jacobi, pivoted_cholesky, usable, whitened

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, d, seed, rank=None):
    rng = np.random.default_rng(seed)
    basis = rng.normal(size=(rank or d, d)) * np.linspace(0.2, 1.0, rank or d)[:, None]
    return (rng.normal(size=(n, rank or d)) @ basis * 0.1 + rng.normal(size=d)).astype(np.float32)


def brute(v):
    x = np.floor(1024 * v.astype(np.float64)).astype(np.int64) + 100000
    n, s = len(x), [int(a) for a in x.astype(object).sum(0)]
    deviation = [sum((n * int(c) - t) ** 2 for c, t in zip(row, s)) for row in x]
    d = x - np.array([t / n for t in s])
    e, u = np.linalg.eigh(d.T @ d / n)
    return n, deviation, d, e[::-1], u[:, ::-1]


def table(spark, v, parts=3):
    return spark.createDataFrame([(i, [float(c) for c in r], 1) for i, r in enumerate(v)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("n, d", [(300, 12), (40, 5), (500, 33)])
def test_equals_numpy(spark, n, d):
    v = vectors(n, d, n)
    rows = whitened(table(spark, v)).collect()
    m, deviation, centred, e, u = brute(v)
    k = min(8, d)
    assert len(rows) == n * k
    got = np.zeros((n, k))
    for r in rows:
        assert r.n == m and int(r.deviation) == deviation[r.vec_id]
        assert abs(r.explained - e[r.component - 1] / e.sum()) < 1e-9 * r.explained
        assert r.identity_error < 1e-9
        got[r.vec_id, r.component - 1] = r.whitened
    want = centred @ u[:, :k] / np.sqrt(e[:k])
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got, want * signs, atol=1e-8)


def test_factor_and_rotation():
    rng = np.random.default_rng(3)
    for d, rank, spread in ((1, 1, 1), (2, 2, 9), (17, 17, 12), (30, 11, 6), (64, 64, 3)):
        b = rng.normal(size=(d, rank)) * np.logspace(0, -spread / 2, rank)
        a = b @ b.T
        factor = pivoted_cholesky(a)
        assert factor.shape[1] <= d and np.allclose(factor @ factor.T, a, atol=1e-12 * np.abs(a).max() * d)
        pivots = np.argsort(-np.abs(factor[:, 0]))[:1]
        assert factor[pivots[0], 0] == pytest.approx(np.sqrt(a.diagonal().max()))
        norms, units = one_sided_jacobi(factor)
        r = len(norms)
        assert np.all(np.diff(norms) <= 0) and np.allclose(units.T @ units, np.eye(r), atol=1e-12)
        assert np.allclose(norms, np.linalg.eigvalsh(a)[::-1][:r], atol=1e-12 * norms[0])
        assert np.allclose(a @ units, units * norms, atol=1e-11 * norms[0])
    assert pivoted_cholesky(np.zeros((4, 4))).shape == (4, 0)


def test_rank_below_the_components(spark):
    v = np.round(vectors(60, 3, 4) * 64) / 64
    wide = np.concatenate([v, v, np.ones((60, 2), dtype=np.float32)], axis=1)     # repeated and constant dimensions
    rows = whitened(table(spark, wide)).collect()
    assert {r.component for r in rows} == {1, 2, 3}
    assert max(r.identity_error for r in rows) < 1e-9
    assert sum({r.component: r.explained for r in rows}.values()) == pytest.approx(1.0)
    assert whitened(table(spark, np.ones((9, 4)))).count() == 0


def test_rows_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(c) for c in r] for r in vectors(30, 4, 8)]
    bad = [None, [], [nan, 1., 1., 1.], [inf, 1., 1., 1.], [1., None, 1., 1.], [1., 2.], [1e30, 1., 1., 1.]]
    df = spark.createDataFrame([(i, r, None) for i, r in enumerate(good + bad)] + [(0, good[0], 1), (None, good[1], 1)], SCHEMA)
    df = df.select("*", *[F.lit(1).alias(c) for c in ("e", "i", "v", "n", "component", "whitened")])
    rows = whitened(df).collect()
    m, deviation, *_ = brute(np.array(good + [good[0], good[1]], dtype=np.float32))
    assert {r.n for r in rows} == {32} == {m}
    assert sorted({(r.vec_id, int(r.deviation)) for r in rows}, key=str) == sorted(
        {*((i, deviation[i]) for i in range(30)), (None, deviation[31])}, key=str)
    assert len(rows) == 32 * 4
    assert usable(df.limit(0), "vec_id", "embedding")[1] == 0
    empty = whitened(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == whitened(df).columns


def test_large_entries_stay_exact(spark):
    v = (np.random.default_rng(1).integers(-2**40, 2**40, size=(20, 3))).astype(np.float32)
    rows = whitened(table(spark, v)).collect()
    _, deviation, *_ = brute(v)
    assert {(r.vec_id, int(r.deviation)) for r in rows} == set(enumerate(deviation))
    v[0, 0] = 2.0**51       # over 38 digits for this row alone
    assert {r.vec_id for r in whitened(table(spark, v)).where("deviation is null").collect()} == {0}
