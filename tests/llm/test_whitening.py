import math

import numpy as np
import pytest

from trailframe.llm import whitening as w


def rotated(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    a = (q * np.asarray(values)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.arange(1, 65.0), np.ones(16), [1.0] * 9 + [2.0] * 9, 10.0 ** -np.arange(40),
    np.r_[1 + 1e-9 * np.arange(12), 1e-3 * np.ones(12), 5 + 1e-13 * np.arange(12)], [3.0], np.zeros(4), [0.0] * 30 + [1, 2, 3]])
def test_eigenvectors_also_of_clusters(values):
    a = rotated(values).astype(w.WIDE)
    e, x = w.eigenvectors(a)
    size = float(max(np.abs(a).max(), 1e-300))
    assert float(np.abs(x.T @ x - np.eye(len(a))).max()) < 1e-17
    assert float(np.abs(a @ x - x * e).max()) < 1e-17 * size * 10
    assert (np.diff(e.astype(float)) <= 1e-15 * size).all()
    assert np.allclose(e.astype(float), np.sort(np.asarray(values, dtype=float))[::-1], atol=1e-14 * max(size, 1))


def test_better_than_double_precision():
    """Eigenvectors of a small gap against those from 50-digit arithmetic (a 2 x 2 block has them in closed form)."""
    from decimal import Decimal, getcontext

    getcontext().prec = 50
    a, b, c = (Decimal(float(v)) for v in (1 + 3e-9, 1e-9, 1.0))
    root = (((a - c) / 2) ** 2 + b * b).sqrt()
    top = (a + c) / 2 + root
    slope = (top - a) / b
    x = w.eigenvectors(np.array([[float(a), float(b)], [float(b), float(c)]]).astype(w.WIDE))[1]
    assert math.isclose(float(x[1, 0] / x[0, 0]), float(slope), rel_tol=1e-9)
    assert math.isclose(float(w.eigenvectors(np.array([[2, 1], [1, 2]]).astype(w.WIDE))[0][0]), 3.0, rel_tol=1e-18)


def test_wide_products():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(30, 40)).astype(w.WIDE), (rng.normal(size=(40, 20)) * 10.0 ** rng.integers(-9, 9, size=(40, 20))).astype(w.WIDE)
    assert float((np.abs(w.times(a, b) - a @ b) / (np.abs(a) @ np.abs(b)).max(axis=0)).max()) < 1e-17


def table(spark, vectors, first=0):
    rows = [(first + i, [None if v is None else float(v) for v in x] if x is not None else None, 1, 2, 3.0) for i, x in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, component int, z double")


def expected(vectors, k):
    """By double precision from the start, on exact integers."""
    x = np.floor(1024 * np.asarray(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    v = (d / n).T @ (d / n) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return (d / n) @ u / np.sqrt(e), (d.astype(object) ** 2).sum(axis=1), e / np.trace(v)


def test_equals_direct_computation(spark):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(300, 10)) * np.linspace(1, 3, 10)).tolist()
    bad = [None, [None] * 10, [float("nan")] * 10, [1.0] * 9 + [float("inf")], [], [1.0, 2.0]]
    got = w.whitened_embeddings(table(spark, good + bad).repartition(4)).toPandas()
    z, deviation, explained = expected(good, 8)
    assert len(got) == 2400 and set(got.n) == {300} and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-12
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(wide * np.sign(wide[0]) * np.sign(z[0]), z, atol=1e-11)
    assert got.drop_duplicates("vec_id").sort_values("vec_id").deviation.tolist() == deviation.tolist()
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, explained, rtol=1e-12)


def test_few_dimensions_and_no_variance(spark):
    got = w.whitened_embeddings(table(spark, [[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]])).toPandas()
    assert sorted(got.component) == [1, 1, 1, 2, 2, 2] and got[got.component == 2].whitened.isna().all()
    assert got[got.component == 1].whitened.notna().all() and got.identity_error[0] < 1e-12
    alone = w.whitened_embeddings(table(spark, [[1.0, 5.0]])).toPandas()
    assert len(alone) == 2 and alone.whitened.isna().all() and alone.identity_error.isna().all() and set(alone.deviation) == {0}
    assert w.whitened_embeddings(table(spark, [[1.0], None]).limit(0)).count() == 0
    assert w.whitened_embeddings(table(spark, [None, []])).count() == 0


def test_huge_entries(spark):
    got = w.whitened_embeddings(table(spark, [[1e30, 1.0], [-1e30, 2.0], [0.5, 3.0]])).toPandas()
    assert len(got) == 6 and got.deviation.isna().any()


def test_repeated_rows_and_ids(spark):
    rows = [[float(i % 3), float(i % 5)] for i in range(30)]
    df = table(spark, rows).selectExpr("cast(if(vec_id < 20, null, 7) as long) as vec_id", "embedding")
    got = w.whitened_embeddings(df).toPandas()
    assert len(got) == 60 and set(got.n) == {30} and got.identity_error[0] < 1e-12
