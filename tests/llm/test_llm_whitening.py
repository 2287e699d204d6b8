"""Whitening against a dense eigensolver, and exact sums against whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from footfall.llm.whitening import deviations, fit_list, leading_pairs, minres, whiten


def dense(rows, wanted=16):
    """Brute force: (id, component, n, deviation, whitened up to sign, explained)."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(64 * float(c)) + 1000000 for c in v]) for i, v in usable]
    fit = sorted({tuple(v) for _, v in x})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array([[(n * v[j] - sums[j]) / n for j in range(d)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:wanted], axes[:, ::-1][:, :wanted]
    some = values > 1e-12 * values[0]
    values, axes = values[some], axes[:, some]
    trace = (centred**2).sum() / n
    return [
        (i, k + 1, n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), sum((n * a - s) / n * u for a, s, u in zip(v, sums, axes[:, k])) / math.sqrt(values[k]), values[k] / trace)
        for i, v in x for k in range(len(values))
    ]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def check(found, rows, wanted=16):
    got, want = sorted(found.collect(), key=lambda r: (repr(r.vec_id), r.component)), sorted(dense(rows, wanted), key=lambda r: (repr(r[0]), r[1]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [w[:4] for w in want]
    signs = {}
    for r, w in zip(got, want):
        assert r.explained == pytest.approx(w[5], rel=1e-10)
        if abs(w[4]) > 1e-6:
            assert signs.setdefault(r.component, math.copysign(1, r.whitened * w[4])) == math.copysign(1, r.whitened * w[4])
        assert abs(r.whitened) == pytest.approx(abs(w[4]), abs=1e-8)
        assert r.identity_error < 1e-8


def random_rows(n=120, d=20, seed=0):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, d)) * np.linspace(1, 4, d)
    return [(i, np.float32(v).tolist()) for i, v in enumerate(made)]


def test_awkward_vectors(spark):
    rows = random_rows()
    copies = [(500 + i, rows[3][1]) for i in range(60)] + [rows[5], rows[5], (None, rows[9][1])]
    bad = [(900, None), (901, []), (902, [None] + [0.5] * 19), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [1.0, 2.0])]
    df = vectors(spark, rows + copies + bad).selectExpr("*", "'x' AS x", "1 AS n", "2 AS component").repartition(5)
    check(whiten(df), rows + copies)


def test_fewer_dimensions_and_no_variance(spark):
    flat = [(i, [float(i % 7), 2.0, -float(i % 7), float(i % 3)]) for i in range(40)]
    found = whiten(vectors(spark, flat))
    assert found.agg({"component": "max"}).first()[0] == 2  # of four dimensions two vary on their own
    check(found, flat)
    assert whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whiten(vectors(spark, [])).collect() == []
    assert whiten(vectors(spark, [(1, None)])).schema.names == found.schema.names


def test_repeated_eigenvalues(spark):
    rows = [(2 * i + s, [(3.0 if j == i else 0.0) * (1 - 2 * s) for j in range(6)]) for i in range(6) for s in (0, 1)]
    found = whiten(vectors(spark, rows), components=6).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r.whitened**2)
    # Whatever axes are taken, each vector is as far from the mean as all others.
    assert all(sum(v) == pytest.approx(6, rel=1e-9) for v in by_id.values()) and found[0].identity_error < 1e-9


@pytest.mark.parametrize("d, wanted", [(3, 3), (30, 4), (120, 6)])
def test_leading_pairs(d, wanted):
    rng = np.random.default_rng(d)
    axes = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = np.sort(np.r_[rng.random(d - 1), 5.0])[::-1]
    v = axes @ np.diag(values) @ axes.T
    found, u = leading_pairs(lambda b: v @ b, d, wanted)
    assert np.allclose(found, values[:wanted], rtol=0, atol=1e-12)
    assert np.linalg.norm(v @ u - u * found, axis=0).max() < 1e-11
    assert np.allclose(u.T @ u, np.eye(wanted), atol=1e-12)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(12, 12))
    a = a + a.T
    b = rng.normal(size=(12, 2))
    assert np.allclose(a @ minres(lambda x: a @ x, b, 14), b, atol=1e-6)
    assert not minres(lambda x: a @ x, np.zeros((12, 2)), 5).any()


def test_products_are_centred_in_whole_numbers(spark):
    rows = random_rows(50, 4, 8)
    df = spark.createDataFrame([(i, [10**12 + int(100 * c) for c in v]) for i, v in rows], "vec_id long, x array<long>")
    fit = fit_list(df.repartition(3), 4)
    x = np.array([[10**12 + int(100 * c) for c in v] for _, v in rows])
    c = x - x[0] - (x - x[0]).mean(0)
    assert fit.n == 50 and fit.sums.tolist() == x.sum(0).tolist()
    assert np.allclose(fit.covariance_times(3)(np.eye(4)), c.T @ c / 50, rtol=1e-12)


def test_deviations_are_exact():
    apart = np.array([[3, -4], [2**31, 2**31], [2**31 - 1, 2**31], [2**33, 1]])
    assert deviations(apart).to_pylist() == [25, None, (2**31 - 1) ** 2 + 2**62, None]
