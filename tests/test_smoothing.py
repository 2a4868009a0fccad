"""Smoothing factors against a search over the plain recurrence."""

import random

import numpy as np
import pytest

from ferret.operators import smoothing as S


def sse(y, alpha):
    level, total = y[0], 0.0
    for v in y[1:]:
        e = v - level
        total += e * e
        level += alpha * e
    return total


def searched(y):
    lo, hi = S.LEAST, S.MOST
    for _ in range(9):
        grid = np.linspace(lo, hi, 41)
        k = int(np.argmin([sse(y, a) for a in grid]))
        lo, hi = grid[max(k - 1, 0)], grid[min(k + 1, 40)]
    return sse(y, (lo + hi) / 2)


def series(rng):
    out = {}
    for k, (n, drift) in enumerate([(40, 1.0), (300, 0.1), (2500, 0.5), (90, 0.0), (7, 1.0)]):  # 2500: several stretches
        level, ys = 0.0, []
        for _ in range(n):
            level += drift * rng.gauss(0, 1)
            ys.append(level + rng.gauss(0, 1))
        out[k] = ys
    out[10] = [5.0]
    out[11] = [1.0, 2.0]
    out[12] = [3.0] * 20
    out[13] = [float(t) for t in range(50)]  # a trend wants the largest factor
    return out


def test_best_alpha(spark, monkeypatch):
    data = series(random.Random(3))
    rows = [(k, t, t, y) for k, ys in data.items() for t, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "id int, t int, e int, y double").repartition(5)
    got = {r["id"]: r for r in S.best_alpha(df, "id", "t", "e", "y").collect()}
    assert set(got) == set(data)
    for k, ys in data.items():
        r = got[k]
        assert S.LEAST <= r["alpha"] <= S.MOST
        assert r["sse"] == pytest.approx(sse(ys, r["alpha"]), rel=1e-9, abs=1e-9)
        assert r["sse"] <= searched(ys) * (1 + 1e-9) + 1e-9
    assert got[13]["alpha"] == S.MOST
    assert S.best_alpha(df.limit(0), "id", "t", "e", "y").count() == 0


def test_folding_equals_one_stretch():
    rng = np.random.default_rng(1)
    y = rng.normal(size=100)
    alpha = np.array([[0.3, 0.8]])
    a, q = S.summarise([y], np.array([True]), alpha)
    parts = [y[:33], y[33:34], y[34:]]
    maps, forms = S.summarise(parts, np.array([True, False, False]), np.repeat(alpha, 3, axis=0))
    b, r = S.fold(maps, forms)
    assert np.allclose(a[0, :, :, 0], b[:, :, 0]) and np.allclose(q[0, :, :, 0, 0], r[:, :, 0, 0])
    step = 1e-5  # the sums are the derivatives of the error
    up, down = sse(y, 0.3 + step), sse(y, 0.3 - step)
    assert -2 * q[0, 0, 1, 0, 0] == pytest.approx((up - down) / (2 * step), rel=1e-6)
    assert 2 * q[0, 0, 2, 0, 0] == pytest.approx((up - 2 * sse(y, 0.3) + down) / step ** 2, rel=1e-3)
