"""Maximum-likelihood lambdas against a dense search with numpy."""

import math
import random

import numpy as np
import pytest

from ferret.operators import cleaning as C
from ferret.operators import power


def transformed(x, lam, method):
    lam = 0 if abs(lam) < 1e-9 else lam
    if method == "box-cox":
        return np.log(x) if lam == 0 else (x ** lam - 1) / lam
    out = np.empty_like(x)
    up = x >= 0
    out[up] = np.log1p(x[up]) if lam == 0 else ((x[up] + 1) ** lam - 1) / lam
    down = 2 - lam
    out[~up] = -np.log1p(-x[~up]) if down == 0 else -((1 - x[~up]) ** down - 1) / down
    return out


def llf(x, lam, method):
    jac = np.log(x).sum() if method == "box-cox" else (np.sign(x) * np.log1p(np.abs(x))).sum()
    var = transformed(x, lam, method).var()
    return -len(x) / 2 * math.log(var) + (lam - 1) * jac if 0 < var < math.inf else -math.inf


def best_by_search(x, method, lo=-10.0, hi=10.0):
    for _ in range(12):
        grid = np.linspace(lo, hi, 41)
        k = int(np.argmax([llf(x, g, method) for g in grid]))
        lo, hi = grid[max(k - 1, 0)], grid[min(k + 1, 40)]
    return (lo + hi) / 2


@pytest.fixture(scope="module")
def columns():
    rng = random.Random(1)
    n = 800
    return {"normal": [rng.gauss(3, 2) for _ in range(n)], "skewed": [rng.lognormvariate(0, 1) for _ in range(n)],
            "negative": [-rng.lognormvariate(0, 1) for _ in range(n)], "two": [float(k % 2) for k in range(n)],
            "kinked": [rng.uniform(-1000, 10000) for _ in range(n)]}


def test_yeo_johnson_equals_a_search(spark, columns):
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in names)).repartition(5)
    found, passes = power.maximise(df, names, "yeo-johnson", -10, 10)
    assert passes <= 10
    for c in names:
        x = np.array(columns[c])
        assert found[c].lam == pytest.approx(best_by_search(x, "yeo-johnson"), abs=3e-5)  # the search sees the likelihood only
        assert found[c].llf == pytest.approx(llf(x, found[c].lam, "yeo-johnson"), rel=1e-10, abs=1e-7)
        t = transformed(x, found[c].lam, "yeo-johnson")
        assert found[c].mean == pytest.approx(t.mean(), rel=1e-9) and found[c].std == pytest.approx(t.std(), rel=1e-9)


def test_box_cox_skips_what_is_not_positive(spark, columns):
    x = columns["skewed"]
    df = spark.createDataFrame([(v,) for v in [*x, 0.0, -1.0, None, float("nan")]], "x double")
    fit = C.fit_power(df, ["x"], method="box-cox")["x"]
    assert fit.lam == pytest.approx(best_by_search(np.array(x), "box-cox"), abs=3e-5)


def test_series_joins_the_closed_form():
    f = lambda v, u=7.0: eval(power.f_sql("u", "v").replace("(CASE WHEN", "(").split("THEN")[1].split("ELSE")[0], {"u": u, "v": v})
    assert f(9e-5) == pytest.approx(math.expm1(9e-5 * 7.0) / 9e-5, rel=1e-9)


def test_columns_without_a_maximum(spark):
    df = spark.createDataFrame([(5.0, None, 2.0 ** k) for k in range(4)], "same double, none double, powers double")
    fits = C.fit_power(df, ["same", "none", "powers"])
    assert fits["same"].lam == 1.0 and fits["same"].std == 0.0
    assert fits["none"].lam == 1.0 and fits["none"].mean is None
    assert math.isfinite(fits["powers"].llf)
    assert C.fit_power(df.limit(0), ["powers"])["powers"].lam == 1.0


def test_transform_numerics_by_sign(spark):
    df = spark.createDataFrame([(float(k + 1), float(k - 5)) for k in range(20)], "p double, s double")
    out = df.select(*C.transform_numerics(df, ["p", "s"]))
    assert out.columns == ["p_log", "p_boxcox", "p_inverted", "p_yeo", "s_yeo"] and out.na.drop().count() == 20
