"""The squared-hinge classifier against its optimality conditions and a plain solver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferret.operators import models as Mo
from ferret.operators import squared_hinge as H


def frame(spark, x, y):
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = [(k, *map(float, r), float(t)) for k, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} double" for c in names) + ", y double"), names


def gradient(x, s, w, b, reg):
    z = np.hstack([x, np.ones((len(x), 1))])
    v = np.append(w, b)
    short = np.maximum(0, 1 - s * (z @ v))
    return -2 * (short * s) @ z / len(x) + reg * v


def noisy(n=400, d=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, d)) * 10.0 ** np.arange(d)
    return x, (x[:, 0] + x[:, 1] / 10 + rng.normal(0, 0.7, n) > 0.2).astype(float)


def test_optimality_with_columns_of_any_scale(spark):
    x, y = noisy()
    df, names = frame(spark, x, y)
    m = H.fit_squared_hinge(df, names, "y", 2, 1 / len(x))
    g = gradient(x, 2 * y - 1, m.weights[0], m.intercepts[0], 1 / len(x))
    assert np.abs(g / np.sqrt(np.append((x * x).mean(axis=0), 1))).max() < 1e-8 and m.gradient < 1e-8


def test_more_columns_than_a_block(spark, monkeypatch):
    x, y = noisy(300, 7, 2)
    df, names = frame(spark, x / 10.0 ** np.arange(7), y)
    whole = H.fit_squared_hinge(df, names, "y", 2, 0.01)
    monkeypatch.setattr(H, "BLOCK", 3)
    parts = H.fit_squared_hinge(df, names, "y", 2, 0.01)
    assert np.allclose(whole.weights, parts.weights, atol=1e-7) and whole.passes < parts.passes


def test_three_classes_are_one_against_rest(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 2))
    y = np.where(x[:, 0] > 0.5, 2, np.where(x[:, 1] > 0, 1, 0))
    df, names = frame(spark, x, y)
    m = H.fit_squared_hinge(df, names, "y", 3, 0.02)
    for k in range(3):
        alone = H.fit_squared_hinge(df.withColumn("y", (F.col("y") == k).cast("int")), names, "y", 2, 0.02)
        assert np.allclose(m.weights[k], alone.weights[0], atol=1e-7)
    got = {r["row_id"]: r["p"] for r in df.select("row_id", m.place().alias("p")).collect()}
    want = (x @ m.weights.T + m.intercepts).argmax(axis=1)
    assert [got[k] for k in range(300)] == want.tolist()


def test_missing_values_labels_and_one_class(spark):
    rows = [(0, 1.0, 1.0), (1, None, 1.0), (2, float("nan"), 0.0), (3, -1.0, 0.0), (4, 5.0, None)]
    df = spark.createDataFrame(rows, "row_id long, x double, y double")
    filled = spark.createDataFrame([(0, 1.0, 1.0), (1, 0.0, 1.0), (2, 0.0, 0.0), (3, -1.0, 0.0)], df.schema)
    a, b = (H.fit_squared_hinge(d, ["x"], "y", 2, 0.1) for d in (df, filled))
    assert np.allclose(a.weights, b.weights)
    spec = Mo.ModelSpec("linear_svc", "classification", {"regParam": 0.1})
    one = Mo.fit_model(spec, df.where("y = 1"), ["x"], "y")
    assert {r["prediction"] for r in Mo.predict(one, df).collect()} == {1.0}
    with pytest.raises(ValueError):
        H.fit_squared_hinge(df.limit(0), ["x"], "y", 2, 0.1)


def test_stored_model_predicts_the_same(spark, tmp_path):
    x, y = noisy(100, 2)
    df, names = frame(spark, x, np.where(y > 0, 7.0, 3.0))
    spec = Mo.ModelSpec("linear_svc", "classification", {"regParam": 0.01})
    fm = Mo.fit_model(spec, df, names, "y")
    Mo.save_model(fm, str(tmp_path / "m"))
    back = Mo.load_model(spec, str(tmp_path / "m"), names, "y")
    want = sorted(map(tuple, Mo.predict(fm, df).collect()))
    assert sorted(map(tuple, Mo.predict(back, df).collect())) == want
    assert {p for _, p, _ in want} == {3.0, 7.0}
