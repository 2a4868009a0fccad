"""Softmax boosting over three and more classes."""

import random

import numpy as np
import pytest

from ferret.operators import boosting as B
from ferret.operators import models as Mo


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(k, k % 3, 10.0 * (k % 3 == 1) + rng.random(), 10.0 * (k % 3 == 2) + rng.random(), rng.random()) for k in range(n)]


def noisy(n, seed=2):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a, b = rng.uniform(-2, 2), rng.uniform(-2, 2)
        y = 0 if a * a + b * b < 1 else 1 if a > b else 2
        out.append((k, rng.randrange(3) if rng.random() < 0.1 else y, a, b, rng.random()))
    return out


def reference(x, y, edges, classes, rounds, rate, depth):
    """The same model, node by node, in plain numpy."""
    n, bins = len(x), np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    raw = np.log(np.tile(np.bincount(y, minlength=classes) / n, (n, 1)))
    losses = []
    for _ in range(rounds):
        p = B.softmax(raw)
        losses.append(-np.log(p[np.arange(n), y]).mean())
        step = np.zeros_like(raw)
        for k in range(classes):
            r = (y == k) - p[:, k]

            def grow(members, level):
                best = None
                if level < depth:
                    for j in range(x.shape[1]):
                        for c in range(len(edges[j])):
                            left = bins[members, j] <= c
                            if left.all() or not left.any():
                                continue
                            a, b = r[members[left]], r[members[~left]]
                            g = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b)
                            if best is None or g > best[0] + 1e-9:
                                best = g, members[left], members[~left]
                if best is None or best[0] - r[members].sum() ** 2 / len(members) <= 1e-12:
                    h = (np.abs(r[members]) * (1 - np.abs(r[members]))).sum()
                    step[members, k] = (classes - 1) / classes * r[members].sum() / h if h > 1e-150 else 0.0
                else:
                    grow(best[1], level + 1)
                    grow(best[2], level + 1)

            grow(np.arange(n), 0)
        raw += rate * step
    return B.softmax(raw), losses


def test_equals_plain_boosting(spark):
    data = noisy(240)
    df = spark.createDataFrame(data, "row_id int, y int, a double, b double, c double").repartition(4)
    model = B.fit_softmax_boosting(df, ["a", "b", "c"], "y", [0.0, 1.0, 2.0], max_iter=12, max_depth=2, bins=16)  # crosses a freeze
    x, y = np.array([r[2:] for r in data]), np.array([r[1] for r in data])
    p, losses = reference(x, y, model.edges, 3, 12, 0.1, 2)
    assert np.allclose(model.scores(x), p, atol=1e-8)
    assert np.allclose(model.losses, losses, atol=1e-8)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:]))


@pytest.mark.parametrize("names", [(0, 1, 2), (7, 3, 50)])
def test_three_classes_and_their_labels(spark, names):
    df = spark.createDataFrame([(k, names[y], a, b, c) for k, y, a, b, c in rows(120)], "row_id int, y int, a double, b double, c double")
    for name in ("gradient_boosting", "decision_tree", "logistic_regression", "ridge_classifier"):
        spec = next(s for s in Mo.default_specs("classification", 120) if s.name == name)
        if name == "gradient_boosting":
            spec.params["maxIter"] = 5
        fm = Mo.fit_model(spec, df, ["a", "b", "c"], "y")
        assert Mo.predict(fm, df).join(df.select("row_id", "y"), "row_id").where("prediction = y").count() == 120, name


def test_missing_values_and_labels(spark):
    data = [(k, None if k % 11 == 0 else y, None if k % 5 == 0 else a, float("nan") if k % 7 == 0 else b, 1.0) for k, y, a, b, _ in rows(90)]
    df = spark.createDataFrame(data, "row_id int, y int, a double, b double, c double")
    model = B.fit_softmax_boosting(df, ["a", "b", "c"], "y", [0.0, 1.0, 2.0], max_iter=3)
    assert model.losses[2] < model.losses[0]
    with pytest.raises(ValueError):
        B.fit_softmax_boosting(df.limit(0), ["a"], "y", [0.0, 1.0])
    with pytest.raises(ValueError):
        Mo.label_values(spark.range(2000), "id")
