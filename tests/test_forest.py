"""Forests of larger tables: grown by numpy in tasks, the same trees wherever a node is counted."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferret.operators import forest as Fo
from ferret.operators import models as Mo


def plain(bins, w, s, depth):
    """Predictions of the rows by a tree grown node by node."""
    out = np.full(len(w), s.sum() / w.sum())
    best = (1e-9, None)
    for j in range(bins.shape[1]) if depth else []:
        for cut in range(Fo.BINS - 1):
            a = bins[:, j] <= cut
            if 0 < a.sum() < len(w):
                gain = s[a].sum() ** 2 / w[a].sum() + s[~a].sum() ** 2 / w[~a].sum() - s.sum() ** 2 / w.sum()
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, a)
    if best[1] is not None:
        for a in (best[1], ~best[1]):
            out[a] = plain(bins[a], w[a], s[a], depth - 1)
    return out


@pytest.mark.parametrize("depth, at_once", [(0, 1 << 14), (3, 1 << 14), (9, 2)])
def test_a_tree_equals_one_grown_node_by_node(monkeypatch, depth, at_once):
    monkeypatch.setattr(Fo, "NODES_AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    bins, w = rng.integers(0, 9, (300, 3)).astype(np.uint8), rng.integers(1, 4, 300).astype(float)
    s = w * (bins[:, 0] * 3.0 + rng.normal(0, 1, 300))
    tree = Fo.grow(bins, w, s, depth, 3, rng)
    assert np.allclose(tree.value[tree.descend(bins, depth)], plain(bins, w, s, depth))
    back = Fo.Tree.of(tree.bytes())
    assert (back.descend(bins, depth) == tree.descend(bins, depth)).all()
    different, place = Fo.alike(np.concatenate([bins, bins, bins]))
    assert (different[place] == np.concatenate([bins, bins, bins])).all()
    summed = Fo.grow(different, np.bincount(place, np.tile(w, 3)), np.bincount(place, np.tile(s, 3)), depth, 3, rng)
    assert np.allclose(summed.value[summed.descend(bins, depth)], plain(bins, w, s, depth))


def table(spark, n=3000):
    k = F.col("id")
    return spark.range(0, n, 1, 4).select(
        k.alias("row_id"), (k * 37 % 1009).cast("double").alias("a"), (k % 5).cast("int").alias("b"),
        (k % 400 == 0).cast("int").alias("seldom")).withColumn(
        "y", F.col("a") / 10 + F.col("b") * 7 + F.col("seldom") * 500).withColumn("c", F.when(F.col("y") > 60, 1).otherwise(0))


def test_nodes_counted_by_all_tasks_give_the_same_trees(spark, monkeypatch):
    df = table(spark).cache()
    monkeypatch.setattr(Fo, "ROWS_A_BLOCK", 400)
    monkeypatch.setattr(Fo, "ROWS_A_BRANCH", 5000)
    whole = Fo.fit_forest(df, ["a", "b", "seldom"], "y", 4, 6, 3, 1)
    monkeypatch.setattr(Fo, "ROWS_A_GROUP", 100)
    monkeypatch.setattr(Fo, "ROWS_A_BRANCH", 100)
    monkeypatch.setattr(Fo, "BYTES_A_ROUND", 100_000)  # and in several rounds
    parted = Fo.fit_forest(df, ["a", "b", "seldom"], "y", 4, 6, 3, 1)
    x = np.array([[np.nan if r["row_id"] == 7 else r["a"], r["b"], r["seldom"]] for r in df.collect()], float)
    assert np.allclose(whole.scores(x), parted.scores(x))
    assert np.allclose(whole.importances(), parted.importances()) and abs(sum(parted.importances()) - 1) < 1e-12
    assert all(len(a.left) == len(b.left) for a, b in zip(whole.trees, parted.trees, strict=True))
    assert len({round(float(t.value[0]), 9) for t in Fo.fit_forest(df, ["b"], "y", 4, 0, 1, 1).trees}) == 4  # each its own draw
    shallow = Fo.fit_forest(df, ["a", "b", "seldom"], "y", 2, 2, 3, 1)  # nodes of the last level are above the bound still
    assert all(len(t.left) == 7 for t in shallow.trees)
    assert whole.edges[1:] == [[0.5, 1.5, 2.5, 3.5], [0.5]]
    df.unpersist()


@pytest.mark.parametrize("problem, label", [("regression", "y"), ("classification", "c")])
def test_a_larger_table_gets_a_forest_of_its_own(spark, monkeypatch, tmp_path, problem, label):
    monkeypatch.setattr(Mo, "ROWS_A_TASK", 500)
    df = table(spark).cache()
    feats = ["a", "b", "seldom"]
    spec = Mo.ModelSpec("random_forest", problem, {"numTrees": 20, "maxDepth": 8, "seed": 5})
    fm = Mo.fit_model(spec, df, feats, label)
    assert fm.forest is not None and fm.model is None and len(fm.forest.trees) == 20
    got = {r["row_id"]: (r["prediction"], r["probability"]) for r in Mo.predict(fm, df).collect()}
    y = {r["row_id"]: r[label] for r in df.collect()}
    assert len(got) == 3000
    if problem == "classification":
        assert sum(got[k][0] == y[k] for k in y) > 2900 and all(v == (p > 0.5) and 0 <= p <= 1 for v, p in got.values())
    else:
        monkeypatch.setattr(Mo, "ROWS_A_TASK", 5000)
        spark_one = Mo.predict(Mo.fit_model(spec, df, feats, label), df).collect()
        monkeypatch.setattr(Mo, "ROWS_A_TASK", 500)
        ours, theirs = sum((got[k][0] - y[k]) ** 2 for k in y), sum((r["prediction"] - y[r["row_id"]]) ** 2 for r in spark_one)
        assert 0.6 * theirs < ours < 1.6 * theirs
    Mo.save_model(fm, str(tmp_path / "m"))
    back = Mo.load_model(spec, str(tmp_path / "m"), feats, label)
    assert {r["row_id"]: (r["prediction"], r["probability"]) for r in Mo.predict(back, df).collect()} == got
    many = Mo.predict_many({"f": fm, "d": Mo.fit_model(Mo.ModelSpec(
        "dummy_mean" if problem == "regression" else "dummy_most_frequent", problem), df, feats, label)}, df)
    assert {r["row_id"]: (r["prediction"], r["probability"]) for r in many.where("identifier = 'f'").collect()} == got
    assert many.count() == 6000
    imp = {r["feature"]: r["importance"] for r in Mo.feature_importances(fm).collect()}
    assert set(imp) == set(feats) and abs(sum(imp.values()) - 1) < 1e-9
    for c in (label, "a"):
        with pytest.raises(ValueError):
            Mo.fit_model(spec, df.withColumn(c, F.when(F.col("row_id") != 5, F.col(c))), feats, label)
    df.unpersist()


def test_other_label_values_and_few_rows(spark, monkeypatch):
    spec = Mo.ModelSpec("random_forest", "classification", {"numTrees": 3, "maxDepth": 4})
    df = table(spark, 600).withColumn("c", F.when(F.col("c") == 1, 9).otherwise(4))
    assert Mo.fit_model(spec, df, ["a", "b"], "c").forest is None  # a small table keeps Spark's estimator
    monkeypatch.setattr(Mo, "ROWS_A_TASK", 100)
    fm = Mo.fit_model(spec, df, ["a", "b"], "c")
    assert {r["prediction"] for r in Mo.predict(fm, df).collect()} == {4.0, 9.0}


def test_the_longest_fits_begin_first(spark, monkeypatch):
    begun, fit = [], Mo._fit
    monkeypatch.setattr(Mo, "_fit", lambda spec, *a: begun.append(spec.name) or fit(spec, *a))
    names = ["dummy_mean", "ridge", "decision_tree", "gradient_boosting"]
    specs = [Mo.ModelSpec(n, "regression", {"maxIter": 1, "maxDepth": 2, "regParam": 0.1}) for n in names]
    fitted, _ = Mo.fit_many(specs, table(spark, 200), table(spark, 200), ["a", "b"], "y", threads=1)
    assert begun == ["gradient_boosting", "decision_tree", "dummy_mean", "ridge"]
    assert [fm.spec.name for fm in fitted.values()] == names


@pytest.mark.parametrize("problem, label", [("regression", "y"), ("classification", "c")])
def test_a_single_tree_of_a_larger_table_equals_sparks(spark, monkeypatch, problem, label):
    df = table(spark).withColumn("a", F.col("a") % 29).cache()  # few values: both cut between all of them
    df = df.withColumn("y", F.col("a") * 3.25 + F.col("b") * F.col("b") * 7 + F.col("seldom") * 500.5).withColumn("c", (F.col("y") > 60).cast("int"))
    spec = Mo.ModelSpec("decision_tree", problem, {"maxDepth": 7, "seed": 42})
    theirs = Mo.fit_model(spec, df, ["a", "b", "seldom"], label)
    monkeypatch.setattr(Mo, "ROWS_A_TASK", 500)
    monkeypatch.setattr(Fo, "ROWS_A_BRANCH", 200)
    ours = Mo.fit_model(spec, df, ["a", "b", "seldom"], label)
    assert ours.forest is not None and theirs.forest is None
    both = Mo.predict(ours, df).join(Mo.predict(theirs, df).toDF("row_id", "p", "q"), "row_id").select(
        F.max(F.abs(F.col("prediction") - F.col("p"))), F.max(F.abs(F.coalesce("probability", F.lit(0)) - F.coalesce("q", F.lit(0)))), F.count("*")).collect()[0]
    assert both[0] < 1e-9 and both[1] < 1e-9 and both[2] == 3000
    assert Mo.feature_importances(ours).select("feature").collect() == Mo.feature_importances(theirs).select("feature").collect()
