"""Hand-made edge tables: empty, one row, all-null, constant, NaN beside NULL, ties."""

import math

import pytest
from pyspark.sql import functions as F

from ferret.operators import charts, cleaning as C, nullity, profile as P, roles as R
from ferret.operators.rank import exact_quantiles, global_rank


def test_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert C.fit_medians(df, ["x"])["x"] == 2.5


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "c string")
    assert C.fit_modes(df, ["c"])["c"] == "a"
    di = spark.createDataFrame([(10,), (9,), (10,), (9,)], "c int")
    assert C.fit_modes(di, ["c"])["c"] == 9  # numeric order, not text order


def test_nan_beside_null_counts_both(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "x double")
    r = nullity.na_count_report(df).collect()[0]
    assert r["null_count"] == 2


def test_empty_table_reports(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert nullity.nan_report(df).where("pct_null IS NOT NULL").count() == 0
    assert exact_quantiles(df, ["a"], [0.5]) == {("a", 0.5): None}
    assert C.fit_modes(df, ["b"]) == {"b": None}


def test_one_row(spark):
    df = spark.createDataFrame([(7.0, "x")], "a double, b string")
    assert C.fit_medians(df, ["a"]) == {"a": 7.0}
    h = P.histogram(df, ["a"]).collect()
    assert [(r["bin"], r["count"]) for r in h] == [(0, 1)]


def test_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    assert C.fit_medians(df, ["x"]) == {"x": None}
    assert nullity.nan_features(df).collect()[0]["feature"] == "x"
    out = df.select(C.impute("x", None).alias("x"))
    assert out.where("x IS NULL").count() == 2


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, c double")
    m = {(r["feature_x"], r["feature_y"]): r["corr"] for r in P.correlation_matrix(df, ["a", "c"]).collect()}
    assert m[("a", "a")] == 1.0
    assert m[("a", "c")] is None and m[("c", "c")] is None


def test_constant_column_power_transform(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    fit = C.fit_power(df, ["x"])
    out = df.select(C.power_transform("x", fit["x"]).alias("t")).collect()
    assert all(r["t"] == 0.0 for r in out)


def test_unseen_category_gets_prior(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", 1)], "c string, y int")
    valid = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    te = C.fit_target_encoding(train, ["c"], "y")
    out = C.apply_target_encoding(valid, te, ["c"]).collect()
    assert out[1]["c_te"] == pytest.approx(0.75) and out[2]["c_te"] == pytest.approx(0.75)
    w = 1 / (1 + math.exp(-(2 - 1) / 1.0))
    assert out[0]["c_te"] == pytest.approx(0.75 * (1 - w) + 0.5 * w)


def test_single_class_target(spark):
    from ferret.operators import metrics as M
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "row_id int, y_true int, y_pred int")
    cm = M.confusion_matrix(df, "y_true", "y_pred").collect()
    assert [(r["actual"], r["predicted"], r["count"]) for r in cm] == [(1, 1, 2)]
    auc = M.roc_auc(df.withColumn("s", F.lit(0.5)), "y_true", "s").collect()[0]
    assert auc["roc_auc"] is None  # undefined with one class: NULL, not an error


def test_unequal_bar_labels_raise(spark):
    pts = spark.createDataFrame([("s1", "a", 1.0), ("s1", "b", 2.0), ("s2", "a", 1.0)],
                                "series string, x string, y double")
    with pytest.raises(ValueError):
        charts.check_bar_labels(pts)


def test_chart_drops_non_finite(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, float("inf")), (3.0, float("nan")), (4.0, None)],
                               "x double, y double")
    assert charts.chart_series(df, "c", "s", "x", "y").count() == 1


def test_roles_id_and_high_null(spark):
    rows = [(i, i * 3, None if i % 2 else 1.0, i % 3, f"n{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "row_id int, PassengerId int, cabin double, grp int, name string")
    r = R.infer_roles(df, target=None, key_cols=["row_id"])
    assert r["problematic"] == ["PassengerId"]
    assert r["NaN"] == ["cabin"]
    assert "grp" in r["categoric"] and "name" not in r["categoric"]


def test_infer_problem_rejected():
    from ferret.plans.cleaning_plan import problem_kind
    with pytest.raises(ValueError):
        problem_kind("infer")
    assert problem_kind("binary classification") == "classification"


def test_global_rank_hot_value(spark):
    # one value holds a third of the rows: ranks stay exact and dense
    rows = [(i, 5.0 if i % 3 == 0 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r["k"]: r["rank"] for r in global_rank(df, ["v"], ["k"], num_partitions=7).collect()}
    want = {k: i + 1 for i, (k, _) in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    assert got == want


def test_map_items_never_lowers_parallelism(spark):
    from ferret.operators.items import map_items
    import pandas as pd
    df = spark.range(0, 1000, numPartitions=6).withColumnRenamed("id", "k")
    fn = lambda pdf: pd.DataFrame({"k": pdf["k"] * 2})
    assert map_items(df, fn, "k long", num_workers=2).rdd.getNumPartitions() == 6
    assert map_items(df, fn, "k long", num_workers=12).rdd.getNumPartitions() == 12
    assert map_items(df, fn, "k long").count() == 1000
