"""Fits and scorings use all cores whatever the files; predictions are made once; a stage is ranked once."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ferret.operators import models as Mo
from ferret.operators import normality as N
from ferret.plans import frames
from ferret.plans.cleaning_plan import CleaningPlan
from ferret.plans.model_run import compare_models
from ferret.plans.profile_report import profile


def test_rows_of_one_part_are_dealt_over_the_cores(spark):
    n = 2 * Mo.ROWS_A_TASK + 1
    rows = spark.range(0, n, 1, 1).select("id", F.lit(None).cast("double").alias("x"))
    out = Mo.dealt(rows)
    assert out.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)
    assert (out.count(), out.distinct().count()) == (n, n)
    small = spark.range(0, 100, 1, 1)
    assert Mo.dealt(small).rdd.getNumPartitions() == 1
    assert Mo.dealt(small.where("id < 0")).count() == 0


def test_trees_are_fitted_on_dealt_rows(spark, monkeypatch):
    monkeypatch.setattr(Mo, "ROWS_A_TASK", 50)
    df = spark.range(0, 200, 1, 1).select("id", (F.col("id") % 7).cast("double").alias("a"), F.lit("x").alias("other"),
                                          (F.col("id") % 7 > 3).cast("int").alias("y"))
    parts = []
    whole = Mo._fit

    def seen(spec, train, *rest):
        parts.append((train.rdd.getNumPartitions(), train.count()))
        return whole(spec, train, *rest)

    monkeypatch.setattr(Mo, "_fit", seen)
    spec = Mo.ModelSpec("random_forest", "classification", {"numTrees": 3, "maxDepth": 4})
    fm = Mo.fit_model(spec, df, ["a"], "y")
    assert parts == [(min(4, spark.sparkContext.defaultParallelism), 200)]
    assert Mo.predict(fm, df, "id").join(df, "id").where("prediction <> y").count() == 0
    assert Mo.estimator(spec, "y").getCacheNodeIds()


def test_predictions_of_a_comparison_are_made_once(spark):
    df = spark.range(0, 40, 1, 1).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("double").alias("a"), F.col("id").cast("double").alias("y"),
                                         F.when(F.col("id") % 4 == 0, "valid").otherwise("train").alias("split"))
    registry = Mo.ModelRegistry("regression", 30, use_default_models=False)
    out = compare_models(df, "y", "regression", registry=registry)
    assert out["predictions"].count() == 20
    assert all("ferret-state/predictions" in f for f in out["predictions"].inputFiles()) and out["predictions"].inputFiles()
    assert out["leaderboard"].count() == 2


def test_a_stage_is_ranked_once_for_both_reports(spark, monkeypatch):
    tables = CleaningPlan(target="label", key="row_id", fixed_lambda=0.5, fit_hbos=False).run(frames.orders_frame(spark, SF_SMALL))
    apart = N.probability_plot(tables["imputed"], tables["model"].numeric, "row_id")[1].collect()
    calls, rank = [], N.global_rank
    monkeypatch.setattr(N, "global_rank", lambda *a, **k: calls.append(1) or rank(*a, **k))
    reports = profile(tables)
    assert len(calls) == 3
    assert sorted(reports["probability_fit_imputed"].collect()) == sorted(apart)
