"""Model comparison over a cleaning run, and the whole flow in one call.

``compare_models`` takes the transformed train/valid rows of a run, fits every
model of the registry as concurrent Spark jobs on one cached training table,
stores the long predictions table and the per-model scores in the run folder
and returns the leaderboard.  ``run_flow`` chains cleaning and comparison the
way the reference's command line does.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators import metrics as M
from ferret.operators import models as Mo
from ferret.plans.cleaning_plan import CleaningPlan, problem_kind
from ferret.session import stored

NOT_FEATURES = {"split", "hbos_score", "HBOS"}


def feature_columns(transformed: DataFrame, key: str, target: str) -> list[str]:
    return [c for c in transformed.columns if c not in NOT_FEATURES | {key, target}]


def compare_models(transformed: DataFrame, target: str, problem: str, key: str = "row_id",
                   store=None, registry: Mo.ModelRegistry | None = None, threads: int = 4) -> dict:
    kind = problem_kind(problem)
    feats = feature_columns(transformed, key, target)
    train = transformed.where("split = 'train'")
    valid = transformed.where("split = 'valid'")
    if registry is None:
        registry = Mo.ModelRegistry(kind, train.count())
    fitted, preds = Mo.fit_many(registry.specs, train, valid, feats, target, key, threads)
    preds, _ = stored(preds, "predictions")  # scored once by all models, read several times
    truth = valid.select(key, F.col(target).cast("double").alias("_y"))
    scored = preds.join(truth, key)
    scores = M.score_model(scored, "_y", "prediction", kind, "identifier")
    board = M.leaderboard(scored, "_y", "prediction", kind)
    if store is not None:
        store.append_row("models", registry.table(store.spark).select(
            "identifier", "model_type", "params", F.lit(1).cast("bigint").alias("version")))
        store.append_row("predictions", preds.select("identifier", F.lit("valid").alias("dataset"),
                                                     F.col(key).cast("bigint").alias("row_id"),
                                                     "prediction", "probability"))
        store.append_row("scores", scores.select("identifier", F.lit("valid").alias("dataset"), "score"))
        for ident, fm in fitted.items():
            if fm.model is not None or fm.svc is not None or fm.forest is not None:
                path = store.path("saved_models/" + hashlib.md5(ident.encode()).hexdigest())
                Mo.save_model(fm, path)
                store.append_row("fit_models", store.spark.createDataFrame(
                    [(ident, "train", path)], "identifier string, dataset string, path string"))
    return {"fitted": fitted, "predictions": preds, "scores": scores, "leaderboard": board,
            "features": feats}


def run_flow(df: DataFrame, problem: str, target: str, key: str = "row_id", store=None,
             use_default_models: bool = True, use_dummy_models: bool = True, threads: int = 4) -> dict:
    """Clean (fit on train, transform every split, store the stage tables), then compare models."""
    plan = CleaningPlan(target, problem, key)
    tables = plan.run(df, store)
    kind = problem_kind(problem)
    tr = tables["transformed"]
    registry = Mo.ModelRegistry(kind, tr.where("split = 'train'").count(), use_default_models,
                                use_dummy_models)
    out = compare_models(tr, target, problem, key, store, registry, threads)
    out["tables"] = tables
    return out
