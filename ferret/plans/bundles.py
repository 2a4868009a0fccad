"""Report bundles: dicts of lazy DataFrames (the data behind each chart panel)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators import metrics as M


def classification_viz(df: DataFrame, y_true: str, y_pred: str, score: str | None = None,
                       labels: list | None = None) -> dict[str, DataFrame]:
    """Report, confusion matrix, ROC and PR curves (on ``score`` when given, else on the
    hard predictions) and the two headline scores, computed on the hard predictions."""
    hard = M.curve_base(df, y_true, y_pred)          # one running-total pass per score column
    soft = M.curve_base(df, y_true, score) if score else hard
    auc = M.auc_from(hard).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc_pct").alias("value"))
    ap = M.ap_from(hard).select(F.lit("average_precision").alias("metric"),
                                F.col("average_precision_pct").alias("value"))
    return {
        "report": M.classification_report(df, y_true, y_pred),
        "confusion": M.confusion_matrix(df, y_true, y_pred, labels),
        "roc": M.roc_from(soft),
        "pr": M.pr_from(soft),
        "scores": ap.unionByName(auc),
    }


def fit_and_report(spec, train: DataFrame, valid: DataFrame, feature_cols: list[str], label: str,
                   key: str = "row_id") -> dict[str, DataFrame]:
    """Fit on train, predict valid: the predictions, their report (or metrics), and what the model weighs.

    Classifiers give ``report`` and ``confusion``, regressors ``metrics``; tree
    models give ``importances``, linear ones ``coefficients``.
    """
    from ferret.operators import models as Mo
    fm = Mo.fit_model(spec, train, feature_cols, label)
    pred = Mo.predict(fm, valid, key).join(valid.select(key, label), key)
    out = {"predictions": pred}
    if spec.problem == "classification":
        out |= {"report": M.classification_report(pred, label, "prediction"),
                "confusion": M.confusion_matrix(pred, label, "prediction")}
    else:
        out["metrics"] = M.regression_metrics(pred, label, "prediction")
    last = fm.model.stages[-1] if fm.model is not None else None
    if hasattr(last, "featureImportances"):
        out["importances"] = Mo.feature_importances(fm)
    elif (hasattr(last, "coefficients") and len(fm.model.stages) == 2) or (fm.svc is not None and len(fm.svc.weights) == 1):
        out["coefficients"] = Mo.coefficients(fm)
    return out


def regression_viz(df: DataFrame, y_true: str, y_pred: str, key: str = "row_id",
                   coefficients: DataFrame | None = None, k: int = 15) -> dict[str, DataFrame]:
    """Residual tables, PP and QQ points of the residuals, top coefficients and metrics."""
    res = M.residuals(df, y_true, y_pred, key)
    out = {
        "residuals": res,
        "pp": M.pp_plot(res, "residual", key),
        "qq": M.qq_plot(res, "residual", key),
        "metrics": M.regression_metrics(df, y_true, y_pred),
    }
    if coefficients is not None:
        out["top_coefficients"] = coefficients.orderBy(F.abs("coefficient").desc(), "feature").limit(k)
    return out
