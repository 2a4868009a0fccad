"""All reports of a cleaning run in one call: a dict of DataFrames, the data behind the report pages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ferret.operators import metrics as M
from ferret.operators import normality as N
from ferret.operators import nullity as Nu
from ferret.operators import profile as P
from ferret.operators.columns import nan_to_null


def profile(tables: dict, key: str | None = None, predictions: DataFrame | None = None) -> dict[str, DataFrame]:
    """Reports of ``tables`` (what ``CleaningPlan.run`` returns: the stages and the model).

    Reports that exist per stage carry the stage in their name. ``predictions``
    (identifier, y_true, y_pred) adds the evaluation of each model.
    """
    model = tables["model"]
    key = key or model.key
    raw = nan_to_null(tables["untransformed"])
    features = [c for c in raw.columns if c not in (key, model.target, "split")]
    numeric = [c for c in model.numeric if c in raw.columns]
    categoric = [c for c in model.categoric if c in raw.columns]
    out = {
        "nan_report": Nu.nan_report(raw, features),
        "nullity_bar": Nu.nullity_bar(raw, features),
        "nullity_matrix": Nu.nullity_matrix(raw, features),
        "nullity_correlation": Nu.nullity_correlation(raw, features),
        "nullity_linkage": Nu.nullity_linkage(raw, features),
        "target_distribution": P.target_distribution(raw, model.target, model.problem),
    }
    if numeric:
        out |= {"skew_report": P.skew_report(raw, numeric), "histogram": P.histogram(raw, numeric), "box_stats": P.box_stats(raw, numeric)}
        for stage in ("untransformed", "imputed", "transformed"):
            t = nan_to_null(tables[stage])
            ranked = N.ranked_long(t, numeric, key)  # one ranking for both reports
            points, fit = N.probability_plot(t, numeric, key, ranked)
            out |= {f"correlation_{stage}": P.correlation_matrix(t, numeric, stage),
                    f"normality_{stage}": N.normality_test(t, numeric, key, ranked=ranked),
                    f"probability_points_{stage}": points, f"probability_fit_{stage}": fit}
    if categoric:
        out["category_counts"] = P.category_counts(raw, categoric)
        out["category_target_rate"] = P.category_target_rate(raw, categoric, model.target)
    if predictions is not None:
        out["scores"] = M.leaderboard(predictions, "y_true", "y_pred", model.problem)
    return out
