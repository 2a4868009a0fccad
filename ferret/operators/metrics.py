"""Evaluation operators over any (y_true, y_pred[, score]) table, optionally per model.

Curve operators first collapse rows to one row per (model, distinct score)
with positive/negative counts (map-side partial aggregation, so a hot score is
one row per task), then take exact running totals with ``running_totals`` -
range partitioning instead of a single-task window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferret.functions.normal import norm_cdf, with_norm_ppf
from ferret.operators.rank import global_rank, running_totals


def _g(group: str | None) -> list[str]:
    return [group] if group else []


# ----------------------------------------------------------------------------
# confusion matrix / report
# ----------------------------------------------------------------------------


def _comparable(df: DataFrame, y_true: str, y_pred: str) -> tuple[Column, Column]:
    """Both columns in one type: their own when they agree, double when both are numbers, else string.

    A model predicts doubles for integer labels, so 1 and 1.0 must be one label.
    """
    types = [df.schema[c].dataType for c in (y_true, y_pred)]
    if types[0] == types[1]:
        to = types[0]
    elif all(isinstance(t, (T.NumericType, T.BooleanType)) for t in types):
        to = T.DoubleType()
    else:
        to = T.StringType()

    def cast(c, t):
        x = F.col(c).cast("int") if isinstance(t, T.BooleanType) and to != t else F.col(c)
        x = x.cast(to)
        return F.nanvl(x, F.lit(None).cast(to)) if isinstance(to, (T.FloatType, T.DoubleType)) else x

    return cast(y_true, types[0]), cast(y_pred, types[1])


def _label_text(x: Column, dtype: str) -> Column:
    """Labels as text; a whole double prints as the integer it equals."""
    if dtype in ("double", "float"):
        whole = (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))
        return F.when(whole, x.cast("bigint").cast("string")).otherwise(x.cast("string"))
    return x.cast("string")


def confusion_matrix(df: DataFrame, y_true: str, y_pred: str, labels: list | None = None) -> DataFrame:
    """(actual, predicted, count) for every pair of labels, zero-filled.

    Counts are one distributed group-by; the k x k frame is made from the k
    labels that occur (or are given).  A missing label or prediction is a cell of
    its own, with NULL on that side, when it occurs.
    """
    a, p = _comparable(df, y_true, y_pred)
    pairs = df.select(a.alias("actual"), p.alias("predicted"))
    counts = pairs.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("count"))
    dtype = dict(counts.dtypes)["actual"]
    if labels is None:
        # the result has k * k rows, so the k labels themselves are the small part
        found = counts.select(F.explode(F.array("actual", "predicted")).alias("l")).where(F.col("l").isNotNull())
        labels = [r["l"] for r in found.distinct().collect()]
    if dtype in ("double", "float"):
        labels = [float(x) for x in labels]
    each = df.sparkSession.createDataFrame([(x,) for x in labels], f"a {dtype}")
    grid = each.select("a", F.explode(F.array(*[F.lit(x).cast(dtype) for x in labels]).cast(f"array<{dtype}>")).alias("p"))
    known = (grid.join(counts, (F.col("a") == F.col("actual")) & (F.col("p") == F.col("predicted")), "left")
             .select(F.col("a").alias("actual"), F.col("p").alias("predicted"),
                     F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))
    missing = counts.where(F.col("actual").isNull() | F.col("predicted").isNull())
    return known.unionByName(missing.select("actual", "predicted", F.col("count").cast("bigint")))


def classification_report(df: DataFrame, y_true: str, y_pred: str, digits: int = 2) -> DataFrame:
    """(label, precision, recall, f1_score, support) per class, then rows 'accuracy',
    'macro avg' and 'weighted avg' (accuracy in f1_score, as the text report prints it).

    Rows without a label are left out; a missing prediction of a labelled row counts as wrong.
    """
    a, b = _comparable(df, y_true, y_pred)
    both = df.select(a.alias("t"), b.alias("p")).where(F.col("t").isNotNull())
    dtype = dict(both.dtypes)["t"]
    c = both.select(_label_text(F.col("t"), dtype).alias("t"), _label_text(F.col("p"), dtype).alias("p")).groupBy("t", "p").agg(
        F.count(F.lit(1)).alias("n"))
    tp = c.where("t = p").groupBy(F.col("t").alias("label")).agg(F.sum("n").alias("tp"))
    sup = c.groupBy(F.col("t").alias("label")).agg(F.sum("n").alias("support"))
    pred = c.where(F.col("p").isNotNull()).groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("pred"))
    per = (sup.join(pred, "label", "full").join(tp, "label", "left")
           .select("label", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("tp", "support", "pred")]))
    prec = F.when(F.col("pred") > 0, F.col("tp") / F.col("pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    per = per.select("label", prec.alias("precision"), rec.alias("recall"), "support")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    per = per.select("label", "precision", "recall", f1.alias("f1_score"), "support")
    acc = c.agg((F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")).alias("a"),
                F.sum("n").alias("n"))
    macro = per.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1_score").alias("f1_score"),
                    F.sum("support").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("label"),
        F.sum(F.col("precision") * F.col("support")) / F.sum("support"),
        F.sum(F.col("recall") * F.col("support")) / F.sum("support"),
        F.sum(F.col("f1_score") * F.col("support")) / F.sum("support"),
        F.sum("support")).toDF("label", "precision", "recall", "f1_score", "support")
    accuracy = acc.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                          F.lit(None).cast("double").alias("recall"), F.col("a").alias("f1_score"),
                          F.col("n").alias("support"))
    out = per.unionByName(accuracy).unionByName(macro).unionByName(weighted)
    return out.select("label", *[F.round(x, digits).alias(x) for x in ("precision", "recall", "f1_score")],
                      F.col("support").cast("bigint").alias("support"))


# ----------------------------------------------------------------------------
# score curves
# ----------------------------------------------------------------------------


def _score_counts(df: DataFrame, y_true: str, score: str, group: str | None, pos_label=1) -> DataFrame:
    pos = (F.col(y_true) == F.lit(pos_label)).cast("long")
    return df.groupBy(*_g(group), F.col(score).cast("double").alias("threshold")).agg(
        F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))


def _curve_base(df: DataFrame, y_true: str, score: str, group: str | None, pos_label=1) -> DataFrame:
    """Per (group, distinct score, descending): pos, neg, cum_pos, cum_neg (scores >= s), P, N."""
    if group is None:
        df = df.withColumn("_grp", F.lit(0))
        gname = "_grp"
    else:
        gname = group
    sc = _score_counts(df, y_true, score, gname, pos_label)
    cum = running_totals(sc, [F.col(gname), F.col("threshold").desc()], ["pos", "neg"])
    # running totals are global over (group, score): subtract each group's start,
    # itself a running total over one row per group
    totals = sc.groupBy(gname).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    st = running_totals(totals, [F.col(gname)], ["P", "N"]).select(
        gname, (F.col("cum_P") - F.col("P")).alias("_sp"), (F.col("cum_N") - F.col("N")).alias("_sn"), "P", "N")
    cum = cum.join(st, gname).select(
        *_g(group), "threshold", "pos", "neg", (F.col("cum_pos") - F.col("_sp")).alias("cum_pos"),
        (F.col("cum_neg") - F.col("_sn")).alias("cum_neg"), "P", "N")
    return cum


def curve_base(df: DataFrame, y_true: str, score: str, group: str | None = None, pos_label=1) -> DataFrame:
    """The shared input of every curve metric (compute once, derive several reports)."""
    return _curve_base(df, y_true, score, group, pos_label)


def roc_from(base: DataFrame, group: str | None = None) -> DataFrame:
    pts = base.select(*_g(group), F.try_divide(F.col("cum_neg"), F.col("N")).alias("fpr"),
                      F.try_divide(F.col("cum_pos"), F.col("P")).alias("tpr"), "threshold")
    start = base.groupBy(*_g(group)).agg(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                                         F.lit(float("inf")).alias("threshold"))
    return pts.unionByName(start).select(*_g(group), *[F.round(c, 6).alias(c) for c in ("fpr", "tpr")],
                                         "threshold")


def pr_from(base: DataFrame, group: str | None = None) -> DataFrame:
    kept = base.where(F.col("cum_pos") - F.col("pos") < F.col("P"))
    pts = kept.select(*_g(group), (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                      F.try_divide(F.col("cum_pos"), F.col("P")).alias("recall"), "threshold")
    end = base.groupBy(*_g(group)).agg(F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
                                       F.lit(None).cast("double").alias("threshold"))
    return pts.unionByName(end).select(*_g(group), *[F.round(c, 6).alias(c) for c in ("precision", "recall")],
                                       "threshold")


def auc_from(base: DataFrame, group: str | None = None) -> DataFrame:
    term = F.col("pos") * (F.col("N") - F.col("cum_neg") + 0.5 * F.col("neg"))
    auc = base.groupBy(*_g(group)).agg(F.try_divide(F.sum(term), F.first("P") * F.first("N")).alias("auc"))
    return auc.select(*_g(group), F.round("auc", 6).alias("roc_auc"),
                      F.round(F.col("auc") * 100, 2).alias("roc_auc_pct"))


def ap_from(base: DataFrame, group: str | None = None) -> DataFrame:
    term = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    ap = base.groupBy(*_g(group)).agg(F.try_divide(F.sum(term), F.first("P")).alias("ap"))
    return ap.select(*_g(group), F.round("ap", 6).alias("average_precision"),
                     F.round(F.col("ap") * 100, 2).alias("average_precision_pct"))


def roc_curve(df: DataFrame, y_true: str, score: str, group: str | None = None, pos_label=1) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, plus the (0, 0, +inf) start."""
    return roc_from(_curve_base(df, y_true, score, group, pos_label), group)


def pr_curve(df: DataFrame, y_true: str, score: str, group: str | None = None, pos_label=1) -> DataFrame:
    """(precision, recall, threshold) from the highest score down to the first full-recall
    threshold, plus the (1, 0, NULL) end point."""
    return pr_from(_curve_base(df, y_true, score, group, pos_label), group)


def roc_auc(df: DataFrame, y_true: str, score: str, group: str | None = None, pos_label=1) -> DataFrame:
    """Exact area under ROC (rank-sum with average ranks for ties); also as % rounded to 2."""
    return auc_from(_curve_base(df, y_true, score, group, pos_label), group)


def average_precision(df: DataFrame, y_true: str, score: str, group: str | None = None,
                      pos_label=1) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_{n-1}) * P_n; also as % rounded to 2."""
    return ap_from(_curve_base(df, y_true, score, group, pos_label), group)


# ----------------------------------------------------------------------------
# regression
# ----------------------------------------------------------------------------


def regression_metrics(df: DataFrame, y_true: str, y_pred: str, group: str | None = None,
                       digits: int = 2) -> DataFrame:
    """explained variance, R^2, MSE (one aggregate; per model when grouped)."""
    y, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    r = y - p
    agg = df.groupBy(*_g(group)).agg(
        F.var_pop(r).alias("vr"), F.var_pop(y).alias("vy"), F.avg(r * r).alias("mse"),
        F.count(y).alias("n"))
    ev = F.when(F.col("vy") > 0, 1 - F.col("vr") / F.col("vy"))
    r2 = F.when(F.col("vy") > 0, 1 - F.col("mse") / F.col("vy"))
    return agg.select(*_g(group), F.round(ev, digits).alias("explained_variance"),
                      F.round(r2, digits).alias("r2"), F.round("mse", digits).alias("mse"))


def residuals(df: DataFrame, y_true: str, y_pred: str, key: str = "row_id") -> DataFrame:
    """(key, y_true, y_pred, residual = pred - true): against predicted and against target."""
    return df.select(key, y_true, y_pred, (F.col(y_pred) - F.col(y_true)).alias("residual"))


def pp_plot(df: DataFrame, col: str, key: str) -> DataFrame:
    """(i, theoretical = i/(n+1), sample = Phi(x_(i))) over the sorted values."""
    ranked = _ranked(df, col, key)
    n = ranked.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    return ranked.select("i", F.round(F.col("i") / F.lit(n + 1.0), 6).alias("theoretical"),
                         F.round(norm_cdf(col), 6).alias("sample"))


def qq_plot(df: DataFrame, col: str, key: str) -> DataFrame:
    """(i, theoretical = Phi^-1(i/(n+1)), sample = x_(i))."""
    ranked = _ranked(df, col, key)
    n = ranked.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    q = with_norm_ppf(ranked.withColumn("_p", F.col("i") / F.lit(n + 1.0)), "_p", "_t")
    return q.select("i", F.round("_t", 6).alias("theoretical"), F.round(col, 6).alias("sample"))


def _ranked(df: DataFrame, col: str, key: str) -> DataFrame:
    base = df.select(key, F.col(col).cast("double").alias(col)).where(F.col(col).isNotNull())
    return global_rank(base, [F.col(col)], [key], rank_col="i")


# ----------------------------------------------------------------------------
# scores
# ----------------------------------------------------------------------------


def accuracy(y_true: str, y_pred: str) -> Column:
    return F.avg((F.col(y_true).cast("double") == F.col(y_pred).cast("double")).cast("double"))


def r2_score(y_true: str, y_pred: str) -> Column:
    y, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    return 1 - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))


def score_model(df: DataFrame, y_true: str, y_pred: str, problem: str, group: str | None = None) -> DataFrame:
    """accuracy (classification) / R^2 (regression) per model."""
    s = accuracy(y_true, y_pred) if problem == "classification" else r2_score(y_true, y_pred)
    return df.groupBy(*_g(group)).agg(F.round(s, 6).alias("score"))


def leaderboard(df: DataFrame, y_true: str, y_pred: str, problem: str, group: str = "identifier") -> DataFrame:
    """All models ranked by score, with their headline metrics, from one group-by."""
    if problem == "classification":
        y, p = F.col(y_true), F.col(y_pred)
        tp = F.sum(((y == 1) & (p == 1)).cast("long"))
        prec = F.try_divide(tp, F.sum((p == 1).cast("long")))
        rec = F.try_divide(tp, F.sum((y == 1).cast("long")))
        agg = df.groupBy(group).agg(accuracy(y_true, y_pred).alias("score"), prec.alias("precision"),
                                    rec.alias("recall"), F.count(F.lit(1)).alias("n"))
        cols = ["score", "precision", "recall"]
    else:
        yy, pp = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
        agg = df.groupBy(group).agg(r2_score(y_true, y_pred).alias("score"),
                                    F.avg((yy - pp) * (yy - pp)).alias("mse"),
                                    F.avg(F.abs(yy - pp)).alias("mae"), F.count(F.lit(1)).alias("n"))
        cols = ["score", "mse", "mae"]
    return agg.select(group, *[F.round(c, 6).alias(c) for c in cols], "n").orderBy(F.desc("score"), group)
