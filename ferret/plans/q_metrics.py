"""Queries: classification / regression evaluation, normality and probability plots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.functions.normal import norm_cdf_sql, norm_ppf_sql, norm_ppf_steps_sql
from ferret.operators import metrics as M
from ferret.operators import normality as N
from ferret.plans import frames
from ferret.plans.oracle import with_frame
from ferret.plans.registry import query

S = "scored"
SM = "scored_many"



def _curve(frame, group=None, score="score"):
    """DuckDB: per-(group, distinct score) counts and cumulative counts (scores descending)."""
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}, threshold" if group else "GROUP BY threshold"
    part = f"PARTITION BY {group} " if group else ""
    return with_frame("", frame).rstrip() + f""",
sc AS (SELECT {gsel}CAST({score} AS DOUBLE) AS threshold, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos,
              sum(CASE WHEN y_true = 1 THEN 0 ELSE 1 END) AS neg FROM f {gby}),
cu AS (SELECT *, sum(pos) OVER ({part}ORDER BY threshold DESC) AS cum_pos,
              sum(neg) OVER ({part}ORDER BY threshold DESC) AS cum_neg,
              sum(pos) OVER ({part.strip()}) AS P, sum(neg) OVER ({part.strip()}) AS N FROM sc)
"""


@query("confusion_matrix", with_frame("""
SELECT a.l AS actual, p.l AS predicted, count(f.y_true) AS count
FROM (SELECT DISTINCT l FROM (SELECT y_true AS l FROM f UNION SELECT y_pred FROM f)) a
CROSS JOIN (SELECT DISTINCT l FROM (SELECT y_true AS l FROM f UNION SELECT y_pred FROM f)) p
LEFT JOIN f ON f.y_true = a.l AND f.y_pred = p.l
GROUP BY 1, 2""", S))
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(frames.scored(spark, sf), "y_true", "y_pred")


_REPORT_SQL = with_frame("", S).rstrip() + """,
c AS (SELECT CAST(y_true AS VARCHAR) AS t, CAST(y_pred AS VARCHAR) AS p, count(*) AS n FROM f GROUP BY 1, 2),
lab AS (SELECT t AS label FROM c UNION SELECT p FROM c),
per AS (SELECT label,
   coalesce((SELECT sum(n) FROM c WHERE t = label AND p = label), 0) AS tp,
   coalesce((SELECT sum(n) FROM c WHERE t = label), 0) AS support,
   coalesce((SELECT sum(n) FROM c WHERE p = label), 0) AS pred FROM lab),
pr AS (SELECT label, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0e0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0e0 END AS recall, support FROM per),
pf AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0
              THEN 2 * precision * recall / (precision + recall) ELSE 0.0e0 END AS f1_score, support FROM pr)
SELECT label, round(precision, 2) AS precision, round(recall, 2) AS recall, round(f1_score, 2) AS f1_score,
       CAST(support AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(CASE WHEN t = p THEN n ELSE 0 END) / sum(n), 2),
       CAST(sum(n) AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', round(avg(precision), 2), round(avg(recall), 2), round(avg(f1_score), 2),
       CAST(sum(support) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 2),
       round(sum(recall * support) / sum(support), 2), round(sum(f1_score * support) / sum(support), 2),
       CAST(sum(support) AS BIGINT) FROM pf"""


@query("classification_report", _REPORT_SQL)
def q_classification_report(spark, sf):
    return M.classification_report(frames.scored(spark, sf), "y_true", "y_pred")


@query("roc_curve", _curve(S) + """
SELECT round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr, threshold FROM cu
UNION ALL SELECT 0.0, 0.0, CAST('inf' AS DOUBLE)""")
def q_roc_curve(spark, sf):
    return M.roc_curve(frames.scored(spark, sf), "y_true", "score")


@query("roc_curve_by_model", _curve(SM, "identifier") + """
SELECT identifier, round(cum_neg / N, 6) AS fpr, round(cum_pos / P, 6) AS tpr, threshold FROM cu
UNION ALL SELECT DISTINCT identifier, 0.0, 0.0, CAST('inf' AS DOUBLE) FROM f""")
def q_roc_curve_by_model(spark, sf):
    return M.roc_curve(frames.scored_many(spark, sf), "y_true", "score", group="identifier")


@query("pr_curve", _curve(S) + """
SELECT round(cum_pos / (cum_pos + cum_neg), 6) AS precision, round(cum_pos / P, 6) AS recall, threshold
FROM cu WHERE cum_pos - pos < P
UNION ALL SELECT 1.0, 0.0, NULL""")
def q_pr_curve(spark, sf):
    return M.pr_curve(frames.scored(spark, sf), "y_true", "score")


@query("roc_auc", _curve(S) + """
SELECT round(s / (P * N), 6) AS roc_auc, round(s / (P * N) * 100, 2) AS roc_auc_pct
FROM (SELECT sum(pos * (N - cum_neg + 0.5e0 * neg)) AS s, max(P) AS P, max(N) AS N FROM cu) t""")
def q_roc_auc(spark, sf):
    return M.roc_auc(frames.scored(spark, sf), "y_true", "score")


@query("roc_auc_by_model", _curve(SM, "identifier") + """
SELECT identifier, round(s / (P * N), 6) AS roc_auc, round(s / (P * N) * 100, 2) AS roc_auc_pct
FROM (SELECT identifier, sum(pos * (N - cum_neg + 0.5e0 * neg)) AS s, max(P) AS P, max(N) AS N
      FROM cu GROUP BY identifier) t""")
def q_roc_auc_by_model(spark, sf):
    return M.roc_auc(frames.scored_many(spark, sf), "y_true", "score", group="identifier")


@query("roc_auc_hard_labels", _curve(S, score="y_pred") + """
SELECT round(s / (P * N), 6) AS roc_auc, round(s / (P * N) * 100, 2) AS roc_auc_pct
FROM (SELECT sum(pos * (N - cum_neg + 0.5e0 * neg)) AS s, max(P) AS P, max(N) AS N FROM cu) t""")
def q_roc_auc_hard_labels(spark, sf):
    """The headline score of the classification bundle: AUC of the hard predictions."""
    return M.roc_auc(frames.scored(spark, sf), "y_true", "y_pred")


@query("average_precision", _curve(S) + """
SELECT round(s / P, 6) AS average_precision, round(s / P * 100, 2) AS average_precision_pct
FROM (SELECT sum(pos * cum_pos / (cum_pos + cum_neg)) AS s, max(P) AS P FROM cu) t""")
def q_average_precision(spark, sf):
    return M.average_precision(frames.scored(spark, sf), "y_true", "score")


@query("average_precision_by_model", _curve(SM, "identifier") + """
SELECT identifier, round(s / P, 6) AS average_precision, round(s / P * 100, 2) AS average_precision_pct
FROM (SELECT identifier, sum(pos * cum_pos / (cum_pos + cum_neg)) AS s, max(P) AS P FROM cu GROUP BY 1) t""")
def q_average_precision_by_model(spark, sf):
    return M.average_precision(frames.scored_many(spark, sf), "y_true", "score", group="identifier")


RP = "regression_pairs"


@query("regression_metrics", with_frame("""
SELECT round(1 - var_pop(y_pred - y_true) / var_pop(y_true), 2) AS explained_variance,
       round(1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true), 2) AS r2,
       round(avg((y_true - y_pred) * (y_true - y_pred)), 2) AS mse FROM f""", RP))
def q_regression_metrics(spark, sf):
    return M.regression_metrics(frames.regression_pairs(spark, sf), "y_true", "y_pred")


@query("residuals", with_frame("SELECT row_id, y_true, y_pred, y_pred - y_true AS residual FROM f", RP))
def q_residuals(spark, sf):
    return M.residuals(frames.regression_pairs(spark, sf), "y_true", "y_pred")


_RANKED_RES = with_frame("", RP).rstrip() + """,
r AS (SELECT row_id, y_pred - y_true AS x FROM f WHERE y_pred - y_true IS NOT NULL),
k AS (SELECT x, row_number() OVER (ORDER BY x, row_id) AS i, count(*) OVER () AS n FROM r)
"""


@query("pp_plot", _RANKED_RES + f"""SELECT i, round(i / (n + 1.0e0), 6) AS theoretical,
 round({norm_cdf_sql('x')}, 6) AS sample FROM k""")
def q_pp_plot(spark, sf):
    res = M.residuals(frames.regression_pairs(spark, sf), "y_true", "y_pred")
    return M.pp_plot(res, "residual", "row_id")


@query("qq_plot", _RANKED_RES + f"""SELECT i, round({norm_ppf_sql('(i / (n + 1.0e0))')}, 6) AS theoretical,
 round(x, 6) AS sample FROM k""")
def q_qq_plot(spark, sf):
    res = M.residuals(frames.regression_pairs(spark, sf), "y_true", "y_pred")
    return M.qq_plot(res, "residual", "row_id")


@query("score_model", with_frame("""SELECT identifier,
 round(avg(CASE WHEN CAST(y_true AS DOUBLE) = CAST(y_pred AS DOUBLE) THEN 1.0e0 ELSE 0.0e0 END), 6) AS score
 FROM f GROUP BY 1""", SM))
def q_score_model(spark, sf):
    return M.score_model(frames.scored_many(spark, sf), "y_true", "y_pred", "classification", "identifier")


@query("leaderboard", with_frame("""SELECT identifier,
 round(avg(CASE WHEN y_true = y_pred THEN 1.0e0 ELSE 0.0e0 END), 6) AS score,
 round(sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN y_pred = 1 THEN 1 ELSE 0 END), 0), 6) AS precision,
 round(sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END), 0), 6) AS recall,
 count(*) AS n FROM f GROUP BY 1""", SM))
def q_leaderboard(spark, sf):
    return M.leaderboard(frames.scored_many(spark, sf), "y_true", "y_pred", "classification")


# --- normality / probability plots on events.value and orders numerics -----------------
_RK_EVENTS = """WITH k AS (SELECT value AS x, row_number() OVER (ORDER BY value, event_id) AS i,
 count(*) OVER () AS n FROM events WHERE value IS NOT NULL),
v AS (SELECT *, CASE WHEN i = n THEN pow(0.5e0, 1.0e0 / n) WHEN i = 1 THEN 1 - pow(0.5e0, 1.0e0 / n)
 ELSE (i - 0.3175e0) / (n + 0.365e0) END AS pv FROM k),
q AS (SELECT i, x, """ + norm_ppf_sql("pv") + """ AS osm FROM v)
"""


@query("probability_plot", _RK_EVENTS + "SELECT 'value' AS feature, i, round(osm, 6) AS osm, round(x, 6) AS osr FROM q")
def q_probability_plot(spark, sf):
    pts, _ = N.probability_plot(frames.skewed(spark, sf), ["value"], "event_id")
    return pts


@query("probability_plot_fit", _RK_EVENTS + """SELECT 'value' AS feature, round(regr_slope(x, osm), 6) AS slope,
 round(regr_intercept(x, osm), 6) AS intercept, round(corr(osm, x), 6) AS r FROM q""")
def q_probability_plot_fit(spark, sf):
    _, fit = N.probability_plot(frames.skewed(spark, sf), ["value"], "event_id")
    return fit


def _poly_sql(coefs, x):
    return " + ".join(f"({c!r}e0) * pow({x}, {i})" for i, c in enumerate(coefs))


def sw_sql(src: str, col: str, key: str, feature: str) -> str:
    """Shapiro-Wilk W and p of one column, as DuckDB SQL (same formulas as the operator)."""
    return f"""SELECT * FROM (WITH k AS MATERIALIZED (SELECT CAST({col} AS DOUBLE) AS x, row_number() OVER (ORDER BY {col}, {key}) AS i,
  count(*) OVER () AS n FROM {src} WHERE {col} IS NOT NULL),
kp AS (SELECT *, (i - 0.375e0) / (n + 0.25e0) AS p FROM k),
{norm_ppf_steps_sql('kp', {'p': 'm'}, 'm')},
s0 AS (SELECT max(n) AS n, sum(m * m) AS ssm, var_pop(x) * count(x) AS ss,
  (max(n) - 0.375e0) / (max(n) + 0.25e0) AS pn, (max(n) - 1 - 0.375e0) / (max(n) + 0.25e0) AS pn1 FROM m),
{norm_ppf_steps_sql('s0', {'pn': 'mn', 'pn1': 'mn1'}, 's')},
c AS (SELECT *, mn / sqrt(ssm) + {_poly_sql(N.SW_C1, '1.0e0 / sqrt(n)')} AS an,
  mn1 / sqrt(ssm) + {_poly_sql(N.SW_C2, '1.0e0 / sqrt(n)')} AS an1 FROM s),
e AS (SELECT *, (ssm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * an * an - 2 * an1 * an1) AS eps FROM c),
w AS (SELECT e.n, e.ss, least(1.0e0, pow(sum(CASE WHEN m.i = e.n THEN e.an WHEN m.i = 1 THEN -e.an
  WHEN m.i = e.n - 1 THEN e.an1 WHEN m.i = 2 THEN -e.an1 ELSE m.m / sqrt(e.eps) END * m.x), 2) / e.ss) AS w
  FROM m CROSS JOIN e GROUP BY e.n, e.ss),
z AS (SELECT n, w, (ln(1 - w) - ({_poly_sql(N.SW_LARGE_MU, 'ln(n)')})) / exp({_poly_sql(N.SW_LARGE_SIGMA, 'ln(n)')}) AS zz FROM w)
SELECT '{feature}' AS feature, n, round(w, 6) AS w, round(pv, 6) AS p_value,
  pv > 0.05 AS normal, n <= 5000 AS p_exact FROM (SELECT *, 1 - {norm_cdf_sql('zz')} AS pv FROM z) zp) t"""


_SW_SQL = sw_sql("events", "value", "event_id", "value")


def _sw_round(df):
    return df.select("feature", "n", F.round("w", 6).alias("w"), F.round("p_value", 6).alias("p_value"),
                     "normal", "p_exact")


@query("normality_test_events", _SW_SQL)
def q_normality_test_events(spark, sf):
    return _sw_round(N.normality_test(frames.skewed(spark, sf), ["value"], "event_id"))


_VIZ_SQL = _curve(S, score="y_pred") + """
SELECT 'average_precision' AS metric, round(sum(pos * cum_pos / (cum_pos + cum_neg)) / max(P) * 100, 2) AS value
FROM cu
UNION ALL
SELECT 'roc_auc', round(sum(pos * (N - cum_neg + 0.5e0 * neg)) / (max(P) * max(N)) * 100, 2) FROM cu"""


@query("classification_viz", _VIZ_SQL)
def q_classification_viz(spark, sf):
    """Bundle: the headline scores of the classification report (hard labels), long form."""
    from ferret.plans.bundles import classification_viz
    b = classification_viz(frames.scored(spark, sf), "y_true", "y_pred", "score")
    return b["scores"]


@query("regression_viz", with_frame("""
SELECT round(1 - var_pop(y_pred - y_true) / var_pop(y_true), 2) AS explained_variance,
       round(1 - avg((y_true - y_pred) * (y_true - y_pred)) / var_pop(y_true), 2) AS r2,
       round(avg((y_true - y_pred) * (y_true - y_pred)), 2) AS mse FROM f""", RP))
def q_regression_viz(spark, sf):
    from ferret.plans.bundles import regression_viz
    b = regression_viz(frames.regression_pairs(spark, sf), "y_true", "y_pred", "row_id")
    return b["metrics"]


@query("normality_test", with_frame("", "orders").rstrip() + "\n" + "\nUNION ALL\n".join(
    sw_sql("f", c, "row_id", c) for c in ("price", "acctbal", "bucket")))
def q_normality_test(spark, sf):
    f = frames.orders_frame(spark, sf)
    return _sw_round(N.normality_test(f, ["price", "acctbal", "bucket"], "row_id"))


def _stage_sql(stage: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{stage}' AS stage, * FROM ({sw_sql('f', c, 'row_id', c)}) s_{c}" for c in ("price", "acctbal"))


@query("normality_untransformed", with_frame("", "orders").rstrip() + "\n" + _stage_sql("untransformed"))
def q_normality_untransformed(spark, sf):
    """Normality of one stage of the report: the columns as they came."""
    f = frames.orders_frame(spark, sf)
    return _sw_round(N.normality_test(f, ["price", "acctbal"], "row_id")).select(F.lit("untransformed").alias("stage"), "*")


@query("profile_run")
def q_profile_run(spark, sf):
    """Every report of a cleaning run, with its number of rows."""
    from ferret.plans.cleaning_plan import CleaningPlan
    from ferret.plans.profile_report import profile
    from ferret.sources.runs import RunStore
    tables = CleaningPlan(target="label", key="row_id", fixed_lambda=0.5).run(frames.orders_frame(spark, sf), RunStore(spark))
    counts = [df.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n_rows")) for name, df in profile(tables).items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
