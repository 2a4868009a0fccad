"""Queries: model registry, dummy / baseline models, the estimator zoo, importances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import metrics as M
from ferret.operators import models as Mo
from ferret.operators.split import hash32, hash32_sql
from ferret.plans.registry import query
from ferret.sources.runs import RunStore
from ferret.sources.tables import table

CUT = int(0.75 * (1 << 32))
FEATS = ["price_k", "acctbal_k", "nationkey"]

MODEL_INPUTS_SQL = f"""WITH f AS (
SELECT o.o_orderkey AS row_id, o.o_totalprice / 1000 AS price_k, c.c_acctbal / 1000 AS acctbal_k,
       c.c_nationkey AS nationkey,
       CASE WHEN o.o_totalprice + 20 * c.c_acctbal > 300000 THEN 1 ELSE 0 END AS sep,
       3 * o.o_totalprice / 1000 + 2 * c.c_acctbal / 1000 + c.c_nationkey AS y,
       {hash32_sql('o.o_orderkey', 42)} < {CUT} AS is_train
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
tr AS (SELECT * FROM f WHERE is_train), va AS (SELECT * FROM f WHERE NOT is_train)
"""


def model_inputs(spark, sf):
    """Un-nulled features of orders x customer, a separable class and an exact linear target."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("row_id"), (F.col("o_totalprice") / 1000).alias("price_k"),
        (F.col("c_acctbal") / 1000).alias("acctbal_k"), F.col("c_nationkey").alias("nationkey"),
        F.when(F.col("o_totalprice") + 20 * F.col("c_acctbal") > 300000, 1).otherwise(0).alias("sep"),
        (3 * F.col("o_totalprice") / 1000 + 2 * F.col("c_acctbal") / 1000 + F.col("c_nationkey")).alias("y"),
        (hash32("o_orderkey", 42) < F.lit(CUT)).alias("is_train"))


def _split(spark, sf):
    d = model_inputs(spark, sf)
    return d.where("is_train"), d.where("NOT is_train")


def _registry_sql(problems=("classification", "regression"), columns="identifier, problem, model_type, params") -> str:
    """The registry rows as SQL text: fixed parameters literally, 1/n from the train count."""
    sentinel = 7  # 1/7 appears in no fixed parameter, so it marks where 1/n goes
    mark = repr(1.0 / sentinel)
    parts = []
    for problem in problems:
        for sp in Mo.default_specs(problem, sentinel):
            ident, _, mtype, params = sp.row()
            js = "{" + ",".join(f'"{k}":"{v}"' for k, v in sorted(params.items())) + "}"

            def lit(text):
                return "'" + text.replace(mark, "' || CAST(1.0e0 / n AS VARCHAR) || '") + "'"
            parts.append(f"SELECT {lit(ident)} AS identifier, '{problem}' AS problem, '{mtype}' AS model_type, "
                         f"{lit(js)} AS params FROM nn")
    rows = "\nUNION ALL ".join(parts)
    return MODEL_INPUTS_SQL + f", nn AS (SELECT count(*) AS n FROM tr)\nSELECT {columns} FROM ({rows}) r"


@query("model_registry", _registry_sql())
def q_model_registry(spark, sf):
    tr, _ = _split(spark, sf)
    n = tr.count()
    specs = Mo.default_specs("classification", n) + Mo.default_specs("regression", n)
    # map order is not insertion order: serialise with the keys sorted, so the text is stable
    ordered = F.map_from_entries(F.array_sort(F.map_entries("params")))
    return Mo.registry_table(spark, specs).select("identifier", "problem", "model_type",
                                                  F.to_json(ordered).alias("params"))


@query("list_models", _registry_sql(("regression",), "identifier"))
def q_list_models(spark, sf):
    tr, _ = _split(spark, sf)
    store = RunStore(spark)
    store.create_run_tables()
    specs = Mo.default_specs("regression", tr.count())
    store.upsert_model(Mo.registry_table(spark, specs).select("identifier", "model_type", "params"))
    return store.models().select("identifier")


@query("dummy_regressor", MODEL_INPUTS_SQL + """SELECT row_id, 'median' AS strategy,
 (SELECT median(y) FROM tr) AS prediction FROM va
 UNION ALL SELECT row_id, 'mean', (SELECT avg(y) FROM tr) FROM va""")
def q_dummy_regressor(spark, sf):
    tr, va = _split(spark, sf)
    out = None
    for strat in ("median", "mean"):
        fm = Mo.fit_model(Mo.ModelSpec(f"dummy_{strat}", "regression"), tr, FEATS, "y")
        p = Mo.predict(fm, va).select("row_id", F.lit(strat).alias("strategy"), "prediction")
        out = p if out is None else out.unionByName(p)
    return out


_U = f"CAST({hash32_sql('row_id', 43)} AS DOUBLE) / {float(1 << 32)}"


@query("dummy_classifier", MODEL_INPUTS_SQL + f""", pr AS (SELECT avg(CASE WHEN sep = 0 THEN 1.0e0 ELSE 0.0e0 END) AS p0,
 CASE WHEN sum(sep) > count(*) - sum(sep) THEN 1.0e0 ELSE 0.0e0 END AS mf FROM tr)
SELECT row_id, 'most_frequent' AS strategy, mf AS prediction FROM va, pr
UNION ALL SELECT row_id, 'stratified', CASE WHEN {_U} < p0 THEN 0.0e0 ELSE 1.0e0 END FROM va, pr
UNION ALL SELECT row_id, 'uniform', CASE WHEN floor({_U} * 2) = 0 THEN 0.0e0 ELSE 1.0e0 END FROM va""")
def q_dummy_classifier(spark, sf):
    tr, va = _split(spark, sf)
    out = None
    for strat in ("most_frequent", "stratified", "uniform"):
        fm = Mo.fit_model(Mo.ModelSpec(f"dummy_{strat}", "classification", {"seed": 42}), tr, FEATS, "sep")
        p = Mo.predict(fm, va).select("row_id", F.lit(strat).alias("strategy"), "prediction")
        out = p if out is None else out.unionByName(p)
    return out


@query("baseline_regression", MODEL_INPUTS_SQL + "SELECT row_id, (SELECT avg(y) FROM va) AS prediction FROM va")
def q_baseline_regression(spark, sf):
    _, va = _split(spark, sf)
    m = va.agg(F.avg("y")).collect()[0][0]
    return va.select("row_id", F.lit(m).alias("prediction"))


def _estimator_query(name: str, problem: str):
    label = "sep" if problem == "classification" else "y"

    def run(spark, sf):
        tr, va = _split(spark, sf)
        n = tr.count()
        spec = next(s for s in Mo.default_specs(problem, n, use_dummy_models=False) if s.name == name)
        fm = Mo.fit_model(spec, tr, FEATS, label)
        return Mo.predict(fm, va)
    return run


for _name in Mo.CLASSIFIERS:
    if _name not in ("ridge_classifier", "gaussian_nb", "linear_svc"):
        query(_name)(_estimator_query(_name, "classification"))
query("elastic_net")(_estimator_query("elastic_net", "regression"))
for _name in ["decision_tree", "random_forest", "gradient_boosting"]:
    query(_name + "_regressor")(_estimator_query(_name, "regression"))


@query("gradient_boosting_multiclass")
def q_gradient_boosting_multiclass(spark, sf):
    """Softmax boosting of a three-class label: predictions of the valid rows (20 rounds)."""
    tr, va = [d.withColumn("size", F.when(F.col("y") < 200, 0).when(F.col("y") < 500, 1).otherwise(2)) for d in _split(spark, sf)]
    spec = Mo.ModelSpec("gradient_boosting", "classification", {"maxIter": 20, "maxDepth": 3, "stepSize": 0.1})
    return Mo.predict(Mo.fit_model(spec, tr, FEATS, "size"), va)


def normal_eq_sql(lam: str, target: str = "y") -> str:
    """Least squares with an L2 penalty ``lam`` on the centred, population-scaled normal
    equations (Sxx + lam I) w = Sxy, solved by Cramer's rule; CTE ``coef`` holds the result."""
    return MODEL_INPUTS_SQL + f""", c AS (SELECT
  var_pop(price_k) + {lam} AS c11, covar_pop(price_k, acctbal_k) AS c12, covar_pop(price_k, nationkey) AS c13,
  var_pop(acctbal_k) + {lam} AS c22, covar_pop(acctbal_k, nationkey) AS c23, var_pop(nationkey) + {lam} AS c33,
  covar_pop(price_k, {target}) AS b1, covar_pop(acctbal_k, {target}) AS b2, covar_pop(nationkey, {target}) AS b3,
  avg(price_k) AS m1, avg(acctbal_k) AS m2, avg(nationkey) AS m3, avg({target}) AS my FROM tr),
d AS (SELECT *, c11 * (c22 * c33 - c23 * c23) - c12 * (c12 * c33 - c23 * c13) + c13 * (c12 * c23 - c22 * c13) AS det
      FROM c),
beta AS (SELECT *,
  (b1 * (c22 * c33 - c23 * c23) - c12 * (b2 * c33 - c23 * b3) + c13 * (b2 * c23 - c22 * b3)) / det AS w1,
  (c11 * (b2 * c33 - b3 * c23) - b1 * (c12 * c33 - c23 * c13) + c13 * (c12 * b3 - b2 * c13)) / det AS w2,
  (c11 * (c22 * b3 - c23 * b2) - c12 * (c12 * b3 - b2 * c13) + b1 * (c12 * c23 - c22 * c13)) / det AS w3 FROM d),
coef AS (SELECT 'price_k' AS feature, w1 AS coefficient FROM beta
  UNION ALL SELECT 'acctbal_k', w2 FROM beta UNION ALL SELECT 'nationkey', w3 FROM beta
  UNION ALL SELECT 'intercept', my - w1 * m1 - w2 * m2 - w3 * m3 FROM beta)
"""


OLS_SQL = normal_eq_sql("0.0e0")
# ridge with alpha = 1 on the summed squared error = 1/n on the averaged one
RIDGE_SQL = normal_eq_sql("1.0e0 / (SELECT count(*) FROM tr)")
PREDICT_SQL = """SELECT va.row_id,
 round((SELECT coefficient FROM coef WHERE feature = 'intercept')
       + price_k * (SELECT coefficient FROM coef WHERE feature = 'price_k')
       + acctbal_k * (SELECT coefficient FROM coef WHERE feature = 'acctbal_k')
       + nationkey * (SELECT coefficient FROM coef WHERE feature = 'nationkey'), 6) AS prediction,
 CAST(NULL AS DOUBLE) AS probability FROM va"""


@query("fit_model", OLS_SQL + "SELECT feature, round(coefficient, 6) AS coefficient FROM coef")
def q_fit_model(spark, sf):
    """Fit, store under the run folder, load back: coefficients of the stored OLS model."""
    tr, _ = _split(spark, sf)
    spec = Mo.ModelSpec("linear_regression", "regression", {"regParam": 0.0})
    fm = Mo.fit_model(spec, tr, FEATS, "y")
    store = RunStore(spark)
    Mo.save_model(fm, store.path("saved_models/linear_regression"))
    back = Mo.load_model(spec, store.path("saved_models/linear_regression"), FEATS, "y")
    return Mo.coefficients(back).select("feature", F.round("coefficient", 6).alias("coefficient"))


@query("predict_model")
def q_predict_model(spark, sf):
    tr, va = _split(spark, sf)
    spec = Mo.ModelSpec("logistic_regression", "classification", {"regParam": 1.0 / tr.count()})
    fm = Mo.fit_model(spec, tr, FEATS, "sep")
    store = RunStore(spark)
    Mo.save_model(fm, store.path("saved_models/logistic_regression"))
    back = Mo.load_model(spec, store.path("saved_models/logistic_regression"), FEATS, "sep")
    return Mo.predict(back, va)


@query("fit_many")
def q_fit_many(spark, sf):
    tr, va = _split(spark, sf)
    specs = Mo.default_specs("regression", tr.count())
    _, preds = Mo.fit_many(specs, tr, va, FEATS, "y")
    truth = va.select("row_id", "y")
    return M.leaderboard(preds.join(truth, "row_id"), "y", "prediction", "regression")


@query("feature_importances")
def q_feature_importances(spark, sf):
    tr, _ = _split(spark, sf)
    spec = next(s for s in Mo.default_specs("classification", tr.count()) if s.name == "random_forest")
    return Mo.feature_importances(Mo.fit_model(spec, tr, FEATS, "sep"))


@query("top_coefficients", OLS_SQL + """SELECT feature, round(coefficient, 6) AS coefficient FROM coef
 WHERE feature <> 'intercept' ORDER BY abs(coefficient) DESC, feature LIMIT 15""")
def q_top_coefficients(spark, sf):
    tr, _ = _split(spark, sf)
    spec = Mo.ModelSpec("linear_regression", "regression", {"regParam": 0.0})
    return Mo.top_coefficients(Mo.fit_model(spec, tr, FEATS, "y"), 15).select(
        "feature", F.round("coefficient", 6).alias("coefficient"))


@query("model_comparison")
def q_model_comparison(spark, sf):
    """The whole flow on the orders frame: clean, fit every default and dummy classifier, rank."""
    from ferret.plans import frames
    from ferret.plans.model_run import run_flow
    out = run_flow(frames.orders_frame(spark, sf), "classification", "label", "row_id", RunStore(spark))
    return out["leaderboard"]


@query("model_comparison_regression")
def q_model_comparison_regression(spark, sf):
    """Regression flow on the model frame (target y, log1p-transformed by the cleaning run)."""
    from ferret.plans import frames
    from ferret.plans.model_run import run_flow
    f = frames.model_frame(spark, sf).drop("label", "sep")
    out = run_flow(f, "regression", "y", "row_id", RunStore(spark))
    return out["leaderboard"]


@query("gaussian_nb_params", MODEL_INPUTS_SQL + """, v AS (SELECT max(v) AS mx FROM (
   SELECT var_pop(price_k) AS v FROM tr UNION ALL SELECT var_pop(acctbal_k) FROM tr
   UNION ALL SELECT var_pop(nationkey) FROM tr) t)
SELECT CAST(sep AS DOUBLE) AS class, 'price_k' AS feature, round(avg(price_k), 6) AS mean,
       round(var_pop(price_k) + 1.0e-9 * max(mx), 4) AS variance FROM tr, v GROUP BY sep
UNION ALL SELECT CAST(sep AS DOUBLE), 'acctbal_k', round(avg(acctbal_k), 6), round(var_pop(acctbal_k) + 1.0e-9 * max(mx), 4)
  FROM tr, v GROUP BY sep
UNION ALL SELECT CAST(sep AS DOUBLE), 'nationkey', round(avg(nationkey), 6), round(var_pop(nationkey) + 1.0e-9 * max(mx), 4)
  FROM tr, v GROUP BY sep""")
def q_gaussian_nb_params(spark, sf):
    """Per-class means and variances of the fitted Gaussian naive Bayes model (variance
    smoothed by 1e-9 x the largest feature variance)."""
    tr, _ = _split(spark, sf)
    fm = Mo.fit_model(Mo.ModelSpec("gaussian_nb", "classification"), tr, FEATS, "sep")
    return Mo.gaussian_nb_params(fm).select("class", "feature", F.round("mean", 6).alias("mean"),
                                            F.round("variance", 4).alias("variance"))


@query("linear_regression", OLS_SQL + PREDICT_SQL)
def q_linear_regression(spark, sf):
    """Ordinary least squares (normal equations) on the exact linear target; valid predictions."""
    out = _estimator_query("linear_regression", "regression")(spark, sf)
    return out.select("row_id", F.round("prediction", 6).alias("prediction"), "probability")


@query("ridge", RIDGE_SQL + PREDICT_SQL)
def q_ridge(spark, sf):
    """Ridge (alpha = 1 on the summed squared error) predictions for the valid rows."""
    out = _estimator_query("ridge", "regression")(spark, sf)
    return out.select("row_id", F.round("prediction", 6).alias("prediction"), "probability")


# ridge classifier: ridge (alpha = 1) on labels mapped to -1 / +1, class 1 where the score is positive
RIDGE_CLS_SQL = normal_eq_sql("1.0e0 / (SELECT count(*) FROM tr)", "(2.0e0 * sep - 1.0e0)")


@query("ridge_classifier", RIDGE_CLS_SQL + """SELECT va.row_id,
 CASE WHEN (SELECT coefficient FROM coef WHERE feature = 'intercept')
       + price_k * (SELECT coefficient FROM coef WHERE feature = 'price_k')
       + acctbal_k * (SELECT coefficient FROM coef WHERE feature = 'acctbal_k')
       + nationkey * (SELECT coefficient FROM coef WHERE feature = 'nationkey') > 0 THEN 1.0e0 ELSE 0.0e0 END
   AS prediction, CAST(NULL AS DOUBLE) AS probability FROM va""")
def q_ridge_classifier(spark, sf):
    return _estimator_query("ridge_classifier", "classification")(spark, sf)


_REPORT_SQL = RIDGE_CLS_SQL.rstrip() + """,
pr AS (SELECT sep AS t, CASE WHEN (SELECT coefficient FROM coef WHERE feature = 'intercept')
       + price_k * (SELECT coefficient FROM coef WHERE feature = 'price_k')
       + acctbal_k * (SELECT coefficient FROM coef WHERE feature = 'acctbal_k')
       + nationkey * (SELECT coefficient FROM coef WHERE feature = 'nationkey') > 0 THEN 1 ELSE 0 END AS p FROM va),
cl AS (SELECT DISTINCT t AS l FROM pr UNION SELECT DISTINCT p FROM pr),
k AS (SELECT l, count(*) FILTER (t = l AND p = l) AS tp, count(*) FILTER (t = l) AS support, count(*) FILTER (p = l) AS n_pred
      FROM pr, cl GROUP BY l),
q AS (SELECT CAST(CAST(l AS INT) AS VARCHAR) AS label, CASE WHEN n_pred > 0 THEN tp * 1.0e0 / n_pred ELSE 0.0e0 END AS precision,
      CASE WHEN support > 0 THEN tp * 1.0e0 / support ELSE 0.0e0 END AS recall, support FROM k),
fr AS (SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
      ELSE 0.0e0 END AS f1_score, support FROM q),
rep AS (SELECT * FROM fr
 UNION ALL SELECT 'accuracy', NULL, NULL, avg(CASE WHEN t = p THEN 1.0e0 ELSE 0.0e0 END), count(*) FROM pr
 UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM fr
 UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
   sum(f1_score * support) / sum(support), sum(support) FROM fr)
SELECT label, round(precision, 2) AS precision, round(recall, 2) AS recall, round(f1_score, 2) AS f1_score,
 CAST(support AS BIGINT) AS support FROM rep"""


@query("fit_and_report", _REPORT_SQL)
def q_fit_and_report(spark, sf):
    """One call: fit a ridge classifier, predict valid, classification report of the predictions."""
    from ferret.plans.bundles import fit_and_report
    tr, va = _split(spark, sf)
    spec = next(s for s in Mo.default_specs("classification", tr.count()) if s.name == "ridge_classifier")
    return fit_and_report(spec, tr, va, FEATS, "sep")["report"]


_NB_SQL = MODEL_INPUTS_SQL + """, mv AS (SELECT max(v) AS mx FROM (
   SELECT var_pop(price_k) AS v FROM tr UNION ALL SELECT var_pop(acctbal_k) FROM tr
   UNION ALL SELECT var_pop(nationkey) FROM tr) t),
pc AS (SELECT sep AS cls, ln(count(*) / (SELECT count(*) FROM tr)) AS pi,
   avg(price_k) AS m1, var_pop(price_k) + 1.0e-9 * max(mx) AS v1,
   avg(acctbal_k) AS m2, var_pop(acctbal_k) + 1.0e-9 * max(mx) AS v2,
   avg(nationkey) AS m3, var_pop(nationkey) + 1.0e-9 * max(mx) AS v3 FROM tr, mv GROUP BY sep),
ll AS (SELECT va.row_id, pc.cls, pc.pi
   - 0.5e0 * (ln(2 * pi() * v1) + ln(2 * pi() * v2) + ln(2 * pi() * v3))
   - pow(price_k - m1, 2) / (2 * v1) - pow(acctbal_k - m2, 2) / (2 * v2) - pow(nationkey - m3, 2) / (2 * v3) AS s
   FROM va CROSS JOIN pc),
w AS (SELECT row_id, max(CASE WHEN cls = 0 THEN s END) AS s0, max(CASE WHEN cls = 1 THEN s END) AS s1
   FROM ll GROUP BY row_id)
SELECT row_id, CASE WHEN s1 > s0 THEN 1.0e0 ELSE 0.0e0 END AS prediction,
   round(1.0e0 / (1.0e0 + exp(s0 - s1)), 6) AS probability FROM w"""


@query("gaussian_nb", _NB_SQL)
def q_gaussian_nb(spark, sf):
    """Gaussian naive Bayes: class log-prior plus per-feature normal log-densities."""
    out = _estimator_query("gaussian_nb", "classification")(spark, sf)
    return out.select("row_id", "prediction", F.round("probability", 6).alias("probability"))


def squared_hinge_sql(rounds: int = 14) -> str:
    """Plain Newton steps on the squared hinge as chained steps: each solves the ridge system of the rows inside the margin.

    With C = 1 the system is (sum z z' + I / 2) w = sum s z over these rows, z = (features, 1).
    """
    z = [*FEATS, "1.0e0"]
    size = len(z)
    steps = ["w0 AS (SELECT " + ", ".join(f"0.0e0 AS w{i}" for i in range(size)) + ")"]
    for t in range(1, rounds + 1):
        score = " + ".join(f"{c} * w{i}" for i, c in enumerate(z))
        sums = [f"sum({z[i]} * {z[j]})" + (" + 0.5e0" if i == j else "") + f" AS a{i}{j}" for i in range(size) for j in range(i, size)]
        sums += [f"sum(s * {z[i]}) AS r{i}" for i in range(size)]
        steps.append(f"e{t}_0 AS (SELECT {', '.join(sums)} FROM sg, w{t - 1} WHERE s * ({score}) < 1)")
        for k in range(size - 1):  # eliminate unknown k from the rows below
            cols = [f"a{i}{j}" for i in range(k + 1) for j in range(i, size)] + [f"r{i}" for i in range(k + 1)]
            cols += [f"a{i}{j} - a{k}{i} * a{k}{j} / a{k}{k} AS a{i}{j}" for i in range(k + 1, size) for j in range(i, size)]
            cols += [f"r{i} - a{k}{i} * r{k} / a{k}{k} AS r{i}" for i in range(k + 1, size)]
            steps.append(f"e{t}_{k + 1} AS (SELECT {', '.join(cols)} FROM e{t}_{k})")
        src = f"e{t}_{size - 1}"
        for k in reversed(range(size)):  # and back
            rest = "".join(f" - a{k}{j} * w{j}" for j in range(k + 1, size))
            steps.append(f"b{t}_{k} AS (SELECT *, (r{k}{rest}) / a{k}{k} AS w{k} FROM {src})")
            src = f"b{t}_{k}"
        steps.append(f"w{t} AS (SELECT {', '.join(f'w{i}' for i in range(size))} FROM {src})")
    return (MODEL_INPUTS_SQL + ", sg AS (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATS)
            + ", 2.0e0 * sep - 1 AS s FROM tr),\n" + ",\n".join(steps) + f",\nw AS (SELECT * FROM w{rounds})\n")


@query("linear_svc", squared_hinge_sql() + "SELECT row_id, CASE WHEN " + " + ".join(f"{c} * w{i}" for i, c in enumerate(FEATS))
       + f" + w{len(FEATS)} > 0 THEN 1.0e0 ELSE 0.0e0 END AS prediction, CAST(NULL AS DOUBLE) AS probability FROM va, w")
def q_linear_svc(spark, sf):
    return _estimator_query("linear_svc", "classification")(spark, sf)


@query("linear_svc_coefficients", squared_hinge_sql() + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(w{i}, 5) AS coefficient FROM w" for i, c in enumerate([*FEATS, "intercept"])))
def q_linear_svc_coefficients(spark, sf):
    """The fitted line itself."""
    tr, _ = _split(spark, sf)
    spec = next(s for s in Mo.default_specs("classification", tr.count()) if s.name == "linear_svc")
    return Mo.coefficients(Mo.fit_model(spec, tr, FEATS, "sep")).select("feature", F.round("coefficient", 5).alias("coefficient"))
