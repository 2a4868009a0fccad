"""Queries: imputation, flags, encodings, power transforms, HBOS, assembled frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import cleaning as C
from ferret.operators.power import newton_sql, transform_sql
from ferret.operators.split import hash32, hash32_sql
from ferret.plans import frames
from ferret.plans.cleaning_plan import CleaningPlan
from ferret.plans.oracle import with_frame
from ferret.plans.registry import query
from ferret.sources.tables import table

H = hash32_sql("row_id", 42)
CUT = int(0.75 * (1 << 32))
TRAIN_SQL = f"tr AS (SELECT * FROM f WHERE {H} < {CUT})"


_SPLIT_SQL = f"CASE WHEN {H} < {CUT} THEN 'train' ELSE 'valid' END AS split"


def _split_name(key="row_id"):
    return F.when(hash32(key, 42) < F.lit(CUT), "train").otherwise("valid").alias("split")


def _train(df, key="row_id"):
    return df.where(hash32(key, 42) < F.lit(CUT))


def _frame(spark, sf):
    return frames.orders_frame(spark, sf)


def _cte(*parts: str, frame: str = "orders") -> str:
    return with_frame("", frame).rstrip() + ",\n" + ",\n".join(parts) + "\n"


def _mode_sql(col: str, src: str = "tr") -> str:
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


# --- imputation -----------------------------------------------------------------
@query("impute_median", _cte(TRAIN_SQL, "m AS (SELECT median(price) AS mp, median(acctbal) AS ma FROM tr)")
       + "SELECT row_id, coalesce(price, mp) AS price, coalesce(acctbal, ma) AS acctbal FROM f, m")
def q_impute_median(spark, sf):
    f = _frame(spark, sf)
    med = C.fit_medians(_train(f), ["price", "acctbal"])
    return f.select("row_id", *[C.impute(c, med[c]).alias(c) for c in ("price", "acctbal")])


@query("impute_mode", _cte(TRAIN_SQL) + "SELECT row_id, "
       + ", ".join(f"coalesce({c}, {_mode_sql(c)}) AS {c}" for c in ("priority", "nationkey", "bucket"))
       + " FROM f")
def q_impute_mode(spark, sf):
    f = _frame(spark, sf)
    cols = ["priority", "nationkey", "bucket"]
    mode = C.fit_modes(_train(f), cols)
    return f.select("row_id", *[C.impute(c, mode[c]).alias(c) for c in cols])


@query("impute_by_dtype", _cte("m AS (SELECT median(price) AS mp, median(acctbal) AS ma FROM f)")
       + f"SELECT row_id, coalesce(price, mp) AS imputed_price, coalesce(acctbal, ma) AS imputed_acctbal, "
         f"coalesce(priority, {_mode_sql('priority', 'f')}) AS imputed_priority FROM f, m")
def q_impute_by_dtype(spark, sf):
    f = _frame(spark, sf)
    return f.select("row_id", *C.impute_by_dtype(f))


@query("fill_null_zero", with_frame(
    "SELECT row_id, coalesce(price, 0) AS price, coalesce(acctbal, 0) AS acctbal, nationkey FROM f"))
def q_fill_null_zero(spark, sf):
    return C.fill_null_zero(_frame(spark, sf).select("row_id", "price", "acctbal", "nationkey"))


_FEATS = ["OrderId", "price", "acctbal", "priority", "segment", "nationkey", "bucket", "const_col"]


@query("missing_indicator", with_frame(
    "SELECT row_id, " + ", ".join(f"CAST({c} IS NULL AS INT) AS missing_{c}"
                                  for c in ("price", "acctbal", "priority", "segment")) + " FROM f"))
def q_missing_indicator(spark, sf):
    f = _frame(spark, sf)
    flags = C.fit_missing_flags(f, _FEATS)
    return f.select("row_id", *C.missing_flags(f, flags))


@query("missing_indicator_fit", _cte(TRAIN_SQL) + "SELECT row_id, " + ", ".join(
    f"CAST({c} IS NULL AS INT) AS missing_{c}" for c in ("price", "acctbal", "priority", "segment"))
       + f", {_SPLIT_SQL} FROM f")
def q_missing_indicator_fit(spark, sf):
    """Flags of the columns with a null in train, for the rows of both splits."""
    f = _frame(spark, sf)
    flags = C.fit_missing_flags(_train(f), _FEATS)
    return f.select("row_id", *C.missing_flags(f, flags), _split_name())


# --- simple transforms ------------------------------------------------------------
@query("log_transform", with_frame("SELECT row_id, ln(price) AS price_log FROM f"))
def q_log_transform(spark, sf):
    f = _frame(spark, sf)
    pos = C.positive_columns(f, ["price", "acctbal", "bucket"])
    return f.select("row_id", *[C.log_transform(c) for c in pos])


@query("reciprocal_transform", with_frame("SELECT row_id, 1.0e0 / price AS price_inverted FROM f"))
def q_reciprocal_transform(spark, sf):
    f = _frame(spark, sf)
    pos = C.positive_columns(f, ["price", "acctbal", "bucket"])
    return f.select("row_id", *[C.reciprocal_transform(c) for c in pos])


@query("log1p_target", with_frame("SELECT row_id, ln(1 + y) AS y FROM f", "model"))
def q_log1p_target(spark, sf):
    return frames.model_frame(spark, sf).select("row_id", C.log1p_target("y", "regression"))


@query("label_encode", with_frame(
    "SELECT row_id, priority, CASE WHEN priority IS NULL THEN NULL "
    "ELSE dense_rank() OVER (ORDER BY priority) - 1 END AS priority_encoded FROM f"))
def q_label_encode(spark, sf):
    f = _frame(spark, sf).select("row_id", "priority")
    return C.label_encode(f, "priority").select("row_id", "priority", "priority_encoded")


# --- target encoding ----------------------------------------------------------------
_TE_COLS = ["priority", "nationkey"]
_TE_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n, avg(label) AS mean "
    f"FROM tr WHERE {c} IS NOT NULL GROUP BY 2" for c in _TE_COLS)
TE_SQL = _cte(TRAIN_SQL, "pr AS (SELECT avg(label) AS p FROM tr)", f"st AS ({_TE_STATS})",
              "enc AS (SELECT feature, value, CASE WHEN n = 1 THEN p ELSE "
              "p * (1 - 1.0e0 / (1 + exp(-(n - 1) / 1.0e0))) + mean * (1.0e0 / (1 + exp(-(n - 1) / 1.0e0))) "
              "END AS encoding FROM st, pr)") + \
    f"SELECT f.row_id, {_SPLIT_SQL}, " + ", ".join(f"coalesce(e{i}.encoding, p) AS {c}_te" for i, c in enumerate(_TE_COLS)) + \
    " FROM f CROSS JOIN pr " + " ".join(
        f"LEFT JOIN enc e{i} ON e{i}.feature = '{c}' AND e{i}.value = CAST(f.{c} AS VARCHAR)"
        for i, c in enumerate(_TE_COLS))


@query("target_encode", TE_SQL)
def q_target_encode(spark, sf):
    f = _frame(spark, sf)
    te = C.fit_target_encoding(_train(f), _TE_COLS, "label")
    return C.apply_target_encoding(f, te, _TE_COLS).select("row_id", _split_name(), *[c + "_te" for c in _TE_COLS])


@query("target_encode_join", TE_SQL)
def q_target_encode_join(spark, sf):
    """Same as target_encode with the lookup forced through the size-checked join path."""
    f = _frame(spark, sf)
    te = C.fit_target_encoding(_train(f), _TE_COLS, "label", max_literal=0)
    return C.apply_target_encoding(f, te, _TE_COLS).select("row_id", _split_name(), *[c + "_te" for c in _TE_COLS])


# --- HBOS on part (p_size, p_retailprice) ---------------------------------------------
PH = hash32_sql("p_partkey", 42)


def _hbos_edges(c):
    return (f"CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5e0 ELSE min({c}) END AS lo_{c}, "
            f"CASE WHEN min({c}) = max({c}) THEN 0.1e0 ELSE (max({c}) - min({c})) / 10.0e0 END AS w_{c}")


def _hbos_term(c):
    ld = f"ld_{c}"
    return (f"(CASE WHEN {c} < lo_{c} THEN CASE WHEN lo_{c} - {c} <= w_{c} * 0.5e0 THEN "
            f"(SELECT ld FROM {ld} WHERE bin = 0) ELSE (SELECT min(ld) FROM {ld}) END "
            f"WHEN {c} > lo_{c} + w_{c} * 10 THEN CASE WHEN {c} - (lo_{c} + w_{c} * 10) <= w_{c} * 0.5e0 THEN "
            f"(SELECT ld FROM {ld} WHERE bin = 9) ELSE (SELECT min(ld) FROM {ld}) END "
            f"ELSE (SELECT ld FROM {ld} WHERE bin = least(9, CAST(floor(({c} - lo_{c}) / w_{c}) AS INT))) END)")


def _ld_cte(c):
    return (f"ld_{c} AS (SELECT g.bin, log2(coalesce(k.cnt, 0) / (e.n * e.w_{c}) + 0.1e0) AS ld "
            f"FROM (SELECT range AS bin FROM range(10)) g CROSS JOIN e LEFT JOIN "
            f"(SELECT least(9, CAST(floor(({c} - lo_{c}) / w_{c}) AS INT)) AS bin, count(*) AS cnt "
            f"FROM tr CROSS JOIN e GROUP BY 1) k ON g.bin = k.bin)")


HBOS_SQL = ("WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part),\n"
            f"tr AS (SELECT * FROM p WHERE {PH} < {CUT}),\n"
            f"e AS (SELECT count(*) AS n, {_hbos_edges('p_size')}, {_hbos_edges('p_retailprice')} FROM tr),\n"
            f"{_ld_cte('p_size')},\n{_ld_cte('p_retailprice')},\n"
            f"sc AS (SELECT p_partkey, {PH} < {CUT} AS is_train, "
            f"-({_hbos_term('p_size')} + {_hbos_term('p_retailprice')}) AS hbos_score FROM p CROSS JOIN e)\n")


def _hbos(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                        "p_retailprice")
    tr = p.where(hash32("p_partkey", 42) < F.lit(CUT))
    model = C.fit_hbos(tr, ["p_size", "p_retailprice"])
    model.threshold = C.fit_hbos_threshold(tr.select(C.hbos_score(model)))
    return p, model


@query("hbos_fit_score", HBOS_SQL + "SELECT p_partkey, round(hbos_score, 6) AS hbos_score FROM sc")
def q_hbos_fit_score(spark, sf):
    p, model = _hbos(spark, sf)
    return p.select("p_partkey", F.round(C.hbos_score(model), 6).alias("hbos_score"))


_THR = "thr AS (SELECT quantile_cont(hbos_score, 0.9) AS t FROM sc WHERE is_train)"


@query("hbos_label", HBOS_SQL.rstrip() + f",\n{_THR}\n"
       "SELECT p_partkey, CAST(hbos_score > t AS INT) AS HBOS FROM sc CROSS JOIN thr")
def q_hbos_label(spark, sf):
    p, model = _hbos(spark, sf)
    return p.select("p_partkey", C.hbos_label(C.hbos_score(model), model.threshold))


@query("split_in_outliers", HBOS_SQL.rstrip() + f",\n{_THR}\n"
       "SELECT p_partkey, CASE WHEN hbos_score > t THEN 'outlier' ELSE 'inlier' END AS part "
       "FROM sc CROSS JOIN thr")
def q_split_in_outliers(spark, sf):
    p, model = _hbos(spark, sf)
    return C.split_in_outliers(p, model).select("p_partkey", "part")


# --- power transforms ---------------------------------------------------------------
_YJ = C.yeo_johnson_sql("c_acctbal", 0.5)


@query("yeo_johnson", f"""SELECT c_custkey, round(({_YJ} - avg({_YJ}) OVER ()) / stddev_pop({_YJ}) OVER (), 6)
 AS c_acctbal FROM customer""")
def q_yeo_johnson(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    fit = {"c_acctbal": C.PowerFit(0.5, float("nan"))}
    C.fit_standardize(c, ["c_acctbal"], fit, "yeo-johnson")
    return c.select("c_custkey", F.round(C.power_transform("c_acctbal", fit["c_acctbal"]), 6).alias("c_acctbal"))


def _fitted_sql(feature: str, x: str, source: str, method: str, steps: int = 12) -> str:
    """Plain Newton steps in SQL: (feature, lam) of the likelihood's maximum."""
    return f"(WITH {newton_sql(x, source, method, steps)} SELECT '{feature}' AS feature, lam FROM l{steps})"


_YJ_FIT_SQL = " UNION ALL ".join(f"""SELECT feature, round(max(lam), 6) AS lambda,
 round(-count(*) / 2.0e0 * ln(var_pop(t)) + (max(lam) - 1.0e0) * sum(CASE WHEN x < 0 THEN -ln(1.0e0 - x) ELSE ln(1.0e0 + x) END), 3) AS llf,
 round(avg(t), 2) AS mean, round(stddev_pop(t), 2) AS std
FROM (SELECT feature, lam, x, {transform_sql('x', 'lam', 'yeo-johnson')} AS t FROM (SELECT CAST({x} AS DOUBLE) AS x FROM {src}) d,
      {_fitted_sql(x, x, src, 'yeo-johnson')} l) z GROUP BY feature"""
                                 for x, src in (("value", "events"), ("c_acctbal", "customer")))


@query("yeo_johnson_fit", _YJ_FIT_SQL)
def q_yeo_johnson_fit(spark, sf):
    """Fitted lambda by maximum likelihood, its likelihood, and mean and deviation of the transformed values."""
    both = table(spark, sf, "events").select("value").unionByName(table(spark, sf, "customer").select("c_acctbal"), allowMissingColumns=True)
    fits = C.fit_power(both, ["value", "c_acctbal"])
    rows = [(k, round(v.lam, 6), round(v.llf, 3), round(v.mean, 2), round(v.std, 2)) for k, v in fits.items()]
    return spark.createDataFrame(rows, "feature string, lambda double, llf double, mean double, std double")


@query("yeo_johnson_target", with_frame(f"""SELECT row_id, round((t - avg(t) OVER ()) / stddev_pop(t) OVER (), 5) AS y_yj
FROM (SELECT row_id, {transform_sql('y', 'lam', 'yeo-johnson')} AS t FROM f, {_fitted_sql('y', 'y', 'f', 'yeo-johnson')} l) z""", "model"))
def q_yeo_johnson_target(spark, sf):
    m = frames.model_frame(spark, sf).select("row_id", "y")
    fit = C.fit_power(m, ["y"])
    return m.select("row_id", F.round(C.power_transform("y", fit["y"]), 5).alias("y_yj"))


_BC = C.boxcox_sql("value", 0.5)


@query("boxcox", f"SELECT event_id, round({_BC}, 6) AS value_boxcox FROM events")
def q_boxcox(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return e.select("event_id", F.round(C.boxcox("value", 0.5), 6).alias("value_boxcox"))


@query("boxcox_fit", f"""SELECT event_id, round({transform_sql('value', 'lam', 'box-cox')}, 5) AS value_boxcox
FROM events, {_fitted_sql('value', 'value', 'events', 'box-cox')} l""")
def q_boxcox_fit(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    fit = C.fit_power(e, ["value"], method="box-cox", standardize=False)
    return e.select("event_id", F.round(C.power_transform("value", fit["value"], "box-cox", False), 5).alias("value_boxcox"))


_NUM_SQL = "(SELECT c_custkey, c_custkey + 1 AS nr, c_acctbal AS bal FROM customer)"  # positive values; values of both signs


@query("transform_numerics", f"""SELECT c_custkey, round(ln(nr), 5) AS nr_log,
 round({transform_sql('nr', 'b.lam', 'box-cox')}, 5) AS nr_boxcox, round(1.0e0 / nr, 5) AS nr_inverted,
 round({transform_sql('nr', 'k.lam', 'yeo-johnson')}, 5) AS nr_yeo, round({transform_sql('bal', 'a.lam', 'yeo-johnson')}, 3) AS bal_yeo
FROM {_NUM_SQL} t, {_fitted_sql('b', 'nr', _NUM_SQL, 'box-cox')} b, {_fitted_sql('k', 'nr', _NUM_SQL, 'yeo-johnson')} k,
 {_fitted_sql('a', 'bal', _NUM_SQL, 'yeo-johnson')} a""")
def q_transform_numerics(spark, sf):
    """All transforms of two columns with fitted lambdas; only Yeo-Johnson takes values of both signs."""
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") + 1).alias("nr"), F.col("c_acctbal").alias("bal"))
    out = c.select("c_custkey", *C.transform_numerics(c, ["nr", "bal"]))
    return out.select("c_custkey", *[F.round(n, 3 if n == "bal_yeo" else 5).alias(n) for n in out.columns[1:]])


# --- assembled frames -------------------------------------------------------------------
_ASM_SQL = with_frame("").rstrip() + f""",
sp AS (SELECT f.*, s.split FROM f JOIN (
  SELECT row_id, CASE WHEN rn <= nc - CAST(ceil(0.25e0 * nc) AS BIGINT) THEN 'train' ELSE 'valid' END AS split
  FROM (SELECT row_id, row_number() OVER (PARTITION BY label ORDER BY {H}, row_id) AS rn,
               count(*) OVER (PARTITION BY label) AS nc FROM f) t) s ON f.row_id = s.row_id),
tr AS (SELECT * FROM sp WHERE split = 'train'),
m AS (SELECT median(price) AS mp, median(acctbal) AS ma, median(bucket) AS mb FROM tr)
SELECT row_id, split, coalesce(price, mp) AS price, coalesce(acctbal, ma) AS acctbal,
       CAST(coalesce(bucket, mb) AS DOUBLE) AS bucket,
       coalesce(priority, {_mode_sql('priority')}) AS priority,
       coalesce(nationkey, {_mode_sql('nationkey')}) AS nationkey,
       coalesce(bucket, {_mode_sql('bucket')}) AS bucket_cat, label
FROM sp, m"""


def _plan_model(spark, sf):
    f = _frame(spark, sf)
    plan = CleaningPlan("label", "classification")
    sp = plan.split(f)
    return f, sp, plan.fit(f, sp)


@query("assemble_imputed", _ASM_SQL)
def q_assemble_imputed(spark, sf):
    f, sp, model = _plan_model(spark, sf)
    return model.imputed(sp).withColumn("bucket", F.col("bucket").cast("double"))


@query("assemble_transformed")
def q_assemble_transformed(spark, sf):
    f, sp, model = _plan_model(spark, sf)
    return model.transformed(sp)


@query("score_new")
def q_score_new(spark, sf):
    """A model of the orders frame applied to another, unlabelled table: one row per customer, some without orders."""
    _, _, model = _plan_model(spark, sf)
    return model.score_new(frames.customers_frame(spark, sf))
