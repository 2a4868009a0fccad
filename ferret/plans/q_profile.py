"""Queries: skew, correlation, histogram, density, box, category reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import profile as P
from ferret.plans import frames
from ferret.plans.frames import ORDERS_FRAME_SQL
from ferret.plans.oracle import with_frame
from ferret.plans.registry import query

NUM = ["price", "acctbal", "bucket", "nationkey", "const_col"]


@query("skew_report", with_frame("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(skewness({c}), 6) AS skew, abs(skewness({c})) > 5 AS high_skew FROM f"
    for c in NUM)))
def q_skew_report(spark, sf):
    return P.skew_report(frames.orders_frame(spark, sf), NUM)


@query("skew_report_events", "SELECT 'value' AS feature, round(skewness(value), 6) AS skew, "
       "abs(skewness(value)) > 5 AS high_skew FROM events")
def q_skew_report_events(spark, sf):
    return P.skew_report(frames.skewed(spark, sf), ["value"])


def _corr_sql(a, b):
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    den = (f"(stddev_pop(CASE WHEN {both} THEN CAST({a} AS DOUBLE) END) * "
           f"stddev_pop(CASE WHEN {both} THEN CAST({b} AS DOUBLE) END))")
    return f"CASE WHEN {den} > 0 THEN covar_pop({a}, {b}) / {den} END"


def _corr_rows(cols, frame_filter=""):
    parts = []
    for a in cols:
        for b in cols:
            parts.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, round({_corr_sql(a, b)}, 6) AS corr FROM f")
    return "\nUNION ALL\n".join(parts)


@query("correlation_matrix", with_frame(_corr_rows(NUM)))
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(frames.orders_frame(spark, sf), NUM)


HC = ["price", "acctbal", "bucket", "y"]


@query("high_correlation", with_frame("SELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{HC[i]}' AS feature_x, '{HC[j]}' AS feature_y, round({_corr_sql(HC[i], HC[j])}, 6) AS corr FROM f"
    for i in range(len(HC)) for j in range(i + 1, len(HC))) + "\n) t WHERE corr > 0.95", "model"))
def q_high_correlation(spark, sf):
    return P.high_correlation(frames.model_frame(spark, sf), HC, 0.95)


def _hist_sql(col, src):
    return f"""
SELECT '{col}' AS feature, bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi, count(*) AS count
FROM (SELECT least(nb - 1, CAST(floor((CAST({col} AS DOUBLE) - lo) / w) AS INT)) AS bin, lo, w
      FROM {src} CROSS JOIN (
        SELECT CASE WHEN a = b THEN a - 0.5e0 ELSE a END AS lo,
               CASE WHEN a = b THEN 1.0e0 ELSE b - a END / nb AS w, nb
        FROM (SELECT a, b, CAST(greatest(1, least(50, CASE WHEN n < 2 THEN 1
                     WHEN h = 0 THEN floor(sqrt(n)) ELSE ceil((b - a) / h) END)) AS INT) AS nb
              FROM (SELECT count({col}) AS n, min(CAST({col} AS DOUBLE)) AS a, max(CAST({col} AS DOUBLE)) AS b,
                           2.0e0 * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) / pow(count({col}), 1.0e0 / 3.0e0) AS h
                    FROM {src}) s) s2) e
      WHERE {col} IS NOT NULL) t
GROUP BY bin, lo, w"""


@query("histogram", with_frame(_hist_sql("price", "f") + "\nUNION ALL\n" + _hist_sql("acctbal", "f")))
def q_histogram(spark, sf):
    return P.histogram(frames.orders_frame(spark, sf), ["price", "acctbal"])


@query("histogram_events", "WITH f AS (SELECT * FROM events)" + _hist_sql("value", "f"))
def q_histogram_events(spark, sf):
    return P.histogram(frames.skewed(spark, sf), ["value"])


DENSITY_SQL = """
WITH s AS (SELECT count(value) AS n, min(value) AS a, max(value) AS b, stddev_samp(value) AS sd FROM events),
p AS (SELECT n, a, (b - a) / 1024 AS w, sd * pow(n, -0.2e0) AS bw,
             a - 3.0e0 * sd * pow(n, -0.2e0) AS g0,
             (b + 3.0e0 * sd * pow(n, -0.2e0) - (a - 3.0e0 * sd * pow(n, -0.2e0))) / 99 AS step FROM s),
c AS (SELECT least(1023, CAST(floor((value - a) / w) AS INT)) AS bin, count(*) AS c
      FROM events CROSS JOIN p GROUP BY 1),
g AS (SELECT range AS grid FROM range(100))
SELECT 'value' AS feature, CAST(grid AS INT) AS grid, round(g0 + grid * step, 6) AS x,
       round(sum(c * exp(-0.5e0 * pow((g0 + grid * step - (a + (bin + 0.5e0) * w)) / bw, 2)))
             / (n * bw * sqrt(2 * pi())), 9) AS density
FROM c CROSS JOIN g CROSS JOIN p
GROUP BY grid, g0, step, n, bw
"""


@query("density", DENSITY_SQL)
def q_density(spark, sf):
    return P.density(frames.skewed(spark, sf), "value")


def _box_sql(col, src="f"):
    return f"""
SELECT '{col}' AS feature, round(q1, 6) AS q1, round(md, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
  round((SELECT min({col}) FROM {src} WHERE {col} >= q1 - 1.5e0 * (q3 - q1)), 6) AS whisker_low,
  round((SELECT max({col}) FROM {src} WHERE {col} <= q3 + 1.5e0 * (q3 - q1)), 6) AS whisker_high,
  (SELECT count(*) FROM {src} WHERE {col} < q1 - 1.5e0 * (q3 - q1) OR {col} > q3 + 1.5e0 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS md, quantile_cont({col}, 0.75) AS q3
      FROM {src}) q"""


@query("box_stats", with_frame(_box_sql("price") + "\nUNION ALL\n" + _box_sql("acctbal")))
def q_box_stats(spark, sf):
    return P.box_stats(frames.orders_frame(spark, sf), ["price", "acctbal"])


@query("box_stats_events", "WITH f AS (SELECT * FROM events)" + _box_sql("value"))
def q_box_stats_events(spark, sf):
    return P.box_stats(frames.skewed(spark, sf), ["value"])


CAT = ["priority", "nationkey", "segment"]


@query("category_counts", with_frame("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM f GROUP BY 2" for c in CAT)))
def q_category_counts(spark, sf):
    return P.category_counts(frames.orders_frame(spark, sf), CAT)


@query("category_target_rate", with_frame("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(label) AS n, round(avg(label), 6) AS mean, "
    f"round(avg(label) - 1.96e0 * stddev_samp(label) / sqrt(count(label)), 6) AS ci_low, "
    f"round(avg(label) + 1.96e0 * stddev_samp(label) / sqrt(count(label)), 6) AS ci_high FROM f GROUP BY 2"
    for c in CAT)))
def q_category_target_rate(spark, sf):
    return P.category_target_rate(frames.orders_frame(spark, sf), CAT, "label")


@query("target_distribution", with_frame("SELECT label AS value, count(*) AS count FROM f GROUP BY 1"))
def q_target_distribution(spark, sf):
    return P.target_distribution(frames.orders_frame(spark, sf), "label", "classification")


@query("target_distribution_regression", with_frame(
    _hist_sql("y", "f").replace("SELECT 'y' AS feature, bin", "SELECT bin"), "model"))
def q_target_distribution_regression(spark, sf):
    return P.target_distribution(frames.model_frame(spark, sf), "y", "regression")


SUMMARY = ["price", "acctbal", "bucket", "nationkey"]


@query("column_summary", with_frame("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, round(min(CAST({c} AS DOUBLE)), 6) AS min, "
    f"round(max(CAST({c} AS DOUBLE)), 6) AS max, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(median(CAST({c} AS DOUBLE)), 6) AS median, "
    f"round(CAST((SELECT {c} FROM f WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS DOUBLE), 6) AS mode "
    f"FROM f" for c in SUMMARY)))
def q_column_summary(spark, sf):
    return P.column_summary(frames.orders_frame(spark, sf), SUMMARY)


def _boot_sql(cols, draws=100):
    cdf = " ".join(f"WHEN u < {c!r}e0 THEN {k}" for k, c in enumerate(P.POISSON1_CDF))
    long = " UNION ALL ".join(f"SELECT row_id, label, '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM f"
                              for c in cols)
    return with_frame("").rstrip() + f""",
l AS ({long}),
d AS (SELECT l.*, g.draw, CAST(('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':' || CAST(g.draw AS VARCHAR)), 1, 8))
        AS BIGINT) / {float(1 << 32)} AS u FROM l CROSS JOIN (SELECT range AS draw FROM range(1, {draws + 1})) g),
wt AS (SELECT *, CASE {cdf} ELSE {len(P.POISSON1_CDF)} END AS w FROM d),
per AS (SELECT feature, value, draw, sum(w * label) / sum(w) AS m FROM wt WHERE w > 0 GROUP BY 1, 2, 3),
ci AS (SELECT feature, value, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM per GROUP BY 1, 2),
base AS (SELECT feature, value, count(label) AS n, avg(label) AS mean FROM l GROUP BY 1, 2)
SELECT b.feature, b.value, b.n, round(b.mean, 6) AS mean, round(ci.lo, 6) AS ci_low, round(ci.hi, 6) AS ci_high
FROM base b LEFT JOIN ci ON b.feature = ci.feature AND b.value IS NOT DISTINCT FROM ci.value"""


@query("category_target_rate_bootstrap", _boot_sql(["priority", "nationkey"]))
def q_category_target_rate_bootstrap(spark, sf):
    return P.category_target_rate_bootstrap(frames.orders_frame(spark, sf), ["priority", "nationkey"],
                                            "label", "row_id")


@query("correlation_matrix_stages")
def q_correlation_matrix_stages(spark, sf):
    """Pearson matrices of the untransformed, imputed and transformed numerics of one run."""
    from ferret.plans.cleaning_plan import CleaningPlan
    f = frames.orders_frame(spark, sf)
    plan = CleaningPlan("label", "classification", fit_hbos=False)
    sp = plan.split(f)
    m = plan.fit(f, sp)
    num = m.numeric
    out = P.correlation_matrix(sp, num, "untransformed")
    out = out.unionByName(P.correlation_matrix(m.imputed(sp), num, "imputed"))
    return out.unionByName(P.correlation_matrix(m.transformed(sp, with_hbos=False), num, "transformed"))


# ---- NaN counts as missing: price is NaN in some rows and NULL in others ------

def nan_frame(spark, sf):
    price = F.when(F.col("row_id") % 7 == 0, F.lit(float("nan"))).when(F.col("row_id") % 11 != 0, F.col("price").cast("double"))
    return frames.orders_frame(spark, sf).withColumn("price", price)


def with_nan_frame(body: str) -> str:
    return (f"WITH g AS ({ORDERS_FRAME_SQL}),\nf AS (SELECT * REPLACE (CASE WHEN row_id % 7 <> 0 AND row_id % 11 <> 0 "
            f"THEN CAST(price AS DOUBLE) END AS price) FROM g)\n{body}")


@query("skew_report_nan", with_nan_frame("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(skewness({c}), 6) AS skew, abs(skewness({c})) > 5 AS high_skew FROM f" for c in NUM)))
def q_skew_report_nan(spark, sf):
    return P.skew_report(nan_frame(spark, sf), NUM)


@query("correlation_matrix_nan", with_nan_frame(_corr_rows(NUM)))
def q_correlation_matrix_nan(spark, sf):
    return P.correlation_matrix(nan_frame(spark, sf), NUM)


@query("histogram_nan", with_nan_frame(_hist_sql("price", "f")))
def q_histogram_nan(spark, sf):
    return P.histogram(nan_frame(spark, sf), ["price"])


@query("impute_median_nan", with_nan_frame("SELECT row_id, coalesce(price, (SELECT median(price) FROM f)) AS price FROM f"))
def q_impute_median_nan(spark, sf):
    from ferret.operators import cleaning as C
    f = nan_frame(spark, sf)
    return f.select("row_id", C.impute("price", C.fit_medians(f, ["price"])["price"]).alias("price"))
