"""Rank-based normality reports: Shapiro-Wilk W / p and normal probability plots.

All columns are ranked in ONE distributed pass: the values are unpivoted to
(feature, value, key) and ranked by ``global_rank`` over (feature, value,
key); a per-feature offset table (k rows) turns global positions into ranks
within each feature.  The statistics are then plain aggregates over the
ranked rows with the normal quantile as a Column expression.

Shapiro-Wilk follows Royston (1995), algorithm AS R94: coefficients from the
normal scores m_i = Phi^-1((i - 3/8) / (n + 1/4)) with polynomial corrections
for the two extreme coefficients, and a normalising transform of W for the
p-value (valid up to n = 5000; above that ``p_exact`` is false).
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.functions.normal import with_norm_ppf
from ferret.operators.columns import unpivot_values
from ferret.operators.rank import global_rank, running_totals

# Fixed values (Royston 1995, AS R94): polynomial coefficients.
SW_C1 = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
SW_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_LARGE_MU = [-1.5861, -0.31082, -0.083751, 0.0038915]
SW_LARGE_SIGMA = [-0.4803, -0.082676, 0.0030302]
SW_SMALL_GAMMA = [-2.273, 0.459]
SW_SMALL_MU = [0.544, -0.39978, 0.025054, -6.714e-4]
SW_SMALL_SIGMA = [1.3822, -0.77857, 0.062767, -0.0020322]

_ND = NormalDist()


def _poly(c: list[float], x: float) -> float:
    return sum(ci * x ** i for i, ci in enumerate(c))


def ranked_long(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """(feature, key, value, i, n): value ranks 1..n within each feature (nulls dropped)."""
    long = unpivot_values(df.select(key, *cols), cols, ids=[key], cast="double").where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    ranked = global_rank(long, [F.col("feature"), F.col("value")], [key], rank_col="_g")
    # one row per feature: where its ranks start is a running total
    counts = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    off = running_totals(counts, [F.col("feature")], ["n"]).select("feature", (F.col("cum_n") - F.col("n")).alias("_off"), "n")
    return ranked.join(off, "feature").select(
        "feature", key, "value", (F.col("_g") - F.col("_off")).alias("i"), "n")


def _coefficients(n: int, ssm: float) -> tuple[float, float, float]:
    """(a_n, a_{n-1}, eps) for n > 5; (a_n, 0, eps) for 3 < n <= 5."""
    u = 1.0 / math.sqrt(n)
    mn = _ND.inv_cdf((n - 0.375) / (n + 0.25))
    a_n = mn / math.sqrt(ssm) + _poly(SW_C1, u)
    if n > 5:
        mn1 = _ND.inv_cdf((n - 1 - 0.375) / (n + 0.25))
        a_n1 = mn1 / math.sqrt(ssm) + _poly(SW_C2, u)
        eps = (ssm - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * a_n * a_n - 2 * a_n1 * a_n1)
        return a_n, a_n1, eps
    eps = (ssm - 2 * mn * mn) / (1 - 2 * a_n * a_n)
    return a_n, 0.0, eps


def sw_pvalue(w: float, n: int) -> float:
    if n == 3:
        return max(0.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    w1 = math.log1p(-w) if w < 1 else -math.inf
    if n <= 11:
        gamma = _poly(SW_SMALL_GAMMA, n)
        if w1 >= gamma:
            return 1e-99
        y = -math.log(gamma - w1)
        m, s = _poly(SW_SMALL_MU, n), math.exp(_poly(SW_SMALL_SIGMA, n))
    else:
        ln = math.log(n)
        y, m, s = w1, _poly(SW_LARGE_MU, ln), math.exp(_poly(SW_LARGE_SIGMA, ln))
    if y == -math.inf:
        return 1.0
    return 1.0 - _ND.cdf((y - m) / s)


def normality_test(df: DataFrame, cols: list[str], key: str, alpha: float = 0.05, ranked: DataFrame | None = None) -> DataFrame:
    """(feature, n, w, p_value, normal, p_exact) per column; ``ranked``: their ``ranked_long``, if already there."""
    spark = df.sparkSession
    ranked = ranked_long(df, cols, key) if ranked is None else ranked
    rk = with_norm_ppf(ranked.withColumn(
        "_p", (F.col("i") - F.lit(0.375)) / (F.col("n") + F.lit(0.25))), "_p", "m").cache()
    st = {r["feature"]: r for r in rk.groupBy("feature").agg(
        F.first("n").alias("n"), F.sum(F.col("m") * F.col("m")).alias("ssm"),
        (F.var_pop("value") * F.count("value")).alias("ss")).collect()}
    params = []
    for c in cols:
        if c not in st or st[c]["n"] < 3:
            continue
        n, ssm = st[c]["n"], st[c]["ssm"]
        if n == 3:
            params.append((c, math.sqrt(0.5), 0.0, None))
        else:
            a_n, a_n1, eps = _coefficients(n, ssm)
            params.append((c, a_n, a_n1, eps))
    rows = []
    if params:
        pt = spark.createDataFrame(params, "feature string, a_n double, a_n1 double, eps double")
        i, n = F.col("i"), F.col("n")
        a = (F.when(n == 3, F.when(i == 1, -F.col("a_n")).when(i == 3, F.col("a_n")).otherwise(0.0))
             .when(i == n, F.col("a_n")).when(i == 1, -F.col("a_n"))
             .when((n > 5) & (i == n - 1), F.col("a_n1")).when((n > 5) & (i == 2), -F.col("a_n1"))
             .otherwise(F.col("m") / F.sqrt("eps")))
        num = rk.join(F.broadcast(pt), "feature").groupBy("feature").agg(
            F.sum(a * F.col("value")).alias("b"))
        b = {r["feature"]: r["b"] for r in num.collect()}
        for c, *_ in params:
            n, ss = st[c]["n"], st[c]["ss"]
            w = None if not ss else min(1.0, b[c] * b[c] / ss)
            p = None if w is None else sw_pvalue(w, n)
            rows.append((c, n, w, p, None if p is None else p > alpha, n <= 5000))
    rk.unpersist()
    return spark.createDataFrame(rows, "feature string, n bigint, w double, p_value double, "
                                       "normal boolean, p_exact boolean")


def _filliben():
    n, i = F.col("n").cast("double"), F.col("i").cast("double")
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return (F.when(F.col("i") == F.col("n"), last).when(F.col("i") == 1, 1 - last)
            .otherwise((i - 0.3175) / (n + 0.365)))


def probability_plot(df: DataFrame, cols: list[str], key: str, ranked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Normal probability plot: points (feature, i, osm, osr) and the least-squares fit
    (feature, slope, intercept, r) of ordered values on theoretical quantiles."""
    ranked = ranked_long(df, cols, key) if ranked is None else ranked
    rk = with_norm_ppf(ranked.withColumn("_v", _filliben()), "_v", "osm")
    pts = rk.select("feature", "i", "osm", F.col("value").alias("osr"))
    den = F.stddev_pop("osm") * F.stddev_pop("osr")  # both sides are present in every row
    fit = pts.groupBy("feature").agg(
        F.regr_slope("osr", "osm").alias("slope"), F.regr_intercept("osr", "osm").alias("intercept"),
        F.when(den > 0, F.try_divide(F.covar_pop("osm", "osr"), den)).alias("r"))
    return (pts.select("feature", "i", F.round("osm", 6).alias("osm"), F.round("osr", 6).alias("osr")),
            fit.select("feature", *[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r")]))
