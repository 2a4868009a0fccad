"""Profiling reports returned as DataFrames (the data behind every chart)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferret.operators.columns import nan_to_null, unpivot_values
from ferret.operators.gramian import both_ways, named, pair_sums
from ferret.operators.rank import exact_quantiles


def _value(c: str) -> Column:
    """A column as double, with NaN as NULL: one notion of missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


# ----------------------------------------------------------------------------
# skew
# ----------------------------------------------------------------------------


def corrected_skew(col: str) -> Column:
    """Bias-corrected sample skewness G1 = g1 * sqrt(n (n-1)) / (n - 2)."""
    x = _value(col)
    n = F.count(x).cast("double")
    return F.try_multiply(F.skewness(x), F.try_divide(F.sqrt(n * (n - 1)), n - 2))


def skew_report(df: DataFrame, cols: list[str], threshold: float = 5.0) -> DataFrame:
    """(feature, skew, high_skew) for every numeric column, from one aggregate."""
    wide = df.agg(*[corrected_skew(c).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "skew")
    return long.select("feature", F.round("skew", 6).alias("skew"),
                       (F.abs("skew") > F.lit(threshold)).alias("high_skew"))


# ----------------------------------------------------------------------------
# correlation
# ----------------------------------------------------------------------------


def _centres(df: DataFrame, cols: list[str]) -> list[float]:
    """The mean of each column, or its value if it has only one: shifted by it, sums of squares don't cancel."""

    def stats(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, len(cols))
            there = ~np.isnan(x)
            part = [there.sum(axis=0), np.where(there, x, 0.0).sum(axis=0), np.where(there, x, np.inf).min(axis=0),
                    np.where(there, x, -np.inf).max(axis=0)]
            total = part if total is None else [f(a, b) for f, a, b in zip((np.add, np.add, np.minimum, np.maximum), total, part)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cols), dtype=np.int32)), pa.array(total[0].astype(np.int64)),
                                              *map(pa.array, total[1:])], ["i", "n", "s", "a", "b"])

    rows = df.select(F.array(*[_value(c) for c in cols]).alias("x"))
    parts = rows.mapInArrow(stats, "i int, n long, s double, a double, b double")
    out = [0.0] * len(cols)
    for r in parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("a").alias("a"), F.max("b").alias("b")).collect():
        if r["n"]:
            out[r["i"]] = r["a"] if r["a"] == r["b"] else r["s"] / r["n"]
    return out


def _pearson_sums(x, y):
    """Of two blocks of shifted columns: rows with both values, and the sums over these rows."""
    mx, my = ~np.isnan(x), ~np.isnan(y)
    x, y, mx, my = np.where(mx, x, 0.0), np.where(my, y, 0.0), mx.astype(float), my.astype(float)
    return mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y


def _correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, corr) for i <= j: pairwise-complete Pearson correlations, NULL where a column doesn't vary."""
    shifted = [_value(c) - F.lit(m) for c, m in zip(cols, _centres(df, cols))]
    sums = pair_sums(df, shifted, ["n", "sx", "sy", "sxx", "syy", "sxy"], _pearson_sums)
    mean = {c: F.try_divide(F.col(c), F.col("n")) for c in ("sx", "sy", "sxx", "syy", "sxy")}
    var_x, var_y = mean["sxx"] - mean["sx"] * mean["sx"], mean["syy"] - mean["sy"] * mean["sy"]
    corr = F.when((var_x > 0) & (var_y > 0), (mean["sxy"] - mean["sx"] * mean["sy"]) / F.sqrt(var_x * var_y))
    return sums.select("i", "j", F.nanvl(corr, F.lit(None).cast("double")).alias("corr"))


def correlation_matrix(df: DataFrame, cols: list[str], dataset: str | None = None) -> DataFrame:
    """Long (feature_x, feature_y, corr) for every ordered pair (pairwise-complete Pearson, NaN as missing)."""
    out = both_ways(_correlations(df, cols).withColumn("corr", F.round("corr", 6)), cols, "corr")
    if dataset is not None:
        out = out.select(F.lit(dataset).alias("dataset"), "*")
    return out


def high_correlation(df: DataFrame, cols: list[str], threshold: float = 0.95) -> DataFrame:
    """Upper-triangle pairs (x before y in column order) with corr above ``threshold``."""
    pairs = _correlations(df, cols).where((F.col("i") < F.col("j")) & (F.col("corr") > threshold))
    return named(pairs.withColumn("corr", F.round("corr", 6)), cols, "corr")


# ----------------------------------------------------------------------------
# histogram / density / box
# ----------------------------------------------------------------------------


def fd_bins(n: int, q1: float | None, q3: float | None, lo: float | None, hi: float | None,
            max_bins: int = 50) -> int:
    """Freedman-Diaconis bin count, capped (the distribution-plot default)."""
    if n < 2 or lo is None:
        return 1
    h = 2.0 * (q3 - q1) / (n ** (1.0 / 3.0))
    bins = int(math.sqrt(n)) if h == 0 else int(math.ceil((hi - lo) / h))
    return max(1, min(max_bins, bins))


def _ranges(df: DataFrame, cols: list[str]) -> dict:
    r = df.agg(*[F.count(_value(c)).alias(f"n{i}") for i, c in enumerate(cols)],
               *[F.min(_value(c)).alias(f"a{i}") for i, c in enumerate(cols)],
               *[F.max(_value(c)).alias(f"b{i}") for i, c in enumerate(cols)]).collect()[0]
    return {c: (r[f"n{i}"], r[f"a{i}"], r[f"b{i}"]) for i, c in enumerate(cols)}


def bin_edges(n, lo, hi, bins):
    if lo is None:
        return None, None
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return lo, (hi - lo) / bins


def histogram(df: DataFrame, cols: list[str], bins: int | dict | None = None,
              max_bins: int = 50) -> DataFrame:
    """(feature, bin, bin_lo, bin_hi, count): equal-width bins between min and max,
    the last bin closed; bin count by Freedman-Diaconis unless given."""
    rng = _ranges(df, cols)
    if bins is None:
        q = exact_quantiles(df, cols, [0.25, 0.75])
        nb = {c: fd_bins(rng[c][0], q[(c, .25)], q[(c, .75)], rng[c][1], rng[c][2], max_bins) for c in cols}
    elif isinstance(bins, int):
        nb = {c: bins for c in cols}
    else:
        nb = dict(bins)
    exprs, meta = [], {}
    for c in cols:
        n, a, b = rng[c]
        lo, w = bin_edges(n, a, b, nb[c])
        if lo is None:
            continue
        meta[c] = (lo, w, nb[c])
        x = _value(c)
        exprs.append(F.when(x.isNotNull(), F.least(F.lit(nb[c] - 1), F.floor((x - F.lit(lo)) / F.lit(w)).cast("int")))
                     .alias(c))
    if not meta:
        return df.sparkSession.createDataFrame([], "feature string, bin int, bin_lo double, bin_hi double, count bigint")
    long = unpivot_values(df.select(*exprs), list(meta)).where(F.col("value").isNotNull())
    counts = long.groupBy("feature", F.col("value").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    lo_map = F.create_map(*[x for c, (lo, w, k) in meta.items() for x in (F.lit(c), F.lit(lo))])
    w_map = F.create_map(*[x for c, (lo, w, k) in meta.items() for x in (F.lit(c), F.lit(w))])
    lo_c, w_c = F.element_at(lo_map, F.col("feature")), F.element_at(w_map, F.col("feature"))
    return counts.select("feature", "bin", F.round(lo_c + F.col("bin") * w_c, 6).alias("bin_lo"),
                         F.round(lo_c + (F.col("bin") + 1) * w_c, 6).alias("bin_hi"), "count")


def density(df: DataFrame, col: str, grid_size: int = 100, cut: float = 3.0,
            fine_bins: int = 1024) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth, std * n^(-1/5)) on a grid from
    min - cut*bw to max + cut*bw.

    An approximation whose fineness is the parameter ``fine_bins``: every value
    stands at the centre of its bin.  The data pass is one fine histogram (``fine_bins`` counts); the kernel sums
    run over those bounded bin counts: each bin row is exploded over the grid
    and summed per grid point, so the cost does not grow with the rows.
    """
    x = _value(col)
    r = df.agg(F.count(x).alias("n"), F.min(x).alias("a"), F.max(x).alias("b"),
               F.stddev_samp(x).alias("s")).collect()[0]
    n, a, b, s = r["n"], r["a"], r["b"], r["s"]
    spark = df.sparkSession
    if not n or s is None or s == 0:
        return spark.createDataFrame([], "feature string, grid int, x double, density double")
    bw = s * n ** (-0.2)
    lo, w = a, (b - a) / fine_bins
    g0, g1 = a - cut * bw, b + cut * bw
    step = (g1 - g0) / (grid_size - 1)
    fine = F.least(F.lit(fine_bins - 1), F.floor((x - F.lit(lo)) / F.lit(w)).cast("int"))
    counts = (df.select(F.when(x.isNotNull(), fine).alias("bin"))
              .where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("c")))
    centre = F.lit(lo) + (F.col("bin") + F.lit(0.5)) * F.lit(w)
    grid = F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("grid")
    pts = counts.select("bin", "c", centre.alias("centre"), grid)
    gx = F.lit(g0) + F.col("grid") * F.lit(step)
    z = (gx - F.col("centre")) / F.lit(bw)
    contrib = F.col("c") * F.exp(-0.5 * z * z)
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    return (pts.groupBy("grid").agg(F.sum(contrib).alias("k"))
            .select(F.lit(col).alias("feature"), "grid", F.round(gx, 6).alias("x"),
                    F.round(F.col("k") * F.lit(norm), 9).alias("density")))


def box_stats(df: DataFrame, cols: list[str], whisker: float = 1.5) -> DataFrame:
    """(feature, q1, median, q3, iqr, whisker_low, whisker_high, n_outliers)."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    aggs, fences = [], {}
    for i, c in enumerate(cols):
        q1, q3 = q[(c, .25)], q[(c, .75)]
        if q1 is None:
            continue
        lo, hi = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
        fences[c] = (lo, hi)
        x = _value(c)
        aggs += [F.min(F.when(x >= F.lit(lo), x)).alias(f"l{i}"),
                 F.max(F.when(x <= F.lit(hi), x)).alias(f"h{i}"),
                 F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"o{i}")]
    r = df.agg(*aggs).collect()[0] if aggs else None
    rows = []
    for i, c in enumerate(cols):
        if c not in fences:
            rows.append((c, None, None, None, None, None, None, 0))
            continue
        q1, md, q3 = q[(c, .25)], q[(c, .5)], q[(c, .75)]
        rows.append((c, q1, md, q3, q3 - q1, r[f"l{i}"], r[f"h{i}"], r[f"o{i}"]))
    out = df.sparkSession.createDataFrame(
        rows, "feature string, q1 double, median double, q3 double, iqr double, "
              "whisker_low double, whisker_high double, n_outliers bigint")
    return out.select("feature", *[F.round(c, 6).alias(c) for c in
                                   ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")], "n_outliers")


# ----------------------------------------------------------------------------
# categories
# ----------------------------------------------------------------------------


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, count) per label (nulls as their own label)."""
    long = unpivot_values(df, cols, cast="string")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))


def category_target_rate(df: DataFrame, cols: list[str], target: str, z: float = 1.96) -> DataFrame:
    """(feature, value, n, mean, ci_low, ci_high): target mean per label with a normal interval."""
    long = unpivot_values(df.select(*cols, target), cols, ids=[target], cast="string")
    g = long.groupBy("feature", "value").agg(F.count(F.col(target)).alias("n"),
                                             F.avg(target).alias("mean"),
                                             F.stddev_samp(target).alias("sd"))
    half = F.lit(z) * F.col("sd") / F.sqrt("n")
    return g.select("feature", "value", "n", F.round("mean", 6).alias("mean"),
                    F.round(F.col("mean") - half, 6).alias("ci_low"),
                    F.round(F.col("mean") + half, 6).alias("ci_high"))


# fixed values: cumulative Poisson(1) probabilities, k = 0..7 (inverse-CDF sampling of weights)
POISSON1_CDF = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
                0.9963401531726563, 0.9994058151824183, 0.9999167588507719, 0.9999897508033216]


def poisson1_weights(key: Column, draws: int) -> Column:
    """Poisson(1) weights of a row in all bootstrap draws, from hashes (no state, no shuffle).

    The uniform numbers are an array of their own, so that each hash is taken once.
    """
    us = F.transform(F.sequence(F.lit(1), F.lit(draws)), lambda d: F.conv(F.substring(F.md5(F.concat_ws(
        ":", key.cast("string"), d.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)))

    def weight(u: Column) -> Column:
        w = F.lit(float(len(POISSON1_CDF)))
        for k in range(len(POISSON1_CDF) - 1, -1, -1):
            w = F.when(u < F.lit(POISSON1_CDF[k]), F.lit(float(k))).otherwise(w)
        return w

    return F.transform(us, weight)


def category_target_rate_bootstrap(df: DataFrame, cols: list[str], target: str, key: str,
                                   draws: int = 100, level: float = 0.95) -> DataFrame:
    """Target mean per label with a Poisson-bootstrap percentile interval.

    A row carries the hashed Poisson(1) weights of all draws in one array, and the weighted
    sums of all draws are columns of one aggregate per label: each task sends one row per label,
    no row is copied per draw.  The interval is an exact percentile over the means of a label.
    """
    rows = df.select(*cols, target, poisson1_weights(F.col(key), draws).alias("__w"))
    long = unpivot_values(rows, cols, ids=[target, "__w"], cast="string")
    sums = [f(F.col("__w")[d]).alias(f"{n}{d}") for d in range(draws)
            for n, f in (("w", F.sum), ("t", lambda w: F.sum(w * F.col(target))))]
    per = long.groupBy("feature", "value").agg(F.count(F.col(target)).alias("n"), F.avg(target).alias("mean"), *sums)
    means = F.array(*[F.try_divide(F.col(f"t{d}"), F.col(f"w{d}")) for d in range(draws)])
    # a draw without a row of the label has no mean; the others are interpolated
    # linearly at (draws - 1) * q, the quantile_cont definition
    ms = per.select("feature", "value", "n", "mean", F.array_sort(F.array_compact(means)).alias("ms"))
    lo, hi = round((1 - level) / 2, 12), round(1 - (1 - level) / 2, 12)

    def at(q: float) -> Column:
        pos = (F.size("ms") - 1).cast("double") * F.lit(q)
        i0, i1 = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
        v0, v1 = F.get("ms", i0), F.get("ms", i1)
        return v0 + (v1 - v0) * (pos - i0)

    return ms.select("feature", "value", "n", F.round("mean", 6).alias("mean"),
                     F.round(at(lo), 6).alias("ci_low"), F.round(at(hi), 6).alias("ci_high"))


def column_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, n, min, max, mean, median, mode): one aggregate, exact medians, distributed modes."""
    from ferret.operators.cleaning import fit_modes
    df = nan_to_null(df)
    r = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
               *[F.min(_value(c)).alias(f"a{i}") for i, c in enumerate(cols)],
               *[F.max(_value(c)).alias(f"b{i}") for i, c in enumerate(cols)],
               *[F.avg(_value(c)).alias(f"m{i}") for i, c in enumerate(cols)]).collect()[0]
    med = exact_quantiles(df, cols, [0.5])
    mode = fit_modes(df, cols)
    rows = [(c, r[f"n{i}"], r[f"a{i}"], r[f"b{i}"], r[f"m{i}"], med[(c, 0.5)],
             None if mode[c] is None else float(mode[c])) for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(
        rows, "feature string, n bigint, min double, max double, mean double, median double, mode double")
    return out.select("feature", "n", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "median", "mode")])


def target_distribution(df: DataFrame, target: str, problem: str) -> DataFrame:
    """Classification: (value, count) per class.  Regression: histogram of the target."""
    if problem == "regression":
        return histogram(df, [target]).drop("feature")
    return df.groupBy(F.col(target).alias("value")).agg(F.count(F.lit(1)).alias("count"))
