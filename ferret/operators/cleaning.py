"""Cleaning and feature transforms: fit = a few aggregates, transform = expressions.

Every ``fit_*`` returns a small parameter object (a handful of numbers per
column, or a per-category table); every transform is a ``Column`` expression,
so a fitted pipeline applies as one lazy ``select``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferret.operators import power
from ferret.operators.columns import is_missing, kinds, unpivot_values, nan_to_null
from ferret.operators.rank import exact_quantiles, global_rank
from ferret.session import checkpoint_dir

# ----------------------------------------------------------------------------
# imputation
# ----------------------------------------------------------------------------


def fit_medians(df: DataFrame, cols: list[str], approximate: bool = False,
                accuracy: int = 10_000) -> dict[str, float | None]:
    """Exact medians (midpoint of the two middle values for even counts).

    ``approximate=True`` trades exactness for one pass (``percentile_approx``).
    """
    if approximate:
        if not cols:
            return {}
        r = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(f"m{i}")
                     for i, c in enumerate(cols)]).collect()[0]
        return {c: r[f"m{i}"] for i, c in enumerate(cols)}
    q = exact_quantiles(df, cols, [0.5])
    return {c: q[(c, 0.5)] for c in cols}


def fit_modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """Most frequent non-null value per column; the smallest value wins ties.

    Distributed: unpivot -> count per (column, value) with map-side partial
    aggregation (a hot value collapses to one row per task) -> one ``min_by``
    per column over the counts.
    """
    out: dict[str, object] = {c: None for c in cols}
    kd = kinds(df)
    groups = {"string": [], "integral": [], "fractional": []}
    for c in cols:
        groups.get(kd[c], groups["string"]).append(c)
    for kind_name, cast in (("string", "string"), ("integral", "bigint"), ("fractional", "double")):
        gcols = groups[kind_name]
        if not gcols:
            continue
        long = unpivot_values(df, gcols, cast=cast).where(F.col("value").isNotNull())
        if kind_name == "fractional":
            long = long.where(~F.isnan("value"))
        cnt = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        best = cnt.groupBy("feature").agg(
            F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("mode"))
        for r in best.collect():
            out[r["feature"]] = r["mode"]
    return out


def impute(col: str, value) -> Column:
    """``coalesce(col, value)`` (NaN counts as missing for float columns)."""
    x = F.col(col)
    if value is None:
        return x
    return F.when(x.isNull() | (F.isnan(x) if isinstance(value, float) else F.lit(False)),
                  F.lit(value)).otherwise(x)


def impute_by_dtype(df: DataFrame, threshold: float = 0.25, prefix: str = "imputed_") -> list[Column]:
    """Columns that fill what is missing in at most ``threshold`` of the rows: fractional ones with
    the median, strings with the mode (columns with more missing values, or none, are left out)."""
    from ferret.operators.nullity import nan_split
    todo = [r["feature"] for r in nan_split(df, threshold).where("status = 'impute'").collect()]
    kd = kinds(df)
    num = [c for c in todo if kd[c] == "fractional"]
    obj = [c for c in todo if kd[c] == "string"]
    fill = {**fit_medians(df, num), **fit_modes(df, obj)}
    return [impute(c, fill[c]).alias(prefix + c) for c in num + obj]


def split_in_outliers(df: DataFrame, model: HBOSModel) -> DataFrame:
    """``df`` with ``part``: 'outlier' above the model's threshold, else 'inlier' (one scoring of the table)."""
    flag = hbos_label(hbos_score(model), model.threshold)
    return df.withColumn("part", F.when(flag == 1, "outlier").otherwise("inlier"))


def fill_null_zero(df: DataFrame) -> DataFrame:
    return df.fillna(0)


# ----------------------------------------------------------------------------
# missing indicators
# ----------------------------------------------------------------------------


def fit_missing_flags(df: DataFrame, cols: list[str], extra: list[Column] | None = None):
    """Columns (in order) with at least one missing value in ``df``.

    ``extra`` aggregates ride along in the same pass; then (flags, their values) is returned.
    """
    extra = extra or []
    if not cols and not extra:
        return ([], []) if extra else []
    r = df.agg(*[F.max(is_missing(df, c).cast("int")).alias(f"m{i}") for i, c in enumerate(cols)],
               *[e.alias(f"x{j}") for j, e in enumerate(extra)]).collect()[0]
    flags = [c for i, c in enumerate(cols) if r[f"m{i}"]]
    if extra:
        return flags, [r[f"x{j}"] for j in range(len(extra))]
    return flags


def missing_flags(df: DataFrame, cols: list[str], prefix: str = "missing_") -> list[Column]:
    return [is_missing(df, c).cast("int").alias(prefix + c) for c in cols]


# ----------------------------------------------------------------------------
# power transforms (SQL text so the oracle runs the identical formula)
# ----------------------------------------------------------------------------


def _num(v: float) -> str:
    return format(float(v), ".17e")


def yeo_johnson_sql(x: str, lam: float) -> str:
    pos = f"ln({x} + 1.0e0)" if abs(lam) < 1e-12 else \
        f"(power({x} + 1.0e0, {_num(lam)}) - 1.0e0) / {_num(lam)}"
    neg = f"-ln(1.0e0 - {x})" if abs(lam - 2) < 1e-12 else \
        f"-(power(1.0e0 - {x}, {_num(2 - lam)}) - 1.0e0) / {_num(2 - lam)}"
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 0 THEN {pos} ELSE {neg} END)"


def boxcox_sql(x: str, lam: float) -> str:
    body = f"ln({x})" if abs(lam) < 1e-12 else f"(power({x}, {_num(lam)}) - 1.0e0) / {_num(lam)}"
    return f"(CASE WHEN {x} > 0 THEN {body} ELSE NULL END)"


def _q(c: str) -> str:
    return f"`{c}`"


def yeo_johnson(col: str, lam: float) -> Column:
    return F.expr(yeo_johnson_sql(_q(col), lam))


def boxcox(col: str, lam: float) -> Column:
    return F.expr(boxcox_sql(_q(col), lam))


@dataclass
class PowerFit:
    lam: float
    llf: float
    mean: float | None = None
    std: float | None = None


def fit_power(df: DataFrame, cols: list[str], method: str = "yeo-johnson", lo: float = -10.0, hi: float = 10.0,
              standardize: bool = True) -> dict[str, PowerFit]:
    """Maximum-likelihood lambda per column, to 1e-9, between ``lo`` and ``hi``.

    A handful of aggregates whatever the number of columns (``operators/power.py``);
    mean and deviation come from the pass that confirmed the lambda.
    """
    if not cols:
        return {}
    best, _ = power.maximise(df, cols, method, lo, hi)
    fits = {c: PowerFit(p.lam, p.llf) for c, p in best.items()}
    if standardize:
        for c, p in best.items():
            fits[c].mean, fits[c].std = p.mean, p.std
    return fits


def fit_standardize(df: DataFrame, cols: list[str], fits: dict[str, PowerFit], method: str) -> None:
    fn = yeo_johnson_sql if method == "yeo-johnson" else boxcox_sql
    aggs = []
    for i, c in enumerate(cols):
        t = fn(_q(c), fits[c].lam)
        aggs += [F.expr(f"avg({t})").alias(f"m{i}"), F.expr(f"stddev_pop({t})").alias(f"s{i}")]
    r = df.agg(*aggs).collect()[0]
    for i, c in enumerate(cols):
        fits[c].mean, fits[c].std = r[f"m{i}"], r[f"s{i}"]


def power_transform(col: str, fit: PowerFit, method: str = "yeo-johnson",
                    standardize: bool = True) -> Column:
    t = yeo_johnson(col, fit.lam) if method == "yeo-johnson" else boxcox(col, fit.lam)
    if not standardize or fit.mean is None:
        return t
    centred = t - F.lit(fit.mean)
    if not fit.std:
        return centred
    return centred / F.lit(fit.std)


def log_likelihood(df: DataFrame, col: str, lam: float, method: str = "yeo-johnson") -> float:
    return power.evaluate(df, {col: [lam]}, method)[col][0].llf


# ----------------------------------------------------------------------------
# simple positive-only transforms (G1)
# ----------------------------------------------------------------------------


def positive_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns whose minimum is > 0 (the guard for log, Box-Cox and reciprocal)."""
    if not cols:
        return []
    r = df.agg(*[F.min(c).alias(f"m{i}") for i, c in enumerate(cols)]).collect()[0]
    return [c for i, c in enumerate(cols) if r[f"m{i}"] is not None and r[f"m{i}"] > 0]


def log_transform(col: str) -> Column:
    return F.log(F.col(col)).alias(col + "_log")


def reciprocal_transform(col: str) -> Column:
    return F.try_divide(F.lit(1.0), F.col(col)).alias(col + "_inverted")


def transform_numerics(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> list[Column]:
    """Every transform of every numeric column, lambdas fitted on ``fit_on`` (default: ``df`` itself).

    ``<c>_log``, ``<c>_boxcox`` and ``<c>_inverted`` for columns whose values are all
    positive, ``<c>_yeo`` for all of them; not standardised.
    """
    train = df if fit_on is None else fit_on
    positive = positive_columns(train, cols)
    yeo = fit_power(train, cols, standardize=False)
    box = fit_power(train, positive, method="box-cox", standardize=False)
    out = []
    for c in cols:
        if c in positive:
            out += [log_transform(c), power_transform(c, box[c], "box-cox", False).alias(c + "_boxcox"), reciprocal_transform(c)]
        out.append(power_transform(c, yeo[c], standardize=False).alias(c + "_yeo"))
    return out


def log1p_target(col: str, problem: str) -> Column:
    return F.log1p(F.col(col)).alias(col) if problem == "regression" else F.col(col)


# ----------------------------------------------------------------------------
# label encoding
# ----------------------------------------------------------------------------


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Category -> 0-based index in ascending sorted order (nulls stay null).

    Distinct values are ranked with the distributed ``global_rank`` (no
    single-task window), then joined back: broadcast only when the code table is
    small, checked by count.
    """
    from ferret.plans.sizing import checked_broadcast
    out = out or col + "_encoded"
    codes = global_rank(df.select(col).where(F.col(col).isNotNull()).distinct(), [F.col(col)], [],
                        rank_col="_r").select(col, (F.col("_r") - 1).alias(out))
    return df.join(checked_broadcast(codes), col, "left")


# ----------------------------------------------------------------------------
# target encoding
# ----------------------------------------------------------------------------


@dataclass
class TargetEncoding:
    prior: float
    table: DataFrame                     # (feature, value string, n, encoding)
    small: dict[str, dict] = field(default_factory=dict)  # collected lookups


def fit_target_encoding(df: DataFrame, cols: list[str], target: str, min_samples_leaf: int = 1,
                        smoothing: float = 1.0, single_to_prior: bool = True,
                        max_literal: int = 32, method: str = "sigmoid",
                        prior: float | None = None) -> TargetEncoding:
    """Smoothed per-category target mean.

    ``method='sigmoid'`` (default): weight = 1 / (1 + exp(-(count - min_samples_leaf) / smoothing)),
    and a category seen once gets the prior when ``single_to_prior``.
    ``method='additive'``: weight = count / (count + smoothing) (Spark's own encoder).
    encoding = prior * (1 - weight) + mean * weight.  Unseen categories get the prior.
    Features with at most ``max_literal`` categories become a literal map (searched in order, hence
    few); the others stay a table that ``apply_target_encoding`` joins, broadcast if measured to be small.
    """
    if prior is None:
        prior = df.agg(F.avg(target).alias("p")).collect()[0]["p"]
    long = unpivot_values(df.select(*cols, target), cols, ids=[target], cast="string") \
        .where(F.col("value").isNotNull())
    stats = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"),
                                                 F.avg(target).alias("mean"))
    if method == "additive":
        w = F.col("n") / (F.col("n") + F.lit(smoothing))
    else:
        w = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(min_samples_leaf)) / F.lit(smoothing)))
    enc = F.lit(prior) * (1.0 - w) + F.col("mean") * w
    if single_to_prior and method != "additive":
        enc = F.when(F.col("n") == 1, F.lit(prior)).otherwise(enc)
    te = TargetEncoding(prior, stats.select("feature", "value", "n", enc.alias("encoding")))
    # categories are counted without being collected; only features with few of them are
    place = F.row_number().over(Window.partitionBy("feature").orderBy("value"))
    few = te.table.withColumn("_k", place).where(F.col("_k") <= max_literal + 1).collect() if max_literal else []
    for r in few:
        te.small.setdefault(r["feature"], {})[r["value"]] = r["encoding"]
    te.small = {c: te.small.get(c, {}) for c in cols if max_literal and len(te.small.get(c, {})) <= max_literal}
    if len(te.small) < len(cols):  # joined later, when the rows it was counted from may be gone from memory
        checkpoint_dir(df.sparkSession)
        te.table = te.table.checkpoint()
    return te


def target_encode_col(te: TargetEncoding, col: str, out: str | None = None) -> Column | None:
    """Expression for a small lookup (map literal); None when the table is large."""
    if col not in te.small:
        return None
    m = te.small[col]
    key = F.col(col).cast("string")
    if m:
        lookup = F.create_map(*[x for k, v in sorted(m.items()) for x in (F.lit(k), F.lit(v))])
        val = F.coalesce(F.element_at(lookup, key), F.lit(te.prior))
    else:
        val = F.lit(te.prior)
    return val.alias(out or col)


def apply_target_encoding(df: DataFrame, te: TargetEncoding, cols: list[str],
                          names: dict[str, str] | None = None) -> DataFrame:
    """Add encoded columns; large lookups go through a (size-checked) join."""
    from ferret.plans.sizing import checked_broadcast
    names = names or {c: c + "_te" for c in cols}
    exprs = [target_encode_col(te, c, names[c]) for c in cols if c in te.small]
    out = df.select("*", *exprs) if exprs else df
    for c in cols:
        if c in te.small:
            continue
        lk = te.table.where(F.col("feature") == c).select(
            F.col("value").alias("_k"), F.col("encoding").alias(names[c]))
        out = out.join(checked_broadcast(lk), F.col(c).cast("string") == F.col("_k"), "left") \
            .drop("_k").withColumn(names[c], F.coalesce(F.col(names[c]), F.lit(te.prior)))
    return out


# ----------------------------------------------------------------------------
# HBOS (histogram-based outlier score, Goldstein & Dengel 2012)
# ----------------------------------------------------------------------------


@dataclass
class HBOSModel:
    cols: list[str]
    lo: dict[str, float]
    width: dict[str, float]
    n_bins: int
    log_density: dict[str, list[float]]   # log2(density + alpha) per bin
    tol: float
    threshold: float | None = None


def fit_hbos(df: DataFrame, cols: list[str], n_bins: int = 10, alpha: float = 0.1,
             tol: float = 0.5) -> HBOSModel:
    """Equal-width histograms per feature: one min/max aggregate + one count per (feature, bin)."""
    df = nan_to_null(df)
    r = df.agg(F.count(F.lit(1)).alias("__n"),
               *[F.min(c).alias(f"a{i}") for i, c in enumerate(cols)],
               *[F.max(c).alias(f"b{i}") for i, c in enumerate(cols)]).collect()[0]
    n = max(1, r["__n"])
    lo, width = {}, {}
    for i, c in enumerate(cols):
        # a column without any value gets an empty histogram: every value is equally unusual there
        a, b = (0.0, 0.0) if r[f"a{i}"] is None else (float(r[f"a{i}"]), float(r[f"b{i}"]))
        if a == b:
            a, b = a - 0.5, b + 0.5
        lo[c], width[c] = a, (b - a) / n_bins
    model = HBOSModel(cols, lo, width, n_bins, {}, tol)
    bins = df.select(*[_bin_expr(model, c).alias(c) for c in cols])
    counts = {(x["feature"], x["value"]): x["n"] for x in
              unpivot_values(bins, cols).groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    for c in cols:
        dens = [counts.get((c, b), 0) / (n * width[c]) for b in range(n_bins)]
        model.log_density[c] = [math.log2(d + alpha) for d in dens]
    return model


def _number(c: str) -> Column:
    """As double, with NaN as NULL: one notion of missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _bin_expr(model: HBOSModel, c: str) -> Column:
    x = _number(c)
    # least() skips NULL arguments: keep a missing value out of every bin
    return F.when(x.isNotNull(), F.least(F.lit(model.n_bins - 1),
                  F.floor((x - F.lit(model.lo[c])) / F.lit(model.width[c])).cast("int")))


HBOS_UNROLL_MAX = 16  # up to this many features the score is unrolled (codegen); above, one HOF


def hbos_score(model: HBOSModel) -> Column:
    """Outlier score = -sum over features of log2(density(bin) + alpha)."""
    if len(model.cols) > HBOS_UNROLL_MAX:
        return _hbos_score_hof(model)
    total = None
    for c in model.cols:
        x = _number(c)
        lo, w, nb = model.lo[c], model.width[c], model.n_bins
        hi = lo + w * nb
        ld = model.log_density[c]
        arr = F.array(*[F.lit(v) for v in ld])
        inside = F.element_at(arr, _bin_expr(model, c) + 1)
        worst = F.lit(min(ld))
        term = (F.when(x.isNull(), worst)
                .when(x < F.lit(lo), F.when(F.lit(lo) - x <= F.lit(w * model.tol), F.lit(ld[0])).otherwise(worst))
                .when(x > F.lit(hi), F.when(x - F.lit(hi) <= F.lit(w * model.tol), F.lit(ld[-1])).otherwise(worst))
                .otherwise(inside))
        total = term if total is None else total + term
    return (-total).alias("hbos_score")


def _hbos_score_hof(model: HBOSModel) -> Column:
    """Same score as one ``aggregate`` over the feature index: the expression size does not
    grow with the number of features (per-feature parameters are literal arrays)."""
    cols, nb, tol = model.cols, model.n_bins, model.tol
    xs = F.array(*[_number(c) for c in cols])
    los = F.array(*[F.lit(model.lo[c]) for c in cols])
    ws = F.array(*[F.lit(model.width[c]) for c in cols])
    lds = F.array(*[F.array(*[F.lit(v) for v in model.log_density[c]]) for c in cols])
    worst = F.array(*[F.lit(min(model.log_density[c])) for c in cols])

    def term(acc, i):
        x, lo, w, ld, bad = F.get(xs, i), F.get(los, i), F.get(ws, i), F.get(lds, i), F.get(worst, i)
        hi = lo + w * F.lit(float(nb))
        b = F.least(F.lit(nb - 1), F.floor((x - lo) / w).cast("int"))
        t = (F.when(x.isNull(), bad)
             .when(x < lo, F.when(lo - x <= w * F.lit(tol), F.get(ld, F.lit(0))).otherwise(bad))
             .when(x > hi, F.when(x - hi <= w * F.lit(tol), F.get(ld, F.lit(nb - 1))).otherwise(bad))
             .otherwise(F.get(ld, b)))
        return acc + t

    total = F.aggregate(F.sequence(F.lit(0), F.lit(len(cols) - 1)), F.lit(0.0), term)
    return (-total).alias("hbos_score")


def fit_hbos_threshold(scored_train: DataFrame, contamination: float = 0.1,
                       score_col: str = "hbos_score") -> float:
    q = 1.0 - contamination
    return exact_quantiles(scored_train, [score_col], [q])[(score_col, q)]


def hbos_label(score: Column, threshold: float) -> Column:
    return (score > F.lit(threshold)).cast("int").alias("HBOS")
