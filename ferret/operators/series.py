"""Time-series operators: positions within a series, simple exponential smoothing.

Simple exponential smoothing is the linear recurrence
``l_t = alpha * y_t + (1 - alpha) * l_{t-1}`` with ``l_1 = y_1``.  It is
computed by ``exp_scan``: the series is cut into chunks of C consecutive
positions; inside a chunk the level is a windowed prefix sum of
``beta^-o * x`` (bounded window: C rows); the level carried into each chunk is
the same scan one level up, over one row per chunk with decay ``beta^C``.  The
recursion stops when a whole series fits one chunk.  No window ever holds
more than C rows, so one very long series is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferret.operators.rank import global_rank, running_totals
from ferret.plans.sizing import checked_broadcast

MAX_CHUNK = 1024
EXP_BUDGET = 300.0  # beta^-C stays below e^300


def series_positions(df: DataFrame, key: str, order: str, tiebreak: str,
                     pos_col: str = "pos") -> DataFrame:
    """Add ``pos`` (1-based position inside each series by ``order``) and ``n`` (series length).

    One distributed rank over (key, order, tiebreak) plus per-series start offsets from
    running totals over the per-series counts; no per-series window.
    """
    ranked = global_rank(df, [F.col(key), F.col(order)], [tiebreak], rank_col="_g")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    starts = running_totals(counts, [F.col(key)], ["n"], prefix="_c_").select(
        key, "n", (F.col("_c_n") - F.col("n")).alias("_start"))
    out = ranked.join(checked_broadcast(starts), key)
    return out.withColumn(pos_col, F.col("_g") - F.col("_start")).drop("_g", "_start")


def positional_slice(df: DataFrame, key: str, order: str, tiebreak: str, n_train: int | None = None,
                     frac: float | None = None) -> DataFrame:
    """'train' for the first ``n_train`` (or ``frac`` of each series) positions, else 'test'."""
    p = series_positions(df, key, order, tiebreak)
    if n_train is not None:
        cut = F.lit(n_train)
    else:
        cut = F.floor(F.col("n") * F.lit(frac))
    return p.withColumn("part", F.when(F.col("pos") <= cut, "train").otherwise("test"))


def _chunk_size(beta_min: float) -> int:
    if beta_min >= 1.0:
        return MAX_CHUNK
    if beta_min <= 0.0:
        raise ValueError("decay must be > 0 (alpha < 1)")
    return max(2, min(MAX_CHUNK, int(EXP_BUDGET / -math.log(beta_min))))


def exp_scan(df: DataFrame, keys: list[str], pos: str, x: str, beta: str, out: str,
             chunk: int | None = None, max_pos: int | None = None,
             beta_min: float | None = None) -> DataFrame:
    """``out_t = sum_{j <= t} beta^(t - j) * x_j`` within each key group (pos dense from 1).

    ``beta`` is a column (constant within a group), in (0, 1].  Callers that know the
    smallest decay and the longest group pass ``beta_min`` / ``max_pos`` and the scan
    runs no extra action; otherwise each is one small aggregate.
    """
    if beta_min is None:
        beta_min = df.agg(F.min(beta)).collect()[0][0]
        beta_min = 1.0 if beta_min is None else beta_min
    if chunk is None:
        chunk = _chunk_size(beta_min)
    C = chunk
    b, p = F.col(beta), F.col(pos) - 1
    d = (df.withColumn("_c", F.floor(p / C).cast("long"))
         .withColumn("_o", (p % C).cast("long")))
    w = (Window.partitionBy(*keys, "_c").orderBy("_o")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_loc", F.pow(b, F.col("_o").cast("double"))
                     * F.sum(F.pow(b, -F.col("_o").cast("double")) * F.col(x)).over(w))
    if max_pos is None:
        max_pos = df.agg(F.max(pos)).collect()[0][0] or 0
    if max_pos <= C:
        return d.withColumn(out, F.col("_loc")).drop("_c", "_o", "_loc")
    # one row per chunk: T_c = level at the chunk end without carry-in
    summ = d.groupBy(*keys, "_c").agg(
        F.max(F.struct("_o", "_loc")).getField("_loc").alias("_T"),
        F.first(beta).alias("_b"))
    summ = summ.select(*keys, (F.col("_c") + 1).alias("_cpos"), "_T",
                       F.pow(F.col("_b"), F.lit(float(C))).alias("_bC"))
    # E_c = level at the end of chunk c (full chunks before the last): same scan one level up
    bmin_c = beta_min ** C  # smallest decay one level up, known without looking at the data
    chunk_c = MAX_CHUNK if bmin_c <= 0.0 else _chunk_size(bmin_c)
    carry_col = "_carry" + out  # unique per level: a deeper level's carry never meets this one
    ends = exp_scan(summ, keys, "_cpos", "_T", "_bC", carry_col, chunk=chunk_c,
                    max_pos=-(-max_pos // C), beta_min=bmin_c)
    # carry into chunk _cpos (0-based); the carry table derives from d itself, so its key
    # columns get fresh names - comparing d[k] with carry[k] would be an ambiguous self-join
    ck = [f"_ck{i}" for i in range(len(keys))]
    carry = ends.select(*[F.col(k).alias(c) for k, c in zip(keys, ck)],
                        F.col("_cpos").alias("_cnext"), carry_col)
    d = d.join(carry, [*[F.col(k) == F.col(c) for k, c in zip(keys, ck)], F.col("_c") == F.col("_cnext")],
               "left").drop(*ck)
    level = F.col("_loc") + F.coalesce(F.pow(b, (F.col("_o") + 1).cast("double")) * F.col(carry_col), F.lit(0.0))
    return d.withColumn(out, level).drop("_c", "_o", "_loc", "_cnext", carry_col)


def ses_levels(df: DataFrame, keys: list[str], pos: str, y: str, alpha: str,
               alpha_max: float | None = None, max_len: int | None = None) -> DataFrame:
    """Add ``level`` and one-step-ahead ``fitted`` (fitted_1 = y_1, fitted_t = level_{t-1})."""
    a = F.col(alpha)
    d = df.withColumn("_x", F.when(F.col(pos) == 1, F.col(y)).otherwise(a * F.col(y))) \
          .withColumn("_beta", F.lit(1.0) - a)
    d = exp_scan(d, keys, pos, "_x", "_beta", "level", max_pos=max_len,
                 beta_min=None if alpha_max is None else 1.0 - alpha_max)
    fitted = F.when(F.col(pos) == 1, F.col(y)).otherwise((F.col("level") - a * F.col(y)) / F.col("_beta"))
    return d.withColumn("fitted", fitted).drop("_x", "_beta")


def ses_fixed(df: DataFrame, key: str, order: str, tiebreak: str, y: str,
              alphas: tuple[float, ...] = (0.2, 0.6)) -> DataFrame:
    """Fitted values of simple exponential smoothing for each fixed alpha."""
    if any(not 0.0 < a < 1.0 for a in alphas):
        raise ValueError("alpha must lie in (0, 1)")
    p = series_positions(df, key, order, tiebreak)
    longest = _longest(df, key)
    p = p.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))
    return ses_levels(p, [key, "alpha"], "pos", y, "alpha", max(alphas), longest)


def _longest(df: DataFrame, key: str) -> int:
    """Length of the longest series: one partial+final aggregate over per-series counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).collect()[0][0] or 0


def ses_forecast(levels: DataFrame, key: str, horizon: int = 3) -> DataFrame:
    """Flat forecast: the last level of each (series, alpha) repeated ``horizon`` steps."""
    last = levels.where(F.col("pos") == F.col("n")).select(key, "alpha", "level")
    return last.select(key, "alpha", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"),
                       F.col("level").alias("forecast"))


def ses_optimised(df: DataFrame, key: str, order: str, tiebreak: str, y: str) -> DataFrame:
    """Per series, the alpha that minimises the squared one-step error, and that error (see ``smoothing.py``)."""
    from ferret.operators.smoothing import best_alpha
    return best_alpha(df, key, order, tiebreak, y)
