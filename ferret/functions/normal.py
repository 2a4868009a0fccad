"""Normal distribution functions as SQL expressions.

Spark has no ``erf`` or probit. Both functions are emitted as SQL text built
from plain arithmetic, so the very same expression runs in Spark
(``F.expr``) and in DuckDB (the oracle).

Fixed values: the coefficients below are published constants and must not
change.  ``CDF_*`` are Hart's double-precision rational approximation of the
normal tail as given by G. West (2005), "Better approximations to cumulative
normal functions".  ``PPF_*`` are P. J. Acklam's rational approximation of the
normal quantile (relative error 1.15e-9), refined by one Halley step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (West 2005 / Hart 1968) ---------------------------------
CDF_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165,
           33.912866078383, 112.079291497871, 221.213596169931,
           220.206867912376]
CDF_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207,
           86.7807322029461, 296.564248779674, 637.333633378831,
           793.826512519948, 440.413735824752]
CDF_SPLIT = 7.07106781186547
CDF_SQRT_2PI = 2.506628274631

# --- fixed values (Acklam) -------------------------------------------------
PPF_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
PPF_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
PPF_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
PPF_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00]
PPF_LOW = 0.02425


def _lit(v: float) -> str:
    # exponent form keeps the literal a DOUBLE in both Spark and DuckDB
    return format(float(v), ".17e")


def _horner(coefs: list[float], x: str) -> str:
    expr = _lit(coefs[0])
    for c in coefs[1:]:
        expr = f"({expr} * {x} + {_lit(c)})"
    return expr


def norm_cdf_sql(x: str) -> str:
    """Standard normal CDF of SQL expression ``x``."""
    a = f"abs({x})"
    e = f"exp(-({a}) * ({a}) / 2.0e0)"
    inner = f"({e} * {_horner(CDF_NUM, a)} / {_horner(CDF_DEN, a)})"
    frac = f"({a} + 0.65e0)"
    for k in (4, 3, 2, 1):
        frac = f"({a} + {k}.0e0 / {frac})"
    outer = f"({e} / {frac} / {_lit(CDF_SQRT_2PI)})"
    tail = (f"(CASE WHEN {a} > 37.0e0 THEN 0.0e0 "
            f"WHEN {a} < {_lit(CDF_SPLIT)} THEN {inner} ELSE {outer} END)")
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} > 0.0e0 THEN 1.0e0 - {tail} ELSE {tail} END)"


def _acklam_sql(p: str) -> str:
    q_low = f"sqrt(-2.0e0 * ln({p}))"
    q_high = f"sqrt(-2.0e0 * ln(1.0e0 - {p}))"
    low = f"({_horner(PPF_C, q_low)} / ({_horner(PPF_D + [1.0], q_low)}))"
    high = f"(-{_horner(PPF_C, q_high)} / ({_horner(PPF_D + [1.0], q_high)}))"
    q = f"({p} - 0.5e0)"
    r = f"({q} * {q})"
    mid = f"({_horner(PPF_A, r)} * {q} / {_horner(PPF_B + [1.0], r)})"
    return (f"(CASE WHEN {p} < {_lit(PPF_LOW)} THEN {low} "
            f"WHEN {p} > {_lit(1 - PPF_LOW)} THEN {high} ELSE {mid} END)")


def norm_ppf_sql(p: str, refine: bool = True) -> str:
    """Standard normal quantile of SQL expression ``p`` in (0, 1); NULL outside."""
    x0 = _acklam_sql(p)
    if refine:
        # one Halley step: e = cdf(x) - p ; u = e * sqrt(2 pi) * exp(x^2 / 2)
        e = f"({norm_cdf_sql(x0)} - {p})"
        u = f"({e} * {_lit(math.sqrt(2 * math.pi))} * exp({x0} * {x0} / 2.0e0))"
        x = f"({x0} - {u} / (1.0e0 + {x0} * {u} / 2.0e0))"
    else:
        x = x0
    return f"(CASE WHEN {p} > 0.0e0 AND {p} < 1.0e0 THEN {x} ELSE NULL END)"


def with_norm_ppf(df, p_col: str, out_col: str):
    """Add ``out_col`` = Phi^-1(p_col) in three projections.

    The refined quantile references the first approximation several times;
    staging it as columns keeps each expression small enough for whole-stage
    codegen (Catalyst does not inline a non-trivial expression used twice).
    """
    p = f"`{p_col}`"
    df = df.withColumn("__ppf_x0", F.expr(_acklam_sql(p)))
    df = df.withColumn("__ppf_e", F.expr(f"({norm_cdf_sql('`__ppf_x0`')} - {p})"))
    x0, e = "`__ppf_x0`", "`__ppf_e`"
    u = f"({e} * {_lit(math.sqrt(2 * math.pi))} * exp({x0} * {x0} / 2.0e0))"
    x = f"({x0} - {u} / (1.0e0 + {x0} * {u} / 2.0e0))"
    df = df.withColumn(out_col, F.expr(f"(CASE WHEN {p} > 0.0e0 AND {p} < 1.0e0 THEN {x} ELSE NULL END)"))
    return df.drop("__ppf_x0", "__ppf_e")


def norm_ppf_steps_sql(source: str, p_cols: dict[str, str], name: str) -> str:
    """CTEs that add Phi^-1 of columns to ``source``: {p column: out column}, the last CTE called ``name``.

    The refined quantile needs its first approximation several times; as
    columns of their own the steps stay small (the SQL form of :func:`with_norm_ppf`).
    """
    first = ", ".join(f"{_acklam_sql(p)} AS x0_{p}" for p in p_cols)
    error = ", ".join(f"({norm_cdf_sql(f'x0_{p}')} - {p}) AS e_{p}" for p in p_cols)

    def last(p):
        u = f"(e_{p} * {_lit(math.sqrt(2 * math.pi))} * exp(x0_{p} * x0_{p} / 2.0e0))"
        return f"(CASE WHEN {p} > 0.0e0 AND {p} < 1.0e0 THEN x0_{p} - {u} / (1.0e0 + x0_{p} * {u} / 2.0e0) ELSE NULL END) AS {p_cols[p]}"

    return (f"{name}_0 AS MATERIALIZED (SELECT *, {first} FROM {source}),\n{name}_1 AS MATERIALIZED (SELECT *, {error} FROM {name}_0),\n"
            f"{name} AS MATERIALIZED (SELECT *, {', '.join(map(last, p_cols))} FROM {name}_1)")


def norm_cdf(col: str | Column) -> Column:
    return _apply(norm_cdf_sql, col)


def norm_ppf(col: str | Column) -> Column:
    return _apply(norm_ppf_sql, col)


def _apply(fn, col) -> Column:
    # The expression references its argument several times; bind it to a
    # named column first when a Column is given (callers use names).
    if isinstance(col, str):
        return F.expr(fn(f"`{col}`"))
    raise TypeError("pass a column name; wrap expressions with withColumn first")


def norm_cdf_py(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))
