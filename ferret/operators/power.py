"""Maximum-likelihood lambda of the Yeo-Johnson and Box-Cox transforms.

With ``u = ln(1 + |x|)`` (Box-Cox: ``ln x``) both transforms are ``f(u, v) =
(exp(v u) - 1) / v`` with ``v = lambda``, or ``2 - lambda`` and a minus sign for
negative values, so one formula and its first two derivatives by lambda serve
all rows.  The profile log-likelihood ``-n/2 ln var(t) + (lambda - 1) s`` then has

    slope = s - n/2 V'/V,    V'  = 2 cov(t, t')
    curvature = -n/2 (V''/V - (V'/V)^2),    V'' = 2 (var(t') + cov(t, t''))

and all of it is one aggregate over all columns: a pass reads each row once and
shuffles one row a task.  The search is a safeguarded Newton method: points with
slopes of both signs enclose the maximum, the next points are the root of the
polynomial through the slopes and curvatures known there and the Newton step, and half of
the enclosure if both fail.  Four or five passes reach 1e-9.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SERIES_BELOW = 1e-4  # |v| below which f and its derivatives are summed as a series
FLAT = 1e-14  # a deviation below this share of the mean is rounding
TOLERANCE = 1e-9  # of lambda
ROUNDING = 1e-12  # share of a slope's terms that sums over rows may be off by
FIRST_POINTS = (-1.0, 0.5, 2.0)


def log_part_sql(x: str, method: str) -> str:
    return f"ln(1.0e0 + abs({x}))" if method == "yeo-johnson" else f"(CASE WHEN {x} > 0 THEN ln({x}) END)"


def f_sql(u: str, v: str) -> str:
    return (f"(CASE WHEN abs({v}) < {SERIES_BELOW} THEN {u} + {v} * {u} * {u} / 2.0e0 + {v} * {v} * {u} * {u} * {u} / 6.0e0 "
            f"ELSE (exp({v} * {u}) - 1.0e0) / {v} END)")


def f1_sql(u: str, v: str, f: str) -> str:
    return (f"(CASE WHEN abs({v}) < {SERIES_BELOW} THEN {u} * {u} / 2.0e0 + {v} * {u} * {u} * {u} / 3.0e0 "
            f"+ {v} * {v} * {u} * {u} * {u} * {u} / 8.0e0 ELSE ({u} * (1.0e0 + {v} * {f}) - {f}) / {v} END)")


def f2_sql(u: str, v: str, f: str, f1: str) -> str:
    return (f"(CASE WHEN abs({v}) < {SERIES_BELOW} THEN {u} * {u} * {u} / 3.0e0 + {v} * {u} * {u} * {u} * {u} / 4.0e0 "
            f"+ {v} * {v} * {u} * {u} * {u} * {u} * {u} / 10.0e0 ELSE ({u} * {u} * (1.0e0 + {v} * {f}) - 2.0e0 * {f1}) / {v} END)")


@dataclass
class Point:
    """The likelihood at one lambda, its slope and curvature (both per row), mean and deviation of the transformed values."""
    lam: float
    llf: float
    slope: float
    curve: float
    mean: float | None
    std: float | None
    scale: float = 0.0  # of the terms that make up the slope


def evaluate(df: DataFrame, points: dict[str, list[float]], method: str) -> dict[str, list[Point]]:
    """The likelihood of every (column, lambda) given, in one aggregate."""
    cols = list(points)
    num = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(cols)])
    parts = num.select(*[F.expr(e) for i in range(len(cols)) for e in (
        f"{log_part_sql(f'x{i}', method)} AS u{i}", f"(CASE WHEN x{i} < 0 THEN -1.0e0 ELSE 1.0e0 END) AS s{i}")])
    pairs = [(i, j, lam) for i, c in enumerate(cols) for j, lam in enumerate(points[c])]
    keep = [f"u{i}" for i in range(len(cols))] + [f"s{i}" for i in range(len(cols))]
    # one projection a level: each exponential is taken once a row
    powers = [f"(CASE WHEN s{i} < 0 THEN {2.0 - lam!r}D ELSE {lam!r}D END) AS v{i}_{j}" if method == "yeo-johnson"
              else f"{lam!r}D AS v{i}_{j}" for i, j, lam in pairs]
    levels = [powers, [f"{f_sql(f'u{i}', f'v{i}_{j}')} AS f{i}_{j}" for i, j, _ in pairs],
              [f"{f1_sql(f'u{i}', f'v{i}_{j}', f'f{i}_{j}')} AS g{i}_{j}" for i, j, _ in pairs],
              [f"{f2_sql(f'u{i}', f'v{i}_{j}', f'f{i}_{j}', f'g{i}_{j}')} AS h{i}_{j}" for i, j, _ in pairs]]
    for level in levels:
        parts = parts.select("*", *[F.expr(e) for e in level])
    parts = parts.select(*keep, *[F.expr(e) for i, j, _ in pairs for e in (
        f"s{i} * f{i}_{j} AS t{i}_{j}", f"g{i}_{j}", f"s{i} * h{i}_{j} AS h{i}_{j}")])
    sums = [F.count(f"u{i}").alias(f"n{i}") for i in range(len(cols))]
    sums += [F.sum(F.expr(f"s{i} * u{i}")).alias(f"l{i}") for i in range(len(cols))]
    for i, j, _ in pairs:
        t, g, h = f"t{i}_{j}", f"g{i}_{j}", f"h{i}_{j}"
        sums += [F.avg(t).alias("a" + t), F.var_pop(t).alias("v" + t), F.covar_pop(t, g).alias("c" + t),
                 F.var_pop(g).alias("w" + t), F.covar_pop(t, h).alias("d" + t)]
    r = parts.agg(*sums).collect()[0]
    out: dict[str, list[Point]] = {c: [] for c in cols}
    for i, j, lam in pairs:
        n, total, t = r[f"n{i}"], r[f"l{i}"], f"t{i}_{j}"
        mean, var, c, w, d = (r[k + t] for k in "avcwd")
        if not n:
            out[cols[i]].append(Point(lam, -math.inf, 0.0, 0.0, None, None))
        elif math.sqrt(abs(var)) <= FLAT * abs(mean):  # one value, but for rounding
            out[cols[i]].append(Point(lam, -math.inf, 0.0, 0.0, mean, 0.0))
        elif not all(map(math.isfinite, (var, c, w, d))):  # overflown: the maximum lies towards 1
            out[cols[i]].append(Point(lam, -math.inf, math.copysign(math.inf, 1.0 - lam), 0.0, mean, math.inf))
        else:
            rate = 2.0 * c / var
            out[cols[i]].append(Point(lam, -n / 2.0 * math.log(var) + (lam - 1.0) * total, total / n - 0.5 * rate,
                                      -0.5 * (2.0 * (w + d) / var - rate * rate), mean, math.sqrt(var), abs(total / n) + abs(rate)))
    return out


def _root(points: list[Point], a: float, b: float) -> float:
    """A root in (a, b) of the polynomial through the slopes and curvatures (divided differences of doubled nodes)."""
    xs = [p.lam for p in points for _ in (0, 1)]
    table = [p.slope for p in points for _ in (0, 1)]
    coefficients = [table[0]]
    for k in range(1, len(xs)):
        table = [points[i // 2].curve if k == 1 and xs[i] == xs[i + k] else (table[i + 1] - table[i]) / (xs[i + k] - xs[i])
                 for i in range(len(xs) - k)]
        coefficients.append(table[0])

    def value(x):
        out = 0.0
        for c, node in zip(reversed(coefficients), reversed(xs), strict=True):
            out = out * (x - node) + c
        return out

    for _ in range(60):
        mid = (a + b) / 2.0
        a, b = (mid, b) if value(mid) > 0 else (a, mid)
    return (a + b) / 2.0


def best_point(known: list[Point]) -> Point:
    """The highest likelihood; of points equal but for rounding, the one with the flattest slope."""
    top = max(p.llf for p in known)
    return min((p for p in known if p.llf >= top - 1e-12 * abs(top)), key=lambda p: abs(p.slope)) if math.isfinite(top) else known[0]


def next_lambdas(known: list[Point], lo: float, hi: float) -> list[float]:
    """Where to look next; nothing if the best point known is the maximum between the bounds."""
    best = best_point(known)
    # at the maximum, as far as rounding and the tolerance tell
    if not math.isfinite(best.llf) or abs(best.slope) <= max(ROUNDING * best.scale, TOLERANCE * -best.curve):
        return []
    up = best.slope > 0
    bound = hi if up else lo
    if best.lam == bound:
        return []
    beyond = [p for p in known if (p.lam > best.lam if up else p.lam < best.lam)]
    other = (min if up else max)(beyond, key=lambda p: p.lam, default=None)
    newton = best.lam - best.slope / best.curve if best.curve < 0 else None
    if other is None:  # not enclosed yet: a Newton step, or two towards the bound
        if newton is not None and abs(newton - best.lam) < min(2.0, abs(bound - best.lam)):
            return [newton]
        return [(best.lam + bound) / 2.0, bound]
    a, b = sorted((best.lam, other.lam))
    out = []
    if math.isfinite(other.slope) and (other.slope > 0) != up:
        third = min((p for p in known if math.isfinite(p.llf) and p not in (best, other)), key=lambda p: abs(p.lam - best.lam), default=None)
        near = [p for p in (best, other, third) if p is not None]
        out.append(_root(sorted(near, key=lambda p: p.lam), a, b))
    if newton is not None and a < newton < b and all(abs(newton - x) > 1e-6 for x in out):
        out.append(newton)
    return out or [(a + b) / 2.0]


def maximise(df: DataFrame, cols: list[str], method: str, lo: float, hi: float,
             most_passes: int = 40) -> tuple[dict[str, Point], int]:
    """The best point of every column, and the number of passes taken.

    A column without two different values keeps lambda 1, as does one without values.
    """
    first = sorted({min(max(p, lo), hi) for p in FIRST_POINTS})
    known: dict[str, list[Point]] = {c: [] for c in cols}
    todo, passes = {c: list(first) for c in cols}, 0
    while todo and passes < most_passes:
        for c, found in evaluate(df, todo, method).items():
            known[c] += found
        passes += 1
        todo = {}
        for c in cols:
            # a step below the tolerance: the best point is as near to the root
            if new := [x for x in next_lambdas(known[c], lo, hi) if all(abs(x - p.lam) >= TOLERANCE for p in known[c])]:
                todo[c] = new
    flat = [c for c in cols if not any(math.isfinite(p.llf) for p in known[c])]
    out = {c: best_point(known[c]) for c in cols if c not in flat}
    if flat:
        for c, found in evaluate(df, {c: [1.0] for c in flat}, method).items():
            out[c] = found[0]
        passes += 1
    return out, passes


def newton_sql(x: str, source: str, method: str, steps: int, start: float = 1.0) -> str:
    """CTEs ``l0`` ... ``l<steps>`` (lam): plain Newton steps in SQL, for checking fits against."""
    v = "(CASE WHEN x < 0 THEN 2.0e0 - lam ELSE lam END)" if method == "yeo-johnson" else "lam"
    sign = "(CASE WHEN x < 0 THEN -1.0e0 ELSE 1.0e0 END)" if method == "yeo-johnson" else "1.0e0"
    base = (f"xs AS MATERIALIZED (SELECT x, {sign} AS s, {log_part_sql('x', method)} AS u FROM "
            f"(SELECT CAST({x} AS DOUBLE) AS x FROM {source}) z WHERE x IS NOT NULL)")
    parts = [base, f"l0 AS (SELECT CAST({start!r} AS DOUBLE) AS lam)"]
    for k in range(steps):
        parts.append(f"""l{k + 1} AS MATERIALIZED (SELECT lam - (total / n - covar_tg / var_t)
  / (-((var_g + covar_th) / var_t - 2.0e0 * (covar_tg / var_t) * (covar_tg / var_t))) AS lam FROM (
  SELECT any_value(lam) AS lam, count(*) AS n, sum(s * u) AS total, var_pop(s * f) AS var_t, covar_pop(s * f, g) AS covar_tg,
         var_pop(g) AS var_g, covar_pop(s * f, s * h) AS covar_th
  FROM (SELECT *, {f2_sql('u', 'v', 'f', 'g')} AS h FROM (SELECT *, {f1_sql('u', 'v', 'f')} AS g FROM (
        SELECT *, {f_sql('u', 'v')} AS f FROM (SELECT xs.*, lam, {v} AS v FROM xs, l{k}) a) b) c) d) e)""")
    return ",\n".join(parts)


def transform_sql(x: str, lam: str, method: str) -> str:
    """The transform with a lambda that is itself an SQL expression."""
    if method == "box-cox":
        body = f"CASE WHEN abs({lam}) < 1.0e-12 THEN ln({x}) ELSE (power({x}, {lam}) - 1.0e0) / {lam} END"
        return f"(CASE WHEN {x} > 0 THEN {body} END)"
    up = f"CASE WHEN abs({lam}) < 1.0e-12 THEN ln({x} + 1.0e0) ELSE (power({x} + 1.0e0, {lam}) - 1.0e0) / {lam} END"
    down = f"CASE WHEN abs({lam} - 2.0e0) < 1.0e-12 THEN -ln(1.0e0 - {x}) ELSE -(power(1.0e0 - {x}, 2.0e0 - {lam}) - 1.0e0) / (2.0e0 - {lam}) END"
    return f"(CASE WHEN {x} >= 0 THEN {up} WHEN {x} < 0 THEN {down} END)"
