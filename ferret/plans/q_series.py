"""Queries: positions in a series, exponential smoothing, per-item map."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import series as T
from ferret.plans.registry import query

_POS = """WITH s AS (SELECT user_id, ts, event_id, value,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
  count(*) OVER (PARTITION BY user_id) AS n FROM events)
"""

_SES = _POS + """, a AS (SELECT 0.2e0 AS alpha UNION ALL SELECT 0.6e0),
x AS (SELECT s.*, a.alpha, 1 - a.alpha AS beta,
             CASE WHEN pos = 1 THEN value ELSE a.alpha * value END AS xv FROM s CROSS JOIN a),
l AS (SELECT *, pow(beta, pos) * sum(xv * pow(beta, -pos)) OVER (PARTITION BY user_id, alpha ORDER BY pos) AS level
      FROM x)
"""


@query("positional_slice", _POS + """SELECT user_id, ts, pos,
 CASE WHEN pos <= floor(n * 0.75e0) THEN 'train' ELSE 'test' END AS part FROM s""")
def q_positional_slice(spark, sf):
    e = _events(spark, sf)
    return T.positional_slice(e, "user_id", "ts", "event_id", frac=0.75).select("user_id", "ts", "pos", "part")


def _events(spark, sf):
    from ferret.sources.tables import table
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@query("ses_fixed", _SES + """SELECT user_id, ts, alpha, round(level, 6) AS level,
 round(CASE WHEN pos = 1 THEN value ELSE (level - alpha * value) / beta END, 6) AS fitted FROM l""")
def q_ses_fixed(spark, sf):
    lv = T.ses_fixed(_events(spark, sf), "user_id", "ts", "event_id", "value")
    return lv.select("user_id", "ts", "alpha", F.round("level", 6).alias("level"),
                     F.round("fitted", 6).alias("fitted"))


@query("ses_fixed_forecast", _SES + """SELECT user_id, alpha, step, round(level, 6) AS forecast
 FROM l CROSS JOIN (SELECT range AS step FROM range(1, 4)) h WHERE pos = n""")
def q_ses_fixed_forecast(spark, sf):
    lv = T.ses_fixed(_events(spark, sf), "user_id", "ts", "event_id", "value")
    fc = T.ses_forecast(lv, "user_id", 3)
    return fc.select("user_id", "alpha", F.col("step").cast("bigint").alias("step"),
                     F.round("forecast", 6).alias("forecast"))


def _sse_sql(grid_cte: str, name: str) -> str:
    return f"""{name}_x AS (SELECT s.user_id, s.pos, s.value, g.alpha, 1 - g.alpha AS beta,
    CASE WHEN s.pos = 1 THEN s.value ELSE g.alpha * s.value END AS xv FROM s JOIN {grid_cte} g ON {'g.user_id = s.user_id' if 'fine' in name else 'TRUE'}),
{name}_l AS (SELECT *, pow(beta, pos) * sum(xv * pow(beta, -pos)) OVER (PARTITION BY user_id, alpha ORDER BY pos) AS level
    FROM {name}_x),
{name} AS (SELECT user_id, alpha, sum(pow(value - CASE WHEN pos = 1 THEN value ELSE (level - alpha * value) / beta END, 2))
    AS sse FROM {name}_l GROUP BY 1, 2)"""


_COARSE = ", ".join(f"{round(0.05 * (i + 1), 10)}e0" for i in range(19))


def _newton_step(k: int) -> str:
    """One Newton step of every series: level, its two derivatives and the error's, by windows."""
    w = "OVER (PARTITION BY user_id ORDER BY pos)"

    def scan(x, out, src):
        return f"SELECT *, pow(beta, pos) * sum(({x}) * pow(beta, -pos)) {w} AS {out} FROM {src}"

    prev = "OVER (PARTITION BY user_id ORDER BY pos)"
    return f"""n{k}_a AS (SELECT s.user_id, s.pos, s.value, a.alpha, a.lo0, a.hi0, 1 - a.alpha AS beta,
    CASE WHEN s.pos = 1 THEN s.value ELSE a.alpha * s.value END AS xv FROM s JOIN al{k} a ON a.user_id = s.user_id),
n{k}_l AS ({scan('xv', 'level', f'n{k}_a')}),
n{k}_e AS (SELECT *, CASE WHEN pos = 1 THEN 0.0e0 ELSE value - lag(level) {prev} END AS e FROM n{k}_l),
n{k}_d AS ({scan('e', 'd', f'n{k}_e')}),
n{k}_p AS (SELECT *, CASE WHEN pos = 1 THEN 0.0e0 ELSE lag(d) {prev} END AS dp FROM n{k}_d),
n{k}_h AS ({scan('-2 * dp', 'h', f'n{k}_p')}),
n{k}_q AS (SELECT *, CASE WHEN pos = 1 THEN 0.0e0 ELSE lag(h) {prev} END AS hp FROM n{k}_h),
n{k}_s AS (SELECT user_id, any_value(alpha) AS alpha, any_value(lo0) AS lo0, any_value(hi0) AS hi0, sum(e * e) AS sse, -sum(e * dp) AS g,
    sum(dp * dp - e * hp) AS c FROM n{k}_q GROUP BY user_id),
n{k}_b AS (SELECT *, CASE WHEN g < 0 THEN alpha ELSE lo0 END AS lo, CASE WHEN g > 0 THEN alpha ELSE hi0 END AS hi,
    CASE WHEN c > 0 THEN alpha - g / c END AS nt FROM n{k}_s),
al{k + 1} AS MATERIALIZED (SELECT user_id, lo AS lo0, hi AS hi0, CASE WHEN g = 0 OR lo >= hi OR (c > 0 AND abs(g / c) <= 1e-8) THEN alpha WHEN nt > lo AND nt < hi THEN nt
    WHEN g < 0 AND hi >= 0.995e0 THEN 0.995e0 WHEN g > 0 AND lo <= 0.005e0 THEN 0.005e0 ELSE (lo + hi) / 2 END AS alpha FROM n{k}_b)"""


_STEPS = 12
SES_OPT_SQL = _POS + f""", cg AS (SELECT unnest([{_COARSE}]) AS alpha),
{_sse_sql('cg', 'coarse')},
al0 AS MATERIALIZED (SELECT user_id, alpha, greatest(0.005e0, round(alpha - 0.05e0, 10)) AS lo0, least(0.995e0, round(alpha + 0.05e0, 10)) AS hi0 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sse, alpha) AS r
    FROM coarse) t WHERE r = 1),
""" + ",\n".join(_newton_step(k) for k in range(_STEPS)) + f"""
SELECT user_id, round(alpha, 5) AS alpha, round(sse, 4) AS sse FROM n{_STEPS - 1}_s"""


@query("ses_optimised", SES_OPT_SQL)
def q_ses_optimised(spark, sf):
    r = T.ses_optimised(_events(spark, sf), "user_id", "ts", "event_id", "value")
    return r.select("user_id", F.round("alpha", 5).alias("alpha"), F.round("sse", 4).alias("sse"))
