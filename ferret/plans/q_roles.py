"""Queries: column roles of ``orders_frame`` (target ``label``, key ``row_id``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import roles as R
from ferret.plans import frames
from ferret.plans.oracle import ORDERS_COLS, ORDERS_KIND, union_per_column, with_frame
from ferret.plans.registry import query

TARGET, KEY = "label", "row_id"
FEATS = [c for c in ORDERS_COLS if c != KEY]

_STATS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, '{ORDERS_KIND[c]}' AS kind, count(*) AS n, "
    f"count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS ndv FROM f" for c in FEATS)

ROLES_SQL = with_frame("").rstrip() + f""",
st AS ({_STATS}),
cand AS (SELECT * FROM st WHERE feature <> '{TARGET}'),
nanf AS (SELECT feature FROM cand WHERE nulls > 0.25e0 * n),
prob AS (SELECT feature FROM cand WHERE contains(feature, 'Id') OR contains(feature, 'ID')),
und AS (SELECT * FROM cand WHERE feature NOT IN (SELECT feature FROM nanf)
                             AND feature NOT IN (SELECT feature FROM prob)),
roles AS (
  SELECT 'NaN' AS category, feature FROM nanf
  UNION ALL SELECT 'problematic', feature FROM prob
  UNION ALL SELECT 'undefined', feature FROM und
  UNION ALL SELECT 'numeric', feature FROM und
            WHERE kind IN ('integral', 'fractional') AND CAST(ndv AS DOUBLE) / n >= 0.01e0
  UNION ALL SELECT 'categoric', feature FROM und
            WHERE kind IN ('integral', 'string') AND CAST(ndv AS DOUBLE) / n < 0.10e0
  UNION ALL SELECT 'target', '{TARGET}')
"""


def _roles(spark, sf):
    return R.infer_roles(frames.orders_frame(spark, sf), TARGET, [KEY])


def _cat(spark, sf, cat):
    return _roles(spark, sf).to_df(spark).where(F.col("category") == cat).select("feature")


@query("role_summary", ROLES_SQL + "SELECT category, feature FROM roles")
def q_role_summary(spark, sf):
    return _roles(spark, sf).to_df(spark)


for _name, _cat_name in [("numeric_features", "numeric"), ("categorical_features", "categoric"),
                         ("undefined_features", "undefined"), ("problematic_features", "problematic")]:
    def _mk(cat):
        return lambda spark, sf: _cat(spark, sf, cat)
    query(_name, ROLES_SQL + f"SELECT feature FROM roles WHERE category = '{_cat_name}'")(_mk(_cat_name))


@query("other_types", ROLES_SQL + """SELECT feature FROM roles WHERE category = 'undefined'
 AND feature NOT IN (SELECT feature FROM roles WHERE category = 'numeric')""")
def q_other_types(spark, sf):
    r = _roles(spark, sf)
    return spark.createDataFrame([(c,) for c in R.other_types(r)], "feature string")


@query("column_difference", ROLES_SQL + f"""SELECT feature FROM st
 WHERE feature NOT IN (SELECT feature FROM roles WHERE category IN ('NaN', 'problematic'))""")
def q_column_difference(spark, sf):
    r = _roles(spark, sf)
    return spark.createDataFrame([(c,) for c in R.column_difference(FEATS, r["NaN"], r["problematic"])],
                                 "feature string")


@query("value_counts", with_frame(union_per_column(
    "SELECT '{c}' AS feature, count(DISTINCT {c}) AS ndv FROM f", FEATS)))
def q_value_counts(spark, sf):
    stats = R.column_stats(frames.orders_frame(spark, sf), FEATS, exact=True)
    return spark.createDataFrame([(c, s.ndv) for c, s in stats.items()], "feature string, ndv bigint")
