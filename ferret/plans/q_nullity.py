"""Queries: missing-value reports over ``orders_frame``."""

from __future__ import annotations

from ferret.operators import nullity
from ferret.plans import frames
from ferret.plans.oracle import ORDERS_COLS, null_counts_sql, with_frame
from ferret.plans.registry import query

def _sql(body: str) -> str:
    # f (frame) then nc (null counts per column)
    return with_frame("").rstrip() + f",\nnc AS ({null_counts_sql()})\n{body}"


@query("nan_report", _sql(
    "SELECT feature, round(null_count * 100.0e0 / n, 2) AS pct_null FROM nc"))
def q_nan_report(spark, sf):
    return nullity.nan_report(frames.orders_frame(spark, sf))


@query("na_count_report", _sql("SELECT feature, null_count FROM nc"))
def q_na_count_report(spark, sf):
    return nullity.na_count_report(frames.orders_frame(spark, sf))


@query("nan_features", _sql("SELECT feature FROM nc WHERE null_count > 0.25e0 * n"))
def q_nan_features(spark, sf):
    return nullity.nan_features(frames.orders_frame(spark, sf))


@query("nan_split", _sql(
    "SELECT feature, CASE WHEN null_count > 0.25e0 * n THEN 'problematic' ELSE 'impute' END AS status "
    "FROM nc WHERE null_count > 0"))
def q_nan_split(spark, sf):
    return nullity.nan_split(frames.orders_frame(spark, sf))


@query("null_sum", _sql("SELECT CAST(sum(null_count) AS BIGINT) AS null_cells FROM nc"))
def q_null_sum(spark, sf):
    return nullity.null_sum(frames.orders_frame(spark, sf))


@query("count_rows", with_frame("SELECT count(*) AS n_rows FROM f"))
def q_count_rows(spark, sf):
    return nullity.count_rows(frames.orders_frame(spark, sf))


@query("nullity_bar", _sql("SELECT feature, n - null_count AS non_null, n FROM nc"))
def q_nullity_bar(spark, sf):
    return nullity.nullity_bar(frames.orders_frame(spark, sf))


_MASK = " + ".join(f"(CASE WHEN {c} IS NULL THEN {1 << i} ELSE 0 END)"
                   for i, c in enumerate(ORDERS_COLS))
_FLAGS = " || ".join(f"(CASE WHEN {c} IS NULL THEN '1' ELSE '0' END)" for c in ORDERS_COLS)


@query("nullity_matrix", with_frame(
    f"SELECT {_FLAGS} AS flags, count(*) AS n_rows FROM f GROUP BY 1"))
def q_nullity_matrix(spark, sf):
    return nullity.nullity_matrix(frames.orders_frame(spark, sf), ORDERS_COLS)


def _pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


_VARYING = ["price", "acctbal", "priority", "segment"]


@query("nullity_correlation", with_frame(
    "SELECT feature_x, feature_y, round(corr, 6) AS corr FROM (\n" + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, "
        f"(avg(CAST({a} IS NULL AS INT) * CAST({b} IS NULL AS INT)) - avg(CAST({a} IS NULL AS INT)) * avg(CAST({b} IS NULL AS INT))) / "
        f"sqrt(avg(CAST({a} IS NULL AS INT)) * (1 - avg(CAST({a} IS NULL AS INT))) * avg(CAST({b} IS NULL AS INT)) * (1 - avg(CAST({b} IS NULL AS INT)))) AS corr FROM f"
        for a, b in _pairs(_VARYING)) + "\n) t"))
def q_nullity_correlation(spark, sf):
    return nullity.nullity_correlation(frames.orders_frame(spark, sf), ORDERS_COLS)


@query("nullity_linkage", with_frame(
    "SELECT feature_x, feature_y, mismatches, round(sqrt(mismatches), 6) AS distance FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, "
        f"CAST(count_if(({a} IS NULL) <> ({b} IS NULL)) AS BIGINT) AS mismatches FROM f"
        for a, b in _pairs(ORDERS_COLS)) + "\n) t"))
def q_nullity_linkage(spark, sf):
    # the data-dependent part: the column distance table
    return nullity.nullity_distance(frames.orders_frame(spark, sf), ORDERS_COLS)


@query("nullity_linkage_merges")
def q_nullity_linkage_merges(spark, sf):
    return nullity.nullity_linkage(frames.orders_frame(spark, sf), ORDERS_COLS)
