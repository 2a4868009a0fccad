"""Queries without an SQL twin run on sf0.001 and return rows under distinct column names."""

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

ALL = entry.queries()
ORACLE = entry.oracle_sql()
# the two whole flows are exercised by test_flow_regression_end_to_end
ROWS_ONLY = sorted(n for n in ALL if n not in ORACLE and not n.startswith("model_comparison"))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = ALL[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    assert len(rows) > 0
    assert len(set(cols)) == len(cols) and all(c for c in cols)


def test_profile_run_has_a_row_per_report(spark):
    rows = {r["report"]: r["n_rows"] for r in entry.queries()["profile_run"](spark, SF_SMALL).collect()}
    stages = ("untransformed", "imputed", "transformed")
    assert {f"{r}_{s}" for r in ("correlation", "normality", "probability_fit", "probability_points") for s in stages} <= set(rows)
    assert {"nan_report", "nullity_matrix", "skew_report", "histogram", "category_target_rate", "target_distribution"} <= set(rows)
    assert all(n > 0 for r, n in rows.items() if r != "nullity_correlation")
