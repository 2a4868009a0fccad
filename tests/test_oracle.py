"""Every query with an oracle equals its DuckDB SQL on the same tables (sf0.001)."""

import math

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

# oracle SQL written for the role lists that hold at sf0.01 (the driver's scale)
ROLE_DEPENDENT = {"assemble_imputed"}

ORACLE = entry.oracle_sql()
NAMES = sorted(n for n in ORACLE if n not in ROLE_DEPENDENT)


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return 0.0 if v == 0 else v
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(rel.fetchall(), dcols)


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 100


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["feature", "pct_null"]
    assert df.count() > 0
