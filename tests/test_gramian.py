"""Pair sums in blocks of columns, and the reports on them, against pandas and plain clustering."""

import time

import numpy as np
import pandas as pd
import pytest

from ferret.operators import gramian as G
from ferret.operators import nullity as Nu
from ferret.operators import profile as P


def wide(k, n=60, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, k)) + rng.standard_normal((n, 1)) + 1e6 * np.arange(k)
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 3] = 5.0
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])


@pytest.mark.parametrize("block,bytes_", [(256, 96 << 20), (8, 96 << 20), (7, 8 * 6 * 49 * 4)])
def test_blocks_and_scans_give_the_same_correlations(spark, monkeypatch, block, bytes_):
    monkeypatch.setattr(G, "BLOCK", block)
    monkeypatch.setattr(G, "SCAN_BYTES", bytes_)
    pdf = wide(30)
    df = spark.createDataFrame(pdf).repartition(3)
    got = {(r["feature_x"], r["feature_y"]): r["corr"] for r in P.correlation_matrix(df, list(pdf.columns)).collect()}
    want = pdf.corr()
    assert len(got) == 900
    for (a, b), v in got.items():
        assert (v is None and np.isnan(want.loc[a, b])) or v == pytest.approx(want.loc[a, b], abs=2e-6)
    high = {(r["feature_x"], r["feature_y"]) for r in P.high_correlation(df, list(pdf.columns), 0.6).collect()}
    assert high == {(a, b) for i, a in enumerate(pdf) for b in list(pdf)[i + 1:] if want.loc[a, b] > 0.6}


def test_many_scans_read_only_their_columns(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(G, "BLOCK", 2)
    monkeypatch.setattr(G, "SCAN_BYTES", 1)
    spark.createDataFrame(wide(6)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = P.correlation_matrix(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    reads = [line.split("ReadSchema: struct<")[1].count("double") for line in plan.splitlines() if "ReadSchema" in line]
    assert len(reads) == 6 and sorted(reads) == [2, 2, 2, 4, 4, 4]


def test_no_rows_and_no_varying_flag(spark):
    df = spark.createDataFrame(wide(4)).limit(0)
    assert [r["corr"] for r in P.correlation_matrix(df, df.columns).collect()] == [None] * 16
    full = spark.range(5).selectExpr("id AS a", "id AS b")
    assert Nu.nullity_correlation(full).count() == 0
    assert [r["mismatches"] for r in Nu.nullity_distance(df).collect()] == [0] * 6


def test_flags_against_pandas(spark):
    pdf = wide(12)
    df = spark.createDataFrame(pdf).repartition(2)
    miss = pdf.isna()
    want = miss.astype(float).drop(columns="c3").corr()
    for r in Nu.nullity_correlation(df).collect():
        assert r["corr"] == pytest.approx(want.loc[r["feature_x"], r["feature_y"]], abs=2e-6)
    for r in Nu.nullity_distance(df).collect():
        assert r["mismatches"] == (miss[r["feature_x"]] != miss[r["feature_y"]]).sum()


def greedy(d):
    """Average linkage by the definition: the closest two clusters, over and over."""
    parts, out = [[i] for i in range(len(d))], []
    while len(parts) > 1:
        best = min(((np.mean([d[x, y] for x in a for y in b]), i, j) for i, a in enumerate(parts) for j, b in enumerate(parts) if i < j))
        a, b = parts[best[1]], parts[best[2]]
        out.append((frozenset(a), frozenset(b), best[0]))
        parts = [p for p in parts if p is not a and p is not b] + [a + b]
    return out


@pytest.mark.parametrize("seed", range(5))
def test_chains_merge_as_the_definition(seed):
    rng = np.random.default_rng(seed)
    d = rng.random((14, 14))
    d = d + d.T
    sets = {i: frozenset([i]) for i in range(14)}
    for (a, b, at), (x, y, distance) in zip(greedy(d), Nu.average_merges(d), strict=True):
        assert {sets[x], sets[y]} == {a, b} and distance == pytest.approx(at)
        union = a | b
        for i in union:
            sets[i] = union


def test_two_thousand_columns_and_equal_distances():
    d = np.floor(np.random.default_rng(1).random((2000, 2000)) * 20)
    begin = time.time()
    merges = Nu.average_merges(np.maximum(d, d.T))
    assert len(merges) == 1999 and time.time() - begin < 30
    assert len(Nu.average_merges(np.zeros((50, 50)))) == 49
