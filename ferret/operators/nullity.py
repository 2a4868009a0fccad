"""Missing-value reports (nan report, nullity bar / matrix / correlation / linkage)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators.columns import is_missing, null_counts
from ferret.operators.gramian import named, pair_sums


def na_count_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, null_count) per column."""
    return null_counts(df, cols).select("feature", "null_count")


def nan_report(df: DataFrame, cols: list[str] | None = None, digits: int = 2) -> DataFrame:
    """(feature, pct_null): share of missing values in %, rounded, largest first."""
    nc = null_counts(df, cols)
    pct = F.round(F.try_divide(F.col("null_count") * F.lit(100.0), F.col("n")), digits)
    return nc.select("feature", pct.alias("pct_null")).orderBy(F.desc("pct_null"), "feature")


def nan_features(df: DataFrame, threshold: float = 0.25, cols: list[str] | None = None) -> DataFrame:
    """Columns whose missing share is strictly above ``threshold``."""
    nc = null_counts(df, cols)
    return nc.where(F.col("null_count") > F.lit(threshold) * F.col("n")).select("feature")


def nan_split(df: DataFrame, threshold: float = 0.25, cols: list[str] | None = None) -> DataFrame:
    """(feature, status): 'problematic' above threshold, 'impute' for 0 < share <= threshold."""
    nc = null_counts(df, cols)
    status = (F.when(F.col("null_count") > F.lit(threshold) * F.col("n"), "problematic")
              .when(F.col("null_count") > 0, "impute"))
    return nc.select("feature", status.alias("status")).where(F.col("status").isNotNull())


def null_sum(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Total number of missing cells (``isna().sum().sum()``)."""
    return null_counts(df, cols).agg(F.sum("null_count").alias("null_cells"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def nullity_bar(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, non_null, n): present values per column."""
    nc = null_counts(df, cols)
    return nc.select("feature", (F.col("n") - F.col("null_count")).alias("non_null"), "n")


def nullity_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missingness patterns: (flags, n_rows), one character per column in column order, 1 where it is missing."""
    cols = list(cols or df.columns)
    flags = F.concat(*[F.when(is_missing(df, c), "1").otherwise("0") for c in cols])
    return df.select(flags.alias("flags")).groupBy("flags").agg(F.count(F.lit(1)).alias("n_rows"))


def _missing_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, both) for i <= j: the rows in which both columns are missing."""
    flags = [is_missing(df, c) for c in cols]
    return pair_sums(df, flags, ["both"], lambda a, b: [a.T @ b])


def _missing_counts(df: DataFrame, cols: list[str]) -> tuple[int, list[int]]:
    rows = {r["feature"]: r for r in null_counts(df, cols).collect()}
    return rows[cols[0]]["n"], [rows[c]["null_count"] for c in cols]


def nullity_correlation(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson (phi) correlation of the 0/1 missing flags, for columns whose flag varies.

    Long form (feature_x, feature_y, corr) with x before y in column order.
    """
    cols = list(cols or df.columns)
    n, missing = _missing_counts(df, cols)
    kept = [(c, m / n) for c, m in zip(cols, missing) if 0 < m < n]
    if not kept:
        return df.sparkSession.createDataFrame([], "feature_x string, feature_y string, corr double")
    names = [c for c, _ in kept]
    share = F.array(*[F.lit(p) for _, p in kept])
    px, py = F.get(share, F.col("i")), F.get(share, F.col("j"))
    corr = (F.col("both") / n - px * py) / F.sqrt(px * (1 - px) * py * (1 - py))
    pairs = _missing_pairs(df, names).where("i < j").withColumn("corr", F.round(corr, 6))
    return named(pairs, names, "corr")


def _mismatches(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, mismatches) for i < j: the rows in which exactly one of the two columns is missing."""
    _, missing = _missing_counts(df, cols)
    count = F.array(*[F.lit(m).cast("long") for m in missing])
    return _missing_pairs(df, cols).where("i < j").select(
        "i", "j", (F.get(count, F.col("i")) + F.get(count, F.col("j")) - 2 * F.col("both").cast("long")).alias("mismatches"))


def nullity_distance(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Euclidean distance between the 0/1 missing flags of every column pair: sqrt(#mismatches)."""
    cols = list(cols or df.columns)
    pairs = _mismatches(df, cols).withColumn("distance", F.round(F.sqrt("mismatches"), 6))
    return named(pairs, cols, "mismatches", "distance")


def nullity_linkage(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Average-linkage merges of the columns by ``sqrt(mismatches)``: (step, left, right, distance, size).

    The data pass is distributed; the clustering works on the k x k distances of the k
    columns, never on rows: k^2 numbers and k^2 steps (chains of nearest neighbours).
    Of equal distances the columns that come first are merged; merges are listed by distance.
    """
    cols = list(cols or df.columns)
    k = len(cols)
    d = np.zeros((k, k))
    found = _mismatches(df, cols).toPandas()
    i, j = found["i"].to_numpy(), found["j"].to_numpy()
    d[i, j] = d[j, i] = np.sqrt(found["mismatches"].to_numpy(np.float64))
    label, size, parent = list(cols), [1] * k, list(range(k))

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    steps = []
    for step, (x, y, distance) in enumerate(average_merges(d)):
        a, b = sorted((root(x), root(y)), key=lambda c: label[c])
        steps.append((step, label[a], label[b], round(float(distance), 6), size[a] + size[b]))
        label[a], size[a], parent[b] = f"({label[a]},{label[b]})", size[a] + size[b], a
    return df.sparkSession.createDataFrame(
        steps, "step int, left string, right string, distance double, size int")


def average_merges(distances: np.ndarray) -> list[tuple[int, int, float]]:
    """Average-linkage merges by nearest-neighbour chains, by distance: (member of one side, of the other, distance).

    A chain goes from a cluster to its nearest one until two are nearest to each other; these
    are merged.  Average linkage never brings a union nearer than its parts were, so the
    rest of the chain stays valid, and every step reads one row.
    """
    d = distances.astype(np.float64).copy()
    k = len(d)
    np.fill_diagonal(d, np.inf)
    size, alive = np.ones(k), np.ones(k, bool)
    merges, chain = [], []
    while len(merges) < k - 1:
        if not chain:
            chain = [int(alive.argmax())]
        top = chain[-1]
        near = int(d[top].argmin())
        if len(chain) > 1 and d[top, chain[-2]] <= d[top, near] * (1 + 1e-12):
            near = chain[-2]  # of equal distances back along the chain, so that it ends
        if len(chain) < 2 or near != chain[-2]:
            chain.append(near)
            continue
        del chain[-2:]
        a, b = min(top, near), max(top, near)
        merges.append((a, b, d[a, b]))
        row = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        d[a], d[:, a] = row, row
        d[a, a] = np.inf
        d[b], d[:, b] = np.inf, np.inf
        size[a] += size[b]
        alive[b] = False
    return sorted(merges, key=lambda m: m[2])
