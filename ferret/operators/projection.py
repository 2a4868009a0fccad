"""Uncentred truncated SVD (2-D projection) of a vector column.

The right singular vectors are found by a randomised range finder that grows a
block Krylov basis: a pass multiplies the rows by the newest block of directions and
back (``X^T (X Q)``), each task adding up d x ``BLOCK`` numbers with numpy on Arrow
batches, which a group-by per dimension sums.  The basis is kept orthonormal on
the driver (d x at most ``MOST_BLOCKS`` blocks, then a restart from the leading directions), and the
passes end when the leading pairs satisfy ``X^T X v = s^2 v`` to ``tolerance``.  Vectors
of up to ``BLOCK`` dimensions take one pass.  The singular values come from a tall-skinny QR
of the rows projected on the leading directions: each task keeps one small R,
and R factors are merged in groups.  Nothing of size d x d is ever held.
Projection, reconstruction and the explained variance are Column expressions and aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class SVDModel:
    components: np.ndarray          # k x d, rows = right singular vectors
    singular_values: np.ndarray     # k
    explained_variance: np.ndarray | None = None
    explained_variance_ratio: np.ndarray | None = None
    dim: int = 0


BLOCK = 64
MOST_BLOCKS = 12
FAN_IN = 7  # bits of the partition number dropped at a merge of R factors


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column(0).flatten(), np.float64).reshape(batch.num_rows, -1)


def _rows(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).alias("x")).where("x IS NOT NULL")


def _there_and_back(rows: DataFrame, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """X^T (X q), the column sums of X and of its squares, from one pass."""
    d, width = q.shape
    names = [f"v{i}" for i in range(width + 2)]

    def partial(batches):
        total, seen = np.zeros((d, width + 2)), False
        for batch in batches:
            if batch.num_rows:
                x, seen = _matrix(batch), True
                total[:, :width] += x.T @ (x @ q)
                total[:, width] += x.sum(axis=0)
                total[:, width + 1] += (x * x).sum(axis=0)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), *[pa.array(c) for c in np.ascontiguousarray(total.T)]],
                                             ["j", *names])

    parts = rows.mapInArrow(partial, "j int, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((d, width + 2))
    for r in parts.groupBy("j").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[r["j"]] = r[1:]
    return out[:, :width], out[:, width], out[:, width + 1]


def _tall_skinny_r(rows: DataFrame, v: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of X v: one per task, merged in groups of neighbouring partitions."""
    width = v.shape[1]

    def stacked(r, more):
        return np.linalg.qr(np.vstack([r, more]), mode="r")

    def flat(r):
        return pa.ListArray.from_arrays(pa.array([0, r.size], pa.int32()), pa.array(r.reshape(-1)))

    def partial(batches):
        r = np.zeros((0, width))
        for batch in batches:
            if batch.num_rows:
                r = stacked(r, _matrix(batch) @ v)
        if len(r):
            yield pa.RecordBatch.from_arrays([flat(r)], ["r"])

    def merge(key, factors):
        r = np.zeros((0, width))
        for one in factors.column("r"):
            r = stacked(r, np.asarray(one.values).reshape(-1, width))
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), flat(r)], ["part", "r"])

    parts = rows.mapInArrow(partial, "r array<double>").select(F.spark_partition_id().alias("part"), "r")
    for _ in range(2):
        parts = (parts.select(F.shiftright("part", FAN_IN).alias("part"), "r").groupBy("part")
                 .applyInArrow(merge, "part int, r array<double>"))
    r = np.zeros((0, width))
    for one in sorted(parts.collect(), key=lambda one: one["part"]):
        r = stacked(r, np.array(one["r"]).reshape(-1, width))
    return r


def _fresh(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` outside the span of ``basis`` (twice is enough); none if nothing is left."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10]
    return block


def fit_svd(df: DataFrame, col: str, k: int = 2, block: int = BLOCK, tolerance: float = 1e-10, max_passes: int = 200,
            seed: int = 42) -> SVDModel:
    """The ``k`` leading right singular vectors of the rows of a vector column (null vectors are left out).

    ``tolerance`` bounds ``||X^T X v - s^2 v||`` against the largest s^2.
    """
    rows = _rows(df, col)
    first = rows.first()
    if first is None:
        raise ValueError("no vectors to project")
    d = len(first["x"])
    k = min(k, d)
    block = min(max(block, k), d)
    rng = np.random.default_rng(seed)
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    new = np.linalg.qr(rng.standard_normal((d, block)))[0]
    sums = squares = vectors = None
    for _ in range(max_passes):
        back, sums, squares = _there_and_back(rows, new)
        basis, image = np.hstack([basis, new]), np.hstack([image, back])
        h = basis.T @ image
        values, turn = np.linalg.eigh((h + h.T) / 2)
        turn = turn[:, ::-1][:, :block]
        values = values[::-1][:block]
        vectors = basis @ turn
        rest = image @ turn - vectors * values
        if (np.linalg.norm(rest[:, :k], axis=0) <= tolerance * max(values[0], 0.0)).all():
            break
        if basis.shape[1] + block > MOST_BLOCKS * block:
            basis, image = vectors, image @ turn
        new = _fresh(rest, basis)
        if not new.shape[1]:
            break
    r = _tall_skinny_r(rows, vectors)
    _, sv, turn = np.linalg.svd(r, full_matrices=False)
    comps = np.zeros((k, d))
    comps[:min(k, len(turn))] = (vectors @ turn[:k].T).T
    sv = np.append(sv, np.zeros(k))[:k]
    for c in comps:  # sign: largest-magnitude entry of each component positive
        if c[int(np.argmax(np.abs(c)))] < 0:
            c *= -1.0
    n = rows.count()
    m = SVDModel(comps, sv, dim=d)
    # variance of the projected columns: E[(xv)^2] - E[xv]^2
    mean = sums / n
    m.explained_variance = sv ** 2 / n - (comps @ mean) ** 2
    total_var = float(squares.sum() / n - mean @ mean)
    m.explained_variance_ratio = m.explained_variance / total_var if total_var > 0 else m.explained_variance * np.nan
    return m


def _dot(col: str, v: np.ndarray) -> Column:
    w = F.array(*[F.lit(float(x)) for x in v])
    prod = F.zip_with(F.col(col).cast("array<double>"), w, lambda a, b: a * b)
    return F.aggregate(prod, F.lit(0.0), lambda acc, x: acc + x)


def transform(model: SVDModel, df: DataFrame, col: str, prefix: str = "comp") -> DataFrame:
    """Append ``comp1..compk`` = X v_i (no row leaves the JVM)."""
    return df.select("*", *[_dot(col, model.components[i]).alias(f"{prefix}{i + 1}")
                            for i in range(len(model.components))])


def inverse_transform(model: SVDModel, df: DataFrame, prefix: str = "comp", out: str = "reconstruction") -> DataFrame:
    """Reconstruction sum_i comp_i * v_i as an array column."""
    k = len(model.components)
    terms = None
    for i in range(k):
        v = F.array(*[F.lit(float(x)) for x in model.components[i]])
        t = F.transform(v, _times(f"{prefix}{i + 1}"))
        terms = t if terms is None else F.zip_with(terms, t, lambda a, b: a + b)
    return df.withColumn(out, terms)


def _times(c: str):
    return lambda e: e * F.col(c)


def summary(model: SVDModel, spark) -> DataFrame:
    rows = [(i + 1, float(model.singular_values[i]),
             None if model.explained_variance is None else float(model.explained_variance[i]),
             None if model.explained_variance_ratio is None else float(model.explained_variance_ratio[i]))
            for i in range(len(model.singular_values))]
    return spark.createDataFrame(rows, "component int, singular_value double, explained_variance double, "
                                       "explained_variance_ratio double")
