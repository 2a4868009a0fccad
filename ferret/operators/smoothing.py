"""The smoothing factor of each series that minimises its squared one-step error.

With ``e = y - l`` the recurrences ``l' = l + a e``, ``d' = e + (1 - a) d`` (the
derivative of ``l`` by ``a``) and ``h' = -2 d + (1 - a) h`` (the second one) are
linear in ``z = (1, l, d, h)``, and the error ``sum e^2``, ``sum e d`` and ``sum
(d^2 - e h)`` (its derivatives but for a factor) are quadratic in it.  A stretch of
a series is therefore summed up by a matrix and three quadratic forms in the ``z``
it starts from, and two neighbouring stretches by

    (A2, Q2) after (A1, Q1) = (A2 A1, Q1 + A1' Q2 A1).

The rows are cut once into stretches of at most ``STRETCH`` values (the only copy
of the data).  Each pass turns stretches into summaries inside tasks and folds
those per series, at most ``FOLD`` at a time, so a series of any length is
shared by many tasks.  The first pass tries a coarse grid inside the tasks; a
safeguarded Newton search per series between the best point's neighbours follows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators.series import series_positions
from ferret.plans.sizing import checked_broadcast
from ferret.session import remove, stored

STRETCH = 512
FOLD = 1024
LEAST, MOST = 0.005, 0.995
GRID = [round(0.05 * k, 10) for k in range(1, 20)]
TOLERANCE = 1e-8
MOST_PASSES = 40
UNITS = 4  # z = (1, level, first and second derivative)


def stretches(df: DataFrame, key: str, order: str, tiebreak: str, y: str) -> tuple[DataFrame, int]:
    """(key, part, ys) with the values of each part in order, and the most parts of a series."""
    p = series_positions(df, key, order, tiebreak)
    part = F.floor((F.col("pos") - 1) / STRETCH).cast("long")
    value = F.struct("pos", F.col(y).cast("double").alias("y"))
    cut = (p.select(F.col(key).alias("key"), part.alias("part"), value.alias("v")).groupBy("key", "part")
           .agg(F.transform(F.array_sort(F.collect_list("v")), lambda v: v["y"]).alias("ys")))
    cut = cut.persist(StorageLevel.MEMORY_AND_DISK)
    return cut, (cut.agg(F.max("part")).collect()[0][0] or 0) + 1


def summarise(ys: list[np.ndarray], first: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maps (n, m, 4, 4) and forms (n, m, 3, 4, 4) of n stretches under m factors each; ``alpha`` (n, m)."""
    order = sorted(range(len(ys)), key=lambda k: -len(ys[k]))
    n, m = alpha.shape
    a = alpha[order][:, :, None]
    size = np.array([len(ys[k]) for k in order])
    y = np.zeros((n, size.max(initial=0)))
    for k, j in enumerate(order):
        y[k, :size[k]] = ys[j]
    z = np.zeros((3, n, m, UNITS))  # level and derivatives as linear functions of what comes in
    for k in range(3):
        z[k, :, :, k + 1] = 1.0
    starts = first[order]
    z[:, starts] = 0.0
    z[0, starts, :, 0] = y[starts, 0][:, None] if y.size else 0.0  # a series starts at its first value, without an error
    forms = np.zeros((n, m, 3, UNITS, UNITS))
    for t in range(y.shape[1]):
        live = int((size > t).sum())
        rows = np.arange(live) if t else np.flatnonzero(~starts[:live])
        l, d, h = z[:, rows]
        e = -l
        e[:, :, 0] += y[rows, t][:, None]
        forms[rows, :, 0] += e[..., :, None] * e[..., None, :]
        forms[rows, :, 1] += e[..., :, None] * d[..., None, :]
        forms[rows, :, 2] += d[..., :, None] * d[..., None, :] - e[..., :, None] * h[..., None, :]
        z[0, rows], z[1, rows], z[2, rows] = l + a[rows] * e, e + (1 - a[rows]) * d, (1 - a[rows]) * h - 2 * d
    maps = np.zeros((n, m, UNITS, UNITS))
    maps[:, :, 0, 0] = 1.0
    for k in range(3):
        maps[:, :, k + 1] = z[k]
    back = np.argsort(order)
    return maps[back], forms[back]


def fold(maps: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring stretches (first axis, in order) as one."""
    a, q = maps[0], forms[0]
    for b, r in zip(maps[1:], forms[1:], strict=True):
        q = q + np.einsum("mij,mfik,mkl->mfjl", a, r, a)
        a = b @ a
    return a, q


def _pack(maps, forms) -> bytes:
    return np.concatenate([maps.reshape(-1), forms.reshape(-1)]).tobytes()


def _unpack(raw: bytes, m: int):
    v = np.frombuffer(raw)
    return v[:m * 16].reshape(m, UNITS, UNITS), v[m * 16:].reshape(m, 3, UNITS, UNITS)


def evaluate(cut: DataFrame, parts: int, alphas: list[float] | None) -> DataFrame:
    """(key, sums): per factor, squared error and the two derivative sums of whole series.

    ``alphas``: the same factors for all series; None if ``cut`` has a column ``alpha``.
    """
    m = len(alphas) if alphas else 1
    kind = cut.schema["key"].dataType.simpleString()

    def to_summaries(batches):
        for batch in batches:
            ys = [np.asarray(v.values, dtype=np.float64) for v in batch.column("ys")]
            part = np.asarray(batch.column("part"))
            alpha = np.tile(alphas, (len(ys), 1)) if alphas else np.asarray(batch.column("alpha"))[:, None]
            maps, forms = summarise(ys, part == 0, alpha)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"),
                                              pa.array([_pack(a, q) for a, q in zip(maps, forms, strict=True)], pa.binary())],
                                             ["key", "part", "s"])

    def folded(batches):
        for batch in batches:
            out = []
            for row in batch.column("all").to_pylist():
                each = [_unpack(r["s"], m) for r in row]
                out.append(_pack(*fold(np.stack([a for a, _ in each]), np.stack([q for _, q in each]))))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), pa.array(out, pa.binary())], ["key", "part", "s"])

    schema = f"key {kind}, part long, s binary"
    out = cut.select("key", "part", "ys", *(["alpha"] if not alphas else [])).mapInArrow(to_summaries, schema)
    while parts > 1:
        out = (out.groupBy("key", F.floor(F.col("part") / FOLD).cast("long").alias("part"))
               .agg(F.array_sort(F.collect_list(F.struct(F.col("part").alias("k"), "s"))).alias("all")).mapInArrow(folded, schema))
        parts = -(-parts // FOLD)

    def totals(batches):
        for batch in batches:
            sums = [_unpack(r, m)[1][:, :, 0, 0].reshape(-1).tolist() for r in batch.column("s").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sums, pa.list_(pa.float64()))], ["key", "sums"])

    return out.mapInArrow(totals, f"key {kind}, sums array<double>")


def best_alpha(df: DataFrame, key: str, order: str, tiebreak: str, y: str) -> DataFrame:
    """(key, alpha, sse) per series, ``alpha`` between ``LEAST`` and ``MOST``.

    Series of one or two values, or of equal ones, have no error that depends on the factor: they get the first grid point.
    """
    cut, parts = stretches(df, key, order, tiebreak, y)
    sse = F.transform(F.sequence(F.lit(0), F.lit(len(GRID) - 1)), lambda k: F.struct(F.get("sums", 3 * k).alias("sse"), k.alias("k")))
    at = F.array_min(sse)["k"]
    grid = F.array(*[F.lit(g) for g in GRID])
    state, at_path = stored(evaluate(cut, parts, GRID).select(
        "key", F.get(grid, at).alias("alpha"), F.coalesce(F.get(grid, F.when(at > 0, at - 1)), F.lit(LEAST)).alias("lo"),
        F.coalesce(F.get(grid, at + 1), F.lit(MOST)).alias("hi"), F.get("sums", 3 * at).alias("best_sse"),
        F.get(grid, at).alias("best")), "smoothing")
    for _ in range(MOST_PASSES):
        new = evaluate(cut.join(checked_broadcast(state.select("key", "alpha")), "key"), parts, None)
        s, slope, curve = F.col("sums")[0], -F.col("sums")[1], F.col("sums")[2]
        j = state.join(new, "key")
        # the minimum lies where the slope changes its sign; a factor at the edge that wants to go on stays there
        lo, hi = F.when(slope < 0, F.col("alpha")).otherwise(F.col("lo")), F.when(slope > 0, F.col("alpha")).otherwise(F.col("hi"))
        j = j.select("key", "alpha", lo.alias("lo"), hi.alias("hi"), "best_sse", "best", s.alias("s"), slope.alias("slope"), curve.alias("curve"))
        newton = F.when(F.col("curve") > 0, F.col("alpha") - F.col("slope") / F.col("curve"))
        inside = (newton > F.col("lo")) & (newton < F.col("hi"))
        done = (F.col("slope") == 0) | ((F.col("curve") > 0) & (F.abs(newton - F.col("alpha")) <= TOLERANCE))
        step = (F.when(done | (F.col("lo") >= F.col("hi")), F.col("alpha")).when(inside, newton)
                .when((F.col("slope") < 0) & (F.col("hi") >= MOST), F.lit(MOST))
                .when((F.col("slope") > 0) & (F.col("lo") <= LEAST), F.lit(LEAST))
                .otherwise((F.col("lo") + F.col("hi")) / 2))
        better = F.col("s") <= F.col("best_sse")
        state, new_path = stored(j.select("key", step.alias("alpha"), "lo", "hi", F.when(better, F.col("s")).otherwise(F.col("best_sse")).alias("best_sse"),
                         F.when(better, F.col("alpha")).otherwise(F.col("best")).alias("best"),
                         (F.abs(step - F.col("alpha")) > TOLERANCE).alias("open")), "smoothing")
        remove(df.sparkSession, at_path)
        at_path = new_path
        if state.where("open").isEmpty():
            break
    cut.unpersist()
    return state.select(F.col("key").alias(key), F.col("best").alias("alpha"), F.col("best_sse").alias("sse"))
