"""Linear support vector classification with the squared hinge, by truncated Newton.

For signs s = -1 / +1 and rows z = (x, 1) the fit minimises

    1/n sum max(0, 1 - s z.w)^2 + reg / 2 ||w||^2

(the intercept is penalised as well).  More than two classes are one-against-rest,
all classes in the same passes.  A Newton direction comes from conjugate gradients
preconditioned by the Hessian's diagonal blocks of ``BLOCK`` columns (with fewer columns
that is the Hessian itself, and one product ends the search); a pass adds up, inside each
task, one Hessian-vector product per class, and a further pass the losses at all steps of
the line search together with the gradient and the blocks at the full step.  Only classes x
features x ``BLOCK`` numbers per task are shuffled and reach the driver, never their square.

Features are measured in units of their root mean square, so neither the passes nor the
stopping rule depend on their scale.  Missing feature values count as zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32
STEPS = 0.5 ** np.arange(20)  # tried in one pass, the largest that lowers the loss enough is taken
ENOUGH = 1e-4
ROUNDING = 1e-13              # of the loss: a full step near the optimum isn't refused for less


@dataclass
class SquaredHinge:
    features: list[str]
    weights: np.ndarray       # (classes, features); one row for two classes, for the second of them
    intercepts: np.ndarray
    gradient: float = 0.0     # largest component at the end, in scaled units
    passes: int = 0

    def margins(self) -> list[Column]:
        """One score a row of ``weights`` as expressions over the feature columns."""
        x = F.array(*[_value(c) for c in self.features])
        return [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b), F.lit(float(b)),
                            lambda acc, v: acc + v) for w, b in zip(self.weights, self.intercepts)]

    def place(self) -> Column:
        """The predicted place among the label values (ties: the first)."""
        scores = self.margins()
        if len(scores) == 1:
            return F.when(scores[0] > 0, 1.0).otherwise(0.0)
        return F.array_position(F.array(*scores), F.greatest(*scores)).cast("double") - 1


def _value(c: str) -> Column:
    x = F.col(f"`{c}`").cast("double")
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(0.0))


def _rows(batch: pa.RecordBatch, scale: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled rows with a final one, and the signs (rows, classes)."""
    x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, -1)
    z = np.hstack([x, np.ones((len(x), 1))]) / scale
    y = np.asarray(batch.column("y"))
    places = np.array([1]) if classes == 1 else np.arange(classes)
    return z, np.where(y[:, None] == places, 1.0, -1.0)


def _summed(rows: DataFrame, size: int, add) -> np.ndarray:
    """The sum over all tasks of ``size`` numbers; ``add(total, batch)`` adds a batch in place."""

    def task(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                add(total, batch)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(total))], ["sums"])

    parts = rows.mapInArrow(task, "sums array<double>").select(F.posexplode("sums").alias("k", "v"))
    out = np.zeros(size)
    for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


def fit_squared_hinge(train: DataFrame, features: list[str], label: str, classes: int, reg: float,
                      tolerance: float = 1e-9, max_newton: int = 100) -> SquaredHinge:
    """``label`` holds the places 0..classes-1 of the label values; rows without one are left out.

    Ends when no component of the gradient (in scaled units) is above ``tolerance``.
    """
    x = F.array(*[_value(c) for c in features])
    rows = (train.select(x.alias("x"), F.col(f"`{label}`").cast("int").alias("y")).where("y IS NOT NULL")
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        return _fit(rows, features, 1 if classes <= 2 else classes, reg, tolerance, max_newton)
    finally:
        rows.unpersist()


def _fit(rows, features, classes, reg, tolerance, max_newton) -> SquaredHinge:
    width = len(features) + 1
    shape, cells = (classes, width), classes * width

    def squares(total, batch):
        z, _ = _rows(batch, np.ones(width), classes)
        total[:width] += (z * z).sum(axis=0)
        total[width] += len(z)

    sums = _summed(rows, width + 1, squares)
    n = sums[width]
    if not n:
        raise ValueError("no labelled rows to learn from")
    scale = np.sqrt(sums[:width] / n)
    scale[scale == 0] = 1.0
    ridge = reg / scale ** 2
    passes = 1
    blocks = -(-width // BLOCK)
    padded = blocks * BLOCK
    losses = len(STEPS) * classes

    def look(w, d):
        """Losses at w + t d for every step t; gradient and inverted diagonal blocks of the Hessian at w + d."""

        def add(total, batch):
            z, s = _rows(batch, scale, classes)
            at, along = s * (z @ w.T), s * (z @ d.T)
            for i, t in enumerate(STEPS):
                total[i * classes:(i + 1) * classes] += (np.maximum(0.0, 1.0 - at - t * along) ** 2).sum(axis=0)
            short = np.maximum(0.0, 1.0 - at - along)
            total[losses:losses + cells] += (-2.0 * (short * s).T @ z).reshape(-1)
            square = total[losses + cells:].reshape(classes, blocks, BLOCK, BLOCK)
            z = np.pad(z, ((0, 0), (0, padded - width)))
            for k in range(classes):
                for b in range(blocks):
                    part = z[short[:, k] > 0, b * BLOCK:(b + 1) * BLOCK]
                    square[k, b] += 2.0 * part.T @ part

        v = _summed(rows, losses + cells + classes * padded * BLOCK, add) / n
        full = w + d
        loss = v[:losses].reshape(-1, classes) + np.array([(ridge * (w + t * d) ** 2).sum(axis=1) / 2 for t in STEPS])
        square = v[losses + cells:].reshape(classes, blocks, BLOCK, BLOCK)
        inner = np.arange(BLOCK)
        square[:, :, inner, inner] += np.append(ridge, np.ones(padded - width)).reshape(blocks, BLOCK)
        return loss, v[losses:losses + cells].reshape(shape) + ridge * full, np.linalg.inv(square)

    def eased(inverse, r):
        """The preconditioner: each block of the residual solved on its own."""
        parts = np.pad(r, ((0, 0), (0, padded - width))).reshape(classes, blocks, BLOCK, 1)
        return (inverse @ parts).reshape(classes, padded)[:, :width]

    def curved(w, p):
        """The Hessian at w times p, per class."""

        def add(total, batch):
            z, s = _rows(batch, scale, classes)
            active = s * (z @ w.T) < 1.0
            total += (2.0 * (active * (z @ p.T)).T @ z).reshape(-1)

        return _summed(rows, cells, add).reshape(shape) / n + ridge * p

    w = np.zeros(shape)
    loss, g, inverse = look(w, w)
    f = loss[0]
    passes += 1
    for _ in range(max_newton):
        size = np.abs(g).max(axis=1)
        if (size <= tolerance).all():
            break
        # conjugate gradients for H d = -g, every class on its own, all in the same passes
        d, r = np.zeros(shape), -g
        u = eased(inverse, r)
        goal = np.where(size > tolerance, np.minimum(0.1, size) * np.sqrt((r * u).sum(axis=1)), np.inf)
        p, ru = u.copy(), (r * u).sum(axis=1)
        for _ in range(4 * width):
            going = np.sqrt(np.maximum(ru, 0.0)) > goal
            if not going.any():
                break
            p[~going] = 0.0
            q = curved(w, p)
            passes += 1
            bend = (p * q).sum(axis=1)
            step = np.where(going, ru / np.where(bend > 0, bend, 1.0), 0.0)[:, None]
            d, r = d + step * p, r - step * q
            u = eased(inverse, r)
            left = (r * u).sum(axis=1)
            p = u + np.where(going, left / np.where(ru > 0, ru, 1.0), 0.0)[:, None] * p
            ru = np.where(going, left, ru)
        slope = (g * d).sum(axis=1)
        loss, g1, inverse1 = look(w, d)
        passes += 1
        fits = loss <= f + ENOUGH * STEPS[:, None] * slope + ROUNDING * f
        first = fits.argmax(axis=0)
        t = np.where(fits.any(axis=0), STEPS[first], 0.0)
        if not (t * np.abs(d).max(axis=1)).any():
            break  # no class can be lowered any further in floating point
        w = w + t[:, None] * d
        if (t < 1.0).any():
            loss, g1, inverse1 = look(w, np.zeros(shape))
            passes += 1
        f, g, inverse = loss[0], g1, inverse1
    plain = w / scale
    return SquaredHinge(list(features), plain[:, :-1], plain[:, -1], float(np.abs(g).max()), passes)
