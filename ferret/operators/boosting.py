"""Gradient boosting of one shared softmax over three or more classes.

Each round grows one regression tree per class on the residuals ``1[y = k] -
p_k`` of the common softmax, all classes level by level together.  Features are
cut once into at most ``BINS`` intervals at approximate quantiles.  A level is one
pass: every task adds up, per (class, node, feature, interval), the residuals, the
rows and ``|r| (1 - |r|)``, and one aggregate adds up the tasks' rows, so the
shuffle holds no data row and the driver only sums.  The last level's sums also give
the leaf values ``(K - 1) / K * sum r / sum |r| (1 - |r|)``.

Scores travel with the rows and are frozen by a reliable checkpoint every
``FREEZE`` rounds; in between a pass evaluates the few trees since then.

Missing feature values stand in the lowest interval.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.session import checkpoint_dir

BINS = 64
FREEZE = 10


@dataclass
class Tree:
    """A perfect tree of ``depth`` levels, nodes numbered 1.. as in a heap; a node that doesn't split sends all rows left."""
    depth: int
    feature: np.ndarray
    cut: np.ndarray       # rows with an interval (or value) of at most the cut go left
    value: np.ndarray     # of the leaves, left to right


@dataclass
class SoftmaxBoosting:
    features: list[str]
    edges: list[list[float]]
    start: np.ndarray                 # score of each class before any tree
    rate: float
    rounds: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)   # mean log-loss before each round

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape, np.uint8)
        for j, e in enumerate(self.edges):
            col = x[:, j]
            out[:, j] = np.where(np.isnan(col), 0, np.searchsorted(np.array(e), col, side="left"))
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (rows, classes) of raw feature rows."""
        return softmax(add_trees(np.tile(self.start, (len(x), 1)), self.bins(x), self.rounds, self.rate))


def softmax(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def descend(tree: Tree, bins: np.ndarray, levels: int) -> np.ndarray:
    """The heap number of the node that each row has reached after ``levels`` levels."""
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        node = 2 * node + (bins[rows, tree.feature[node]] > tree.cut[node])
    return node


def add_trees(raw: np.ndarray, bins: np.ndarray, rounds: list[list[Tree]], rate: float) -> np.ndarray:
    for trees in rounds:
        for k, t in enumerate(trees):
            raw[:, k] += rate * t.value[descend(t, bins, t.depth) - (1 << t.depth)]
    return raw


def _empty(depth: int) -> Tree:
    return Tree(depth, np.zeros(1 << depth, np.int64), np.full(1 << depth, 255, np.int64), np.zeros(1 << depth))


def _sums(state: DataFrame, trees: list[Tree], level: int, rounds, rate: float, n_features: int, classes: int, bins: int):
    """(class, node of the level, feature, interval, [residuals, |r| (1 - |r|), rows]) summed over all rows; and log-loss, rows."""
    shape = (classes, 1 << level, n_features, bins, 3)
    size = int(np.prod(shape))

    def add(batches):
        out, loss = np.zeros(shape), np.zeros(2)
        for batch in batches:
            n = batch.num_rows
            b = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(n, n_features)
            raw = np.asarray(batch.column("raw").flatten()).reshape(n, classes).copy()
            y = np.asarray(batch.column("y"))
            p = softmax(add_trees(raw, b, rounds, rate))
            loss += [-np.log(np.maximum(p[np.arange(n), y], 1e-300)).sum(), n]
            r = -p
            r[np.arange(n), y] += 1.0
            h = np.abs(r) * (1.0 - np.abs(r))
            for k, t in enumerate(trees):
                node = descend(t, b, level) - (1 << level)
                for j in range(n_features):
                    at = node * bins + b[:, j]
                    for s, w in enumerate((r[:, k], h[:, k], None)):
                        out[k, :, j, :, s] += np.bincount(at, w, minlength=bins << level).reshape(-1, bins)
        yield pa.RecordBatch.from_arrays([pa.array([np.append(out.reshape(-1), loss).tolist()], pa.list_(pa.float64()))], ["sums"])

    rows = (state.mapInArrow(add, "sums array<double>").select(F.posexplode("sums").alias("k", "v"))
            .where("v <> 0").groupBy("k").agg(F.sum("v").alias("v")).collect())
    total = np.zeros(size + 2)
    for r in rows:
        total[r["k"]] = r["v"]
    return total[:size].reshape(shape), total[size:]


def _split(tree: Tree, level: int, sums: np.ndarray, classes: int) -> None:
    """Choose the splits of a level (ties: first feature, lowest cut); ``sums`` of one class."""
    for node in range(1 << level):
        s = sums[node]
        total = s[0].sum(axis=0)
        left = np.cumsum(s, axis=1)[:, :-1]
        right = total - left
        ok = (left[..., 2] > 0) & (right[..., 2] > 0)
        heap = (1 << level) + node
        best = None
        if ok.any():
            gain = np.where(ok, left[..., 0] ** 2 / np.maximum(left[..., 2], 1) + right[..., 0] ** 2 / np.maximum(right[..., 2], 1), -np.inf)
            # the first of equal gains, whatever the order in which the tasks' sums were added
            j, cut = np.unravel_index(int((gain >= gain.max() * (1 - 1e-9)).argmax()), gain.shape)
            if gain[j, cut] - total[0] ** 2 / total[2] > 1e-12:
                best = int(j), int(cut)
        tree.feature[heap], tree.cut[heap] = best or (0, 255)
        if level == tree.depth - 1:
            halves = (left[best], right[best]) if best else (total, np.zeros(3))
            for side, (r, h, _) in enumerate(halves):
                tree.value[2 * node + side] = (classes - 1) / classes * r / h if h > 1e-150 else 0.0


def fit_softmax_boosting(train: DataFrame, features: list[str], label: str, classes: list, max_iter: int = 100,
                         max_depth: int = 3, rate: float = 0.1, bins: int = BINS) -> SoftmaxBoosting:
    """``classes``: the label values in order; rows without a label are left out."""
    if max_depth < 1 or not 2 <= bins <= 255:
        raise ValueError("boosting needs trees of a level at least and 2 to 255 intervals")
    x = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in features]
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("double")) - 1
    rows = train.select(F.array(*x).alias("x"), y.cast("int").alias("y")).where("y >= 0")
    probs = [k / bins for k in range(1, bins)]
    r = rows.agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.col("x")[j], probs, 10_000).alias(f"q{j}") for j in range(len(features))],
                 *[F.sum(F.when(F.col("y") == k, 1).otherwise(0)).alias(f"c{k}") for k in range(len(classes))]).collect()[0]
    if not r["n"]:
        raise ValueError("no labelled rows to learn from")
    model = SoftmaxBoosting(list(features), [sorted(set(r[f"q{j}"] or [])) for j in range(len(features))],
                            np.array([math.log(r[f"c{k}"] / r["n"]) if r[f"c{k}"] else -30.0 for k in range(len(classes))]), rate)
    n_features, k_classes = len(features), len(classes)
    schema = "bins binary, raw array<double>, y int"

    def begin(batches):
        for batch in batches:
            n = batch.num_rows
            v = np.array(batch.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, n_features)
            raw = np.tile(model.start, (n, 1))
            yield _state(model.bins(v), raw, batch.column("y"))

    def advance(rounds):
        def run(batches):
            for batch in batches:
                n = batch.num_rows
                b = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(n, n_features)
                raw = np.asarray(batch.column("raw").flatten()).reshape(n, k_classes).copy()
                yield _state(b, add_trees(raw, b, rounds, rate), batch.column("y"))
        return run

    checkpoint_dir(train.sparkSession)
    state = rows.mapInArrow(begin, schema).persist(StorageLevel.MEMORY_AND_DISK)
    fresh: list[list[Tree]] = []
    for _ in range(max_iter):
        trees = [_empty(max_depth) for _ in classes]
        for level in range(max_depth):
            sums, (loss, n) = _sums(state, trees, level, fresh, rate, n_features, k_classes, bins)
            for k, t in enumerate(trees):
                _split(t, level, sums[k], k_classes)
            if level == 0:
                model.losses.append(loss / n)
        model.rounds.append(trees)
        fresh.append(trees)
        if len(fresh) == FREEZE:
            frozen = state.mapInArrow(advance(fresh), schema).checkpoint()
            state.unpersist()
            state, fresh = frozen, []
    state.unpersist()
    return model


def _state(bins: np.ndarray, raw: np.ndarray, y) -> pa.RecordBatch:
    n, k = raw.shape
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(raw.reshape(-1), pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), lists, y], ["bins", "raw", "y"])
