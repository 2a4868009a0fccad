"""Random forests whose nodes are counted where few tasks need to agree, and grown where their rows are.

Features are cut once into at most ``BINS`` intervals.  The rows stand in blocks of at
most ``ROWS_A_BLOCK``; every tree draws its bootstrap weights (Poisson) block by block from
the seed, the tree and the block, so a draw comes out alike in every pass and on every
retry.  Rows of a block that stand in the same intervals are one row of summed weights:
no tree can tell them apart, so the sums are the same.

A node of more than ``ROWS_A_GROUP`` rows (fewer, where so few trees would leave cores idle) is split by histograms that all tasks add up.  The
rows of every other node go to one task each, which grows the rest of that branch; without it
each level would send a histogram of every node from every task, which for the deep levels of a
hundred trees is far more than the rows themselves.

Splits are the best of a random subset of the features (a third of them for numbers, the square
root for classes), by variance; for two classes, as 0 and 1, these are the splits of Gini's
measure.  A value missing at scoring stands in the highest interval.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.session import remove, stored

BINS = 32
ROWS_A_BLOCK = 1 << 20
ROWS_A_GROUP = 1 << 21
ROWS_A_BRANCH = 12_288   # no smaller node is split by all tasks
ROWS_A_SCORING = 1 << 17
BYTES_A_ROUND = 4 << 30  # of rows dealt to trees at a time
NODES_AT_ONCE = 1 << 14
PACKED = 12              # so many features of 5 bits make up one number


@dataclass
class Tree:
    """Nodes by number, 0 the root; the children of a node are ``left`` and ``left + 1``, a leaf leads to itself."""
    feature: np.ndarray
    cut: np.ndarray       # rows of an interval of at most the cut go left
    left: np.ndarray
    value: np.ndarray     # mean label of the node's rows
    gain: np.ndarray      # per feature, for the importances

    def bytes(self) -> list[bytes]:
        return [a.tobytes() for a in (self.feature, self.cut, self.left, self.value, self.gain)]

    @classmethod
    def of(cls, parts) -> Tree:
        kinds = (np.int16, np.uint8, np.int32, np.float64, np.float64)
        return cls(*[np.frombuffer(p, k).copy() for p, k in zip(parts, kinds, strict=True)])

    def descend(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row reaches."""
        n, f = bins.shape
        flat, row, node = bins.reshape(-1), np.arange(n) * f, np.zeros(n, np.int32)
        for _ in range(levels):
            after = self.left[node] + (flat[row + self.feature[node]] > self.cut[node])
            if (after == node).all():
                break
            node = after
        return node


COLUMNS = ("feature", "cut", "left", "value", "gain")
SCHEMA = "edges array<array<double>>, depth int, tree int, " + ", ".join(f"{c} binary" for c in COLUMNS)


@dataclass
class Forest:
    features: list[str]
    edges: list[list[float]]
    depth: int
    trees: list[Tree]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees of the value each raw feature row ends at."""
        bins, place = alike(cut_up(x, self.edges))
        out = np.zeros(len(bins))
        for t in self.trees:
            out += t.value[t.descend(bins, self.depth)]
        out /= len(self.trees)
        return out if place is None else out[place]

    def importances(self) -> list[float]:
        """Share of the gains per feature, each tree with equal weight."""
        total = sum(t.gain / t.gain.sum() if t.gain.sum() > 0 else t.gain for t in self.trees)
        return (total / total.sum() if total.sum() > 0 else total).tolist()

    def rows(self) -> list[tuple]:
        return [(self.edges, self.depth, k, *map(bytearray, t.bytes())) for k, t in enumerate(self.trees)]

    @classmethod
    def of(cls, features: list[str], rows) -> Forest:
        rows = sorted(rows, key=lambda r: r["tree"])
        return cls(list(features), rows[0]["edges"], rows[0]["depth"], [Tree.of([r[c] for c in COLUMNS]) for r in rows])


def cut_up(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    out = np.zeros(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(np.array(e, np.float64), x[:, j], side="left")  # NaN comes last
    return out


def find_edges(train: DataFrame, x: list) -> list[list[float]]:
    """Where each feature is cut: between all values if they are few, else at quantiles."""
    probs = [k / BINS for k in range(1, BINS)]
    r = train.agg(*[a for j, c in enumerate(x) for a in (
        F.approx_count_distinct(c).alias(f"d{j}"), F.min(c).alias(f"a{j}"), F.max(c).alias(f"b{j}"),
        F.percentile_approx(c, probs, 10_000).alias(f"q{j}"))]).collect()[0]
    few = [j for j in range(len(x)) if r[f"d{j}"] <= 2 * BINS]
    held = train.agg(F.lit(0), *[F.collect_set(x[j]).alias(f"v{j}") for j in few]).collect()[0]
    out = []
    for j in range(len(x)):
        values = sorted(held[f"v{j}"]) if j in few else []
        if j in few and len(values) <= BINS:
            out.append([a + (b - a) / 2 for a, b in zip(values, values[1:])])
        else:
            out.append(sorted({v for v in [r[f"a{j}"], *r[f"q{j}"]] if v < r[f"b{j}"]})[-(BINS - 1):])
    return out


def alike(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """The different rows and the place of each row among them, or the rows themselves if that saves little."""
    n, f = bins.shape
    if f > PACKED or not n:
        return bins, None
    packed = np.zeros(n, np.uint64)
    for j in range(f):
        packed = (packed << np.uint64(5)) | bins[:, j]
    _, first, place = np.unique(packed, return_index=True, return_inverse=True)
    return (bins[first], place) if 2 * len(first) <= n else (bins, None)


def _splits(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best gain, cut) per node of a histogram (nodes, intervals, [weight, sum]); no gain where nothing can be split."""
    total = hist.sum(axis=1)
    part = hist.cumsum(axis=1)[:, :-1]
    w, s = part[..., 0], part[..., 1]
    rest = total[:, None, 0] - w
    ok = (w > 0) & (rest > 0)
    score = np.where(ok, s * s / np.where(ok, w, 1) + (total[:, None, 1] - s) ** 2 / np.where(ok, rest, 1), -np.inf)
    cut = score.argmax(axis=1)
    base = total[:, 1] ** 2 / np.maximum(total[:, 0], 1)
    gain = score[np.arange(len(cut)), cut] - base
    return np.where(gain > 1e-12 * base, gain, 0.0), cut


def subsets(nodes: int, features: int, some: int, rng) -> np.ndarray:
    if some >= features:
        return np.tile(np.arange(features), (nodes, 1))
    return rng.random((nodes, features)).argsort(axis=1)[:, :some]


def grow(bins: np.ndarray, w: np.ndarray, s: np.ndarray, depth: int, some: int, rng) -> Tree:
    """A tree of at most ``depth`` levels of splits over rows with a weight and a sum of labels."""
    n, f = bins.shape
    flat, row, node = bins.reshape(-1), np.arange(n) * f, np.zeros(n, np.int64)
    levels, gains, k, numbered = [], np.zeros(f), 1, 1
    for level in range(depth + 1):
        weight, total = np.bincount(node, w, k), np.bincount(node, s, k)
        feature, cut, left = np.zeros(k, np.int16), np.full(k, 255, np.uint8), np.arange(numbered - k, numbered, dtype=np.int32)
        levels.append((feature, cut, left, total / np.maximum(weight, 1e-300)))
        if level == depth:
            break
        best, tried = np.zeros(k), subsets(k, f, some, rng)
        if k > NODES_AT_ONCE:
            order = np.argsort(node, kind="stable")
            row, node, w, s = row[order], node[order], w[order], s[order]
        for a in range(0, k, NODES_AT_ONCE):
            b = min(k, a + NODES_AT_ONCE)
            at = slice(*np.searchsorted(node, [a, b])) if k > NODES_AT_ONCE else slice(None)
            for j in range(some):
                key = (node[at] - a) * BINS + flat[row[at] + tried[node[at], j]]
                hist = np.stack([np.bincount(key, v, (b - a) * BINS).reshape(-1, BINS) for v in (w[at], s[at])], axis=-1)
                gain, where = _splits(hist)
                better = np.flatnonzero(gain > best[a:b] * (1 + 1e-9))  # the first of equal gains
                best[a + better], feature[a + better], cut[a + better] = gain[better], tried[a + better, j], where[better]
        split = best > 0
        k = 2 * int(split.sum())
        if not k:
            break
        place = np.cumsum(split) - 1
        left[split] = numbered + 2 * place[split]
        numbered += k
        np.add.at(gains, feature[split], best[split])
        kept = split[node]
        if not kept.all():
            row, node, w, s = row[kept], node[kept], w[kept], s[kept]
        node = 2 * place[node] + (flat[row + feature[node]] > cut[node])
    return Tree(*[np.concatenate(p) for p in zip(*levels)], gains)


def _blocks(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """(block, rows, different rows, bins, labels) of blocks of the rows (x, y)."""
    f = len(edges)

    def gather(batches):
        from pyspark import TaskContext
        part, k, xs, ys = TaskContext.get().partitionId(), 0, [], []

        def block():
            bins, y = np.concatenate(xs), np.concatenate(ys)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k], pa.int64()), pa.array([len(y)], pa.int64()), pa.array([len(alike(bins)[0])], pa.int64()),
                 pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["block", "n", "different", "bins", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            xs.append(cut_up(np.array(batch.column(0).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, f), edges))
            ys.append(np.array(batch.column(1).to_numpy(zero_copy_only=False), np.float64))
            if sum(map(len, ys)) >= ROWS_A_BLOCK:
                yield block()
                k, xs, ys = k + 1, [], []
        if ys:
            yield block()

    return rows.mapInArrow(gather, "block long, n long, different long, bins binary, y binary")


def _draws(batches, trees, features: int, mean: float, seed: int | None):
    """(tree, bins, weights, sums of labels) of every block and tree, rows of no weight left out; no seed: each row once."""
    for batch in batches:
        for block, raw, ys in zip(batch.column("block").to_pylist(), batch.column("bins").to_pylist(), batch.column("y").to_pylist()):
            y = np.frombuffer(ys, np.float64) - mean
            bins, place = alike(np.frombuffer(raw, np.uint8).reshape(-1, features))
            for t in trees:
                w = np.ones(len(y)) if seed is None else np.random.default_rng([seed, t, block]).poisson(1.0, len(y)).astype(np.float64)
                s = w * y
                if place is not None:
                    w, s = np.bincount(place, w, len(bins)), np.bincount(place, s, len(bins))
                kept = np.flatnonzero(w)
                yield t, bins[kept], w[kept], s[kept]


def _count_open(blocks: DataFrame, tops: dict[int, Tree], opened: list[tuple[int, int]], tried: np.ndarray, features: int,
                mean: float, seed: int | None, levels: int) -> np.ndarray:
    """(open node, feature tried, interval, [weight, sum of labels, rows]) added up over all blocks."""
    shape = (len(opened), tried.shape[1], BINS, 3)
    places = {t: np.full(len(top.left), -1) for t, top in tops.items()}
    for k, (t, node) in enumerate(opened):
        places[t][node] = k
    trees = sorted({t for t, _ in opened})

    def add(batches):
        out = np.zeros(shape)
        for t, bins, w, s in _draws(batches, trees, features, mean, seed):
            at = places[t][tops[t].descend(bins, levels)]
            kept = np.flatnonzero(at >= 0)
            at, w, s = at[kept], w[kept], s[kept]
            for j in range(shape[1]):
                key = at * BINS + bins[kept, tried[at, j]]
                for i, v in enumerate((w, s, None)):
                    out[:, j, :, i] += np.bincount(key, v, len(opened) * BINS).reshape(-1, BINS)
        flat = out.reshape(-1)
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(flat[some])], ["k", "v"])

    total = np.zeros(int(np.prod(shape)))
    for r in blocks.mapInArrow(add, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        total[r["k"]] = r["v"]
    return total.reshape(shape)


def _with_children(top: Tree, node: int, feature: int, cut: int, values: list[float], gain: float) -> None:
    n = len(top.left)
    top.feature[node], top.cut[node], top.left[node] = feature, cut, n
    top.gain[feature] += gain
    top.feature, top.cut = np.append(top.feature, np.zeros(2, np.int16)), np.append(top.cut, np.full(2, 255, np.uint8))
    top.left, top.value = np.append(top.left, np.array([n, n + 1], np.int32)), np.append(top.value, values)


def _graft(top: Tree, node: int, branch: Tree) -> None:
    """Put a branch in the place of a leaf."""
    shift = len(top.left) - 1  # the branch's root takes the leaf's number
    left = np.where(branch.left == 0, node, branch.left + shift).astype(np.int32)
    for name, values in (("feature", branch.feature), ("cut", branch.cut), ("left", left), ("value", branch.value)):
        whole = np.append(getattr(top, name), values[1:])
        whole[node] = values[0]
        setattr(top, name, whole)
    top.gain = top.gain + branch.gain


def _grow_round(blocks: DataFrame, trees: list[int], items: int, features: int, some: int, depth: int, mean: float,
                seed: int | None, most: int) -> list[Tree]:
    first = 0 if seed is None else seed
    tops = {t: Tree(np.zeros(1, np.int16), np.full(1, 255, np.uint8), np.zeros(1, np.int32), np.zeros(1), np.zeros(features)) for t in trees}
    ready = {(t, 0): 0 for t in trees}  # nodes that a task grows, and their levels
    opened = list(ready) if items > most else []
    for level in range(depth):
        if not opened:
            break
        ready = {at: v for at, v in ready.items() if at not in set(opened)}
        tried = subsets(len(opened), features, some, np.random.default_rng([first, 1, trees[0], level]))
        counts, after = _count_open(blocks, tops, opened, tried, features, mean, seed, level), []
        found = [_splits(counts[:, j, :, :2]) for j in range(some)]
        for k, (t, node) in enumerate(opened):
            j = 0
            for i in range(1, some):  # the first of equal gains
                j = i if found[i][0][k] > found[j][0][k] * (1 + 1e-9) else j
            gain, cut = found[j][0][k], int(found[j][1][k])
            if not gain:
                whole = counts[k, 0].sum(axis=0)
                tops[t].value[node] = whole[1] / max(whole[0], 1)
                continue
            halves = [counts[k, j, :cut + 1].sum(axis=0), counts[k, j, cut + 1:].sum(axis=0)]
            _with_children(tops[t], node, int(tried[k, j]), cut, [h[1] / h[0] for h in halves], gain)
            for side, h in enumerate(halves):
                child = (t, int(tops[t].left[node]) + side)
                if h[2] > most:
                    after.append(child)
                elif level + 1 < depth:
                    ready[child] = level + 1
        opened = after

    def deal(batches):
        for t, bins, w, s in _draws(batches, [t for t in trees if any(x == t for x, _ in ready)], features, mean, seed):
            node = tops[t].descend(bins, depth)
            order = np.argsort(node, kind="stable") if len(tops[t].left) > 1 else np.arange(len(node))
            nodes, starts = np.unique(node[order], return_index=True)
            for v, rows in zip(nodes.tolist(), np.split(order, starts[1:])):
                if (t, v) in ready:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t], pa.int32()), pa.array([v], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (
                            bins[rows], w[rows].astype(np.float32), s[rows])]], ["tree", "node", "bins", "w", "s"])

    def branch(key, table):
        t, v = key[0].as_py(), key[1].as_py()
        bins = np.frombuffer(b"".join(table.column("bins").to_pylist()), np.uint8).reshape(-1, features)
        w = np.frombuffer(b"".join(table.column("w").to_pylist()), np.float32).astype(np.float64)
        s = np.frombuffer(b"".join(table.column("s").to_pylist()), np.float64)
        bins, place = alike(bins)
        if place is not None:
            w, s = np.bincount(place, w, len(bins)), np.bincount(place, s, len(bins))
        grown = grow(bins, w, s, depth - ready[t, v], some, np.random.default_rng([first, 2, t, v]))
        return pa.table([pa.array([t], pa.int32()), pa.array([v], pa.int32()), *[pa.array([b], pa.binary()) for b in grown.bytes()]],
                        names=["tree", "node", *COLUMNS])

    if ready:
        pairs = blocks.mapInArrow(deal, "tree int, node int, bins binary, w binary, s binary")
        # one task a branch: they are few and of bounded size, and would be joined to fewer tasks than cores
        grown = pairs.repartition(len(ready), "tree", "node").groupBy("tree", "node").applyInArrow(
            branch, "tree int, node int, " + ", ".join(f"{c} binary" for c in COLUMNS))
        for r in sorted(grown.collect(), key=lambda r: (r["tree"], r["node"])):
            _graft(tops[r["tree"]], r["node"], Tree.of([r[c] for c in COLUMNS]))
    for top in tops.values():
        top.value = top.value + mean
    return [tops[t] for t in trees]


def fit_forest(train: DataFrame, features: list[str], label: str, trees: int, depth: int, some: int, seed: int | None,
               classes: bool = False) -> Forest:
    """A forest of the mean of a numeric label; for two classes, the label is 0 or 1.  No seed: every row counts once."""
    x = [F.col(f"`{c}`").cast("double") for c in features]
    y = F.col(f"`{label}`").cast("double")
    finite = [F.coalesce(F.abs(c) < float("inf"), F.lit(False)) for c in (y, *x)]  # NaN is above infinity
    wrong, mean = train.agg(F.count_if(~reduce(and_, finite)), F.avg(y)).collect()[0]
    if wrong:  # as Spark's own estimators do
        raise ValueError(f"{wrong} rows with a label or feature that is missing or infinite")
    mean = 0.0 if classes else mean  # sums of numbers are taken from the mean; those of 0 and 1 are exact
    edges = find_edges(train, x)
    blocks, path = stored(_blocks(train.select(F.array(*x).alias("x"), y.alias("y")), edges), "forest")
    try:
        rows, items = blocks.agg(F.sum("n"), F.sum("different")).collect()[0]
        # few trees are split into as many branches as keep all cores busy
        most = max(ROWS_A_BRANCH, min(ROWS_A_GROUP, items * trees // (4 * train.sparkSession.sparkContext.defaultParallelism)))
        # an open node holds more rows than a group, so a round's histograms are bounded with its rows
        at_once = max(1, int(BYTES_A_ROUND / (items * (len(features) + 12))))
        grown: list[Tree] = []
        for a in range(0, trees, at_once):
            grown += _grow_round(blocks, list(range(a, min(trees, a + at_once))), items, len(features), some, depth, mean, seed, most)
    finally:
        remove(train.sparkSession, path)
    return Forest(list(features), edges, depth, grown)


def features_tried(count: int, classes: bool) -> int:
    return max(1, math.ceil(math.sqrt(count) if classes else count / 3))
