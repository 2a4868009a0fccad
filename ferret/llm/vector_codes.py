"""Operator 11: product codes of vectors, with Drake-Hamerly adaptive bounds.

Vectors become integers (``floor(4096 x)``) and are cut into equal parts; each part
position has a codebook that rounds of assignment and averaging refine.  Every
part carries, from round to round in the written table,

* its entry and an upper bound of the distance to it,
* its ``b`` next closest entries with ascending lower bounds,
* one outer lower bound of all others.

When entries have moved, the upper bound grows by the move of the part's entry, each
lower bound shrinks by that of its entry, the outer one by the largest move.
A part whose upper bound is below its first lower bound keeps its entry unseen.  An
uncertain one is verified in integers: first the distance to its entry, then the
entries whose lower bounds aren't above it, and all entries only when the outer
bound fails.  ``b`` starts at a quarter of the entries and falls, not below an
eighth, to the length of list that all but a hundredth of a round's parts got along with.

All of it is exact: bounds are integers rounded to the safe side, distances are
squared integers, ties go to the lower index, and a bound that is merely equal
counts as uncertain.  Rows are never shuffled: each round reads the table of the round
before and writes its own, whose tasks append one row of sums per entry; those are
added up by an aggregate, and only entries x components numbers reach the driver.
A round's table is removed once the next one is written.

Cases: rows whose vector is null or holds a null or a component that isn't finite are
dropped; with fewer rows than entries the codebooks have as many entries as rows;
repeated rows are coded each; equal keys are ordered by their vectors, a null key
stands behind all others; an empty table gives an empty result.  Vectors must have
one length that the parts divide, and components below 2^16 in size (a squared
distance then fits a long); anything else raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.llm.common import delete, scratch

SCALE = 4096
LARGEST = 1 << 28  # of an integer component: 32 squared differences fit 63 bits
FAR = np.int64(1) << np.int64(40)  # beyond every distance
NO_BOUND = -FAR


def root_down(d2: np.ndarray) -> np.ndarray:
    r = np.sqrt(d2.astype(np.float64)).astype(np.int64)
    r -= r * r > d2
    return r + ((r + 1) * (r + 1) <= d2)


def root_up(d2: np.ndarray) -> np.ndarray:
    r = root_down(d2)
    return r + (r * r < d2)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    d = x - entries
    return np.einsum("...i,...i->...", d, d)


@dataclass
class Bounds:
    """Of n parts: ``near`` (n, b + 1) entry and next closest ones; ``limits`` (n, b + 2) upper, lower and outer bounds."""
    near: np.ndarray
    limits: np.ndarray


def closest(x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
    """Bounds from the distances to all entries."""
    d2 = np.stack([squared(x, e) for e in book], axis=1)
    order = np.argsort(d2, axis=1, kind="stable")[:, :b + 2]  # stable: ties to the lower index
    near = order[:, :b + 1]
    d2 = np.take_along_axis(d2, order, axis=1)
    limits = np.full((len(x), b + 2), FAR, np.int64)
    limits[:, 0] = root_up(d2[:, 0])
    limits[:, 1:d2.shape[1]] = root_down(d2[:, 1:])
    return Bounds(near.astype(np.int64), limits)


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return root_up(squared(new, old))


def reassigned(x: np.ndarray, book: np.ndarray, moves: np.ndarray, state: Bounds, b: int) -> tuple[Bounds, np.ndarray]:
    """The bounds after the entries moved, ``b`` of them kept on; and how many parts ended at which depth of their list.

    Depth 0: kept by their bounds; 1: by the distance to their own entry; 2 to b + 1:
    some of the list were compared; b + 2: all entries.
    """
    had = state.near.shape[1] - 1
    near = state.near.copy()
    upper = state.limits[:, 0] + moves[near[:, 0]]
    lower = np.empty((len(x), had + 1), np.int64)
    lower[:, :had] = state.limits[:, 1:had + 1] - moves[near[:, 1:]]
    lower[:, had] = np.where(state.limits[:, had + 1] >= FAR // 2, FAR, state.limits[:, had + 1] - moves.max(initial=0))
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]  # ordered again
    reached = np.zeros(had + 3, np.int64)

    open_ = np.flatnonzero(upper >= lower[:, 0])
    reached[0] = len(x) - len(open_)
    own = squared(x[open_], book[near[open_, 0]])
    upper[open_] = root_up(own)
    depth = (lower[open_] <= upper[open_, None]).sum(axis=1)  # ordered: so many entries of the list may be nearer
    reached[1:] = np.bincount(depth, minlength=had + 2)
    for z in range(1, had + 1):
        here = open_[depth == z]
        if not len(here):
            continue
        ids = np.sort(near[here, :z + 1], axis=1)  # ascending, for ties
        d2 = np.stack([squared(x[here], book[ids[:, j]]) for j in range(z + 1)], axis=1)
        order = np.argsort(d2, axis=1, kind="stable")
        near[here, :z + 1] = np.take_along_axis(ids, order, axis=1)
        d2 = np.take_along_axis(d2, order, axis=1)
        upper[here] = root_up(d2[:, 0])
        lower[here, :z] = root_down(d2[:, 1:])
    lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
    limits = np.empty((len(x), b + 2), np.int64)
    limits[:, 0] = upper
    limits[:, 1:] = lower[:, :b + 1]  # ordered: the first one that is dropped bounds all the others
    near = near[:, :b + 1]
    if len(full := open_[depth == had + 1]):
        fresh = closest(x[full], book, b)
        near[full], limits[full] = fresh.near, fresh.limits
    return Bounds(near, limits), reached


def first_b(entries: int) -> int:
    return min(max(entries // 4, 1), entries - 1)


def next_b(b: int, entries: int, reached, spare: float = 0.01) -> int:
    """The length of list that all but ``spare`` of the parts got along with; never growing, at least an eighth of the entries.

    A part that needs a longer list is compared with all entries, so no length loses anything.
    """
    least = min(max(entries // 8, 1), b)
    deeper = np.cumsum(reached[::-1])[::-1]  # from each depth on
    beyond_list = reached[b + 2]
    return next((z for z in range(least, b) if deeper[z + 2] - beyond_list <= spare * deeper[0]), b)


def integer_vectors(batch, vector: str, parts: int, width: int) -> np.ndarray:
    col = batch.column(vector)
    flat = np.asarray(col.flatten())
    if len(flat) != len(col) * width:
        raise ValueError(f"vectors must have one length; found others than {width}")
    if flat.dtype.kind == "f":
        flat = np.floor(flat.astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() > LARGEST:
        raise ValueError(f"components must be below {LARGEST // SCALE} in size")
    return flat.astype(np.int64).reshape(len(col), parts, width // parts)


def _sums(x: np.ndarray, codes: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` (parts, entries, components + 1) the sums and, last, the counts of each entry's parts."""
    for p in range(x.shape[1]):
        mine = (codes[:, p, None] == np.arange(out.shape[1])).astype(np.float64)
        out[p, :, :-1] += (mine.T @ x[:, p]).astype(np.int64)  # exact: a batch's sums stay below 2^53
        out[p, :, -1] += mine.sum(axis=0).astype(np.int64)


@dataclass
class Codes:
    """``rows``: key, label, code, error.  ``books`` (parts, entries, components).  ``reached``: per round, parts by depth."""
    rows: DataFrame
    books: np.ndarray
    reached: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), v.alias("vector"))
            .where(F.col("vector").isNotNull() & finite))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = 8, entries: int = 16, rounds: int = 6) -> Codes:
    """Codebooks after ``rounds`` rounds, and every usable row's code and error."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    source = usable(vectors, key, vector, label)
    # bounded: as many rows as there are entries
    start = source.select("key", "vector").orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).collect()
    width = len(start[0]["vector"]) if start else 0
    if width % parts:
        raise ValueError(f"{parts} parts don't divide vectors of {width} components")
    if any(len(r["vector"]) != width for r in start):
        raise ValueError("vectors must have one length")
    k = len(start)
    label_type = source.schema["label"].dataType.simpleString()
    result = f"key long, label {label_type}, code string, error long"
    if not k:
        return Codes(spark.createDataFrame([], result), np.zeros((parts, 0, 0), np.int64), [])
    first = np.floor(np.array([r["vector"] for r in start], np.float64).reshape(k, parts, width // parts) * SCALE)
    books = first.astype(np.int64).transpose(1, 0, 2)

    b, moves, at, table, reached = first_b(k), None, None, source, []
    shape = (parts, k, width // parts + 1)
    for _ in range(rounds + 1):
        path = scratch(spark, "codes")
        had = reached and at[1]
        coded = _assign(table, books, moves, had, b, parts, width, label_type)
        coded.write.parquet(path)
        if at:
            delete(spark, at[0])
        table, at = spark.read.schema(coded.schema).parquet(path), (path, b)
        tally = (table.where("tally IS NOT NULL").select(F.posexplode("tally").alias("k", "n"))
                 .groupBy("k").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect())
        total = np.zeros(int(np.prod(shape)) + k + 3, object)
        for r in tally:
            total[r["k"]] = int(r["n"])
        depths = total[int(np.prod(shape)):]
        reached.append(depths)
        if len(reached) > rounds:
            break
        sums = total[:int(np.prod(shape))].reshape(shape)
        used = sums[:, :, -1:] > 0
        new = np.where(used, sums[:, :, :-1] // np.where(used, sums[:, :, -1:], 1), books).astype(np.int64)
        moves = np.stack([moved(books[p], new[p]) for p in range(parts)])
        books = new
        b = next_b(b, k, depths) if len(reached) > 1 else b

    def code(rows):
        for batch in rows:
            x = np.asarray(batch.column("vector").flatten(), dtype=np.int64).reshape(batch.num_rows, parts, width // parts)
            near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(batch.num_rows, parts, -1)
            codes = near[:, :, 0]
            error = sum(squared(x[:, p], books[p][codes[:, p]]) for p in range(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(error, pa.int64())], ["key", "label", "code", "error"])

    rows = table.where("tally IS NULL").select("key", "label", "vector", "near").mapInArrow(code, result)
    return Codes(rows, books, reached)


def _assign(table: DataFrame, books, moves, had, b: int, parts: int, width: int, label_type: str) -> DataFrame:
    """The rows with new bounds, and one row with the sums of each task."""
    k, schema = books.shape[1], f"key long, label {label_type}, vector array<int>, near binary, limits array<long>, tally array<long>"
    names = [f.split()[0] for f in schema.split(", ")]
    begun = moves is None

    def assign(rows):
        sums, depths = np.zeros((parts, k, width // parts + 1), np.int64), np.zeros(k + 3, np.int64)
        label_arrow = None
        for batch in rows:
            n = batch.num_rows
            label_arrow = batch.schema.field("label").type
            x = integer_vectors(batch, "vector", parts, width)
            near, limits = np.empty((n, parts, b + 1), np.uint8), np.empty((n, parts, b + 2), np.int64)
            if begun:
                for p in range(parts):
                    new = closest(x[:, p], books[p], b)
                    near[:, p], limits[:, p] = new.near, new.limits
                depths[b + 2] += n * parts
            else:
                old_near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8).reshape(n, parts, had + 1)
                old_limits = np.asarray(batch.column("limits").flatten()).reshape(n, parts, had + 2)
                for p in range(parts):
                    new, reached = reassigned(x[:, p], books[p], moves[p], Bounds(old_near[:, p].astype(np.int64), old_limits[:, p]), b)
                    near[:, p], limits[:, p] = new.near, new.limits
                    depths[:len(reached)] += reached
            _sums(x, near[:, :, 0], sums)
            flat = pa.array(x.reshape(-1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, max(width, 1))[:n + 1] if width else np.zeros(n + 1), pa.int32()), flat),
                 pa.array([r.tobytes() for r in near], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * parts * (b + 2), pa.int32()), pa.array(limits.reshape(-1), pa.int64())),
                 pa.nulls(n, pa.list_(pa.int64()))], names)
        if label_arrow is not None:
            one = np.concatenate([sums.reshape(-1), depths])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, label_arrow), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.binary()),
                 pa.nulls(1, pa.list_(pa.int64())), pa.array([one.tolist()], pa.list_(pa.int64()))], names)

    if begun:
        return table.mapInArrow(assign, schema)
    return table.where("tally IS NULL").select("key", "label", "vector", "near", "limits").mapInArrow(assign, schema)


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with the error summed over equal labels (nulls together).

    Sums are made per task before they are dealt out; the join takes back one sum
    per label, which adaptive execution broadcasts when it is measured to be small.
    """
    per = rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return rows.join(per.withColumnRenamed("label", "other"), F.col("label").eqNullSafe(F.col("other")), "left").drop("other")
