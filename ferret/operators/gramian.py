"""Sums over all pairs of columns, in blocks of columns.

The columns are cut into blocks of ``BLOCK``; a pair of blocks is a small matrix per sum.
Pairs of blocks are dealt to scans of the rows so that the matrices of one scan take at most
``SCAN_BYTES`` in a task (up to about a thousand columns: one scan), and a scan reads only the
columns of its blocks.  Each task adds up its matrices with numpy on Arrow batches and gives one
row per pair of columns; a group-by on the pair sums the tasks.  The result stays a
DataFrame: neither the driver nor a task ever holds a matrix over all columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
SCAN_BYTES = 96 << 20
PIECE = 1 << 16  # pairs of columns in one batch of results


def _scans(blocks: int, block: int, sums: int) -> list[list[tuple[int, int]]]:
    """Pairs of blocks (x <= y) in groups that fit a scan; neighbours share blocks."""
    room = max(1, SCAN_BYTES // (8 * sums * block * block))
    pairs = [(x, y) for x in range(blocks) for y in range(x, blocks)]
    return [pairs[i:i + room] for i in range(0, len(pairs), room)]


def pair_sums(df: DataFrame, cols: list[Column], names: list[str], products) -> DataFrame:
    """(i, j, *names) for all i <= j: ``products(a, b)`` gives, of two blocks of columns (rows x block
    arrays), one matrix per name, summed over all rows.

    Every pair has a row, also without any input row.
    """
    k = len(cols)
    block = min(BLOCK, max(1, k))
    blocks = -(-k // block)
    schema = "i int, j int, " + ", ".join(f"{n} double" for n in names)
    spark = df.sparkSession
    pair = spark.range(k * k).select((F.col("id") / k).cast("int").alias("i"), (F.col("id") % k).cast("int").alias("j"))
    out = pair.where("i <= j").select("i", "j", *[F.lit(0.0).alias(n) for n in names])
    for scan in _scans(blocks, block, len(names)):
        used = sorted({b for p in scan for b in p})
        held = {b: list(range(b * block, min(k, (b + 1) * block))) for b in used}
        at, begin = {}, 0
        for b in used:
            at[b] = slice(begin, begin + len(held[b]))
            begin += len(held[b])
        rows = df.select(F.array(*[cols[i].cast("double") for b in used for i in held[b]]).alias("x"))
        out = out.unionAll(rows.mapInArrow(_adder(scan, held, at, begin, names, products), schema))
    return out.groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in names])


def _adder(scan, held, at, width, names, products):
    def add(batches):
        total = {p: None for p in scan}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, width)
            for p in scan:
                found = products(x[:, at[p[0]]], x[:, at[p[1]]])
                if total[p] is None:
                    total[p] = [np.zeros(m.shape) for m in found]
                for t, m in zip(total[p], found):
                    t += m
        for (bx, by), sums in total.items():
            if sums is None:
                continue
            i, j = np.meshgrid(np.array(held[bx], np.int32), np.array(held[by], np.int32), indexing="ij")
            upper = np.flatnonzero(i.ravel() <= j.ravel())
            for start in range(0, len(upper), PIECE):
                take = upper[start:start + PIECE]
                yield pa.RecordBatch.from_arrays([pa.array(i.ravel()[take]), pa.array(j.ravel()[take]),
                                                  *[pa.array(m.ravel()[take]) for m in sums]], ["i", "j", *names])
    return add


def both_ways(pairs: DataFrame, cols: list[str], *values: str) -> DataFrame:
    """(feature_x, feature_y, values) for the rows (i, j) and, where they differ, (j, i)."""
    turned = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return named(pairs.select(F.explode(turned).alias("p"), *values).select("p.i", "p.j", *values), cols, *values)


def named(pairs: DataFrame, cols: list[str], *values: str) -> DataFrame:
    """The column names in place of their numbers."""
    names = F.array(*[F.lit(c) for c in cols])
    return pairs.select(F.get(names, F.col("i")).alias("feature_x"), F.get(names, F.col("j")).alias("feature_y"), *values)
