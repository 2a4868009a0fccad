"""Order statistics without one-task windows.

* ``global_rank``    – exact 1-based position of every row in a total order.
* ``running_totals`` – exact prefix sums in a total order.
* ``exact_quantiles``– exact (linear-interpolated) quantiles of many columns.

All three avoid an un-partitioned window over data-sized input.  Ranks and
running totals range-partition on the full ordering (ties split by the key
columns, so a hot value is spread over many tasks), number rows inside each
partition, freeze that numbering with a reliable ``checkpoint`` (the
partition ids must be the same in both passes) and add per-partition offsets
from a table with one row per partition.  Quantiles use an approximate
sketch only to bracket the target rank, then count exactly inside the
bracket, so no task ever holds more than the bracket's distinct values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferret.session import checkpoint_dir, shuffle_partitions

_LOW_BITS = (1 << 33) - 1


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    return num_partitions or max(1, shuffle_partitions(df.sparkSession))


def _freeze(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _numbered(df: DataFrame, order: list[Column], num_partitions: int | None) -> DataFrame:
    p = _partitions(df, num_partitions)
    ranged = df.repartitionByRange(p, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    tagged = _freeze(tagged)
    return tagged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))


def _offsets(tagged: DataFrame, value_cols: list[str]) -> DataFrame:
    """One row per partition: exclusive prefix of row counts / sums."""
    aggs = [F.count(F.lit(1)).alias("__cnt")] + [F.sum(c).alias(f"__s_{c}") for c in value_cols]
    per_part = tagged.groupBy("_pid").agg(*aggs)
    # one row per partition (bounded by the partition count, not by the data)
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col("_pid"), F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__offcnt")]
    cols += [F.coalesce(F.sum(f"__s_{c}").over(w), F.lit(0)).alias(f"__off_{c}") for c in value_cols]
    return F.broadcast(per_part.select(*cols))


def global_rank(df: DataFrame, order: list[Column | str], key: list[str],
                rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row ordered by ``order`` then ``key``.

    ``key`` must make the order total (a unique row id).
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order] + [F.col(k) for k in key]
    tagged = _numbered(df, order_cols, num_partitions)
    offs = _offsets(tagged, [])
    out = tagged.join(offs, "_pid").withColumn(
        rank_col, F.col("__offcnt") + F.col("_local") + F.lit(1))
    return out.drop("_mid", "_pid", "_local", "__offcnt")


def running_totals(df: DataFrame, order: list[Column | str], value_cols: list[str],
                   prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along a total ``order``.

    Intended for tables with unique ordering keys (e.g. distinct scores).
    Also adds ``<prefix>rows`` = running row count.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = _numbered(df, order_cols, num_partitions)
    w = (Window.partitionBy("_pid").orderBy("_local")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = tagged.select("*", *[F.sum(c).over(w).alias(f"__loc_{c}") for c in value_cols],
                          F.count(F.lit(1)).over(w).alias("__loccnt"))
    offs = _offsets(tagged, value_cols)
    out = local.join(offs, "_pid")
    for c in value_cols:
        out = out.withColumn(prefix + c, F.col(f"__loc_{c}") + F.col(f"__off_{c}"))
    out = out.withColumn(prefix + "rows", F.col("__loccnt") + F.col("__offcnt"))
    drop = ["_mid", "_pid", "_local", "__loccnt", "__offcnt"]
    drop += [f"__loc_{c}" for c in value_cols] + [f"__off_{c}" for c in value_cols]
    return out.drop(*drop)


BINS = 1024        # per bracket and pass: what reaches the driver is bounded by brackets * BINS
FEW_ROWS = 10_000  # a bracket with no more rows is finished by its distinct values
COLS_PER_PASS = 32


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[tuple[str, float], float | None]:
    """Exact quantiles (linear interpolation, as ``quantile_cont``) of each column; NaN counts as missing.

    Bisection by histograms: a pass counts the rows of each bracket in equal
    bins, with the smallest and largest value of each bin (a partial aggregate,
    so a task sends at most ``BINS`` rows a bracket); the bin that holds the wanted rank is the
    next bracket.  A bracket of one value, or of few rows, is finished.  All
    columns and probabilities share the passes; no task holds the values.
    """
    out: dict[tuple[str, float], float | None] = {}
    for k in range(0, len(cols), COLS_PER_PASS):
        out.update(_exact_quantiles(df, cols[k:k + COLS_PER_PASS], probs))
    return out


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[tuple[str, float], float | None]:
    inf = float("inf")
    aggs = []
    for i, c in enumerate(cols):
        x = _number(c)
        finite = F.when(F.abs(x) < F.lit(inf), x)
        aggs += [F.count(x).alias(f"n{i}"), F.count_if(x == F.lit(-inf)).alias(f"m{i}"), F.count(finite).alias(f"f{i}"),
                 F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
    row = df.agg(*aggs).collect()[0]
    value: dict[tuple[int, int], float] = {}                             # (column, rank from 0) -> value
    bracket: dict[tuple[int, int], tuple[float, float, int, int]] = {}   # -> lowest, highest, rows below, rows inside
    for i in range(len(cols)):
        n, low, inside = row[f"n{i}"], row[f"m{i}"], row[f"f{i}"]
        for p in probs if n else []:
            for r in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                if r < low or r >= low + inside:
                    value[i, r] = -inf if r < low else inf
                else:
                    bracket[i, r] = (row[f"lo{i}"], row[f"hi{i}"], low, inside)
    while bracket:
        for t in [t for t, (lo, hi, *_) in bracket.items() if lo == hi]:
            value[t] = bracket.pop(t)[0]
        few = {t: b for t, b in bracket.items() if b[3] <= FEW_ROWS}
        wide = {t: b for t, b in bracket.items() if b[3] > FEW_ROWS}
        for part, binned in ((few, False), (wide, True)):
            if not part:
                continue
            spans = sorted({(t[0], b[0], b[1]) for t, b in part.items()})
            counts = _bracket_counts(df, cols, spans, binned)
            for t, (lo, hi, below, _) in part.items():
                for first, last, n in counts[spans.index((t[0], lo, hi))]:
                    if t[1] < below + n:
                        break
                    below += n
                bracket[t] = (first, last, below, n)
    out: dict[tuple[str, float], float | None] = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        for p in probs:
            if not n:
                out[c, p] = None
                continue
            h = (n - 1) * p
            a, b = value[i, math.floor(h)], value[i, math.ceil(h)]
            out[c, p] = a if a == b else a + (h - math.floor(h)) * (b - a)
    return out


def _bracket_counts(df: DataFrame, cols: list[str], spans: list, binned: bool) -> list[list[tuple[float, float, int]]]:
    """Per span (column, lowest, highest): (smallest, largest, rows) of its bins (or its distinct values), ascending."""
    structs = []
    for k, (i, lo, hi) in enumerate(spans):
        x = _number(cols[i])
        # halves keep the width of a bracket finite
        at = F.floor((x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2) * BINS) if binned and hi / 2 > lo / 2 else F.lit(0)
        structs.append(F.when(x.between(F.lit(lo), F.lit(hi)), F.struct(
            F.lit(k).alias("k"), F.least(at, F.lit(BINS - 1)).cast("int").alias("bin"), x.alias("v"))))
    rows = df.select(F.explode(F.filter(F.array(*structs), lambda s: s.isNotNull())).alias("s")).select("s.*")
    if binned and all(hi / 2 > lo / 2 for _, lo, hi in spans):
        grouped = rows.groupBy("k", "bin")
    else:  # also where the halves of neighbouring values coincide
        grouped = rows.groupBy("k", "v")
    got = grouped.agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count(F.lit(1)).alias("n")).select("k", "a", "b", "n").collect()
    out: list[list[tuple[float, float, int]]] = [[] for _ in spans]
    for r in sorted(got, key=lambda r: (r["k"], r["a"])):
        out[r["k"]].append((r["a"], r["b"], r["n"]))
    return out
