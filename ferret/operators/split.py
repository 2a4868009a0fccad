"""Reproducible train/valid splits.

The split of a row is a pure function of its key and a seed (md5 of
``"<key>:<seed>"``), so it does not depend on partitioning, row order or
retries (``randomSplit`` does).

* threshold mode (``exact=False``): train when the 32-bit hash falls under
  ``train_frac * 2^32``; stratified in expectation, no shuffle at all.
* exact stratified mode: inside each class the rows ranked by hash; the first
  ``n_c - ceil(test_frac * n_c)`` are train.  The rank comes from
  ``global_rank`` over (class, hash, key) alone, which range-partitions, so one
  large class is spread over many tasks; it yields one cut per class, and the rows are
  compared with their class's cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferret.operators.rank import global_rank, running_totals

TRAIN, VALID = "train", "valid"


def hash32(key: str, seed: int) -> Column:
    """Unsigned 32-bit integer from the first 8 hex digits of md5("<key>:<seed>")."""
    s = F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hash32_sql(key: str, seed: int) -> str:
    """DuckDB equivalent of :func:`hash32`."""
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT)"


def split_random(df: DataFrame, key: str, train_frac: float = 0.75, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    cut = int(train_frac * (1 << 32))
    return df.withColumn(split_col, F.when(hash32(key, seed) < F.lit(cut), TRAIN).otherwise(VALID))


def split_stratified(df: DataFrame, key: str, target: str, train_frac: float = 0.75,
                     seed: int = 42, split_col: str = "split", exact: bool = True) -> DataFrame:
    if not exact:
        return split_random(df, key, train_frac, seed, split_col)
    test_frac = 1.0 - train_frac
    counts = df.groupBy(F.col(target).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    # class starts in the (class, hash, key) order: running totals over one row per class; nulls sort first
    starts = running_totals(counts, [F.col("_class")], ["_n"]).select(
        "_class", (F.col("cum__n") - F.col("_n")).alias("_start"),
        (F.col("_n") - F.ceil(F.round(F.col("_n") * F.lit(test_frac), 9))).alias("_ntrain"))
    # only key, class and hash are ranked; the last train row of each class is its cut
    narrow = df.select(F.col(target).alias("_class"), hash32(key, seed).alias("_h"), F.col(key).alias("_key"))
    ranked = global_rank(narrow, [F.col("_class"), F.col("_h")], ["_key"], rank_col="_grank")
    cut = (ranked.select(F.col("_class").alias("_c"), "_h", "_key", "_grank")
           .join(starts, F.col("_c").eqNullSafe(F.col("_class")))
           .where(F.col("_grank") == F.col("_start") + F.col("_ntrain"))
           .select("_c", F.col("_h").alias("_cut_h"), F.col("_key").alias("_cut_key")))
    h = hash32(key, seed)
    is_train = (h < F.col("_cut_h")) | ((h == F.col("_cut_h")) & (F.col(key) <= F.col("_cut_key")))
    out = df.join(cut, df[target].eqNullSafe(F.col("_c")), "left")
    return out.select(*[df[c] for c in df.columns],
                      F.when(F.coalesce(is_train, F.lit(False)), TRAIN).otherwise(VALID).alias(split_col))
