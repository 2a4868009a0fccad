"""Projections, filters, renames, merges, limits (thin, declarative)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_target(df: DataFrame, target: str) -> DataFrame:
    return df.drop(target)


def select_target(df: DataFrame, target: str, key: str = "row_id") -> DataFrame:
    return df.select(key, target)


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def rename_suffix(df: DataFrame, pattern: str, repl: str, cols: list[str] | None = None) -> DataFrame:
    """Regex rename of (some) column names, e.g. ``_imputed$`` -> ``_target_encoded``."""
    cols = set(cols or df.columns)
    mapping = {c: re.sub(pattern, repl, c) for c in df.columns if c in cols}
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a != b})


def add_suffix(df: DataFrame, suffix: str, cols: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in cols})


def add_prefix(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def merge_one_to_one(left: DataFrame, right: DataFrame, on: str | list[str],
                     suffixes: tuple[str, str] = ("_x", "_y"), validate: bool = True) -> DataFrame:
    """Inner equi-join that requires both sides to be unique on the key.

    Overlapping non-key columns get ``_x`` / ``_y`` suffixes.  The uniqueness
    check is one partial+final aggregate per side.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if validate:
        for side, df in (("left", left), ("right", right)):
            dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").limit(1).collect()
            if dup:
                raise ValueError(f"merge_one_to_one: {side} side is not unique on {keys}")
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    lft = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    rgt = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return lft.join(rgt, keys, "inner")


def sorted_merge(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Inner merge sorted by the key (range-partitioned global sort)."""
    return left.join(right, on, "inner").orderBy(on)


def sort_desc(df: DataFrame, col: str, tiebreak: list[str] | None = None) -> DataFrame:
    return df.orderBy(F.desc(col), *(tiebreak or []))


def limit(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a stated order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, col: str, k: int = 15, by_abs: bool = True,
          tiebreak: list[str] | None = None) -> DataFrame:
    """The ``k`` largest values of ``col`` (by absolute value by default), sign kept."""
    key = F.abs(F.col(col)) if by_abs else F.col(col)
    return df.orderBy(key.desc(), *(tiebreak or [])).limit(k)
