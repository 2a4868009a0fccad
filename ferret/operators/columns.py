"""Schema helpers and the one-pass per-column statistics every report shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def kind(dt: T.DataType) -> str:
    if isinstance(dt, INTEGRAL):
        return "integral"
    if isinstance(dt, FRACTIONAL):
        return "fractional"
    if isinstance(dt, T.StringType):
        return "string"
    return "other"


def kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: kind(f.dataType) for f in df.schema.fields}


def is_missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN for float columns (one notion of missing, as the reference has)."""
    dt = df.schema[c].dataType
    x = F.col(c)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise NaN to NULL in float columns (ingest step)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cols.append(F.when(F.isnan(f.name), None).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long table (feature, null_count, n) from ONE aggregate over all columns."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(is_missing(df, c)).alias(c) for c in cols]
    wide = df.agg(*aggs)
    return wide.unpivot("__n", cols, "feature", "null_count").withColumnRenamed("__n", "n")


def unpivot_values(df: DataFrame, cols: list[str], ids: list[str] | None = None,
                   cast: str | None = None) -> DataFrame:
    """(ids..., feature, value) rows for the given columns (nulls kept)."""
    ids = ids or []
    vals = [F.struct(F.lit(c).alias("feature"),
                     (F.col(c).cast(cast) if cast else F.col(c)).alias("value")) for c in cols]
    return df.select(*ids, F.explode(F.array(*vals)).alias("_s")).select(
        *ids, "_s.feature", "_s.value")
