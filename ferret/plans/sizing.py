"""Size checks before a broadcast.

A lookup table is broadcast only after its rows and bytes have been measured and
found under both bounds; otherwise the join stays a shuffle join and adaptive
execution picks the strategy from the sizes it measures itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_ROWS = 100_000
MOST_BYTES = 8 << 20
_FIXED_BYTES = 16  # a value of fixed width with its share of a row


def row_bytes(df: DataFrame):
    """An upper estimate of a row's bytes as an expression."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        wide = not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))
        size = F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) if wide else F.lit(0)
        total = total + _FIXED_BYTES + size
    return total


def checked_broadcast(df: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df`` for the small side of a join: rows held by the driver and broadcast if both bounds hold, else unchanged.

    One more row than the bound is the most that is ever collected, and only after
    the bytes of those rows have been summed where they are.
    """
    probe = df.limit(most_rows + 1)
    n, size = probe.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).collect()[0]
    if n > most_rows or size > most_bytes:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(df.collect(), df.schema))
