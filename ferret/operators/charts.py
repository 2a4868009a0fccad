"""Chart data as long DataFrames: (chart, series, x, y[, id]).

Lengths match by construction (each point is one row); non-finite y values are
dropped; bar charts whose series disagree on their label set are rejected
with a ``left_anti`` check instead of a drawing error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(col: str):
    c = F.col(col).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def chart_series(df: DataFrame, chart: str, series: str, x: str, y: str, id_col: str | None = None,
                 x_numeric: bool = True) -> DataFrame:
    xs = F.col(x).cast("double") if x_numeric else F.col(x).cast("string")
    cols = [F.lit(chart).alias("chart"), F.lit(series).alias("series"), xs.alias("x"),
            F.col(y).cast("double").alias("y")]
    if id_col:
        cols.append(F.col(id_col).alias("id"))
    keep = finite(y) & (finite(x) if x_numeric else F.lit(True))
    return df.where(keep).select(*cols)


def check_bar_labels(points: DataFrame) -> None:
    """Every series of a bar chart must have the same x labels; raises otherwise."""
    series = [r["series"] for r in points.select("series").distinct().collect()]
    if len(series) < 2:
        return
    first = points.where(F.col("series") == series[0]).select("x").distinct()
    for s in series[1:]:
        other = points.where(F.col("series") == s).select("x").distinct()
        if first.join(other, "x", "left_anti").limit(1).count() or \
                other.join(first, "x", "left_anti").limit(1).count():
            raise ValueError(f"bar series {series[0]!r} and {s!r} have different labels")
