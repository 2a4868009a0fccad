"""File sources: CSV and columnar (parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, index_col: str | None = None) -> DataFrame:
    """Read CSV with a header.  Give ``schema`` for jobs; without it types are inferred
    (one extra pass over the file).  ``index_col`` is kept as an ordinary key column."""
    r = spark.read.option("header", header).option("escape", '"')
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if index_col is not None and index_col not in df.columns:
        raise KeyError(index_col)
    return df


def scan_columnar(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Columnar read; a column list becomes the scan's ReadSchema."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
