"""Readers for the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_all(spark: SparkSession, sf_dir: str) -> None:
    """Expose every given table as a temp view (for ``spark.sql``)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
