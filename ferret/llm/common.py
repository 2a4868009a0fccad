"""Helpers shared by the text operators: scratch tables, texts, word rules.

Texts: a null text counts as empty everywhere in this subpackage.  Operators
select the columns that they need before anything else, so extra columns (with
whatever names) never clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferret.session import checkpoint_dir

# fixed by the word rule: space, tab, line feed, vertical tab, form feed, carriage return
WORD_SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


# texts are large rows: Spark's 10,000 a batch would hold too much of them at a time, in the JVM and in Python
ARROW_ROWS = 1000
_ARROW_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``ARROW_ROWS`` rows, if they are larger."""
    if not 0 < int(spark.conf.get(_ARROW_KEY)) <= ARROW_ROWS:
        spark.conf.set(_ARROW_KEY, str(ARROW_ROWS))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder (never a machine-local one on a cluster)."""
    small_batches(spark)
    return f"{checkpoint_dir(spark).rstrip('/')}/ferret-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared scratch table and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch path through the file system that holds it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def clean_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this session; call it once results have been written."""
    delete(spark, f"{checkpoint_dir(spark).rstrip('/')}/ferret-llm")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, or with the first number from 2 on that makes it differ from all of ``taken`` (in any case of letters)."""
    lower, k, out = {c.lower() for c in taken}, 1, name
    while out.lower() in lower:
        k += 1
        out = f"{name}_{k}"
    return out


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
