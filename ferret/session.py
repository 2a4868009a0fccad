"""Session helpers: one place for the Spark settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale as much as locally: adaptive re-planning,
# skew-join splitting, UTC timestamps, no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # concurrent model fits (driver threads) share the executors instead of queueing
    "spark.scheduler.mode": "FAIR",
    # rank / running-total checkpoints are dropped once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "ferret", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("FERRET_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("FERRET_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and run tables.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session. Only a local-mode session (tests, the laptop) without one gets a
    fresh temporary folder — a machine-local folder is never used on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder for checkpoints"
        )
    local = tempfile.mkdtemp(prefix="ferret-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to a new table in the shared folder and read it back: cuts lineage with a single execution.

    Returns the table and its path, for ``remove`` when it is no longer read.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/ferret-state/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through the file system that holds it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def run_root(spark: SparkSession) -> str:
    """Root folder for stored run tables (``ferret.run.dir`` or under the checkpoint dir)."""
    named = spark.conf.get("ferret.run.dir", None)
    if named:
        return named.rstrip("/")
    base = checkpoint_dir(spark).rstrip("/")
    return base + "/ferret-runs"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
