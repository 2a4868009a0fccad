"""Run tables: every stage of a run stored as parquet under one run folder.

Catalog tables per run:

* ``data_tables(table_name, n_columns)``  – registry of stored tables
* ``features(category, feature)``         – role lists, long form
* ``models(identifier, model_type, params, version)`` – latest version wins
* ``fit_models(identifier, dataset, path)``
* ``predictions(identifier, dataset, row_id, prediction, probability)``
* ``scores(identifier, dataset, score)``

Every table is a ``VersionedTable``: writers commit numbered manifests, so concurrent
writers lose no row, readers always find a whole table, and a job cut off at any
step leaves the table as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferret.session import run_root
from ferret.sources.manifest import VersionedTable

SCHEMAS = {
    "data_tables": "table_name string, n_columns int",
    "features": "category string, feature string",
    "models": "identifier string, model_type string, params map<string,string>, version bigint",
    "fit_models": "identifier string, dataset string, path string",
    "predictions": ("identifier string, dataset string, row_id bigint, prediction double, "
                    "probability double"),
    "scores": "identifier string, dataset string, score double",
}

SQL_TYPES = {"string": "text", "double": "real", "float": "real", "bigint": "int",
             "int": "int", "smallint": "int", "tinyint": "int"}


class RunStore:
    def __init__(self, spark: SparkSession, run_id: str | None = None, root: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self.root = (root or run_root(spark)).rstrip("/") + "/" + self.run_id

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def versioned(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name))

    # -- creation / deletion ------------------------------------------------
    def create_run_tables(self, overwrite: bool = True) -> list[str]:
        for name, ddl in SCHEMAS.items():
            if overwrite or not self.exists(name):
                self.versioned(name).create(T.StructType.fromDDL(ddl))
        return list(SCHEMAS)

    def exists(self, name: str) -> bool:
        return self.versioned(name).exists()

    def drop_table(self, name: str) -> None:
        """``DROP TABLE IF EXISTS``: no longer registered, then gone."""
        if name != "data_tables" and self.exists("data_tables"):
            self.versioned("data_tables").transact(lambda now: now.where(F.col("table_name") != name))
        self.versioned(name).drop()

    # -- reads ---------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        return self.versioned(name).read()

    def load_dfs(self, names=("untransformed", "imputed", "transformed", "train_target",
                              "valid_target")) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}

    # -- writes --------------------------------------------------------------
    def sink_table(self, name: str, df: DataFrame) -> DataFrame:
        """Replace table contents (helper ``index`` column dropped) and register it."""
        df = df.drop("index")
        self.versioned(name).overwrite(df)
        entry = self.spark.createDataFrame([(name, len(df.columns))], SCHEMAS["data_tables"])
        self.versioned("data_tables").transact(
            lambda now: entry if now is None else now.where(F.col("table_name") != name).unionByName(entry))
        return self.table(name)

    def sink_rows(self, name: str, df: DataFrame) -> None:
        """Bulk insert (a new folder of files, added by one commit)."""
        self.versioned(name).append(df)

    def append_row(self, name: str, df: DataFrame) -> None:
        self.sink_rows(name, df)

    def upsert_model(self, specs: DataFrame) -> DataFrame:
        """REPLACE INTO models keyed by identifier: append a new version, read latest.

        The version is one above the highest of the state that the rows are committed to.
        """
        def numbered(now):
            nxt = now.agg(F.coalesce(F.max("version"), F.lit(0)).alias("v")).collect()[0]["v"] + 1
            return specs.withColumn("version", F.lit(nxt).cast("bigint"))

        self.versioned("models").append_computed(numbered)
        return self.models()

    def models(self) -> DataFrame:
        w = Window.partitionBy("identifier").orderBy(F.desc("version"))
        return (self.table("models").withColumn("_rn", F.row_number().over(w))
                .where("_rn = 1").drop("_rn"))


def schema_to_ddl(df: DataFrame) -> DataFrame:
    """(column_name, sql_type): string->text, float->real, int->int, others keep Spark's name."""
    rows = []
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        rows.append((f.name, SQL_TYPES.get(s, s)))
    return df.sparkSession.createDataFrame(rows, "column_name string, sql_type string")


def ddl_string(df: DataFrame) -> str:
    return "( " + ", ".join(f"[{r[0]}] {r[1]}" for r in schema_to_ddl(df).collect()) + " )"
