"""Keyed test frames derived from the given tables.

Every frame carries an explicit unique ``row_id``: rows are never paired by
position.  Nulls are injected by key (the given tables have none where the
operators need them).  The SQL text of each frame (``*_SQL``) runs unchanged
in Spark SQL and DuckDB and is the oracle's starting point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferret.sources.tables import table

ORDERS_FRAME_SQL = """
SELECT o.o_orderkey AS row_id, o.o_orderkey * 7 AS OrderId,
       CASE WHEN o.o_orderkey % 400 = 0 THEN NULL ELSE o.o_totalprice END AS price,
       CASE WHEN o.o_orderkey % 5   = 0 THEN NULL ELSE c.c_acctbal END AS acctbal,
       CASE WHEN o.o_orderkey % 50  = 0 THEN NULL ELSE o.o_orderpriority END AS priority,
       CASE WHEN o.o_orderkey % 4  <> 0 THEN NULL ELSE c.c_mktsegment END AS segment,
       c.c_nationkey AS nationkey, o.o_orderkey % 600 AS bucket,
       CAST(1.0 AS DOUBLE) AS const_col,
       CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS label
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

# orders_frame plus a separable class target and an exact linear regression target
MODEL_FRAME_SQL = """
SELECT f.*, CASE WHEN o.o_totalprice + 20 * c.c_acctbal > 300000 THEN 1 ELSE 0 END AS sep,
       3 * o.o_totalprice / 1000 + 2 * c.c_acctbal / 1000 + c.c_nationkey AS y
FROM (""" + ORDERS_FRAME_SQL + """) f
JOIN orders o ON f.row_id = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

SCORED_SQL = """
SELECT l.doc_id, l.quality AS y_true, l.toxic AS y_pred, d.n_chars AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""

SCORED_MANY_SQL = """
SELECT s.doc_id, m.identifier, s.y_true,
       CASE m.identifier WHEN 'm1' THEN s.y_pred
                         WHEN 'm2' THEN 1 - s.y_pred
                         ELSE CASE WHEN s.doc_id % 3 = 0 THEN 1 ELSE 0 END END AS y_pred,
       CASE m.identifier WHEN 'm1' THEN CAST(s.score AS DOUBLE)
                         WHEN 'm2' THEN CAST(s.score % 97 AS DOUBLE)
                         ELSE CAST(s.doc_id % 11 AS DOUBLE) END AS score
FROM (""" + SCORED_SQL + """) s
JOIN (SELECT 'm1' AS identifier UNION ALL SELECT 'm2' UNION ALL SELECT 'm3') m ON TRUE
"""

SERIES_SQL = "SELECT user_id, ts, value FROM events"
SKEWED_SQL = "SELECT event_id, value FROM events"

REGRESSION_PAIRS_SQL = """
SELECT o.o_orderkey AS row_id,
       3 * o.o_totalprice / 1000 + 2 * c.c_acctbal / 1000 + c.c_nationkey AS y_true,
       3 * o.o_totalprice / 1000 + 2 * c.c_acctbal / 1000 + 12.0 AS y_pred
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")


def orders_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titanic-like mixed frame: Id column, numeric, categorical, high-null, constant, label."""
    o = table(spark, sf_dir, "orders")
    c = _customer(spark, sf_dir)
    k = F.col("o_orderkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    return j.select(
        k.alias("row_id"),
        (k * 7).alias("OrderId"),
        F.when(k % 400 == 0, None).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(k % 5 == 0, None).otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.when(k % 50 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 4 != 0, None).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").alias("nationkey"),
        (k % 600).alias("bucket"),
        F.lit(1.0).cast("double").alias("const_col"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
    )


def customers_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature columns of ``orders_frame`` per customer, without a label; customers without orders have nulls."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.max("o_totalprice").alias("price"), F.max("o_orderpriority").alias("priority"))
    c = _customer(spark, sf_dir)
    return c.join(o, c.c_custkey == o.k, "left").select(
        F.col("c_custkey").alias("row_id"), (F.col("c_custkey") * 7).alias("OrderId"), "price",
        F.col("c_acctbal").alias("acctbal"), "priority", F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nationkey"), (F.col("c_custkey") % 600).alias("bucket"), F.lit(1.0).alias("const_col"))


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders_frame`` + separable class ``sep`` + exact linear target ``y``."""
    o = table(spark, sf_dir, "orders")
    c = _customer(spark, sf_dir)
    base = orders_frame(spark, sf_dir)
    extra = o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_totalprice") + 20 * F.col("c_acctbal") > 300000, 1).otherwise(0).alias("sep"),
        (3 * F.col("o_totalprice") / 1000 + 2 * F.col("c_acctbal") / 1000
         + F.col("c_nationkey")).alias("y"))
    return base.join(extra, "row_id")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "labels")
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return l.join(d, "doc_id").select(
        "doc_id", F.col("quality").alias("y_true"), F.col("toxic").alias("y_pred"),
        F.col("n_chars").alias("score"))


def scored_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored`` seen by three model identifiers (explode of a fixed 3-element array)."""
    s = scored(spark, sf_dir).withColumn("identifier", F.explode(F.array(F.lit("m1"), F.lit("m2"), F.lit("m3"))))
    m = F.col("identifier")
    y_pred = (F.when(m == "m1", F.col("y_pred")).when(m == "m2", 1 - F.col("y_pred"))
              .otherwise(F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0)))
    score = (F.when(m == "m1", F.col("score").cast("double"))
             .when(m == "m2", (F.col("score") % 97).cast("double"))
             .otherwise((F.col("doc_id") % 11).cast("double")))
    return s.select("doc_id", "identifier", "y_true", y_pred.alias("y_pred"), score.alias("score"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "ts", "value")


def skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "value")


def regression_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = _customer(spark, sf_dir)
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    lin = 3 * F.col("o_totalprice") / 1000 + 2 * F.col("c_acctbal") / 1000
    return j.select(F.col("o_orderkey").alias("row_id"),
                    (lin + F.col("c_nationkey")).alias("y_true"),
                    (lin + F.lit(12.0)).alias("y_pred"))
