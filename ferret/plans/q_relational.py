"""Queries: splits, sources / sinks / run tables, projections, merges, limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import relational as rel
from ferret.operators import split as S
from ferret.plans import frames
from ferret.plans.oracle import ORDERS_COLS, with_frame
from ferret.plans.q_roles import ROLES_SQL
from ferret.plans.registry import query
from ferret.sources import files
from ferret.sources.runs import RunStore, schema_to_ddl
from ferret.sources.tables import table

H = S.hash32_sql("row_id", 42)
CUT = int(0.75 * (1 << 32))

SPLIT_RANDOM_SQL = with_frame(
    f"SELECT row_id, CASE WHEN {H} < {CUT} THEN 'train' ELSE 'valid' END AS split FROM f")

SPLIT_STRAT_SQL = with_frame(f"""
SELECT row_id, label, CASE WHEN rn <= nc - CAST(ceil(0.25e0 * nc) AS BIGINT) THEN 'train' ELSE 'valid' END AS split
FROM (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY {H}, row_id) AS rn,
             count(*) OVER (PARTITION BY label) AS nc FROM f) t""")


@query("split_random", SPLIT_RANDOM_SQL)
def q_split_random(spark, sf):
    return S.split_random(frames.orders_frame(spark, sf), "row_id").select("row_id", "split")


@query("split_stratified", SPLIT_STRAT_SQL)
def q_split_stratified(spark, sf):
    return S.split_stratified(frames.orders_frame(spark, sf), "row_id", "label").select(
        "row_id", "label", "split")


@query("split_stratified_hash", with_frame(
    f"SELECT row_id, label, CASE WHEN {H} < {CUT} THEN 'train' ELSE 'valid' END AS split FROM f"))
def q_split_stratified_hash(spark, sf):
    return S.split_stratified(frames.orders_frame(spark, sf), "row_id", "label", exact=False).select(
        "row_id", "label", "split")


# --- sources ------------------------------------------------------------------
_ORD = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query("scan_csv", f"SELECT {_ORD} FROM orders")
def q_scan_csv(spark, sf):
    src = table(spark, sf, "orders").select(*[c.strip() for c in _ORD.split(",")])
    store = RunStore(spark)
    files.write_csv(src, store.path("orders_csv"))
    return files.scan_csv(spark, store.path("orders_csv"), schema=src.schema)


@query("scan_csv_infer", f"SELECT {_ORD} FROM orders")
def q_scan_csv_infer(spark, sf):
    src = table(spark, sf, "orders").select(*[c.strip() for c in _ORD.split(",")])
    store = RunStore(spark)
    files.write_csv(src, store.path("orders_csv"))
    df = files.scan_csv(spark, store.path("orders_csv"))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in src.schema.fields])


@query("scan_columnar", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def q_scan_columnar(spark, sf):
    df = files.scan_columnar(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderpriority"])
    return df.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_totalprice")


@query("scan_table", with_frame("SELECT * FROM f"))
def q_scan_table(spark, sf):
    store = RunStore(spark)
    store.sink_table("untransformed", frames.orders_frame(spark, sf))
    return store.table("untransformed")


@query("sink_table", with_frame("SELECT * FROM f"))
def q_sink_table(spark, sf):
    store = RunStore(spark)
    store.create_run_tables()
    return store.sink_table("frame", frames.orders_frame(spark, sf).withColumn("index", F.lit(0)))


@query("sink_rows", with_frame("SELECT * FROM f"))
def q_sink_rows(spark, sf):
    store = RunStore(spark)
    f = frames.orders_frame(spark, sf)
    store.sink_rows("frame", f.where(F.col("row_id") % 2 == 0))
    store.sink_rows("frame", f.where(F.col("row_id") % 2 == 1))
    return store.table("frame")


@query("schema_to_ddl", with_frame("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CASE typeof({c}) WHEN 'VARCHAR' THEN 'text' WHEN 'DOUBLE' THEN 'real' "
    f"WHEN 'BIGINT' THEN 'int' WHEN 'INTEGER' THEN 'int' ELSE lower(typeof({c})) END AS sql_type "
    f"FROM (SELECT * FROM f LIMIT 1) t" for c in ORDERS_COLS)))
def q_schema_to_ddl(spark, sf):
    return schema_to_ddl(frames.orders_frame(spark, sf))


# --- projections / filters ----------------------------------------------------
@query("drop_target", with_frame("SELECT * EXCLUDE (label) FROM f"))
def q_drop_target(spark, sf):
    return rel.drop_target(frames.orders_frame(spark, sf), "label")


@query("select_target", with_frame("SELECT row_id, label FROM f"))
def q_select_target(spark, sf):
    return rel.select_target(frames.orders_frame(spark, sf), "label")


@query("select_columns", with_frame("SELECT row_id, price, acctbal, bucket FROM f"))
def q_select_columns(spark, sf):
    return rel.select_columns(frames.orders_frame(spark, sf), ["row_id", "price", "acctbal", "bucket"])


@query("filter_equals", with_frame("SELECT * FROM f WHERE priority = '1-URGENT'"))
def q_filter_equals(spark, sf):
    return rel.filter_equals(frames.orders_frame(spark, sf), "priority", "1-URGENT")


@query("rename_suffix", with_frame(
    "SELECT row_id, price AS price_target_encoded, acctbal AS acctbal_target_encoded FROM f"))
def q_rename_suffix(spark, sf):
    f = frames.orders_frame(spark, sf).select("row_id", "price", "acctbal")
    f = rel.add_suffix(f, "_imputed", ["price", "acctbal"])
    return rel.rename_suffix(f, r"_imputed$", "_target_encoded")


_MERGE_SQL = with_frame("""
SELECT a.row_id, a.price AS price_x, b.price AS price_y, a.priority,
       CAST(b.price IS NULL AS INT) AS missing_price
FROM f a JOIN f b ON a.row_id = b.row_id""")


@query("merge_one_to_one", _MERGE_SQL)
def q_merge_one_to_one(spark, sf):
    f = frames.orders_frame(spark, sf)
    left = f.select("row_id", "price", "priority")
    right = f.select("row_id", "price", F.col("price").isNull().cast("int").alias("missing_price"))
    return rel.merge_one_to_one(left, right, "row_id")


@query("sorted_merge", with_frame("""
SELECT f.row_id, f.price, o.o_orderdate FROM f JOIN orders o ON f.row_id = o.o_orderkey"""))
def q_sorted_merge(spark, sf):
    f = frames.orders_frame(spark, sf).select("row_id", "price")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), "o_orderdate")
    return rel.sorted_merge(f, o, "row_id")


@query("limit", with_frame("SELECT * FROM f ORDER BY row_id LIMIT 5"))
def q_limit(spark, sf):
    return rel.limit(frames.orders_frame(spark, sf), 5, ["row_id"])


@query("sort_desc", with_frame("SELECT row_id, price FROM f WHERE price IS NOT NULL"))
def q_sort_desc(spark, sf):
    f = frames.orders_frame(spark, sf).where(F.col("price").isNotNull()).select("row_id", "price")
    return rel.sort_desc(f, "price", ["row_id"])


@query("top_k", """SELECT event_id, value FROM events ORDER BY abs(value) DESC, event_id LIMIT 15""")
def q_top_k(spark, sf):
    return rel.top_k(frames.skewed(spark, sf), "value", 15, tiebreak=["event_id"])


# --- run tables ---------------------------------------------------------------
@query("create_run_tables", ROLES_SQL + "SELECT category, feature FROM roles")
def q_create_run_tables(spark, sf):
    from ferret.operators.roles import infer_roles
    store = RunStore(spark)
    store.create_run_tables()
    r = infer_roles(frames.orders_frame(spark, sf), "label", ["row_id"])
    store.append_row("features", r.to_df(spark))
    return store.table("features")


@query("append_row", with_frame("""
SELECT 'train' AS dataset, count(*) AS n_rows FROM f WHERE """ + H + f""" < {CUT}
UNION ALL SELECT 'valid', count(*) FROM f WHERE """ + H + f" >= {CUT}"))
def q_append_row(spark, sf):
    store = RunStore(spark)
    sp = S.split_random(frames.orders_frame(spark, sf), "row_id")
    for name in ("train", "valid"):
        store.append_row("split_sizes", sp.where(F.col("split") == name).agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows")))
    return store.table("split_sizes")


@query("drop_table", with_frame("""SELECT 'kept' AS table_name, 10 AS n_columns"""))
def q_drop_table(spark, sf):
    store = RunStore(spark)
    f = frames.orders_frame(spark, sf)
    store.sink_table("kept", f)
    store.sink_table("dropped", f.select("row_id"))
    store.drop_table("dropped")
    store.drop_table("never_made")
    return store.table("data_tables")


_UPSERT_SQL = with_frame("", "scored_many").rstrip() + """,
acc AS (SELECT identifier, 'accuracy' AS metric,
        round(avg(CASE WHEN y_pred = y_true THEN 1.0e0 ELSE 0.0e0 END), 6) AS v FROM f GROUP BY 1),
prec AS (SELECT identifier, 'precision' AS metric,
        round(sum(CASE WHEN y_pred = 1 AND y_true = 1 THEN 1.0e0 ELSE 0.0e0 END)
              / sum(CASE WHEN y_pred = 1 THEN 1.0e0 ELSE 0.0e0 END), 6) AS v
        FROM f WHERE identifier <> 'm3' GROUP BY 1)
SELECT identifier, 'score' AS model_type, metric, CAST(v AS VARCHAR) AS value, CAST(2 AS BIGINT) AS version FROM prec
UNION ALL
SELECT identifier, 'score', metric, CAST(v AS VARCHAR), CAST(1 AS BIGINT) FROM acc WHERE identifier = 'm3'"""


@query("upsert_model", _UPSERT_SQL)
def q_upsert_model(spark, sf):
    """REPLACE INTO models keyed by identifier: v1 stores every model's accuracy, v2 replaces
    the specs of m1 and m2 with their precision; the latest version of each identifier wins."""
    store = RunStore(spark)
    store.create_run_tables()
    sm = frames.scored_many(spark, sf)
    hit = F.when(F.col("y_pred") == F.col("y_true"), 1.0).otherwise(0.0)
    tp = F.when((F.col("y_pred") == 1) & (F.col("y_true") == 1), 1.0).otherwise(0.0)
    pp = F.when(F.col("y_pred") == 1, 1.0).otherwise(0.0)

    def specs(df, metric, value):
        return df.groupBy("identifier").agg(F.round(value, 6).cast("string").alias("v")).select(
            "identifier", F.lit("score").alias("model_type"),
            F.create_map(F.lit("metric"), F.lit(metric), F.lit("value"), F.col("v")).alias("params"))

    store.upsert_model(specs(sm, "accuracy", F.avg(hit)))
    out = store.upsert_model(specs(sm.where(F.col("identifier") != "m3"), "precision", F.sum(tp) / F.sum(pp)))
    return out.select("identifier", "model_type", F.col("params")["metric"].alias("metric"),
                      F.col("params")["value"].alias("value"), "version")
