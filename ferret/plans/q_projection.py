"""Queries: SVD projection, per-item map, chart data, catalog lookups, stream scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferret.operators import charts as Ch
from ferret.operators import cleaning as C
from ferret.operators import items as I
from ferret.operators import metrics as M
from ferret.operators import projection as P
from ferret.plans import frames
from ferret.plans.cleaning_plan import CleaningPlan
from ferret.plans.oracle import with_frame
from ferret.plans.q_relational import SPLIT_STRAT_SQL
from ferret.plans.q_roles import ROLES_SQL
from ferret.plans.registry import query
from ferret.sources.runs import RunStore
from ferret.sources.tables import table


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding", "label")


@query("svd_projection")
def q_svd_projection(spark, sf):
    v = _vectors(spark, sf)
    m = P.fit_svd(v, "embedding", 2)
    return P.transform(m, v, "embedding").select("vec_id", "label", F.round("comp1", 6).alias("comp1"),
                                                 F.round("comp2", 6).alias("comp2"))


@query("svd_summary")
def q_svd_summary(spark, sf):
    m = P.fit_svd(_vectors(spark, sf), "embedding", 2)
    return P.summary(m, spark)


@query("svd_inverse")
def q_svd_inverse(spark, sf):
    """Reconstruction from the 2-D projection and its squared error per vector."""
    v = _vectors(spark, sf)
    m = P.fit_svd(v, "embedding", 2)
    rec = P.inverse_transform(m, P.transform(m, v, "embedding"))
    err = F.aggregate(F.zip_with(F.col("embedding").cast("array<double>"), "reconstruction",
                                 lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    return rec.select("vec_id", F.round(err, 6).alias("sq_error"))


@query("projection_scatter")
def q_projection_scatter(spark, sf):
    """2-D projection with the class label and an HBOS outlier flag fitted on all dimensions."""
    v = _vectors(spark, sf)
    d = len(v.first()["embedding"])
    wide = v.select("vec_id", "label", "embedding",
                    *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(d)])
    cols = [f"e{i}" for i in range(d)]
    hb = C.fit_hbos(wide, cols)
    hb.threshold = C.fit_hbos_threshold(wide.select(C.hbos_score(hb)))
    m = P.fit_svd(v, "embedding", 2)
    out = P.transform(m, wide, "embedding").select(
        "vec_id", "label", F.round("comp1", 6).alias("comp1"), F.round("comp2", 6).alias("comp2"),
        C.hbos_label(C.hbos_score(hb), hb.threshold))
    return out


@query("map_items", """SELECT page_id, element, count(*) AS n FROM (
 SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS element FROM pages) t
 GROUP BY 1, 2""")
def q_map_items(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "html")
    return I.map_items(pages, I.page_elements, "page_id long, element string, n long", num_workers=8)


@query("chart_series", with_frame("""SELECT 'residuals_vs_predicted' AS chart, 'Residuals vs. Predicted Values' AS series,
 CAST(y_pred AS DOUBLE) AS x, CAST(y_pred - y_true AS DOUBLE) AS y, row_id AS id FROM f
 WHERE y_pred - y_true IS NOT NULL AND y_pred IS NOT NULL AND NOT isnan(y_pred - y_true)
   AND abs(y_pred - y_true) < 'inf'::DOUBLE""", "regression_pairs"))
def q_chart_series(spark, sf):
    res = M.residuals(frames.regression_pairs(spark, sf), "y_true", "y_pred")
    return Ch.chart_series(res, "residuals_vs_predicted", "Residuals vs. Predicted Values",
                           "y_pred", "residual", "row_id")


# --- catalog lookups over a stored run -------------------------------------------------
_FLAGS = ["price", "acctbal", "priority", "segment"]


@query("missing_columns", with_frame("SELECT row_id, " + ", ".join(
    f"CAST({c} IS NULL AS INT) AS missing_{c}" for c in _FLAGS) + " FROM f"))
def q_missing_columns(spark, sf):
    f = frames.orders_frame(spark, sf)
    store = RunStore(spark)
    store.create_run_tables()
    feats = [c for c in f.columns if c not in ("row_id", "label")]
    flags = C.fit_missing_flags(f, feats)
    store.append_row("features", spark.createDataFrame([("missing", "missing_" + c) for c in flags],
                                                       "category string, feature string"))
    store.sink_table("untransformed", f.select("row_id", *C.missing_flags(f, flags)))
    wanted = [r["feature"] for r in store.table("features").where("category = 'missing'").collect()]
    return store.table("untransformed").select("row_id", *sorted(wanted))


@query("feature_lists", ROLES_SQL + "SELECT category, feature FROM roles WHERE category IN ('numeric', 'categoric')")
def q_feature_lists(spark, sf):
    from ferret.operators.roles import infer_roles
    store = RunStore(spark)
    store.create_run_tables()
    r = infer_roles(frames.orders_frame(spark, sf), "label", ["row_id"])
    store.append_row("features", r.to_df(spark))
    return store.table("features").where(F.col("category").isin("numeric", "categoric"))


@query("load_dfs", "WITH s AS (" + SPLIT_STRAT_SQL + """)
SELECT 'untransformed' AS table_name, count(*) AS n_rows FROM s
UNION ALL SELECT 'imputed', count(*) FROM s UNION ALL SELECT 'transformed', count(*) FROM s
UNION ALL SELECT 'train_target', count(*) FROM s WHERE split = 'train'
UNION ALL SELECT 'valid_target', count(*) FROM s WHERE split = 'valid'""")
def q_load_dfs(spark, sf):
    store = RunStore(spark)
    CleaningPlan("label", "classification").run(frames.orders_frame(spark, sf), store)
    dfs = store.load_dfs()
    out = None
    for name, d in dfs.items():
        c = d.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = c if out is None else out.unionByName(c)
    return out


@query("score_stream")
def q_score_stream(spark, sf):
    """Fit on the orders frame, then score its rows arriving as a parquet stream."""
    from ferret.streaming.scoring import start_scoring
    f = frames.orders_frame(spark, sf)
    plan = CleaningPlan("label", "classification", fit_hbos=True)
    model = plan.fit(f)
    store = RunStore(spark)
    src = store.path("incoming")
    f.drop("label").write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(f.drop("label").schema).parquet(src)
    q = start_scoring(model, stream, store.path("scored"), store.path("scored_ckpt"))
    q.awaitTermination()
    return spark.read.parquet(store.path("scored"))
