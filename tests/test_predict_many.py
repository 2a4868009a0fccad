"""All fitted models from one scan equal each model on its own."""

import random

import pytest

from ferret.operators import models as Mo


@pytest.mark.parametrize("problem", ["classification", "regression"])
def test_one_scan_equals_one_by_one(spark, tmp_path, problem):
    rng = random.Random(1)
    rows = [(k, rng.gauss(0, 1), rng.gauss(0, 1)) for k in range(200)]
    rows = [(k, a, b, int(a + b > 0), 3.0 * a - b + rng.gauss(0, 0.1)) for k, a, b in rows]
    spark.createDataFrame(rows, "row_id int, a double, b double, y int, z double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    specs = Mo.default_specs(problem, 200)
    for s in specs:
        s.params.update({k: v for k, v in (("numTrees", 3), ("maxIter", 3), ("maxDepth", 3)) if k in s.params})
    label = "y" if problem == "classification" else "z"
    fitted, preds = Mo.fit_many(specs, df, df, ["a", "b"], label)
    got = {(r["identifier"], r["row_id"]): (r["prediction"], r["probability"]) for r in preds.collect()}
    assert len(got) == 200 * len(specs)
    for ident, fm in fitted.items():
        for r in Mo.predict(fm, df).collect():
            assert got[ident, r["row_id"]] == (r["prediction"], r["probability"]), ident
    plan = preds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
