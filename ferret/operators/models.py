"""Model registry, fitting, prediction and importances on ``pyspark.ml``.

Estimator parameters are translated from the reference's library objectives
to Spark's (e.g. an L2 penalty ``alpha * ||w||^2`` on a summed loss becomes
``regParam = alpha / n`` on Spark's averaged loss), so the fitted models solve
the same problems.  The vectorised training table is cached once and shared
by every model; fits run as concurrent Spark jobs from driver threads.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators.boosting import SoftmaxBoosting, fit_softmax_boosting
from ferret.operators.forest import SCHEMA as FOREST_SCHEMA
from ferret.operators.forest import ROWS_A_SCORING, Forest, features_tried, fit_forest
from ferret.operators.split import hash32
from ferret.operators.squared_hinge import SquaredHinge, fit_squared_hinge

FEATURES = "features"
CLASSIFIERS = ["decision_tree", "random_forest", "gradient_boosting", "logistic_regression",
               "linear_svc", "ridge_classifier", "gaussian_nb"]
REGRESSORS = ["linear_regression", "ridge", "elastic_net", "decision_tree", "random_forest",
              "gradient_boosting"]
TWO_CLASS = ("gradient_boosting", "ridge_classifier")  # above two classes: softmax boosting, one ridge a class
MOST_CLASSES = 1000
MAX_TREE_DEPTH = 30  # the deepest tree that Spark grows
FOREST_DEPTH = 15
TREES = ("decision_tree", "random_forest", "gradient_boosting")
LONGEST = ("gradient_boosting", "random_forest", "decision_tree", "logistic_regression", "linear_svc")  # of the fits, by their jobs
GROWN = ("decision_tree", "random_forest")  # by operators/forest.py, if the table is larger than this:
ROWS_A_TASK = 12_288  # a smaller training table stays as it is
DUMMY_CLASSIFIERS = ["dummy_most_frequent", "dummy_uniform", "dummy_stratified"]
DUMMY_REGRESSORS = ["dummy_median", "dummy_mean"]


@dataclass
class ModelSpec:
    name: str
    problem: str
    params: dict = field(default_factory=dict)
    custom: object | None = None      # a user-supplied pyspark.ml Estimator

    @property
    def identifier(self) -> str:
        inner = ",".join(f"{k}={v}" for k, v in sorted(self.params.items()))
        return f"{self.name}({inner})"

    @classmethod
    def from_estimator(cls, est, problem: str) -> "ModelSpec":
        """Spec for any Estimator; identifier = class name + its explicitly set params."""
        params = {p.name: v for p, v in est.extractParamMap().items()
                  if est.isSet(p) and p.name not in ("featuresCol", "labelCol")}
        return cls(type(est).__name__, problem, params, custom=est)

    def row(self):
        return (self.identifier, self.problem, self.name, {k: str(v) for k, v in self.params.items()})


class ModelRegistry:
    """The model set of a run: defaults, dummies and user estimators (``add_model``)."""

    def __init__(self, problem: str, n_train: int, use_default_models: bool = True,
                 use_dummy_models: bool = True, seed: int = 42):
        self.problem = problem
        self.specs = default_specs(problem, n_train, use_default_models, use_dummy_models, seed)

    def add_model(self, estimator) -> ModelSpec:
        spec = ModelSpec.from_estimator(estimator, self.problem)
        self.specs = [s for s in self.specs if s.identifier != spec.identifier] + [spec]
        return spec

    def table(self, spark) -> DataFrame:
        return registry_table(spark, self.specs)


def default_specs(problem: str, n_train: int, use_default_models: bool = True,
                  use_dummy_models: bool = True, seed: int = 42, tree_depth: int = MAX_TREE_DEPTH,
                  forest_depth: int = FOREST_DEPTH) -> list[ModelSpec]:
    """Default model set with parameters translated for a training table of ``n_train`` rows.

    ``tree_depth`` bounds single trees (the default is the deepest that Spark
    grows) and ``forest_depth`` the trees of a forest: each level of a forest is one or more
    passes over the rows, so its default is lower; up to ``MAX_TREE_DEPTH`` may be asked for.
    """
    n = max(1, n_train)
    specs: list[ModelSpec] = []
    if problem == "classification":
        if use_default_models:
            specs += [
                ModelSpec("decision_tree", problem, {"maxDepth": tree_depth, "seed": seed}),
                ModelSpec("random_forest", problem, {"numTrees": 100, "maxDepth": forest_depth, "seed": seed}),
                ModelSpec("gradient_boosting", problem, {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1,
                                                         "seed": seed}),
                ModelSpec("logistic_regression", problem, {"regParam": 1.0 / n}),
                ModelSpec("linear_svc", problem, {"regParam": 1.0 / n}),
                ModelSpec("ridge_classifier", problem, {"regParam": 1.0 / n}),
                ModelSpec("gaussian_nb", problem, {}),
            ]
        if use_dummy_models:
            specs += [ModelSpec(d, problem, {"seed": seed}) for d in DUMMY_CLASSIFIERS]
    else:
        if use_default_models:
            specs += [
                ModelSpec("linear_regression", problem, {"regParam": 0.0}),
                ModelSpec("ridge", problem, {"regParam": 1.0 / n}),
                ModelSpec("elastic_net", problem, {"regParam": 1.0, "elasticNetParam": 0.5}),
                ModelSpec("decision_tree", problem, {"maxDepth": tree_depth, "seed": seed}),
                ModelSpec("random_forest", problem, {"numTrees": 100, "maxDepth": forest_depth, "seed": seed}),
                ModelSpec("gradient_boosting", problem, {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1,
                                                         "seed": seed}),
            ]
        if use_dummy_models:
            specs += [ModelSpec(d, problem, {}) for d in DUMMY_REGRESSORS]
    return specs


def registry_table(spark, specs: list[ModelSpec]) -> DataFrame:
    return spark.createDataFrame([s.row() for s in specs],
                                 "identifier string, problem string, model_type string, params map<string,string>")


def params_json(specs: list[ModelSpec]) -> list[tuple[str, str]]:
    return [(s.identifier, json.dumps(s.params, sort_keys=True)) for s in specs]


# Spark's LinearRegression standardises the label: in original units its L2 penalty is
# regParam * (1 - elasticNetParam) / std(label) while the L1 penalty is regParam *
# elasticNetParam.  These models are specified by the unscaled objective
# (1/2n)||y - Xw||^2 + a1 ||w||_1 + (a2 / 2) ||w||^2, so the fit solves for Spark's pair:
# regParam = a1 + a2 * std, elasticNetParam = a1 / regParam (KKT-checked in the tests).
LABEL_SCALED = ("ridge", "elastic_net", "ridge_classifier")


def spark_penalty(reg: float, enet: float, label_std: float) -> tuple[float, float]:
    a1, a2 = reg * enet, reg * (1.0 - enet)
    rp = a1 + a2 * label_std
    return rp, (a1 / rp if rp > 0 else 0.0)


def estimator(spec: ModelSpec, label: str, label_std: float = 1.0):
    """The Spark estimator for a spec (dummy models are handled without an estimator)."""
    p, cls = dict(spec.params), spec.problem == "classification"
    if spec.name in LABEL_SCALED and "regParam" in p:
        p["regParam"], p["elasticNetParam"] = spark_penalty(p["regParam"], p.get("elasticNetParam", 0.0),
                                                            label_std)
    common = {"featuresCol": FEATURES, "labelCol": label}
    if spec.custom is not None:
        return spec.custom.copy({spec.custom.featuresCol: FEATURES, spec.custom.labelCol: label})
    if spec.name == "decision_tree":
        e = C.DecisionTreeClassifier if cls else R.DecisionTreeRegressor
        return e(maxDepth=p.get("maxDepth", MAX_TREE_DEPTH), seed=p.get("seed", 42), **common)
    if spec.name == "random_forest":
        # a level goes on from the nodes that the rows had reached: the same trees, without descending each from its root
        e = C.RandomForestClassifier if cls else R.RandomForestRegressor
        return e(numTrees=p.get("numTrees", 100), maxDepth=p.get("maxDepth", FOREST_DEPTH), seed=p.get("seed", 42), cacheNodeIds=True, **common)
    if spec.name == "gradient_boosting":
        e = C.GBTClassifier if cls else R.GBTRegressor
        return e(maxIter=p.get("maxIter", 100), maxDepth=p.get("maxDepth", 3), stepSize=p.get("stepSize", 0.1),
                 seed=p.get("seed", 42), **common)
    if spec.name == "logistic_regression":
        return C.LogisticRegression(regParam=p["regParam"], elasticNetParam=0.0, standardization=False,
                                    maxIter=200, **common)
    if spec.name == "gaussian_nb":
        return C.NaiveBayes(modelType="gaussian", **common)
    if spec.name == "ridge_classifier":
        return R.LinearRegression(regParam=p["regParam"], elasticNetParam=0.0, standardization=False,
                                  solver="normal", featuresCol=FEATURES, labelCol="_pm1")
    if spec.name in ("linear_regression", "ridge"):
        return R.LinearRegression(regParam=p.get("regParam", 0.0), elasticNetParam=0.0, standardization=False,
                                  solver="normal", **common)
    if spec.name == "elastic_net":
        return R.LinearRegression(regParam=p["regParam"], elasticNetParam=p["elasticNetParam"],
                                  standardization=False, maxIter=200, **common)
    raise KeyError(spec.name)


def vectorize(df: DataFrame, feature_cols: list[str]) -> DataFrame:
    va = VectorAssembler(inputCols=feature_cols, outputCol=FEATURES, handleInvalid="keep")
    return va.transform(df)


@dataclass
class FittedModel:
    spec: ModelSpec
    feature_cols: list[str]
    label: str
    model: PipelineModel | None = None
    constant: float | None = None          # dummy regressors / most_frequent
    priors: list[tuple[float, float]] | None = None   # dummy classifiers (class, prior)
    classes: list[float] | None = None     # label values in order; the models see their places
    boosted: SoftmaxBoosting | None = None
    svc: SquaredHinge | None = None
    forest: Forest | None = None           # of a training table of more than ``ROWS_A_TASK`` rows


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores.

    As they come they stand in as many parts as the files have, which may be one, and each
    pass of a fit, or a scoring by many trees, takes no more cores than that.
    """
    parts = min(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_TASK))
    return df.repartition(parts) if parts > 1 else df


def fit_model(spec: ModelSpec, train: DataFrame, feature_cols: list[str], label: str) -> FittedModel:
    if spec.custom is not None or spec.name not in TREES:
        return _fit(spec, train, feature_cols, label)
    train = dealt(train.select(label, *feature_cols)).cache()
    try:
        return _fit(spec, train, feature_cols, label)
    finally:
        train.unpersist()


def _fit(spec: ModelSpec, train: DataFrame, feature_cols: list[str], label: str) -> FittedModel:
    fm = FittedModel(spec, feature_cols, label)
    if spec.name.startswith("dummy_"):
        return _fit_dummy(fm, train)
    data = train
    if spec.custom is None and spec.problem == "classification":
        fm.classes = label_values(train, label)
        if spec.name == "gradient_boosting" and len(fm.classes) > 2:
            p = spec.params
            fm.boosted = fit_softmax_boosting(train, feature_cols, label, fm.classes, p.get("maxIter", 100), p.get("maxDepth", 3),
                                              p.get("stepSize", 0.1))
            return fm
        data = train.withColumn(label, label_place(label, fm.classes))
    classes = max(2, len(fm.classes or []))
    if spec.name == "linear_svc":
        fm.svc = fit_squared_hinge(data, feature_cols, label, classes, spec.params["regParam"])
        return fm
    if spec.name == "ridge_classifier" and classes > 2:
        return _fit_ridge_per_class(fm, data, classes)
    if spec.name == "ridge_classifier":
        data = data.withColumn("_pm1", F.when(F.col(label) > 0, 1.0).otherwise(-1.0))
    if spec.custom is None and spec.name in GROWN and classes == 2 and train.count() > ROWS_A_TASK:
        p, cls = spec.params, spec.problem == "classification"
        if spec.name == "decision_tree":  # one tree of all rows and features
            fm.forest = fit_forest(data, feature_cols, label, 1, p.get("maxDepth", MAX_TREE_DEPTH), len(feature_cols), None, cls)
        else:
            fm.forest = fit_forest(data, feature_cols, label, p.get("numTrees", 100), p.get("maxDepth", FOREST_DEPTH),
                                   features_tried(len(feature_cols), cls), p.get("seed", 42), cls)
        return fm
    label_std = 1.0
    if spec.custom is None and spec.name in LABEL_SCALED:
        lab = "_pm1" if spec.name == "ridge_classifier" else label
        label_std = data.agg(F.stddev_pop(F.col(lab).cast("double"))).collect()[0][0] or 1.0
    est = estimator(spec, label, label_std)
    if classes > 2 and spec.name in TWO_CLASS:
        est = C.OneVsRest(classifier=est, featuresCol=FEATURES, labelCol=label)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feature_cols, outputCol=FEATURES, handleInvalid="keep"), est])
    fm.model = pipe.fit(data)
    return fm


def label_values(df: DataFrame, label: str) -> list[float]:
    """The values of a label column as numbers, ascending."""
    rows = df.select(F.col(label).cast("double").alias("c")).where("c IS NOT NULL").distinct().limit(MOST_CLASSES + 1).collect()
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} values: not a class label")
    return sorted(r["c"] for r in rows)


def label_place(label: str, classes: list[float]):
    """The place of a label among ``classes``: unchanged if they are 0, 1, ..."""
    y = F.col(label).cast("double")
    if classes == [float(k) for k in range(len(classes))]:
        return y
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), y) - 1).cast("double")


def label_at(place, classes: list[float] | None):
    """The label value at a predicted place."""
    if classes is None or classes == [float(k) for k in range(len(classes))]:
        return place
    return F.element_at(F.array(*[F.lit(c) for c in classes]), place.cast("int") + 1)


def _fit_ridge_per_class(fm: FittedModel, train: DataFrame, classes: int) -> FittedModel:
    """One ridge regression per class on -1 / +1 labels; the class of the largest score wins."""
    data = train.select("*", *[F.when(F.col(fm.label) == k, 1.0).otherwise(-1.0).alias(f"_pm{k}") for k in range(classes)])
    std = data.agg(*[F.stddev_pop(f"_pm{k}") for k in range(classes)]).collect()[0]
    stages = [VectorAssembler(inputCols=fm.feature_cols, outputCol=FEATURES, handleInvalid="keep")]
    for k in range(classes):
        e = estimator(fm.spec, fm.label, std[k] or 1.0)
        stages.append(e.setLabelCol(f"_pm{k}").setPredictionCol(f"_score{k}"))
    fm.model = Pipeline(stages=stages).fit(data)
    return fm


def _fit_dummy(fm: FittedModel, train: DataFrame) -> FittedModel:
    y = F.col(fm.label).cast("double")
    if fm.spec.name == "dummy_mean":
        fm.constant = train.agg(F.avg(y)).collect()[0][0]
    elif fm.spec.name == "dummy_median":
        from ferret.operators.rank import exact_quantiles
        fm.constant = exact_quantiles(train, [fm.label], [0.5])[(fm.label, 0.5)]
    else:
        counts = train.groupBy(y.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy("c").collect()
        total = sum(r["n"] for r in counts)
        fm.priors = [(r["c"], r["n"] / total) for r in counts]
        best = max(counts, key=lambda r: (r["n"], -r["c"]))
        fm.constant = best["c"]
    return fm


def predict(fm: FittedModel, df: DataFrame, key: str = "row_id") -> DataFrame:
    """(key, prediction, probability): probability of class 1 where the model has one."""
    name, cls = fm.spec.name, fm.spec.problem == "classification"
    if name.startswith("dummy_"):
        return _predict_dummy(fm, df, key)
    if fm.boosted is not None:
        return _predict_boosted(fm, df, key)
    if fm.forest is not None:
        return _predict_forest(fm, df, key)
    if fm.svc is not None:
        return df.select(key, label_at(fm.svc.place(), fm.classes).alias("prediction"), F.lit(None).cast("double").alias("probability"))
    out = fm.model.transform(df)
    scores = len(fm.model.stages) - 1
    if name == "ridge_classifier" and scores > 1:
        each = F.array(*[F.col(f"_score{k}") for k in range(scores)])
        pred = (F.array_position(each, F.array_max(each)) - 1).cast("double")
        return out.select(key, label_at(pred, fm.classes).alias("prediction"), F.lit(None).cast("double").alias("probability"))
    pred = F.col("prediction").cast("double")
    if name == "ridge_classifier":
        pred = F.when(F.col("prediction") > 0, 1.0).otherwise(0.0)
    prob = F.lit(None).cast("double")
    if cls and "probability" in out.columns:
        prob = F.get(vector_to_array("probability"), F.lit(1))
    return out.select(key, label_at(pred, fm.classes).alias("prediction"), prob.alias("probability"))


def _predict_boosted(fm: FittedModel, df: DataFrame, key: str) -> DataFrame:
    model, classes = fm.boosted, np.array(fm.classes)

    def score(batches):
        for batch in batches:
            x = np.array(batch.column(1).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
            p = model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(classes[p.argmax(axis=1)]), pa.array(p[:, 1])],
                                             [key, "prediction", "probability"])

    rows = df.select(key, F.array(*[F.col(f"`{c}`").cast("double") for c in fm.feature_cols]).alias("x"))
    return rows.mapInArrow(score, f"`{key}` {rows.schema[key].dataType.simpleString()}, prediction double, probability double")


def _predict_forest(fm: FittedModel, df: DataFrame, key: str) -> DataFrame:
    model, cls, classes = fm.forest, fm.spec.problem == "classification", fm.classes

    def score(batches):
        held = []  # many rows at a time: more of them stand in the same intervals
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= ROWS_A_SCORING:
                yield from scored(held)
                held = []
        yield from scored(held)

    def scored(held):
        if held:
            x = np.concatenate([np.array(b.column(1).flatten().to_numpy(zero_copy_only=False), np.float64) for b in held])
            s, a = model.scores(x.reshape(-1, len(model.features))), 0
            for b in held:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s[a:a + b.num_rows], pa.float64())], [key, "s"])
                a += b.num_rows

    rows = df.select(key, F.array(*[F.col(f"`{c}`").cast("double") for c in fm.feature_cols]).alias("x"))
    out = rows.mapInArrow(score, f"`{key}` {rows.schema[key].dataType.simpleString()}, s double")
    if not cls:
        return out.select(key, F.col("s").alias("prediction"), F.lit(None).cast("double").alias("probability"))
    return out.select(key, label_at((F.col("s") > 0.5).cast("double"), classes).alias("prediction"), F.col("s").alias("probability"))


def _predict_dummy(fm: FittedModel, df: DataFrame, key: str) -> DataFrame:
    pred, prob = _dummy_columns(fm, key)
    return df.select(key, pred.alias("prediction"), prob.alias("probability"))


def _dummy_columns(fm: FittedModel, key: str):
    """(prediction, probability) of a dummy model as expressions."""
    name = fm.spec.name
    seed = fm.spec.params.get("seed", 42)
    none = F.lit(None).cast("double")
    if name in ("dummy_mean", "dummy_median"):
        return F.lit(fm.constant).cast("double"), none
    if name == "dummy_most_frequent":
        return F.lit(fm.constant).cast("double"), F.lit(dict(fm.priors).get(1.0, 0.0)).cast("double")
    u = hash32(key, seed + 1).cast("double") / F.lit(float(1 << 32))
    classes = [c for c, _ in fm.priors]
    if name == "dummy_uniform":
        idx = F.floor(u * len(classes)).cast("int")
        return (F.element_at(F.array(*[F.lit(c) for c in classes]), idx + 1).cast("double"),
                F.lit(0.5 if len(classes) == 2 else None).cast("double"))
    # stratified: class by cumulative prior
    cum, expr = 0.0, None
    for c, p in fm.priors:
        cum += p
        cond = u < F.lit(cum)
        expr = F.when(cond, F.lit(c)) if expr is None else expr.when(cond, F.lit(c))
    return expr.otherwise(F.lit(classes[-1])).cast("double"), F.lit(dict(fm.priors).get(1.0)).cast("double")


def predict_many(fitted: dict[str, FittedModel], df: DataFrame, key: str = "row_id") -> DataFrame:
    """(identifier, key, prediction, probability) of all models, long, from one scan of ``df``.

    Every model adds its own columns to the rows, whose features are assembled once;
    the rows are turned into long form at the end.  Models of several parts with columns
    of their own (one-vs-rest, user pipelines, softmax boosting) take a scan each.
    """
    apart, pairs, rows, assembled = [], [], df, None
    for i, (ident, fm) in enumerate(fitted.items()):
        if fm.spec.name.startswith("dummy_"):
            pairs.append((ident, *_dummy_columns(fm, key)))
            continue
        if fm.svc is not None:
            pairs.append((ident, label_at(fm.svc.place(), fm.classes), F.lit(None).cast("double")))
            continue
        stages = fm.model.stages[1:] if fm.model is not None else []
        if not stages or fm.spec.custom is not None or any(isinstance(m, C.OneVsRestModel) for m in stages):
            apart.append((ident, fm))
            continue
        if assembled is None:
            assembled, rows = fm.feature_cols, vectorize(rows, fm.feature_cols)
        elif assembled != fm.feature_cols:
            apart.append((ident, fm))
            continue
        for j, m in enumerate(stages):
            m = m.copy().setPredictionCol(f"_p{i}_{j}")
            for what, name in (("Probability", f"_q{i}"), ("RawPrediction", f"_w{i}")):
                if hasattr(m, f"set{what}Col"):
                    m = getattr(m, f"set{what}Col")(name)
            rows = m.transform(rows)
        prob = F.get(vector_to_array(f"_q{i}"), F.lit(1)) if f"_q{i}" in rows.columns else F.lit(None).cast("double")
        pred = F.col(f"_p{i}_0").cast("double")
        if len(stages) > 1:  # one score a class
            each = F.array(*[F.col(f"_p{i}_{j}") for j in range(len(stages))])
            pred = (F.array_position(each, F.array_max(each)) - 1).cast("double")
        elif fm.spec.name == "ridge_classifier":
            pred = F.when(pred > 0, 1.0).otherwise(0.0)
        pairs.append((ident, label_at(pred, fm.classes), prob))
    out = None
    if pairs:
        each = F.array(*[F.struct(F.lit(ident).alias("identifier"), pred.alias("prediction"), prob.alias("probability"))
                         for ident, pred, prob in pairs])
        out = rows.select(key, F.explode(each).alias("m")).select("m.identifier", key, "m.prediction", "m.probability")
    for ident, fm in apart:
        p = predict(fm, df, key).select(F.lit(ident).alias("identifier"), key, "prediction", "probability")
        out = p if out is None else out.unionByName(p)
    return out


def fit_many(specs: list[ModelSpec], train: DataFrame, valid: DataFrame, feature_cols: list[str],
             label: str, key: str = "row_id", threads: int = 4) -> tuple[dict, DataFrame]:
    """Fit every spec (concurrent Spark jobs) and return (fitted by identifier, long predictions)."""
    train = dealt(train.select(key, label, *feature_cols)).cache()

    sc = train.sparkSession.sparkContext

    def one(spec):
        # one scheduler pool per model so FAIR mode interleaves the fits
        sc.setLocalProperty("spark.scheduler.pool", spec.name)
        try:
            return spec.identifier, _fit(spec, train, feature_cols, label)
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    try:
        with ThreadPoolExecutor(max_workers=threads) as ex:
            # the longest first, so that none of them is left to run alone at the end
            done = dict(ex.map(one, sorted(specs, key=lambda s: LONGEST.index(s.name) if s.name in LONGEST else len(LONGEST))))
            fitted = {s.identifier: done[s.identifier] for s in specs}
    finally:
        train.unpersist()  # fitted models hold their parameters; the cached rows are done
    return fitted, predict_many(fitted, dealt(valid), key)


def gaussian_nb_params(fm: FittedModel) -> DataFrame:
    """(class, feature, mean, variance) of a fitted Gaussian naive Bayes model."""
    m = fm.model.stages[-1]
    theta, sigma = m.theta.toArray(), m.sigma.toArray()
    labels = [float(x) for x in range(theta.shape[0])]
    rows = [(labels[i], f, float(theta[i, j]), float(sigma[i, j]))
            for i in range(theta.shape[0]) for j, f in enumerate(fm.feature_cols)]
    return _spark().createDataFrame(rows, "class double, feature string, mean double, variance double")


def feature_importances(fm: FittedModel) -> DataFrame:
    """(feature, importance) descending, for tree models."""
    imp = fm.forest.importances() if fm.forest is not None else fm.model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(fm.feature_cols, imp), key=lambda t: (-t[1], t[0]))
    return _spark().createDataFrame(rows, "feature string, importance double")


def coefficients(fm: FittedModel) -> DataFrame:
    """(feature, coefficient) of a linear model of one score, intercept as its own row."""
    if fm.svc is not None:
        if len(fm.svc.weights) > 1:
            raise ValueError("one row of coefficients a class: read them from the model's svc.weights")
        rows = [*zip(fm.feature_cols, fm.svc.weights[0].tolist()), ("intercept", float(fm.svc.intercepts[0]))]
        return _spark().createDataFrame(rows, "feature string, coefficient double")
    m = fm.model.stages[-1]
    coef = m.coefficients.toArray().tolist()
    rows = list(zip(fm.feature_cols, coef)) + [("intercept", float(m.intercept))]
    return _spark().createDataFrame(rows, "feature string, coefficient double")


def top_coefficients(fm: FittedModel, k: int = 15) -> DataFrame:
    c = coefficients(fm).where(F.col("feature") != "intercept")
    return c.orderBy(F.abs("coefficient").desc(), "feature").limit(k)


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


SVC_SCHEMA = "weights array<array<double>>, intercepts array<double>, classes array<double>"


def save_model(fm: FittedModel, path: str) -> None:
    if fm.model is not None:
        fm.model.write().overwrite().save(path)
    if fm.forest is not None:
        _spark().createDataFrame(fm.forest.rows(), FOREST_SCHEMA).write.mode("overwrite").parquet(path)
    if fm.svc is not None:
        row = [(fm.svc.weights.tolist(), fm.svc.intercepts.tolist(), fm.classes)]
        _spark().createDataFrame(row, SVC_SCHEMA).write.mode("overwrite").parquet(path)


def load_model(spec: ModelSpec, path: str, feature_cols: list[str], label: str) -> FittedModel:
    if spec.name == "linear_svc":
        r = _spark().read.schema(SVC_SCHEMA).parquet(path).first()
        svc = SquaredHinge(list(feature_cols), np.array(r["weights"]), np.array(r["intercepts"]))
        return FittedModel(spec, feature_cols, label, classes=r["classes"], svc=svc)
    if spec.name in GROWN:
        hadoop = _spark()._jvm.org.apache.hadoop.fs.Path(path + "/metadata")
        if not hadoop.getFileSystem(_spark()._jsc.hadoopConfiguration()).exists(hadoop):  # not one of Spark's models
            forest = Forest.of(list(feature_cols), _spark().read.schema(FOREST_SCHEMA).parquet(path).collect())
            classes = [0.0, 1.0] if spec.problem == "classification" else None
            return FittedModel(spec, feature_cols, label, classes=classes, forest=forest)
    return FittedModel(spec, feature_cols, label, PipelineModel.load(path))
