"""Cleaning as fit / transform.

``CleaningPlan.fit(df)`` runs a fixed number of aggregates over the train
split (roles, missing flags, medians, modes, power-transform lambdas,
target-encoding table, HBOS histograms and threshold) and returns a
``CleaningModel`` holding only small parameters.  ``CleaningModel.transform``
is one lazy projection (plus, only for very large category tables, a
size-checked join), so applying it to a new table - train, valid, an
unlabelled test table or a stream - never reshuffles the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferret.operators import cleaning as C
from ferret.operators.columns import nan_to_null
from ferret.operators.roles import Roles, infer_roles
from ferret.operators.split import split_random, split_stratified

PROBLEMS = {"classification": "classification", "binary classification": "classification",
            "regression": "regression"}


def problem_kind(problem: str) -> str:
    if problem == "infer":
        raise ValueError("problem='infer' is not supported: name classification or regression")
    if problem not in PROBLEMS:
        raise ValueError(f"unknown problem {problem!r}")
    return PROBLEMS[problem]


@dataclass
class CleaningModel:
    target: str
    problem: str
    key: str
    roles: Roles
    numeric: list[str]
    categoric: list[str]
    flags: list[str]
    medians: dict
    modes: dict
    power: dict
    encoding: C.TargetEncoding
    hbos: C.HBOSModel | None
    method: str = "yeo-johnson"
    names: dict = field(default_factory=dict)

    # column names ----------------------------------------------------------
    def cat_name(self, c: str, suffix: str) -> str:
        return c + suffix if c in self.numeric else c

    # projections -----------------------------------------------------------
    def imputed_columns(self) -> list[Column]:
        cols = [C.impute(c, self.medians[c]).alias(c) for c in self.numeric]
        cols += [C.impute(c, self.modes[c]).alias(self.cat_name(c, "_cat")) for c in self.categoric]
        return cols

    def _passthrough(self, df: DataFrame) -> list[str]:
        keep = [self.key] + [c for c in ("split",) if c in df.columns]
        return keep

    def imputed(self, df: DataFrame) -> DataFrame:
        df = nan_to_null(df)
        tgt = [self.target] if self.target in df.columns else []
        return df.select(*self._passthrough(df), *self.imputed_columns(), *tgt)

    def transformed(self, df: DataFrame, with_hbos: bool = True) -> DataFrame:
        df = nan_to_null(df)
        imp = df.select(*self._passthrough(df),
                        *[C.impute(c, self.medians[c]).alias(c) for c in self.numeric],
                        *[C.impute(c, self.modes[c]).alias("__cat_" + c) for c in self.categoric],
                        *C.missing_flags(df, self.flags),
                        *([self.target] if self.target in df.columns else []))
        num = [C.power_transform(c, self.power[c], self.method).alias(c) for c in self.numeric]
        names = {"__cat_" + c: self.cat_name(c, "_te") for c in self.categoric}
        enc_cols = ["__cat_" + c for c in self.categoric]
        te = C.TargetEncoding(self.encoding.prior, self.encoding.table,
                              {"__cat_" + k: v for k, v in self.encoding.small.items()})
        flags = ["missing_" + c for c in self.flags]
        tgt = []
        if self.target in df.columns:
            tgt = [C.log1p_target(self.target, self.problem)]
        out = imp.select(*self._passthrough(imp), *num, *enc_cols, *flags, *tgt)
        # large category tables fall back to a join keyed on the original column name
        big = [c for c in self.categoric if c not in self.encoding.small]
        if big:
            te_big = C.TargetEncoding(self.encoding.prior, self.encoding.table.withColumn(
                "feature", F.concat(F.lit("__cat_"), F.col("feature"))), te.small)
            out = C.apply_target_encoding(out, te_big, ["__cat_" + c for c in big],
                                          {"__cat_" + c: names["__cat_" + c] for c in big})
        small_exprs = [C.target_encode_col(te, c, names[c]) for c in enc_cols if c in te.small]
        others = [c for c in out.columns if c not in enc_cols]
        out = out.select(*others, *small_exprs)
        order = (self._passthrough(out) + [c for c in self.numeric]
                 + [names["__cat_" + c] for c in self.categoric] + flags)
        out = out.select(*order, *[t for t in ([self.target] if self.target in out.columns else [])])
        if with_hbos and self.hbos is not None:
            score = C.hbos_score(self.hbos)
            out = out.select("*", score)
            if self.hbos.threshold is not None:
                out = out.withColumn("HBOS", C.hbos_label(F.col("hbos_score"), self.hbos.threshold))
        return out

    def score_new(self, df: DataFrame) -> DataFrame:
        """Apply every train-fitted step to an unlabelled table."""
        return self.transformed(df.drop(self.target) if self.target in df.columns else df)

    def features_table(self, spark) -> DataFrame:
        t = self.roles.to_df(spark)
        miss = spark.createDataFrame([("missing", "missing_" + c) for c in self.flags],
                                     "category string, feature string")
        return t.unionByName(miss)


@dataclass
class CleaningPlan:
    target: str
    problem: str = "classification"
    key: str = "row_id"
    seed: int = 42
    train_frac: float = 0.75
    exact_split: bool = True   # False: md5 threshold, stratified in expectation, no shuffle
    method: str = "yeo-johnson"
    fixed_lambda: float | None = None
    min_samples_leaf: int = 1
    smoothing: float = 1.0
    hbos_bins: int = 10
    hbos_alpha: float = 0.1
    hbos_tol: float = 0.5
    contamination: float = 0.1
    fit_hbos: bool = True

    def split(self, df: DataFrame) -> DataFrame:
        kind = problem_kind(self.problem)
        df = nan_to_null(df)  # one notion of missing from here on
        if kind == "classification":
            return split_stratified(df, self.key, self.target, self.train_frac, self.seed, exact=self.exact_split)
        return split_random(df, self.key, self.train_frac, self.seed)

    def fit(self, df: DataFrame, split_df: DataFrame | None = None) -> CleaningModel:
        kind = problem_kind(self.problem)
        df = nan_to_null(df)
        roles = infer_roles(df, self.target, [self.key])
        sp = nan_to_null(split_df) if split_df is not None else self.split(df)
        # the fit reads train a fixed number of times: keep it (spills to disk when large)
        train = sp.where(F.col("split") == "train").persist(StorageLevel.MEMORY_AND_DISK)
        numeric, categoric = roles["numeric"], roles["categoric"]
        feats = list(dict.fromkeys(numeric + categoric))
        # one pass: which features have a train null, and the target prior for the encoder
        flags, (prior,) = C.fit_missing_flags(train, feats, [F.avg(C.log1p_target(self.target, kind))])
        medians = C.fit_medians(train, numeric)
        modes = C.fit_modes(train, categoric)
        imp = train.select(*[C.impute(c, medians[c]).alias(c) for c in numeric],
                           *[C.impute(c, modes[c]).alias("__cat_" + c) for c in categoric],
                           C.log1p_target(self.target, kind).alias("__y"))
        if self.fixed_lambda is None:
            power = C.fit_power(imp, numeric, self.method)
        else:
            power = {c: C.PowerFit(self.fixed_lambda, float("nan")) for c in numeric}
            C.fit_standardize(imp, numeric, power, self.method)
        te = C.fit_target_encoding(imp, ["__cat_" + c for c in categoric], "__y",
                                   self.min_samples_leaf, self.smoothing, prior=prior)
        te = C.TargetEncoding(te.prior, te.table.withColumn("feature", F.regexp_replace("feature", "^__cat_", "")),
                              {k[len("__cat_"):]: v for k, v in te.small.items()})
        model = CleaningModel(self.target, kind, self.key, roles, numeric, categoric, flags,
                              medians, modes, power, te, None, self.method)
        if self.fit_hbos and (numeric or categoric):
            tr = model.transformed(train, with_hbos=False)
            hcols = numeric + [model.cat_name(c, "_te") for c in categoric]
            hb = C.fit_hbos(tr, hcols, self.hbos_bins, self.hbos_alpha, self.hbos_tol)
            model.hbos = hb
            # one double a row: the passes of the quantile read it instead of transforming every row again
            scored = tr.select(C.hbos_score(hb)).persist(StorageLevel.MEMORY_AND_DISK)
            hb.threshold = C.fit_hbos_threshold(scored, self.contamination)
            scored.unpersist()
        train.unpersist()
        return model

    def run(self, df: DataFrame, store=None) -> dict[str, DataFrame]:
        """Fit on train, transform every split, store the stage tables when a store is given."""
        sp = self.split(df)
        model = self.fit(df, sp)
        tables = {
            "untransformed": sp,
            "imputed": model.imputed(sp),
            "transformed": model.transformed(sp),
            "train_target": sp.where("split = 'train'").select(self.key, self.target),
            "valid_target": sp.where("split = 'valid'").select(self.key, self.target),
        }
        if store is not None:
            store.create_run_tables()
            store.append_row("features", model.features_table(df.sparkSession))
            for name, t in tables.items():
                store.sink_table(name, t)
            tables = store.load_dfs()
        tables["model"] = model
        return tables
