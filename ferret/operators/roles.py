"""Column-role inference (one pass over the data, tiny result).

Rules (default = the packaged generation, with its defects fixed):

* ``NaN``         – missing share > 0.25
* ``problematic`` – name contains ``Id`` or ``ID`` (case-sensitive)
* ``undefined``   – every other column except the target and key columns
* ``numeric``     – undefined, numeric type, distinct/rows >= 0.01
* ``categoric``   – undefined, integral or string type, distinct/rows < 0.10
  (an integral column can be both numeric and categoric)

Distinct counts: ``approx_count_distinct`` for all columns in one aggregate,
then one exact count of hashed values for all columns whose estimate lies
near a cut: two jobs whatever the number of columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferret.operators.columns import is_missing, kinds

NAN_SHARE = 0.25
NUMERIC_MIN_RATIO = 0.01
CATEGORIC_MAX_RATIO = 0.10
APPROX_RSD = 0.05  # sketch error; 16x smaller buffers than 0.01 and the exact recount keeps roles exact
NEAR_CUT = 5 * APPROX_RSD  # relative window around a cut where the exact count is taken
CATEGORIES = ("NaN", "problematic", "undefined", "numeric", "categoric")


@dataclass
class ColumnStats:
    feature: str
    kind: str
    n: int
    null_count: int
    ndv: int


@dataclass
class Roles:
    target: str | None
    stats: dict[str, ColumnStats]
    lists: dict[str, list[str]] = field(default_factory=dict)

    def __getitem__(self, k: str) -> list[str]:
        return self.lists[k]

    def to_df(self, spark) -> DataFrame:
        rows = [(cat, f) for cat in CATEGORIES for f in self.lists.get(cat, [])]
        if self.target is not None:
            rows.append(("target", self.target))
        return spark.createDataFrame(rows, "category string, feature string")


def column_stats(df: DataFrame, cols: list[str] | None = None,
                 cuts: tuple[float, ...] = (NUMERIC_MIN_RATIO, CATEGORIC_MAX_RATIO),
                 exact: bool = False) -> dict[str, ColumnStats]:
    cols = list(cols or df.columns)
    kd = kinds(df)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        aggs.append(F.count_if(is_missing(df, c)).alias(f"m{i}"))
        aggs.append(F.approx_count_distinct(c, APPROX_RSD).alias(f"d{i}"))
    r = df.agg(*aggs).collect()[0]
    n = r["__n"]
    out = {c: ColumnStats(c, kd[c], n, r[f"m{i}"], r[f"d{i}"]) for i, c in enumerate(cols)}
    recheck = []
    for c, s in out.items():
        if exact:
            recheck.append(c)
            continue
        for cut in cuts:
            t = cut * n
            if t > 0 and abs(s.ndv - t) <= NEAR_CUT * t + 2:
                recheck.append(c)
                break
    if recheck:
        for c, ndv in exact_distinct(df, recheck).items():
            out[c].ndv = ndv
    return out


def exact_distinct(df: DataFrame, cols: list[str]) -> dict[str, int]:
    """Distinct non-null values of all ``cols`` in one job.

    Only (column, 128 bits of hash) is shuffled, each value at most once per task,
    keyed by both, so a column of many values is spread over all reducers.
    """
    cells = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(
        F.lit(i).alias("i"), F.xxhash64(f"`{c}`").alias("a"), F.xxhash64(F.lit("second"), f"`{c}`").alias("b"))) for i, c in enumerate(cols)]
    values = df.select(F.explode(F.array_compact(F.array(*cells))).alias("v")).select("v.i", "v.a", "v.b")
    counts = {r["i"]: r["count"] for r in values.distinct().groupBy("i").count().collect()}
    return {c: counts.get(i, 0) for i, c in enumerate(cols)}


def infer_roles(df: DataFrame, target: str | None = None, key_cols: list[str] | None = None,
                legacy_all_columns: bool = False) -> Roles:
    key_cols = list(key_cols or [])
    cols = [c for c in df.columns if c not in key_cols]
    stats = column_stats(df, cols)
    n = next(iter(stats.values())).n if stats else 0
    feats = [c for c in cols if c != target]
    nan = [c for c in feats if n and stats[c].null_count / n > NAN_SHARE]
    prob = [c for c in feats if ("Id" in c or "ID" in c)]
    undefined = [c for c in feats if c not in set(nan) | set(prob)]
    numeric = [c for c in undefined if stats[c].kind in ("integral", "fractional")
               and n and stats[c].ndv / n >= NUMERIC_MIN_RATIO]
    pool = feats if legacy_all_columns else undefined
    categoric = [c for c in pool if stats[c].kind in ("integral", "string")
                 and n and stats[c].ndv / n < CATEGORIC_MAX_RATIO]
    lists = {"NaN": nan, "problematic": prob, "undefined": undefined,
             "numeric": numeric, "categoric": categoric}
    return Roles(target, stats, lists)


def role_table(df: DataFrame, target: str | None = None, key_cols: list[str] | None = None) -> DataFrame:
    """The ``features`` table: (category, feature), target included."""
    return infer_roles(df, target, key_cols).to_df(df.sparkSession)


def other_types(roles: Roles) -> list[str]:
    """Features (undefined) that are not numeric."""
    num = set(roles["numeric"])
    return [c for c in roles["undefined"] if c not in num]


def column_difference(all_cols: list[str], *remove: list[str]) -> list[str]:
    """Column list minus the given role lists (set difference, order kept)."""
    gone = set().union(*[set(r) for r in remove]) if remove else set()
    return [c for c in all_cols if c not in gone]
