"""House-price-style regression workflow on ``order_feats`` (the reference's project H).

validate → hash holdout → median imputation fitted on train → engineered features →
IQR row filter on train → population-std scaling → OLS → metrics for train and holdout.
Every fit reads only the train part (``fit_scope="all"`` reproduces the reference's
fit-before-split behaviour).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.operators import gram, impute, metrics, profile, regress, scale, split, validate
from tablelearn.plans.views import REFERENCE_YEAR, order_feats

ORDER_RULES = [
    ("columns", ["id", "target", "n_lines", "qty", "gross", "yr"]),
    ("non_empty",),
    ("positive", "target"),
    ("not_null", "target"),
    ("non_negative", "n_lines"),
    ("non_negative", "qty"),
]
RAW = ["n_lines", "qty", "gross", "yr"]
FEATURES = ["n_lines", "qty", "gross", "yr", "total", "weighted", "age"]


def engineer(df: DataFrame, reference_year: int = REFERENCE_YEAR) -> DataFrame:
    """total = gross + qty, weighted = n_lines + 0.5·qty, age = max(year − yr, 0)."""
    return (df.withColumn("total", F.col("gross") + F.col("qty"))
              .withColumn("weighted", F.col("n_lines") + F.lit(0.5) * F.col("qty"))
              .withColumn("age", F.greatest(F.lit(reference_year) - F.col("yr"), F.lit(0)).cast("double")))


def prepare(train: DataFrame, other: DataFrame, iqr_k: float = 3.0, fit_scope: DataFrame | None = None):
    """Fit medians/IQR/scaler on ``fit_scope`` (default: train); return (train', other', state).

    Raw columns lose infinities and get their medians, then the engineered features do: a gap
    left in any feature is filled with that feature's learned median."""
    fit_on = fit_scope if fit_scope is not None else train
    raw = impute.fit_median(impute.sanitize_inf(fit_on, RAW), RAW).first().asDict()

    def filled(df):
        return impute.sanitize_inf(engineer(impute.apply_median(impute.sanitize_inf(df, RAW), raw)), FEATURES)
    fitted = filled(fit_on)
    made = [c for c in FEATURES if c not in RAW]  # a raw column's median stays after filling with it
    q = profile.exact_quantiles(fitted, made, {c: [0.25, 0.5, 0.75] if c == "total" else [0.5] for c in made})
    med, (q1, q3) = {**raw, **{c: q[c][0.5] for c in made}}, (q["total"][0.25], q["total"][0.75])
    bounds = (q1 - iqr_k * (q3 - q1), q3 + iqr_k * (q3 - q1))
    tr = impute.residual_fill(impute.iqr_filter(filled(train), "total", bounds=bounds), FEATURES, learned=med)
    ot = impute.residual_fill(filled(other), FEATURES, learned=med)
    sc = scale.fit_scaler(tr, FEATURES).first().asDict()
    return (scale.apply_scaler(tr, sc, FEATURES), scale.apply_scaler(ot, sc, FEATURES),
            {"raw_medians": raw, "medians": med, "bounds": bounds, "scaler": sc})


def scoring_model(state: dict, fit: gram.Fit, features) -> PipelineModel:
    """One saveable pipeline from unprepared rows to predictions: infinities and gaps, engineered
    features, learned medians, scaler and regression."""
    def gap(c, fill):
        d, known = f"CAST({c} AS DOUBLE)", "NULL" if fill is None else f"{fill!r}D"
        return f"COALESCE(CASE WHEN isnan({d}) OR abs({d}) = double('Infinity') THEN NULL ELSE {d} END, {known})"
    raw = ", ".join(f"{gap(c, state['raw_medians'][c])} AS _r_{c}" for c in RAW)
    made = {**{c: f"_r_{c}" for c in RAW}, "total": "_r_gross + _r_qty", "weighted": "_r_n_lines + 0.5D * _r_qty",
            "age": f"greatest({REFERENCE_YEAR} - _r_yr, 0)"}
    sc = state["scaler"]
    scaled = ", ".join(f"({gap('(' + made[c] + ')', state['medians'][c])} - {sc[f'mean_{c}']!r}D) / {(sc[f'std_{c}'] or 1.0)!r}D AS _f_{c}"
                       for c in features)
    drop = ", ".join([*(f"_r_{c}" for c in RAW), *(f"_f_{c}" for c in features)])
    return PipelineModel(stages=[
        SQLTransformer(statement=f"SELECT *, {raw} FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
        SQLTransformer(statement=regress.linear_sql(fit, [f"_f_{c}" for c in features])),
        SQLTransformer(statement=f"SELECT * EXCEPT ({drop}) FROM __THIS__")])


def run(spark: SparkSession, sf_dir: str, test_frac: float = 0.2, seed=42, iqr_k: float = 3.0,
        fit_scope: str = "train") -> DataFrame:
    """fit_scope="train" (default) learns medians/IQR bounds on the train part only;
    "all" learns them before the split, as the reference does."""
    # the joined base is computed once: validation materialises it, later passes reuse it
    # (lost blocks are recomputed from the deterministic lineage)
    base = order_feats(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    validate.require(base, ORDER_RULES)
    parts = split.holdout(base, "id", test_frac, seed)
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    tr, te, _ = prepare(train, test, iqr_k, fit_scope=base if fit_scope == "all" else None)
    model = regress.fit_ols(tr, FEATURES, "target")
    scored = model.transform(tr.unionByName(te)).select("id", "split", "target", "prediction")
    return metrics.regression(scored, "target", "prediction", group="split")


def fit_scoring(train: DataFrame, features=tuple(FEATURES)) -> PipelineModel:
    """Fit on prepared ``train`` and return the pipeline that scores unprepared rows."""
    tr, _, state = prepare(train, train)
    return scoring_model(state, gram.fit(tr, list(features), "target"), list(features))
