"""Least squares: the full design from second moments (``gram``), closed forms for 1–2 features,
and K-fold cross-validated RMSE computed in one pass per stage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.exprs import col_of
from tablelearn.operators import gram


def linear_sql(fit: gram.Fit, columns, prediction: str = "prediction") -> str:
    """The fit as a SQL projection over ``columns``."""
    terms = "".join(f" + {float(b)!r}D * CAST(`{c}` AS DOUBLE)" for b, c in zip(fit.coefficients, columns))
    return f"SELECT *, {fit.intercept!r}D{terms} AS `{prediction}` FROM __THIS__"


def fit_ols(df: DataFrame, features, label: str, prediction: str = "prediction") -> PipelineModel:
    """Intercept OLS (no regularisation) from one pass over the rows, as a pipeline of one SQL projection.

    On a collinear design the coefficients are those of minimum norm.  Rows with a null take no part in
    the fit and get no prediction."""
    return PipelineModel(stages=[SQLTransformer(statement=linear_sql(gram.fit(df, features, label), features, prediction))])


def ols_coefficients(df: DataFrame, features, label: str) -> DataFrame:
    """(feature, coefficient) of the minimum-norm fit, the intercept first."""
    f = gram.fit(df, features, label)
    rows = [("intercept", f.intercept), *[(str(c), float(b)) for c, b in zip(features, f.coefficients)]]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def ols_simple(df: DataFrame, x: str, y: str) -> DataFrame:
    """y = a + b·x in closed form: (slope, intercept, r2, n) in one aggregation."""
    xx, yy = col_of(x).cast("double"), col_of(y).cast("double")
    return df.agg((F.covar_pop(xx, yy) / F.var_pop(xx)).alias("slope"),
                  (F.avg(yy) - F.covar_pop(xx, yy) / F.var_pop(xx) * F.avg(xx)).alias("intercept"),
                  F.pow(F.corr(xx, yy), 2).alias("r2"), F.count(F.lit(1)).alias("n"))


def ols_two(df: DataFrame, x1: str, x2: str, y: str) -> DataFrame:
    """y = b0 + b1·x1 + b2·x2 from population covariances, one aggregation."""
    a, b, t = (col_of(c).cast("double") for c in (x1, x2, y))
    s = df.agg(F.var_pop(a).alias("s11"), F.var_pop(b).alias("s22"), F.covar_pop(a, b).alias("s12"),
               F.covar_pop(a, t).alias("s1y"), F.covar_pop(b, t).alias("s2y"),
               F.avg(a).alias("m1"), F.avg(b).alias("m2"), F.avg(t).alias("my"), F.count(F.lit(1)).alias("n"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    b1 = (F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12")) / det
    b2 = (F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12")) / det
    return s.select(b1.alias("b1"), b2.alias("b2"), (F.col("my") - b1 * F.col("m1") - b2 * F.col("m2")).alias("b0"),
                    "n")


def cv_rmse_simple(df: DataFrame, x: str, y: str, fold: str, k: int) -> DataFrame:
    """K-fold CV of single-feature OLS: per-fold RMSE (train on the other folds).

    Pass 1: all k leave-one-fold-out fits as conditional aggregates in one aggregation.
    Pass 2: per-fold squared errors with the k coefficient pairs as literals.
    Output (fold, rmse, n); summarise with ``cv_summary``.
    """
    xx, yy, ff = col_of(x).cast("double"), col_of(y).cast("double"), col_of(fold)
    aggs = []
    for f in range(k):
        xm = F.when(ff != f, xx)
        ym = F.when(ff != f, yy)
        aggs += [F.covar_pop(xm, ym).alias(f"c{f}"), F.var_pop(xm).alias(f"v{f}"),
                 F.avg(xm).alias(f"mx{f}"), F.avg(ym).alias(f"my{f}")]
    r = df.agg(*aggs).first()
    slope = F.lit(None).cast("double")
    icpt = F.lit(None).cast("double")
    for f in range(k):
        b = r[f"c{f}"] / r[f"v{f}"] if r[f"v{f}"] else 0.0
        a = r[f"my{f}"] - b * r[f"mx{f}"]
        slope = F.when(ff == f, F.lit(b)).otherwise(slope)
        icpt = F.when(ff == f, F.lit(a)).otherwise(icpt)
    e = yy - (icpt + slope * xx)
    return df.groupBy(ff.alias("fold")).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """Mean and population std of the fold RMSEs."""
    return per_fold.agg(F.avg("rmse").alias("cv_rmse_mean"), F.stddev_pop("rmse").alias("cv_rmse_std"),
                        F.count(F.lit(1)).alias("folds"))


def cross_validate(df: DataFrame, features, label: str, fold: str) -> DataFrame:
    """(fold, rmse, n): full-design K-fold CV on a fold column, all fits and errors from one pass."""
    rows = [(f, e, n) for f, e, n, _ in gram.cross_validated(df, features, label, fold)]
    return df.sparkSession.createDataFrame(rows, "fold int, rmse double, n long")
