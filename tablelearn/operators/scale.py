"""Standard scaling with the population std; zero-variance columns keep scale 1.

Spark ML's StandardScaler divides by the sample std, so the statistics are our own
aggregate (scalar columns) or a Summarizer pass (vector columns), applied as literals.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.exprs import col_of, nan_to_null


def fit_scaler(df: DataFrame, cols) -> DataFrame:
    """One-row DataFrame: mean_<c>, std_<c> (population) per column, one aggregation."""
    aggs = []
    for c in cols:
        v = nan_to_null(df, c).cast("double")
        aggs += [F.avg(v).alias(f"mean_{c}"), F.stddev_pop(v).alias(f"std_{c}")]
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, fitted, cols) -> DataFrame:
    st = fitted if isinstance(fitted, dict) else fitted.first().asDict()
    out = []
    for c in df.columns:
        if c in cols:
            sd = st[f"std_{c}"]
            scale = 1.0 if (sd is None or sd == 0.0) else sd
            out.append(((col_of(c).cast("double") - F.lit(st[f"mean_{c}"])) / F.lit(scale)).alias(c))
        else:
            out.append(col_of(c))
    return df.select(*out)


def scaled_points(df: DataFrame, cols, fitted: dict | None, out: str = "x") -> DataFrame:
    """Add the scaled columns as one array and keep the raw ones; no statistics: raw values."""
    def one(c):
        if fitted is None:
            return col_of(c).cast("double")
        return (col_of(c).cast("double") - F.lit(fitted[f"mean_{c}"])) / F.lit(fitted[f"std_{c}"] or 1.0)
    return df.withColumn(out, F.array(*[one(c) for c in cols]))


def fit_vector_scaler(df: DataFrame, vec: str) -> tuple[list[float], list[float]]:
    """Mean and population std of a vector column (one Summarizer pass; d-sized result)."""
    r = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(vec)).alias("s")).first()["s"]
    n = r["count"]
    mean = r["mean"].toArray().tolist()
    var = r["variance"].toArray().tolist()
    std = [(v * (n - 1) / n) ** 0.5 if n > 1 else 0.0 for v in var]
    return mean, std


def apply_vector_scaler(df: DataFrame, vec: str, mean, std, out: str | None = None) -> DataFrame:
    """(x − mean)/scale element-wise, JVM-side through array higher-order functions."""
    scale = [s if s > 0 else 1.0 for s in std]
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in scale])
    arr = vector_to_array(F.col(vec))
    scaled = F.zip_with(F.zip_with(arr, m, lambda x, y: x - y), s, lambda x, y: x / y)
    return df.withColumn(out or vec, array_to_vector(scaled))
