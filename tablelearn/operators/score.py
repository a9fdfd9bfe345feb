"""Scoring helpers: class-probability vectors, top-1 with confidence, probability maps,
prediction tables with lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.exprs import matrix_literal, vec_sqdist
from tablelearn.operators.align import lookup_default


def softmax_distance(df: DataFrame, vec: str, centroids, out: str = "probability") -> DataFrame:
    """Probabilities ∝ exp(−‖x − c‖²), computed stably (shifted by the smallest distance)."""
    mat = matrix_literal(centroids)
    d = F.transform(mat, lambda c: vec_sqdist(F.col(vec), c))
    df = df.withColumn("_d", d).withColumn("_dmin", F.array_min("_d"))
    e = F.transform("_d", lambda x: F.exp(-(x - F.col("_dmin"))))
    df = df.withColumn("_e", e)
    tot = F.aggregate("_e", F.lit(0.0), lambda a, v: a + v)
    return df.withColumn(out, F.transform("_e", lambda v: v / tot)).drop("_d", "_dmin", "_e")


def top1(df: DataFrame, proba: str, classes, cls_out: str = "top_class", conf_out: str = "confidence") -> DataFrame:
    """Arg-max class (the first maximum wins, like argmax) and its probability."""
    arr = F.array(*[F.lit(c) for c in classes])
    pos = F.array_position(F.col(proba), F.array_max(F.col(proba))).cast("int")
    return df.withColumn(cls_out, F.element_at(arr, pos)).withColumn(conf_out, F.array_max(F.col(proba)))


def proba_map(df: DataFrame, proba: str, classes, out: str = "proba_map") -> DataFrame:
    """class → probability map column."""
    keys = F.array(*[F.lit(str(c)) for c in classes])
    return df.withColumn(out, F.map_from_arrays(keys, F.col(proba)))


def predictions_table(df: DataFrame, y: str, p: str, names, dim: DataFrame, key: str, value: str,
                      default=None) -> DataFrame:
    """true/predicted class names, their looked-up values and a correctness flag."""
    nm = F.array(*[F.lit(n) for n in names])
    t = df.withColumn("true_class", F.element_at(nm, F.col(y) + 1)).withColumn("predicted_class",
                                                                               F.element_at(nm, F.col(p) + 1))
    dd = dim.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    t = lookup_default(t.withColumn("_k", F.col("true_class")), dd, "_k", "_v", default=default, out="true_value").drop("_k")
    t = lookup_default(t.withColumn("_k", F.col("predicted_class")), dd, "_k", "_v", default=default,
                       out="predicted_value").drop("_k")
    return t.withColumn("correct", (F.col(y) == F.col(p)).cast("int"))
