"""Projection helpers: feature selection with a clear error, fixed column order, label
encode/decode against an ordered class list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.errors import ValidationError
from tablelearn.functions.exprs import col_of

MAX_LITERAL_CLASSES = 100


def select_features(df: DataFrame, features, keep=()) -> DataFrame:
    if not features:
        raise ValidationError("feature list is empty")
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValidationError(f"missing feature columns: {missing}")
    return df.select(*[col_of(c) for c in list(keep) + list(features)])


def order_columns(df: DataFrame, features) -> DataFrame:
    """Other columns first (original order), then the features in the configured order."""
    others = [c for c in df.columns if c not in features]
    return df.select(*[col_of(c) for c in others + list(features)])


def encode_labels(df: DataFrame, col: str, classes, out: str = "label") -> DataFrame:
    """Position in the ordered class list (0-based); unknown → null.  ≤100 classes as a literal
    map, more through a broadcast join of the (bounded) class table."""
    if len(classes) <= MAX_LITERAL_CLASSES:
        m = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
        return df.withColumn(out, F.try_element_at(m, col_of(col)).cast("int"))
    t = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(classes)], f"_c string, {out} int")
    return df.join(F.broadcast(t), col_of(col) == F.col("_c"), "left").drop("_c")


def decode_labels(df: DataFrame, col: str, classes, out: str = "class_name") -> DataFrame:
    arr = F.array(*[F.lit(c) for c in classes])
    return df.withColumn(out, F.when(col_of(col).between(0, len(classes) - 1), F.element_at(arr, col_of(col) + 1)))
