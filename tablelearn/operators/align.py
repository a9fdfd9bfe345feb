"""Keyed row alignment: lookups with a default, missing-key listing, semi/anti alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.exprs import col_of

MAX_BROADCAST_BYTES = 32 << 20


def bounded(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast a dimension only after measuring its size (bytes of its values as text)."""
    size = dim.agg(F.sum(F.octet_length(F.to_json(F.struct(*dim.columns)))).alias("b")).first()["b"] or 0
    return F.broadcast(dim) if size <= max_bytes else dim  # too large: let the planner shuffle-join it


def lookup_default(df: DataFrame, dim: DataFrame, key: str, value: str, default_key: str = "default",
                   default=None, out: str | None = None) -> DataFrame:
    """Left lookup of ``value`` by ``key``; unknown keys get the dimension's ``default`` entry
    (or the given default; the smallest of several).  A literal key equal to ``default_key`` matches like any other."""
    if default is None:
        default = dim.where(col_of(key) == F.lit(default_key)).agg(F.min(col_of(value))).first()[0]
    d = dim.select(col_of(key).alias("_lk"), col_of(value).alias("_lv"))
    j = df.join(bounded(d), col_of(key) == F.col("_lk"), "left")
    return j.withColumn(out or value, F.coalesce(F.col("_lv"), F.lit(default))).drop("_lk", "_lv")


def missing_keys(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Keys of ``df`` absent from the dimension, with row counts (grouped left-anti)."""
    d = dim.select(col_of(key).alias(key))
    return (df.join(bounded(d), key, "left_anti").groupBy(key).agg(F.count(F.lit(1)).alias("n")))


def semi_align(y: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    return y.join(kept.select(key), key, "left_semi")
