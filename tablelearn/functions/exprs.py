"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_FLOATING = (T.FloatType, T.DoubleType)


def col_of(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, _FLOATING)


def is_missing(df: DataFrame, name: str) -> Column:
    """pandas ``isna``: null, and NaN for floating columns."""
    c = col_of(name)
    return (c.isNull() | F.isnan(c)) if is_floating(df, name) else c.isNull()


def nan_to_null(df: DataFrame, name: str) -> Column:
    c = col_of(name)
    return F.nanvl(c, F.lit(None).cast(df.schema[name].dataType)) if is_floating(df, name) else c


def order_hash(key, seed: int | str = 42) -> Column:
    """Deterministic per-row order: md5 of 'seed:key' (same text in DuckDB)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), col_of(key).cast("string")))


def hash_bucket(h: Column, digits: int = 4) -> Column:
    """Leading hex digits of an md5 as an integer bucket (order-preserving)."""
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def round_doubles(df: DataFrame, places: int = 6, overrides: dict | None = None) -> DataFrame:
    """Report-layer rounding of every floating column (comparison hygiene)."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        c = col_of(f.name)
        if isinstance(f.dataType, _FLOATING):
            out.append(F.round(c.cast("double"), overrides.get(f.name, places)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def vec_sqdist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0).cast("double"),
                       lambda acc, v: acc + v)


def array_literal(values, elem_type: str = "double") -> Column:
    return F.array(*[F.lit(float(v) if elem_type == "double" else v) for v in values]).cast(f"array<{elem_type}>")


def matrix_literal(rows) -> Column:
    return F.array(*[array_literal(r) for r in rows])


WIDE_DIM = 64


def grouped_vector_sums(df: DataFrame, group: str, vec: str, dim: int, max_groups: int = 1000):
    """{group: (count, [Σ x_i])} for an array<double> column; k rows reach the driver.

    Up to WIDE_DIM dimensions: one aggregate per dimension (exact sums).  Wider vectors use
    one Summarizer aggregate (mean · count) so the plan does not grow with d."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    if dim <= WIDE_DIM:
        aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(F.col(vec)[i]).alias(f"_s{i}") for i in range(dim)]
        rows = df.groupBy(F.col(group).alias("_g")).agg(*aggs).limit(max_groups + 1).collect()
        out = {r["_g"]: (r["_n"], [float(r[f"_s{i}"]) for i in range(dim)]) for r in rows}
    else:
        rows = (df.select(F.col(group).alias("_g"), array_to_vector(F.col(vec)).alias("_v"))
                .groupBy("_g").agg(Summarizer.metrics("mean", "count").summary(F.col("_v")).alias("_s"))
                .limit(max_groups + 1).collect())
        out = {r["_g"]: (r["_s"]["count"], [float(m) * r["_s"]["count"] for m in r["_s"]["mean"].toArray()])
               for r in rows}
    if len(out) > max_groups:
        from tablelearn.errors import SizeBoundError
        raise SizeBoundError(f"more than {max_groups} groups")
    return out
