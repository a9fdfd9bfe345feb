"""Validation rules, all counted in one aggregation job per table.

``check`` returns a long table ``(seq, rule, column, violations)``; ``require``
raises on the first failing rule in the order given (the reference's order).
Rules:
  ("columns", [names])          required columns present (driver, no job)
  ("non_empty",)                at least one row
  ("positive", col)             count of col <= 0
  ("not_null", col)             count of null or NaN
  ("non_negative", col)         count of col < 0
  ("unique", [cols])            rows beyond the first per key (null is a value)
  ("between", col, lo, hi)      count outside [lo, hi]
  ("one_of", col, [values])     count not in the set (nulls count)
  ("min_rows", n)               violations = max(n - rows, 0)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.errors import ValidationError
from tablelearn.functions.exprs import col_of, is_missing

_SCHEMA = "seq int, rule string, column string, violations bigint"


def _cnt(cond):
    return F.count_if(cond).cast("bigint")


def check(df: DataFrame, rules) -> DataFrame:
    spark = df.sparkSession
    static, aggs = [], []  # static: rows known without a job
    present = set(df.columns)
    for seq, r in enumerate(rules):
        kind = r[0]
        if kind == "columns":
            missing = [c for c in r[1] if c not in present]
            static.append((seq, "columns", ",".join(missing) or "*", len(missing)))
            continue
        cols = r[1] if len(r) > 1 and kind != "min_rows" else None
        names = cols if isinstance(cols, (list, tuple)) else [cols] if cols else []
        if any(c not in present for c in names):
            static.append((seq, kind, ",".join(names), -1))  # cannot evaluate: column absent
            continue
        if kind == "non_empty":
            e = F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint")
            label = "*"
        elif kind == "min_rows":
            e = F.greatest(F.lit(int(r[1])) - F.count(F.lit(1)), F.lit(0)).cast("bigint")
            label = "*"
        elif kind == "positive":
            e, label = _cnt(col_of(cols) <= 0), cols
        elif kind == "non_negative":
            e, label = _cnt(col_of(cols) < 0), cols
        elif kind == "not_null":
            e, label = _cnt(is_missing(df, cols)), cols
        elif kind == "between":
            c = col_of(cols)
            e, label = _cnt(c.isNotNull() & ~c.between(F.lit(r[2]), F.lit(r[3]))), cols
        elif kind == "one_of":
            c = col_of(cols)
            e, label = _cnt(c.isNull() | ~c.isin(list(r[2]))), cols
        elif kind == "unique":
            key = F.struct(*[col_of(c) for c in names])
            e, label = (F.count(F.lit(1)) - F.count_distinct(key)).cast("bigint"), ",".join(names)
        else:
            raise ValueError(f"unknown rule {kind}")
        aggs.append((seq, kind, label, e))
    parts = []
    if static:
        parts.append(spark.createDataFrame(static, _SCHEMA))
    if aggs:
        row = df.agg(*[e.alias(f"r{i}") for i, (_, _, _, e) in enumerate(aggs)])
        stack = ", ".join(f"{s}, '{k}', '{lab}', r{i}" for i, (s, k, lab, _) in enumerate(aggs))
        parts.append(row.selectExpr(f"stack({len(aggs)}, {stack}) as (seq, rule, column, violations)")
                     .selectExpr("cast(seq as int) seq", "rule", "column", "cast(violations as bigint) violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require(df: DataFrame, rules) -> None:
    """Raise ValidationError on the first failing rule (rules are few: collect is bounded)."""
    res = sorted(check(df, rules).collect(), key=lambda r: r["seq"])
    failed = [(r["rule"], r["column"], r["violations"]) for r in res if r["violations"] != 0]
    if failed:
        rule, col, n = failed[0]
        raise ValidationError(f"validation failed: {rule}({col}) violations={n}", failed)


def aligned_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Two-table length check by key: rows only left, only right, and matched."""
    l = left.select(F.col(key).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("nl"))
    r = right.select(F.col(key).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("nr"))
    j = l.join(r, "k", "full_outer")
    return j.agg(
        F.coalesce(F.sum(F.when(F.col("nr").isNull(), F.col("nl"))), F.lit(0)).cast("bigint").alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("nl").isNull(), F.col("nr"))), F.lit(0)).cast("bigint").alias("only_right"),
        F.coalesce(F.sum(F.when(F.col("nl").isNotNull() & F.col("nr").isNotNull(), F.col("nl"))), F.lit(0))
         .cast("bigint").alias("matched"),
    )
