"""Fit-on-one-table, apply-to-another: median imputation, infinity sanitising, IQR filter.

Fitted state is a one-row DataFrame; applying it injects the values as literals, so the
apply side is a pure projection Catalyst can fold and push down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.functions.exprs import col_of, is_floating, nan_to_null
from tablelearn.operators.profile import exact_quantiles


def fit_median(df: DataFrame, cols) -> DataFrame:
    """Exact medians as a one-row DataFrame with one column per feature."""
    q = exact_quantiles(df, cols, [0.5])
    schema = ", ".join(f"`{c}` double" for c in cols)
    return df.sparkSession.createDataFrame([tuple(q[c][0.5] for c in cols)], schema)


def _values(fitted) -> dict:
    return fitted if isinstance(fitted, dict) else fitted.first().asDict()


def apply_median(df: DataFrame, fitted) -> DataFrame:
    """Replace null/NaN in each fitted column by its learned median; other columns untouched."""
    vals = _values(fitted)
    out = []
    for c in df.columns:
        if c in vals and vals[c] is not None:
            out.append(F.coalesce(nan_to_null(df, c), F.lit(vals[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            out.append(col_of(c))
    return df.select(*out)


def sanitize_inf(df: DataFrame, cols=None) -> DataFrame:
    """±infinity → null on every floating column (or the given ones)."""
    cols = set(cols or [c for c in df.columns if is_floating(df, c)])
    return df.select(*[
        F.when(F.abs(col_of(c)) == F.lit(float("inf")), F.lit(None).cast(df.schema[c].dataType))
         .otherwise(col_of(c)).alias(c) if c in cols else col_of(c) for c in df.columns])


def residual_fill(df: DataFrame, cols, learned=None, mode: str = "learned") -> DataFrame:
    """Fill gaps left after ``sanitize_inf``.

    mode="learned" (default, no leakage) reuses the fitted medians; mode="current"
    recomputes medians on this table, which is what the reference does.
    """
    if mode == "current" or learned is None:
        learned = fit_median(df, cols)
    return apply_median(df, learned)


def iqr_bounds(df: DataFrame, col: str, k: float = 3.0) -> tuple[float, float]:
    q = exact_quantiles(df, [col], [0.25, 0.75])[col]
    q1, q3 = q[0.25], q[0.75]
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def iqr_filter(df: DataFrame, col: str, k: float = 3.0, bounds=None) -> DataFrame:
    """Keep rows with col in [q1 − k·iqr, q3 + k·iqr] inclusive; missing values drop."""
    lo, hi = bounds or iqr_bounds(df, col, k)
    return df.where(nan_to_null(df, col).between(F.lit(lo), F.lit(hi)))


def removed_rows(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows a filter removed, by key (left-anti join)."""
    return before.join(after.select(key), key, "left_anti")
