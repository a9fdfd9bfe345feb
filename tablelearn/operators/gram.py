"""Least squares from second moments.

One aggregation gives, per fold, the count, the sums and the sums of products of all features and the
target; everything else is arithmetic on matrices as wide as the design.  The moments of all folds
but one are a subtraction, so k-fold cross-validation costs the same single pass, and the squared
error of a held-out fold follows from its moments without touching its rows again.

Products are taken about a pivot (the means of the whole table, one cheap pass before), since
sums of raw products lose digits where means are large.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.errors import ModelError
from tablelearn.functions.exprs import col_of

#: Share of the largest eigenvalue of the correlation matrix below which a direction counts as absent.
RANK_TOLERANCE = 1e-10
MAX_FOLDS = 1000


class Moments(NamedTuple):
    n: float
    s: np.ndarray  # sums of features and target about the pivot
    p: np.ndarray  # sums of their products

    def __sub__(self, other):
        return Moments(self.n - other.n, self.s - other.s, self.p - other.p)


class Fit(NamedTuple):
    intercept: float
    coefficients: np.ndarray


def moments(df: DataFrame, features, label: str, fold: str | None = None) -> tuple[np.ndarray, dict]:
    """(pivot, {fold: Moments}); rows with a null in any column take no part.  Without ``fold`` the key is None."""
    cols = [col_of(c).cast("double") for c in [*features, label]]
    names = [f"c{i}" for i in range(len(cols))]
    key = col_of(fold).cast("int") if fold else F.lit(None).cast("int")
    rows = df.select(*[c.alias(n) for c, n in zip(cols, names)], key.alias("k")).dropna(subset=names)
    r = rows.agg(*[F.avg(n).alias(n) for n in names]).first()
    if r["c0"] is None:
        raise ModelError("cannot fit on an empty table")
    pivot = np.array([r[n] for n in names], np.float64)
    d = [F.col(n) - F.lit(float(v)) for n, v in zip(names, pivot)]
    pairs = [(i, j) for i in range(len(d)) for j in range(i, len(d))]
    aggs = [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(d)],
            *[F.sum(d[i] * d[j]).alias(f"p{i}_{j}") for i, j in pairs]]
    out = {}
    for r in rows.groupBy("k").agg(*aggs).limit(MAX_FOLDS + 1).collect():
        p = np.zeros((len(d), len(d)))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r["k"]] = Moments(float(r["n"]), np.array([r[f"s{i}"] for i in range(len(d))]), p)
    if len(out) > MAX_FOLDS:
        raise ModelError(f"more than {MAX_FOLDS} folds")
    return pivot, out


def total(parts) -> Moments:
    parts = list(parts)
    return Moments(sum(m.n for m in parts), sum(m.s for m in parts), sum(m.p for m in parts))


def solve(m: Moments, pivot: np.ndarray) -> Fit:
    """Least squares with an intercept; of all solutions the one with the shortest coefficient vector.

    The rank is judged on the correlation matrix, so units do not matter; the part of a solution
    that lies in the null space of the design is then taken off in the features' own units."""
    if m.n <= 0:
        raise ModelError("cannot fit on an empty table")
    mean = m.s / m.n
    c = m.p / m.n - np.outer(mean, mean)
    cov, cross = c[:-1, :-1], c[:-1, -1]
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    # A column whose spread is rounding of its own values is constant.
    used = sd > 1e-12 * (np.abs(pivot[:-1]) + sd)
    b = np.zeros(len(sd))
    if used.any():
        d = sd[used]
        value, vector = np.linalg.eigh(cov[np.ix_(used, used)] / np.outer(d, d))
        keep = value > RANK_TOLERANCE * value[-1]
        got = vector[:, keep] @ ((vector[:, keep].T @ (cross[used] / d)) / value[keep]) / d
        if not keep.all():
            null, _ = np.linalg.qr(vector[:, ~keep] / d[:, None])
            got -= null @ (null.T @ got)
        b[used] = got
    center = pivot + mean
    return Fit(float(center[-1] - b @ center[:-1]), b)


def squared_error(m: Moments, pivot: np.ndarray, fit: Fit) -> float:
    """Sum of squared residuals of a fit over the rows that the moments describe."""
    w = np.append(-fit.coefficients, 1.0)
    a = pivot[-1] - fit.intercept - fit.coefficients @ pivot[:-1]
    return max(0.0, float(w @ m.p @ w + 2.0 * a * (w @ m.s) + m.n * a * a))


def fit(df: DataFrame, features, label: str) -> Fit:
    pivot, parts = moments(df, features, label)
    return solve(total(parts.values()), pivot)


def cross_validated(df: DataFrame, features, label: str, fold: str) -> list[tuple[int, float, int, Fit]]:
    """(fold, RMSE on it of the fit on all others, rows, that fit) for every fold."""
    pivot, parts = moments(df, features, label, fold)
    whole = total(parts.values())
    out = []
    for f in sorted(k for k in parts if k is not None):
        got = solve(whole - parts[f], pivot)
        out.append((f, float(np.sqrt(squared_error(parts[f], pivot, got) / parts[f].n)), int(parts[f].n), got))
    return out
