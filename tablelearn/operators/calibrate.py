"""Class probabilities from decision values, by cross-fitting.

A sigmoid 1 / (1 + exp(A f + B)) is fitted on decision values of rows that the machine behind them has
not seen: every machine is fitted once per fold without it, and the left-out margins of all folds
fit the sigmoid.  With more than two classes there is one machine and one sigmoid per
pair of classes; the pairs are coupled by least squares (Wu, Lin and Weng 2004).

All sigmoids take their Newton steps together, one pass over the packed rows per step.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelearn.operators import blocks, hinge


class Newton:
    """Damped Newton steps for the two numbers of one sigmoid; the caller evaluates ``trial``."""

    def __init__(self, n_pos: float, n_neg: float, smooth: bool):
        self.at = np.array([0.0, np.log((n_neg + 1.0) / (n_pos + 1.0)) if smooth else 0.0])
        self.f, self.trial, self.t, self.done = None, self.at, 1.0, False

    def tell(self, f: float, g: np.ndarray, h: np.ndarray):
        if self.f is not None and f > self.f + 1e-4 * self.t * float(self.g @ self.p) + 1e-14 * abs(self.f):
            self.t *= 0.5
            self.done = self.t < 1e-10
            self.trial = self.at if self.done else self.at + self.t * self.p
            return
        self.at, self.f, self.g = self.trial, f, g
        a, b, c = h
        det = (a + 1e-12) * (c + 1e-12) - b * b
        self.p = -np.array([(c + 1e-12) * g[0] - b * g[1], (a + 1e-12) * g[1] - b * g[0]]) / det
        self.done = float(np.abs(g).max()) < 1e-9 * max(1.0, self.f) or not np.isfinite(self.p).all()
        self.t, self.trial = 1.0, self.at if self.done else self.at + self.p


def sigmoids(packed: DataFrame, cells: int, decide, smooth: bool = True, max_iter: int = 100, via=None) -> np.ndarray:
    """(cells, 2) numbers A, B.  ``decide(x, *scalars)`` gives the decision values (rows, cells) and the
    side of every row, +1, -1 or 0 where a cell leaves it out.

    With ``smooth`` the targets are Platt's (n + 1) / (n + 2) and 1 / (n + 2), else 1 and 0."""
    def sizes(*block):
        side = decide(*block)[1]
        return (side > 0).sum(0), (side < 0).sum(0)
    pos, neg = blocks.total(packed, sizes, [(cells,), (cells,)], via)
    hi, lo = ((pos + 1) / (pos + 2), 1 / (neg + 2)) if smooth else (np.ones(cells), np.zeros(cells))
    runs = [Newton(p, n, smooth) for p, n in zip(pos, neg)]
    for _ in range(max_iter):
        if all(r.done for r in runs):
            break
        a, b = np.array([r.trial for r in runs]).T

        def kernel(*block):
            f, side = decide(*block)
            used = side != 0
            z = a * f + b
            p = np.exp(-np.logaddexp(0.0, z))
            t = np.where(side > 0, hi, lo)
            d = np.where(used, t - p, 0.0)  # the gradient with respect to z
            v = np.where(used, p * (1.0 - p), 0.0)
            loss = np.where(used, np.logaddexp(0.0, z) - (1.0 - t) * z, 0.0)
            return loss.sum(0), np.stack(((d * f).sum(0), d.sum(0))), np.stack(((v * f * f).sum(0), (v * f).sum(0), v.sum(0)))
        loss, g, h = blocks.total(packed, kernel, [(cells,), (2, cells), (3, cells)], via)
        for k, r in enumerate(runs):
            if not r.done:
                r.tell(loss[k], g[:, k], h[:, k])
    return np.array([r.at for r in runs])


def cross_fitted(df: DataFrame, score: str, label: str, fold: str, folds: int, out: str = "probability", smooth: bool = False) -> DataFrame:
    """P(label = 1) from a decision value: the sigmoid applied to a fold is fitted on all others."""
    packed = blocks.pack(df.select(F.array(F.col(score).cast("double")).alias("_f"), label, fold), "_f", [label, fold]).persist()
    names = np.arange(folds)

    def decide(x, y, fold):
        return np.repeat(x, folds, 1), np.where(y[:, None] == 1.0, 1.0, -1.0) * (fold[:, None] != names)
    ab = sigmoids(packed, folds, decide, smooth)
    packed.unpersist()
    per_fold = [F.array(*[F.lit(float(v)) for v in col]) for col in ab.T]
    a, b = (F.element_at(c, F.col(fold).cast("int") + 1) for c in per_fold)
    return df.withColumn(out, 1.0 / (1.0 + F.exp(a * F.col(score) + b)))


def coupled(r: np.ndarray) -> np.ndarray:
    """Class probabilities (rows, k) from pairwise ones: r[:, i, j] = P(i | i or j)."""
    n, k, _ = r.shape
    q = -np.transpose(r, (0, 2, 1)) * r
    own = (np.transpose(r, (0, 2, 1)) ** 2).sum(2) - np.einsum("nii->ni", r) ** 2
    q[:, np.arange(k), np.arange(k)] = own
    system = np.zeros((n, k + 1, k + 1))
    system[:, :k, :k], system[:, :k, k], system[:, k, :k] = q, 1.0, 1.0
    right = np.zeros((n, k + 1, 1))
    right[:, k] = 1.0
    p = np.maximum(np.linalg.solve(system, right)[:, :k, 0], 0.0)
    return p / p.sum(1, keepdims=True)


class SigmoidModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, DefaultParamsReadable, DefaultParamsWritable):
    """Probabilities of k classes from k (k - 1) / 2 machines with a sigmoid each."""

    weights = Param(Params._dummy(), "weights", "width + 1 numbers per pair of classes", typeConverter=TypeConverters.toListFloat)
    curves = Param(Params._dummy(), "curves", "A and B of every pair", typeConverter=TypeConverters.toListFloat)
    classes = Param(Params._dummy(), "classes", "number of classes", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", probabilityCol="probability", weights=None, curves=None, classes=2):
        super().__init__()
        self._setDefault(weights=[], curves=[], classes=2)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        k = self.getOrDefault(self.classes)
        pairs = list(combinations(range(k), 2))
        w = np.array(self.getOrDefault(self.weights)).reshape(len(pairs), -1).T
        a, b = np.array(self.getOrDefault(self.curves)).reshape(len(pairs), 2).T

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def share(s: pd.Series) -> pd.Series:
            if not len(s):
                return pd.Series([], dtype=object)
            first = np.exp(-np.logaddexp(0.0, a * (np.stack(s.to_numpy()) @ w[:-1] + w[-1]) + b))  # of the pair's second class
            r = np.zeros((len(s), k, k))
            for c, (i, j) in enumerate(pairs):
                p = np.clip(first[:, c], 1e-7, 1 - 1e-7)
                r[:, j, i], r[:, i, j] = p, 1 - p
            return pd.Series(list(coupled(r)))

        prob = self.getProbabilityCol()
        out = df.withColumn(prob, share(vector_to_array(F.col(self.getFeaturesCol()))))
        out = out.withColumn(self.getPredictionCol(), (F.array_position(prob, F.array_max(prob)) - 1).cast("double"))
        return out.withColumn(prob, array_to_vector(F.col(prob)))


def fit(df: DataFrame, label: str, fold: str, folds: int, n_classes: int, c: float, stage, tol: float = 1e-5, max_iter: int = 200) -> PipelineModel:
    """Machines on the mapped features of ``stage``, one per pair of classes, each with the sigmoid of its
    left-out margins: every machine is also fitted without each fold, all in the same passes."""
    packed = blocks.pack(df, stage.getInputCol(), [label, fold]).persist()
    via = df.sparkSession.sparkContext.broadcast(stage.mapping())
    pairs = list(combinations(range(n_classes), 2))
    cells = [hinge.Cell(c, float(j), f, float(i)) for f in [*range(folds), -1] for i, j in pairs]
    w = hinge.fit_cells(packed, stage.size(), cells, tol, max_iter, via)
    held = folds * len(pairs)
    of = hinge.sides(cells[:held])
    shared = df.sparkSession.sparkContext.broadcast(w[:, :held])

    def decide(x, y, fold):
        w = shared.value
        side = hinge.truth(y, fold, *of, held=True).reshape(len(x), folds, len(pairs))
        f = (x @ w[:-1] + w[-1]).reshape(len(x), folds, len(pairs))
        return (f * (side != 0)).sum(1), side.sum(1)  # a row is held out by one fold only
    ab = sigmoids(packed, len(pairs), decide, via=via)
    shared.destroy()
    via.destroy()
    packed.unpersist()
    full = w[:, held:]
    model = SigmoidModel(featuresCol=stage.getOutputCol(), weights=[float(v) for v in full.T.ravel()], curves=[float(v) for v in ab.ravel()],
                         classes=n_classes)
    return PipelineModel(stages=[stage, model])
