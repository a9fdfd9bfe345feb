"""Classifiers behind one name-based interface, as Spark ML models (transform, save, load).

* "forest"     200 trees, depth ≤ 20, sqrt features, by mixed growth (``forest``)
* "mlp"        rectified layers (256, 128) trained on minibatches (``network``)
* "svm_linear" squared-hinge machines, one per class against the rest, all in the same passes
* "svm_rbf"    the same on an explicit map of the RBF kernel: random Fourier features (Rahimi &
               Recht 2007; W is regenerated from the seed, so a saved pipeline needs no stored
               matrix) or, with ``kernel_map="landmarks"``, the Nyström map of hashed landmarks.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelearn.errors import ModelError
from tablelearn.operators import blocks, calibrate, forest, hinge, landmarks, network

BACKENDS = ("forest", "mlp", "svm_linear", "svm_rbf")


def rff_matrix(d: int, n_components: int, gamma: float, seed: int):
    """W ~ N(0, 2γ)^(D×d), b ~ U(0, 2π)^D from a seeded generator."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_components, d))
    b = rng.uniform(0.0, 2.0 * np.pi, size=n_components)
    return w, b


def rff_map(w: np.ndarray, b: np.ndarray):
    """x → sqrt(2/D)·cos(W x + b) for the rows of a matrix."""
    return partial(_cosines, w, b)


def _cosines(w: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    z = x @ w.T
    z += b
    np.cos(z, out=z)
    z *= np.sqrt(2.0 / len(b))
    return z


def rff_column(col, w: np.ndarray, b: np.ndarray):
    """The map over Arrow batches (pandas UDF, one matmul per batch)."""
    mapped = rff_map(w, b)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(s: pd.Series) -> pd.Series:
        if len(s) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(mapped(np.stack([np.asarray(v, dtype=np.float64) for v in s]))))
    return rff(col)


class RFF(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Spark ML stage: vector → RFF vector.  gamma="scale" style values are resolved by the caller."""

    gamma = Param(Params._dummy(), "gamma", "RBF gamma", typeConverter=TypeConverters.toFloat)
    nComponents = Param(Params._dummy(), "nComponents", "number of features D", typeConverter=TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "generator seed", typeConverter=TypeConverters.toInt)
    inputDim = Param(Params._dummy(), "inputDim", "length of the input vectors", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="rff", gamma=1.0, nComponents=2000, seed=42, inputDim=0):
        super().__init__()
        self._setDefault(gamma=1.0, nComponents=2000, seed=42, inputDim=0)
        self._set(**self._input_kwargs)

    def matrix(self):
        return rff_matrix(self.getOrDefault(self.inputDim), self.getOrDefault(self.nComponents), self.getOrDefault(self.gamma),
                          self.getOrDefault(self.seed))

    def size(self) -> int:
        return self.getOrDefault(self.nComponents)

    def mapping(self):
        return rff_map(*self.matrix())

    def _transform(self, df: DataFrame) -> DataFrame:
        """Only a projection: no job runs, so empty tables and streams can be scored."""
        w, b = self.matrix()
        z = rff_column(vector_to_array(F.col(self.getInputCol())), w, b)
        return df.withColumn(self.getOutputCol(), array_to_vector(z))


def gamma_scale(df: DataFrame, vec: str) -> float:
    """gamma="scale" = 1 / (d · Var(X)), Var over all n·d elements, from one Summarizer pass:
    Var = mean_d(var_d + mean_d²) − (mean_d mean_d)² with population per-dimension variances."""
    from pyspark.ml.stat import Summarizer

    r = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(vec)).alias("s")).first()["s"]
    n = r["count"]
    mean = np.asarray(r["mean"].toArray())
    var = np.asarray(r["variance"].toArray()) * ((n - 1) / n if n > 1 else 0.0)
    d = len(mean)
    total_var = float(np.mean(var + mean ** 2) - np.mean(mean) ** 2)
    return 1.0 / (d * total_var) if total_var > 0 else 1.0


def resolve_gamma(df: DataFrame, vec: str, gamma) -> float:
    """A number as it is; "scale" = 1 / (d · Var(X)), "auto" = 1 / d."""
    if gamma == "scale":
        return gamma_scale(df, vec)
    return 1.0 / width(df, vec) if gamma == "auto" else float(gamma)


def width(df: DataFrame, vec: str) -> int:
    row = df.select(vec).first()
    if row is None:
        raise ModelError("cannot fit on an empty table")
    return len(row[0])


ROWS_PER_TASK = 200
MAX_CLASSES = 10_000


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """Iterative fits run one small job per step: no more partitions than their rows fill."""
    return blocks.tasks(df, rows, ROWS_PER_TASK)


def kernel_map(df: DataFrame, features: str, n_features: int, seed: int, gamma="scale", kernel_map: str = "fourier",
               n_components: int = 2000):
    """The stage whose image of ``features`` makes a linear machine one with an RBF kernel."""
    gamma = resolve_gamma(df, features, gamma)
    if kernel_map == "landmarks":
        return landmarks.fit(df, features, gamma, n_components, out="_svm_in")
    if kernel_map != "fourier":
        raise ModelError(f"unknown kernel map {kernel_map!r}")
    return RFF(inputCol=features, outputCol="_svm_in", gamma=gamma, nComponents=n_components, seed=seed, inputDim=n_features)


def fit_classifier(df: DataFrame, features: str, label: str, backend: str, n_classes: int, seed: int = 42, **kw):
    """Fit by backend name; returns a fitted Spark model (fit/transform/save/load interface)."""
    if backend not in BACKENDS:
        raise ModelError(f"unknown backend {backend!r}; choose one of {BACKENDS}")
    n_features = width(df, features)
    if backend == "forest":
        return forest.fit(df, features, label, n_classes, kw.get("num_trees", 200), kw.get("max_depth", 20), seed=seed)
    n = df.count()
    if backend == "mlp":
        more = {k: kw[k] for k in ("max_epochs", "rate", "l2", "batch_rows") if k in kw}
        return network.fit(few_tasks(df, n), features, label, n_classes, n_features, kw.get("hidden", [256, 128]), seed=seed, rows=n, **more)
    some, steps = few_tasks(df, n), {"tol": kw.get("tol", 1e-4), "max_iter": kw.get("max_iter", 200)}
    if backend == "svm_linear":
        return hinge.fit(some, features, label, n_classes, 1.0 / (n * kw.get("reg_param", 0.01)), n_features, **steps)
    stage = kernel_map(df, features, n_features, seed, **{k: kw[k] for k in ("gamma", "kernel_map", "n_components") if k in kw})
    c = 1.0 / (n * kw["reg_param"]) if "reg_param" in kw else kw.get("C", 5.0)
    return PipelineModel(stages=[hinge.fit(some, features, label, n_classes, c, stage.size(), stage=stage, **steps)])


def margin(df: DataFrame, raw: str = "rawPrediction", out: str = "margin") -> DataFrame:
    """Binary decision value from a rawPrediction vector (positive-class component)."""
    return df.withColumn(out, vector_to_array(F.col(raw))[1])


def platt_fit(df: DataFrame, score: str, label: str) -> tuple[float, float]:
    """Sigmoid calibration p = 1/(1+exp(A·f+B)) fitted by logistic regression on (f, y)."""
    x = df.select(array_to_vector(F.array(F.col(score).cast("double"))).alias("f"), F.col(label).cast("double").alias("y"))
    m = LogisticRegression(featuresCol="f", labelCol="y", regParam=0.0, standardization=False).fit(x)
    return -float(m.coefficients[0]), -float(m.intercept)


def platt_apply(score_col, a: float, b: float):
    return 1.0 / (1.0 + F.exp(F.lit(a) * score_col + F.lit(b)))


def grid_search(df: DataFrame, features: str, label: str, fold: str, gammas=("scale", "auto"), cs=(0.5, 1.0, 5.0, 10.0),
                n_components: int = 2000, seed: int = 42, kernel: str = "fourier", tol: float = 1e-4, max_iter: int = 100):
    """C × gamma grid of RBF machines, k-fold by a fold column, mean accuracy per cell.

    The rows are packed once; for a gamma all its C × fold machines, and those of every C on all rows, are
    fitted in the same passes, which map the rows as they go, and one more pass scores the left-out rows.
    Returns (rows (gamma, C, accuracy, rows scored), model of the best cell on all rows; ties to
    the earlier gamma and the smaller C).
    """
    rows_in = df.select(features, label, fold).persist()
    sizes = {int(r[fold]): r["n"] for r in rows_in.groupBy(fold).agg(F.count(F.lit(1)).alias("n")).collect()}
    classes = sorted(float(r[0]) for r in rows_in.select(label).distinct().limit(MAX_CLASSES + 1).collect())
    total, d = sum(sizes.values()), width(rows_in, features)
    if len(classes) > MAX_CLASSES:
        raise ModelError(f"more than {MAX_CLASSES} classes")
    n_classes = max(2, int(classes[-1]) + 1)
    rows, best = [], None
    packed = blocks.pack(few_tasks(rows_in, total), features, [label, fold]).persist()
    for g in gammas:
        stage = kernel_map(rows_in, features, d, seed, g, kernel, n_components)
        via = df.sparkSession.sparkContext.broadcast(stage.mapping())
        cells, groups = [], {}
        for c in cs:
            for f in [*sorted(sizes), -1]:
                machines = hinge.against_rest(c, n_classes, f)
                groups[c, f] = list(range(len(cells), len(cells) + len(machines)))
                cells += machines
        w = hinge.fit_cells(packed, stage.size(), cells, tol, max_iter, via)
        held = [k for k in groups if k[1] >= 0]
        right = dict(zip(held, hinge.hits(packed, w, [groups[k] for k in held], [k[1] for k in held], [float(k) for k in range(n_classes)], via)))
        via.destroy()
        for c in cs:
            accuracy = float(np.mean([right[c, f] / n for f, n in sorted(sizes.items())]))
            rows.append((str(g), float(c), accuracy, total))
            if best is None or accuracy > best[0]:
                best = accuracy, PipelineModel(stages=[hinge.model(w[:, groups[c, -1]], features, stage)])
    packed.unpersist()
    rows_in.unpersist()
    return rows, best[1]


def svm_probabilities(df: DataFrame, features: str, label: str, fold: str, n_classes: int = 2, C: float = 5.0, seed: int = 42, **kw):
    """An RBF machine with class probabilities from margins of folds it has not seen; pairs of classes coupled."""
    d = width(df, features)
    folds = int(df.agg(F.max(fold)).first()[0]) + 1
    return calibrate.fit(few_tasks(df, df.count()), label, fold, folds, n_classes, C, kernel_map(df, features, d, seed, **kw))


def epoch_training(train: DataFrame, val: DataFrame, features: str, label: str, n_classes: int,
                   hidden=(32,), rounds: int = 8, iters_per_round: int = 5, seed: int = 42,
                   patience: int = 4, min_delta: float = 1e-5, lr: float | None = None, factor: float = 0.5,
                   lr_patience: int = 2, lr_threshold: float = 1e-4, batch_rows: int = 256):
    """Validation-monitored minibatch training; a round is ``iters_per_round`` epochs.

    History rows (epoch, train_loss, train_acc, val_loss, val_acc[, lr]), the training figures being
    those of the round's last epoch as its steps meet the rows; best = first round with the strictly
    greatest val accuracy (> 0); early stop on val loss as the reference does.  With ``lr`` the
    step is multiplied by ``factor`` after more than ``lr_patience`` rounds without a better
    validation loss; without it it stays at 0.005.
    """
    n = train.count()
    t = network.Training(few_tasks(train, n), features, label, [width(train, features), *hidden, n_classes], seed, lr or 0.005,
                         batch_rows=batch_rows, rows=n)
    held = blocks.pack(val, features, [label]).persist()
    hist, best_acc, best_model, best_loss, counter = [], 0.0, None, float("inf"), 0
    plateau, bad = float("inf"), 0
    for epoch in range(1, rounds + 1):
        for _ in range(iters_per_round):
            tl, ta = t.epoch()
        vl, vacc = network.evaluate(held, t.weights)
        hist.append((epoch, float(tl), float(ta), float(vl), float(vacc)) + (() if lr is None else (t.adam.rate,)))
        if lr is not None:
            better = vl < plateau * (1 - lr_threshold)
            plateau, bad = (vl, 0) if better else (plateau, bad + 1)
            if bad > lr_patience:
                t.adam.rate, bad = t.adam.rate * factor, 0
        if vacc > best_acc:
            best_acc, best_model = vacc, t.model()
        if vl < best_loss - min_delta:
            best_loss, counter = vl, 0
        else:
            counter += 1
            if counter >= patience:
                break
    held.unpersist()
    t.close()
    return hist, best_model
