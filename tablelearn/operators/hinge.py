"""Squared-hinge linear machines, many at a time.

A cell is one machine: a cost C, the label it takes as positive, the label it takes as negative (or
all others), and the fold it leaves out.  The
weights of all cells form one matrix; every step is one pass over the packed rows that gives the
loss and the gradient of every cell (``blocks.total``).  The driver keeps an L-BFGS state per cell,
so cells take their own steps, and those that have converged leave the pass.  The first guess of the
inverse curvature comes from about a thousand rows, decomposed once for all cells.  A larger table has a weak
ridge, which asks for ever more of these steps.  There, if the image of the rows has few directions that count, they
are found in one pass over all rows, and every pass also gives each cell's curvature in them, from all rows that pull
at its point: few Newton steps remain.  Either guess shortens the way and has no part in where it ends.

Objective of a cell over its n rows: |w|² / (2 n C) + mean of max(0, 1 - y (w·x + b))², b not penalised.
"""

from __future__ import annotations

import importlib
import json
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelearn.errors import ModelError
from tablelearn.operators import blocks

MEMORY = 10
#: Rows that the first guess of the curvature is taken from.
CURVATURE_ROWS = 1024
#: Rows above which the curvature is taken anew at every point, directions that are kept at most, directions among
#: SPAN_ROWS rows up to which this is tried, numbers that the curvatures of all cells may have, rows added at once.
NEWTON_ROWS = 1 << 14
DIRECTIONS = 400
SPAN_ROWS = 2048
MOST_DIRECTIONS = 800
CURVATURE_VALUES = 1 << 22
TOGETHER = 2048
#: Share of the objective that may be left to fall, by the curvature at the point, when the gradient passes its test.
LEFT = 0.01


class Cell(NamedTuple):
    c: float
    positive: float = 1.0
    skip: int = -1  # fold left out; -1: none
    negative: float = np.nan  # label of the other side; nan: all others


class Descent:
    """L-BFGS with step halving for one smooth convex function; the caller evaluates ``trial``.

    With ``newton`` the caller sets the guess for every trial point and no pairs are kept.  Half of g guess(g) is then
    about what is left to fall; this must be small beside the function too, as long weights pass the test of the gradient
    early."""

    def __init__(self, size: int, tol: float, guess=None, newton: bool = False):
        self.newton = newton
        self.w, self.tol, self.guess = np.zeros(size), tol, guess
        self.f = self.g = None
        self.pairs: list[tuple] = []
        self.trial, self.t, self.done = self.w, 1.0, False

    def tell(self, f: float, g: np.ndarray):
        if self.f is not None:
            slope = float(self.g @ self.p)
            if not f <= self.f + 1e-4 * self.t * slope:
                # Rounding hides a decrease of the last digits: then the gradient must not have grown.
                flat = f <= self.f + 1e-15 * max(1.0, abs(self.f)) and np.linalg.norm(g) <= np.linalg.norm(self.g)
                if not flat:
                    self.t *= 0.5
                    if self.t < 1e-12:
                        self.done, self.trial = True, self.w
                    else:
                        self.trial = self.w + self.t * self.p
                    return
            s, y = self.trial - self.w, g - self.g
            if not self.newton and s @ y > 1e-300:
                self.pairs = [*self.pairs[-MEMORY + 1:], (s, y, 1.0 / (s @ y))]
        self.w, self.f, self.g = self.trial, f, g
        if np.linalg.norm(g) <= self.tol * max(1.0, np.linalg.norm(self.w)) and (not self.newton or g @ self.guess(g) <= 2 * LEFT * f):
            self.done = True
            return
        q, alphas = g.copy(), []
        for s, y, r in reversed(self.pairs):
            a = r * (s @ q)
            alphas.append(a)
            q -= a * y
        if self.guess:
            q = self.guess(q)
            if self.pairs:
                s, y, r = self.pairs[-1]
                q /= r * (y @ self.guess(y))
        elif self.pairs:
            s, y, r = self.pairs[-1]
            q /= r * (y @ y)
        for (s, y, r), a in zip(self.pairs, reversed(alphas)):
            q += (a - r * (y @ q)) * s
        self.p = -q
        self.t = 1.0 if self.pairs or self.guess else min(1.0, 1.0 / np.linalg.norm(g))
        self.trial = self.w + self.t * self.p


def sides(cells: list[Cell]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positive label, negative label and fold left out of every cell."""
    return tuple(np.array([float(c[i]) for c in cells]) for i in (1, 3, 2))


def truth(y, fold, positive, negative, skip, held: bool = False):
    """+1 or -1 per row and cell, 0 where the cell leaves the row out; with ``held`` 0 where it learns from it."""
    y = y[:, None]
    sign = np.where(y == positive, 1.0, np.where(np.isnan(negative) | (y == negative), -1.0, 0.0))
    return sign if fold is None else sign * ((fold[:, None] == skip) if held else (fold[:, None] != skip))


def decomposed(packed: DataFrame, n: float, via=None, most: int = CURVATURE_ROWS):
    """Curvatures 2 X'X / n and their directions (orthonormal columns) from the first rows of every block, ``most`` or so
    in all; the share of the rows that this is."""
    share = min(1.0, most / max(n, 1.0))

    def some(rows):
        for r in rows:
            x = np.frombuffer(r[1], np.float64).reshape(r[0], -1)
            x = x[:max(1, int(share * len(x)))]
            yield via.value(x) if via else x
    x = np.concatenate(packed.rdd.mapPartitions(some).collect())[:2 * most]
    x = np.hstack((x, np.ones((len(x), 1))))
    value, vector = np.linalg.eigh(2.0 / len(x) * (x @ x.T if len(x) < x.shape[1] else x.T @ x))
    keep = value > 1e-10 * value[-1]
    value, vector = value[keep], vector[:, keep]
    if len(x) < x.shape[1]:
        vector = x.T @ vector / np.sqrt(value * len(x) / 2.0)
    return value, vector, share


def curvature(packed: DataFrame, n: float, via=None):
    """ridge → (q → (ridge + 2 X'X / n)^-1 q), from CURVATURE_ROWS or so: exact in the span of these rows, and with
    their least curvature outside it."""
    value, vector, share = decomposed(packed, n, via)
    rest = 0.0 if share == 1.0 else value[0]

    def inverse(ridge):
        def apply(q):
            inside = vector.T @ q
            return vector @ (inside / (ridge + value) - inside / (ridge + rest)) + q / (ridge + rest)
        return apply
    return inverse


def directions(packed: DataFrame, n: float, ridge: float, width: int, via=None):
    """(columns, least curvature) of the directions in which all rows have a curvature that is not small beside the least ridge,
    from one pass (a Nyström decomposition of 2 X'X / n); None if some rows show that these are many."""
    value, _, _ = decomposed(packed, n, via, SPAN_ROWS)
    if (value > 0.1 * ridge).sum() > MOST_DIRECTIONS:
        return None
    start = np.linalg.qr(np.random.default_rng(0).standard_normal((width + 1, min(width + 1, DIRECTIONS))))[0]
    shared = packed.sparkSession.sparkContext.broadcast(start)

    def kernel(x, *_):
        some = shared.value
        u = x @ some[:-1] + some[-1]
        return [np.vstack((x.T @ u, u.sum(0)))]
    y = 2.0 / n * blocks.total(packed, kernel, [start.shape], via)[0]
    shared.destroy()
    shift = 1e-14 * np.linalg.norm(y)
    y += shift * start
    inner = start.T @ y
    value, vector = np.linalg.eigh((inner + inner.T) / 2.0)
    keep = value > 1e-15 * value[-1]
    vector, root, _ = np.linalg.svd(y @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    value = root ** 2 - shift
    keep = value > 0.1 * ridge
    return (vector[:, keep], 0.1 * ridge if not keep.all() else float(value[-1])) if keep.any() else None


def pulling(packed: DataFrame, weights: np.ndarray, of, vector: np.ndarray, via=None):
    """One pass: loss and gradient of every cell, and U'U of the rows that pull at its weights, U being their image
    in the directions ``vector``."""
    shared = packed.sparkSession.sparkContext.broadcast((weights, of, vector))
    (long, cells), width = weights.shape, vector.shape[1]
    upper = np.triu_indices(width)

    def run(i, rows):
        w, of, v = shared.value
        loss, grad, out, us, on = np.zeros(cells), np.zeros((long, cells)), np.zeros((cells, width, width)), [], []

        def add():
            u, act = np.concatenate(us), np.concatenate(on)
            for k in range(cells):
                some = u[act[:, k]]
                out[k] += some.T @ some
            us.clear()
            on.clear()
        for r in rows:
            for x, y, *fold in blocks.slices(r, via.value if via else None):
                sign = truth(y, fold[0] if fold else None, *of)
                slack = np.maximum(0.0, np.abs(sign) - sign * (x @ w[:-1] + w[-1]))
                pull = -2.0 * sign * slack
                loss += (slack * slack).sum(0)
                grad[:-1] += x.T @ pull
                grad[-1] += pull.sum(0)
                some = (slack > 0).any(1)
                us.append(x[some] @ v[:-1] + v[-1])
                on.append(slack[some] > 0)
                if sum(map(len, us)) >= TOGETHER:
                    add()
        if us:
            add()
        yield i, np.concatenate((loss, grad.ravel(), *(h[upper] for h in out)))
    got = blocks.added(packed.rdd.mapPartitionsWithIndex(run), cells * (1 + long + len(upper[0])))
    shared.destroy()
    hs = np.zeros((cells, width, width))
    hs[:, upper[0], upper[1]] = hs[:, upper[1], upper[0]] = got[cells * (1 + long):].reshape(cells, -1)
    return got[:cells], got[cells:cells * (1 + long)].reshape(long, cells), hs


def solved(h: np.ndarray, ridge: float, vector: np.ndarray, rest: float):
    """q → (ridge + V h V')^-1 q with the curvature ``rest`` outside the directions V."""
    inner = np.linalg.inv(h + ridge * np.eye(len(h)))

    def apply(q):
        inside = vector.T @ q
        return vector @ (inner @ inside - inside / (ridge + rest)) + q / (ridge + rest)
    return apply


def fit_cells(packed: DataFrame, width: int, cells: list[Cell], tol: float = 1e-5, max_iter: int = 200, via=None) -> np.ndarray:
    """Weights (width + 1, cells) of all cells; the last row is the intercept.

    ``packed`` comes from ``blocks.pack`` with the label and, where cells leave folds out, the fold; ``via`` is a
    broadcast feature map whose image the machines work on."""
    of = sides(cells)

    def sizes(x, y, fold=None):
        return [np.abs(truth(y, fold, *of)).sum(0)]
    n = blocks.total(packed, sizes, [(len(cells),)])[0]
    if not (n > 0).all():
        raise ModelError("cannot fit on an empty table")
    ridges, most = [1.0 / (rows * c.c) for rows, c in zip(n, cells)], float(n.max())
    found = directions(packed, most, min(ridges), width, via) if most > NEWTON_ROWS else None
    newton = found is not None and found[0].shape[1] ** 2 * len(cells) <= CURVATURE_VALUES
    inverse = (lambda _: None) if newton else curvature(packed, most, via)
    runs = [Descent(width + 1, tol, inverse(ridge), newton) for ridge in ridges]
    sc = packed.sparkSession.sparkContext
    for _ in range(max_iter):
        live = [k for k, r in enumerate(runs) if not r.done]
        if not live:
            break
        trials, some = np.column_stack([runs[k].trial for k in live]), [v[live] for v in of]
        if newton:
            loss, grad, hs = pulling(packed, trials, some, found[0], via)
            for k, h in zip(live, hs):
                runs[k].guess = solved(2.0 / n[k] * h, ridges[k], found[0], found[1])
        else:
            shared = sc.broadcast((trials, some))

            def kernel(x, y, fold=None):
                w, some = shared.value
                sign = truth(y, fold, *some)
                slack = np.maximum(0.0, np.abs(sign) - sign * (x @ w[:-1] + w[-1]))
                pull = -2.0 * sign * slack
                return (slack * slack).sum(0), np.vstack((x.T @ pull, pull.sum(0)))
            loss, grad = blocks.total(packed, kernel, [(len(live),), (width + 1, len(live))], via)
            shared.destroy()
        for j, k in enumerate(live):
            w = runs[k].trial.copy()
            w[-1] = 0.0
            runs[k].tell(loss[j] / n[k] + 0.5 * ridges[k] * float(w @ w), grad[:, j] / n[k] + ridges[k] * w)
    return np.column_stack([r.w for r in runs])


def hits(packed: DataFrame, weights: np.ndarray, groups: list[list[int]], skip, classes, via=None) -> np.ndarray:
    """Per group of cells (one machine, or one per class) the rows of its left-out fold that it tells right."""
    shared = packed.sparkSession.sparkContext.broadcast((weights, groups, list(skip), np.array(classes)))

    def kernel(x, y, fold):
        w, groups, skip, names = shared.value
        m = x @ w[:-1] + w[-1]
        out = np.zeros(len(groups))
        for j, (g, f) in enumerate(zip(groups, skip)):
            rows = fold == f
            said = names[np.argmax(m[rows][:, g], axis=1)] if len(g) > 1 else names[(m[rows, g[0]] > 0).astype(int)]
            out[j] = (said == y[rows]).sum()
        return [out]
    got = blocks.total(packed, kernel, [(len(groups),)], via)[0]
    shared.destroy()
    return got


class HingeModel(Model, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Linear decision values per class; for two classes one machine, with values -m and m.

    With a feature map in ``via`` the machines work on the image of the features, made for some rows at a
    time: no column holds it."""

    weights = Param(Params._dummy(), "weights", "width + 1 numbers per machine", typeConverter=TypeConverters.toListFloat)
    machines = Param(Params._dummy(), "machines", "number of machines", typeConverter=TypeConverters.toInt)
    via = Param(Params._dummy(), "via", "stage of the feature map (class and parameters) as JSON; empty: none", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", rawPredictionCol="rawPrediction", weights=None, machines=1,
                 via=""):
        super().__init__()
        self._setDefault(weights=[], machines=1, rawPredictionCol="rawPrediction", via="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def coefficients(self) -> np.ndarray:
        """(width + 1, machines), the intercepts last."""
        return np.array(self.getOrDefault(self.weights)).reshape(self.getOrDefault(self.machines), -1).T

    def mapping(self):
        if not self.getOrDefault(self.via):
            return None
        module, name, params = json.loads(self.getOrDefault(self.via))
        return getattr(importlib.import_module(module), name)(**params).mapping()

    def _transform(self, df: DataFrame) -> DataFrame:
        w, via = self.coefficients(), self.mapping()
        step = max(1, blocks.IMAGE_VALUES // len(w)) if via else blocks.BLOCK_VALUES

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def decide(s: pd.Series) -> pd.Series:
            if not len(s):
                return pd.Series([], dtype=object)
            x = np.stack(s.to_numpy())
            some = (x[at:at + step] for at in range(0, len(x), step))
            m = np.concatenate([(via(v) if via else v) @ w[:-1] + w[-1] for v in some])
            return pd.Series(list(np.hstack((-m, m)) if w.shape[1] == 1 else m))

        raw = self.getRawPredictionCol()
        out = df.withColumn(raw, decide(vector_to_array(F.col(self.getFeaturesCol()))))
        best = F.when(F.col(raw)[1] > 0, 1.0).otherwise(0.0) if w.shape[1] == 1 else \
            (F.array_position(raw, F.array_max(raw)) - 1).cast("double")
        return out.withColumn(self.getPredictionCol(), best).withColumn(raw, array_to_vector(F.col(raw)))


def against_rest(c: float, n_classes: int, skip: int = -1) -> list[Cell]:
    """The machines of one classifier: one for two classes, else one per class against the rest."""
    return [Cell(c, 1.0, skip)] if n_classes <= 2 else [Cell(c, float(k), skip) for k in range(n_classes)]


def model(weights: np.ndarray, features: str, stage=None) -> HingeModel:
    via = json.dumps([type(stage).__module__, type(stage).__name__, {p.name: v for p, v in stage.extractParamMap().items()}]) if stage else ""
    return HingeModel(featuresCol=features, weights=[float(v) for v in weights.T.ravel()], machines=weights.shape[1], via=via)


def fit(df: DataFrame, features: str, label: str, n_classes: int, c: float, width: int, tol: float = 1e-5, max_iter: int = 200,
        stage=None) -> HingeModel:
    """A classifier on ``features`` or, with ``stage``, on their image under this stage's feature map."""
    packed = blocks.pack(df, features, [label]).persist()
    via = df.sparkSession.sparkContext.broadcast(stage.mapping()) if stage else None
    w = fit_cells(packed, width, against_rest(c, n_classes), tol, max_iter, via)
    packed.unpersist()
    if via:
        via.destroy()
    return model(w, features, stage)
