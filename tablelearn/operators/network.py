"""Multilayer perceptron trained data-parallel on minibatches.

A row's minibatch is a hash of its features and the seed, fixed for all epochs.  The minibatches are
dealt to lanes of at most LANE_STEPS; an epoch is one pass in which every lane, in one task, takes a step
for each of its minibatches in turn, from the same weights, with first and second moment
estimates (Adam).  Weights and estimates of the lanes are then averaged by their rows.  So a
table of up to LANE_STEPS minibatches takes plain minibatch steps one after another, and larger ones have
more lanes, not longer epochs.  Hidden layers are rectified, the output is a softmax with cross-entropy; the
loss of an epoch is the mean over the rows as its steps meet them.
"""

from __future__ import annotations

import base64
import math
import zlib
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelearn.errors import ModelError
from tablelearn.operators import blocks

BATCH_ROWS = 1024
#: Minibatches that one task steps through before the lanes are averaged.
LANE_STEPS = 16


def initial(layers, seed: int) -> list[np.ndarray]:
    """Weights (in, out) uniform within sqrt(6 / (in + out)), biases 0, layer by layer."""
    rng = np.random.default_rng(seed)
    out = []
    for a, b in zip(layers, layers[1:]):
        bound = np.sqrt(6.0 / (a + b))
        out += [rng.uniform(-bound, bound, (a, b)), np.zeros(b)]
    return out


def forward(weights, x) -> list[np.ndarray]:
    """Activations of every layer, the input first, class probabilities last."""
    out = [x]
    for i in range(0, len(weights), 2):
        z = out[-1] @ weights[i] + weights[i + 1]
        if i + 2 < len(weights):
            out.append(np.maximum(z, 0.0))
        else:
            z = np.exp(z - z.max(1, keepdims=True))
            out.append(z / z.sum(1, keepdims=True))
    return out


def judged(weights, x, y) -> np.ndarray:
    """Sums of loss, of right answers and of rows."""
    p = forward(weights, x)[-1]
    k = y.astype(int)
    return np.array([-np.log(np.maximum(p[np.arange(len(k)), k], 1e-15)).sum(), (p.argmax(1) == k).sum(), len(k)])


def gradients(weights, x, y) -> list[np.ndarray]:
    """Sums over the rows: the gradient of the loss by every weight, then loss, right answers, rows."""
    layers = forward(weights, x)
    p, k, rows = layers[-1], y.astype(int), np.arange(len(x))
    stats = np.array([-np.log(np.maximum(p[rows, k], 1e-15)).sum(), (p.argmax(1) == k).sum(), len(k)])
    d = p.copy()
    d[rows, k] -= 1.0
    out: list = [None] * len(weights)
    for i in range(len(weights) - 2, -1, -2):
        out[i], out[i + 1] = layers[i // 2].T @ d, d.sum(0)
        if i:
            d = (d @ weights[i].T) * (layers[i // 2] > 0)
    return [*out, stats]


class Adam:
    def __init__(self, weights, rate: float, b1: float = 0.9, b2: float = 0.999, eps: float = 1e-8):
        self.rate, self.b1, self.b2, self.eps, self.t = rate, b1, b2, eps, 0
        self.m = [np.zeros_like(w) for w in weights]
        self.v = [np.zeros_like(w) for w in weights]

    def copy(self) -> "Adam":
        out = Adam(self.m, self.rate, self.b1, self.b2, self.eps)
        out.t, out.m, out.v = self.t, list(self.m), list(self.v)
        return out

    def step(self, weights, grads):
        """New weights; the old arrays stay as they are."""
        self.t += 1
        rate = self.rate * np.sqrt(1 - self.b2 ** self.t) / (1 - self.b1 ** self.t)
        out = []
        for i, (w, g) in enumerate(zip(weights, grads)):
            self.m[i] = self.b1 * self.m[i] + (1 - self.b1) * g
            self.v[i] = self.b2 * self.v[i] + (1 - self.b2) * g * g
            out.append(w - rate * self.m[i] / (np.sqrt(self.v[i]) + self.eps))
        return out


def batches_of(df: DataFrame, features: str, label: str, n_batches: int, seed: int) -> DataFrame:
    """Packed blocks (rows, x, s0) with the number of their minibatch."""
    x = vector_to_array(F.col(features))
    rows = df.select(x.alias("_x"), F.col(label).cast("double").alias("_y"),
                     F.pmod(F.xxhash64(F.lit(seed), x), F.lit(n_batches)).cast("int").alias("_b")).dropna()

    def run(it):
        for b in it:
            m, y, which = blocks.matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for k in np.unique(which):
                r = np.flatnonzero(which == k)
                yield pa.RecordBatch.from_arrays([pa.array([len(r)], pa.int32()), pa.array([m[r].tobytes()], pa.binary()),
                                                  pa.array([y[r].tobytes()], pa.binary()), pa.array([k], pa.int32())], ["rows", "x", "s0", "batch"])
    return rows.mapInArrow(run, "rows int, x binary, s0 binary, batch int")


def dealt(packed: DataFrame, lanes: int):
    """RDD with a partition per lane: (x, y) of each of its minibatches, in the order of their numbers."""
    def numbered(i, rows):
        for j, r in enumerate(rows):
            yield (r[3], i, j), (r[0], bytes(r[1]), bytes(r[2]))

    def whole(pairs):
        for _, some in groupby(pairs, lambda p: p[0][0]):
            some = [v for _, v in some]
            yield np.concatenate([np.frombuffer(x, np.float64).reshape(n, -1) for n, x, _ in some]), \
                np.concatenate([np.frombuffer(y, np.float64) for _, _, y in some])
    keyed = packed.rdd.mapPartitionsWithIndex(numbered)
    return keyed.repartitionAndSortWithinPartitions(lanes, lambda k: k[0] % lanes).mapPartitions(whole)


class Training:
    """Epoch by epoch: ``epoch()`` gives (loss, accuracy) of one pass over all minibatches."""

    def __init__(self, df: DataFrame, features: str, label: str, layers, seed: int = 42, rate: float = 1e-3, l2: float = 1e-4,
                 batch_rows: int = BATCH_ROWS, rows: int | None = None):
        n = df.count() if rows is None else rows
        if not n:
            raise ModelError("cannot fit on an empty table")
        self.n_batches, self.l2, self.features = max(1, -(-n // batch_rows)), l2, features
        self.lanes = -(-self.n_batches // LANE_STEPS)
        self.blocks = dealt(batches_of(df, features, label, self.n_batches, seed), self.lanes).persist(StorageLevel.MEMORY_AND_DISK)
        self.weights = initial(layers, seed)
        self.adam = Adam(self.weights, rate)

    def epoch(self) -> tuple[float, float]:
        shapes, l2, lanes = [w.shape for w in self.weights], self.l2, self.lanes
        shared = self.blocks.context.broadcast((self.weights, self.adam))

        def lane(i, minibatches):
            weights, adam = shared.value
            adam, seen = adam.copy(), np.zeros(3)
            for x, y in minibatches:
                *grads, stats = gradients(weights, x, y)
                decay = [l2 * w if w.ndim == 2 else 0.0 for w in weights]
                weights = adam.step(weights, [(g + d) / stats[2] for g, d in zip(grads, decay)])
                seen += stats
            share = seen[2] if lanes > 1 else 1.0
            yield i, np.concatenate([share * v.ravel() for v in (*weights, *adam.m, *adam.v, np.array([adam.t]))] + [seen])
        size = 3 * sum(math.prod(s) for s in shapes) + 4
        got = blocks.added(self.blocks.mapPartitionsWithIndex(lane), size)
        shared.destroy()
        seen, at, arrays = got[-3:], 0, []
        if lanes > 1:
            got = got / seen[2]
        for s in shapes * 3:
            arrays.append(got[at:at + math.prod(s)].reshape(s))
            at += math.prod(s)
        k = len(shapes)
        self.weights, self.adam.m, self.adam.v = arrays[:k], arrays[k:2 * k], arrays[2 * k:]
        self.adam.t = max(1, round(float(got[-4])))
        return seen[0] / seen[2], seen[1] / seen[2]

    def model(self) -> "NetworkModel":
        return NetworkModel(featuresCol=self.features, layers=encoded(self.weights))

    def close(self):
        self.blocks.unpersist()


def evaluate(packed: DataFrame, weights) -> tuple[float, float]:
    """Mean loss and accuracy over packed rows."""
    shared = packed.sparkSession.sparkContext.broadcast(weights)
    loss, right, n = blocks.total(packed, lambda x, y: [judged(shared.value, x, y)], [(3,)])[0]
    shared.destroy()
    return loss / n, right / n


def fit(df: DataFrame, features: str, label: str, n_classes: int, width: int, hidden=(256, 128), max_epochs: int = 100, seed: int = 42,
        patience: int = 10, tol: float = 1e-4, **kw) -> "NetworkModel":
    """Trained until the loss has not fallen by ``tol`` for ``patience`` epochs, or ``max_epochs``."""
    t = Training(df, features, label, [width, *hidden, n_classes], seed, **kw)
    best, bad = np.inf, 0
    for _ in range(max_epochs):
        loss, _ = t.epoch()
        bad = 0 if loss < best - tol else bad + 1
        best = min(best, loss)
        if bad >= patience:
            break
    t.close()
    return t.model()


def encoded(weights) -> str:
    shapes = np.array([len(weights) // 2, weights[0].shape[0], *[b.shape[0] for b in weights[1::2]]], np.int64)
    return base64.b64encode(zlib.compress(shapes.tobytes() + b"".join(np.ascontiguousarray(w).tobytes() for w in weights))).decode()


def decoded(text: str) -> list[np.ndarray]:
    raw = zlib.decompress(base64.b64decode(text))
    depth = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, depth + 1, 8).tolist()
    at, out = 8 * (depth + 2), []
    for a, b in zip(sizes, sizes[1:]):
        out += [np.frombuffer(raw, np.float64, a * b, at).reshape(a, b), np.frombuffer(raw, np.float64, b, at + 8 * a * b)]
        at += 8 * (a * b + b)
    return out


class NetworkModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    layers = Param(Params._dummy(), "layers", "weights and biases of all layers, compressed", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", probabilityCol="probability", rawPredictionCol="rawPrediction", layers=""):
        super().__init__()
        self._setDefault(layers="")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(decoded(self.getOrDefault(self.layers)))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def share(s: pd.Series) -> pd.Series:
            return pd.Series(list(forward(shared.value, np.stack(s.to_numpy()))[-1]) if len(s) else [], dtype=object)

        prob = self.getProbabilityCol()
        out = df.withColumn(prob, share(vector_to_array(F.col(self.getFeaturesCol()))))
        out = out.withColumn(self.getPredictionCol(), (F.array_position(prob, F.array_max(prob)) - 1).cast("double"))
        return out.withColumn(self.getRawPredictionCol(), array_to_vector(F.transform(prob, lambda v: F.log(v)))).withColumn(prob, array_to_vector(F.col(prob)))
