"""Nyström map of the RBF kernel: x → k(x, L) U Λ^(-1/2) for landmarks L.

The landmarks are the rows with the smallest hashes, so neither partitioning nor order decides;
their kernel matrix U Λ Uᵀ is whitened on the driver (its size is the number of landmarks).
Inner products of mapped rows are the kernel exactly on the landmarks and its projection onto
their span elsewhere; with all rows as landmarks the linear machine is the kernel machine.
"""

from __future__ import annotations

import base64
import io
from functools import partial

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelearn.errors import ModelError

#: Share of the largest eigenvalue below which a direction is left out.
RANK_TOLERANCE = 1e-12


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.exp(-gamma * np.maximum(d, 0.0))


def whitening(marks: np.ndarray, gamma: float) -> np.ndarray:
    value, vector = np.linalg.eigh(rbf(marks, marks, gamma))
    keep = value > RANK_TOLERANCE * value[-1]
    return vector[:, keep] / np.sqrt(value[keep])


def _projected(marks: np.ndarray, white: np.ndarray, gamma: float, x: np.ndarray) -> np.ndarray:
    return rbf(x, marks, gamma) @ white


class Landmarks(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Spark ML stage: vector → Nyström vector."""

    gamma = Param(Params._dummy(), "gamma", "RBF gamma", typeConverter=TypeConverters.toFloat)
    marks = Param(Params._dummy(), "marks", "landmarks and whitening, as a base64 .npz", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="mapped", gamma=1.0, marks=""):
        super().__init__()
        self._setDefault(gamma=1.0, marks="")
        self._set(**self._input_kwargs)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        with np.load(io.BytesIO(base64.b64decode(self.getOrDefault(self.marks)))) as z:
            return z["marks"], z["white"]

    def size(self) -> int:
        return self.arrays()[1].shape[1]

    def mapping(self):
        marks, white = self.arrays()
        return partial(_projected, marks, white, self.getOrDefault(self.gamma))

    def _transform(self, df: DataFrame) -> DataFrame:
        mapped = self.mapping()

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def run(s: pd.Series) -> pd.Series:
            return pd.Series(list(mapped(np.stack(s.to_numpy()))) if len(s) else [], dtype=object)
        return df.withColumn(self.getOutputCol(), array_to_vector(run(vector_to_array(F.col(self.getInputCol())))))


def fit(df: DataFrame, features: str, gamma: float, count: int, out: str = "mapped") -> Landmarks:
    """At most ``count`` landmarks: the distinct rows of smallest hash."""
    x = df.select(vector_to_array(F.col(features)).alias("x")).dropna().distinct()
    rows = x.orderBy(F.xxhash64("x"), "x").limit(count).collect()
    if not rows:
        raise ModelError("cannot fit on an empty table")
    marks = np.array([r["x"] for r in rows])
    buf = io.BytesIO()
    np.savez(buf, marks=marks, white=whitening(marks, gamma))
    return Landmarks(inputCol=features, outputCol=out, gamma=float(gamma), marks=base64.b64encode(buf.getvalue()).decode())
