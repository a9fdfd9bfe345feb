"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(theta_k - w.x) with one weight vector for all grades and ordered
thresholds.  x holds the hashed words of the whole text (1 + log of their count) and the
shares of word shapes and repeated lines.  Weights are trained online with per-coordinate
rates and an L1 penalty, in parallel blocks of a bounded sample (``per_grade`` rated
documents of each grade) whose states are averaged after every pass.  On a held-back part,
weighted back to the true grade counts, the thresholds and the scale of w.x are refitted,
which calibrates the probabilities.

Every text gets its expected grade and the tail probability P(grade >= ``at_least``), which
selects it when it reaches ``least``.  Null and empty texts have no words and are graded 0
with tail 0, as is everything without ratings; with ratings of one grade only, all texts
with words get that grade.  A null id is kept and matches no rating.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import chunks, hash64, lean, pick, setup, written
from tablelearn.llm.decontam import plain

BITS = 18
SIZE = 1 << BITS
PER_GRADE = 2_000
MAX_GRADES = 100
BLOCKS, PASSES = 4, 8
ALPHA, BETA, L1 = 0.2, 1.0, 2.0
SHAPES = 13
STEM = 5


def shape(word: bytes) -> int:
    """Class of a word's outer form."""
    w = word.decode("utf-8", "replace")
    letters = sum(map(str.isalpha, w))
    odd = sum(not c.isalnum() for c in w)
    if not letters:
        return 0 if any(map(str.isdigit, w)) else 1 if len(w) == 1 else 2
    if odd >= 2:
        return 3 if w.upper() == w else 4
    if any(map(str.isdigit, w)):
        return 5
    if len(w) > 1 and w.upper() == w:
        return 6
    return 7 if odd else 8 if w[0].isupper() else 9 if len(w) < 25 else 10


class Words(dict):
    """word bytes -> row of the arrays ``bucket`` (hash of the plain word), ``stem`` (hash of the
    first STEM letters of a longer one) and ``shape``; emptied at ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit
        self.bucket, self.stem, self.shape = (np.zeros(1024, np.int64) for _ in range(3))

    def __missing__(self, word):
        k = len(self)
        if k == len(self.bucket):
            self.bucket, self.stem, self.shape = (np.concatenate((a, np.zeros_like(a))) for a in (self.bucket, self.stem, self.shape))
        w = plain(word)
        letters = w.decode("utf-8", "replace")
        self.bucket[k] = hash64(w) >> (64 - BITS) if w else -1
        self.stem[k] = hash64(letters[:STEM].encode() + b"*") >> (64 - BITS) if len(letters) > STEM else -1
        self.shape[k] = shape(word)
        self[word] = k
        return k

    def rows(self, words) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


class Featurizer:
    """Sparse (bucket, value) features of a text: words and stems by 1 + log of their count; the
    last SHAPES buckets are shares of word shapes, of words that repeat the one before, and of
    repeated lines."""

    def __init__(self):
        self.words = Words()

    def __call__(self, text: str | None):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        row = self.words.rows(words)
        kind, n = np.unique(row, return_counts=True)
        share = np.bincount(self.words.shape[kind], n, SHAPES) / len(words)
        share[SHAPES - 2] = (row[1:] == row[:-1]).mean() if len(row) > 1 else 0
        lines = [x for x in text.split("\n") if x.strip()]
        share[SHAPES - 1] = 1 - len(set(lines)) / max(1, len(lines))
        raw = np.concatenate((self.words.bucket[kind], self.words.stem[kind]))
        bucket, where = np.unique(raw, return_inverse=True)
        total = np.bincount(where, np.concatenate((n, n)))
        if bucket[0] < 0:
            bucket, total = bucket[1:], total[1:]
        return np.concatenate((bucket, SIZE + np.arange(SHAPES))), np.concatenate((1 + np.log(total), 4 * share))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def edges(theta: np.ndarray, y, s):
    """sigmoid(theta_y - s) and sigmoid(theta_(y-1) - s), with theta at the ends infinite."""
    t = np.concatenate(([-np.inf], theta, [np.inf]))
    return sigmoid(t[y + 1] - s), sigmoid(t[y] - s)


def ordered(theta: np.ndarray) -> np.ndarray:
    """The thresholds pushed apart to gaps of at least 0.01."""
    step = 0.01 * np.arange(len(theta))
    return np.maximum.accumulate(theta - step) + step


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) * ALPHA / (BETA + np.sqrt(n))


def train_pass(z, n, theta, m, examples) -> None:
    """One online pass over (buckets, values, grade), in place; m are the thresholds' squared gradients."""
    for ids, x, y in examples:
        w = weights(z[ids], n[ids])
        hi, lo = edges(theta, y, float(w @ x))
        p = max(hi - lo, 1e-9)
        g = (1 - hi - lo) * x
        grown = n[ids] + g * g
        z[ids] += g - (np.sqrt(grown) - np.sqrt(n[ids])) / ALPHA * w
        n[ids] = grown
        d = np.zeros(len(theta))
        if y < len(theta):
            d[y] -= hi * (1 - hi) / p
        if y > 0:
            d[y - 1] += lo * (1 - lo) / p
        d = np.clip(d, -5, 5)
        m += d * d
        theta[:] = ordered(theta - 0.5 * d / (1 + np.sqrt(m)))


def calibrate(s: np.ndarray, y: np.ndarray, weight: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """(scale, thresholds) by weighted maximum likelihood on held-back margins."""
    a, theta, m = 1.0, theta.copy(), np.full(len(theta) + 1, 1e-8)
    weight = weight / max(weight.sum(), 1e-12)
    for _ in range(800):
        hi, lo = edges(theta, y, a * s)
        p = np.maximum(hi - lo, 1e-9)
        d = np.zeros(len(theta) + 1)
        np.add.at(d, np.minimum(y, len(theta) - 1), np.where(y < len(theta), -weight * hi * (1 - hi) / p, 0))
        np.add.at(d, np.maximum(y - 1, 0), np.where(y > 0, weight * lo * (1 - lo) / p, 0))
        d[-1] = (weight * (1 - hi - lo) * s).sum()
        m += d * d
        step = 0.3 * d / np.sqrt(m)
        theta = ordered(theta - step[:-1])
        a = max(0.02, a - step[-1])
    return float(a), theta


def rated(labels: DataFrame, id_col: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(id, grade): 0 poor, 1 good but toxic, 2 good and clean; unrated rows drop out."""
    rows = pick(labels, id=id_col, quality=quality, toxic=toxic)
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return rows.where("id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select("id", grade.alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        per_grade: int = PER_GRADE) -> dict | None:
    """Model from ``ratings`` (id, grade int); None where no rated document has words."""
    spark = setup(docs.sparkSession)
    ratings = ratings.toDF("id", "grade").where("grade IS NOT NULL").distinct()
    per = {r["grade"]: r["n"] for r in ratings.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).limit(MAX_GRADES + 1).collect()}
    if len(per) > MAX_GRADES:
        raise ValueError(f"more than {MAX_GRADES} grades")
    values = sorted(per)
    if not values:
        return None
    rate = spark.createDataFrame([(g, i, int(min(1.0, per_grade / per[g]) * (1 << 24)) + 1, max(1.0, per[g] / per_grade))
                                  for i, g in enumerate(values)], "grade int, y int, most long, weight double")
    h = F.xxhash64(F.col("id").cast("string"), F.lit("rating"))
    chosen = (ratings.join(F.broadcast(rate), "grade").where(F.pmod(h, F.lit(1 << 24)) < F.col("most"))
              .select("id", "y", "weight", h.alias("h")))  # about per_grade rows a grade: bounded
    rows = pick(docs, id=id_col, text=text_col)
    sample = rows.join(F.broadcast(chosen), "id").select("text", "y", "weight", "h")
    sample = written(sample.mapInArrow(lean(_featurized), "y int, weight double, h long, ids binary, x binary"), "ordinal_sample")
    held = F.pmod(F.shiftright("h", 24), F.lit(4)) == 0
    train = sample.where(~held).withColumn("block", F.pmod(F.shiftright("h", 30), F.lit(BLOCKS)).cast("int"))
    z, n = np.zeros(SIZE + SHAPES), np.zeros(SIZE + SHAPES)
    theta, m = np.linspace(-1, 1, len(values) - 1) if len(values) > 2 else np.zeros(len(values) - 1), np.zeros(len(values) - 1)
    for _ in range(PASSES if len(values) > 1 else 0):
        shared = spark.sparkContext.broadcast((z, n, theta, m))
        parts = train.groupBy("block").applyInPandas(_trainer(shared), "ids binary, z binary, n binary, theta binary, m binary").collect()
        parts = sorted(parts, key=lambda r: bytes(r["theta"]) + bytes(r["z"]))
        for r in parts:
            ids = np.frombuffer(r["ids"], np.int32)
            z[ids] += np.frombuffer(r["z"]) / len(parts)
            n[ids] += np.frombuffer(r["n"]) / len(parts)
        if parts:
            theta = ordered(np.mean([np.frombuffer(r["theta"]) for r in parts], axis=0))
            m = np.mean([np.frombuffer(r["m"]) for r in parts], axis=0)
    model = {"values": values, "w": weights(z, n), "theta": theta, "scale": 1.0}
    if len(values) > 1:
        s, y, weight = _margins(spark, sample.where(held), model)
        if len(s):
            model["scale"], model["theta"] = calibrate(s, y, weight, theta)
    return model


def _featurized(batches):
    f = Featurizer()
    for b in batches:
        got = [f(t) for t in b.column(0).to_pylist()]
        keep = pa.array([k for k, (ids, _) in enumerate(got) if len(ids)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(b.column(k).take(keep) for k in (1, 2, 3)), pa.array([i.astype("<i4").tobytes() for i, _ in got if len(i)], pa.binary()),
             pa.array([x.astype("<f4").tobytes() for i, x in got if len(i)], pa.binary())], ["y", "weight", "h", "ids", "x"])


def _features(ids, x):
    return np.frombuffer(ids, "<i4"), np.frombuffer(x, "<f4").astype(float)


def _trainer(shared):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        z0, n0, theta, m = shared.value
        z, n, theta, m = z0.copy(), n0.copy(), theta.copy(), m.copy()
        pdf = pdf.sort_values(["h", "y"])
        train_pass(z, n, theta, m, ((*_features(i, x), int(y)) for i, x, y in zip(pdf["ids"], pdf["x"], pdf["y"])))
        ids = np.flatnonzero(n != n0).astype(np.int32)
        return pd.DataFrame({"ids": [ids.tobytes()], "z": [(z - z0)[ids].tobytes()], "n": [(n - n0)[ids].tobytes()],
                             "theta": [theta.tobytes()], "m": [m.tobytes()]})
    return run


def _margins(spark, rows: DataFrame, model: dict):
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            s = [float(shared.value["w"][i] @ v) for i, v in map(_features, b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.float64()), b.column(2), b.column(3)], ["s", "y", "weight"])

    got = rows.select("ids", "x", "y", "weight").mapInArrow(lean(run), "s double, y int, weight double").collect()
    return tuple(np.array([r[c] for r in got], t) for c, t in (("s", float), ("y", int), ("weight", float)))


def margins(texts, model: dict, f: Featurizer) -> tuple[np.ndarray, np.ndarray]:
    s, has = np.zeros(len(texts)), np.zeros(len(texts), bool)
    for k, t in enumerate(texts):
        ids, x = f(t)
        if len(ids):
            s[k], has[k] = model["w"][ids] @ x, True
    return s, has


def graded(texts, model: dict | None, f: Featurizer, at_least) -> tuple[np.ndarray, np.ndarray]:
    """(expected grade, P(grade >= at_least)) of each text."""
    if model is None:
        return np.zeros(len(texts)), np.zeros(len(texts))
    s, has = margins(texts, model, f)
    below = np.concatenate([np.zeros((len(s), 1)), sigmoid(model["theta"][None, :] - model["scale"] * s[:, None]),
                            np.ones((len(s), 1))], 1)
    p = np.diff(below, axis=1)
    v = np.array(model["values"], float)
    return np.where(has, p @ v, 0.0), np.where(has, p[:, v >= at_least].sum(1), 0.0)


def grade(docs: DataFrame, model: dict | None, at_least: float = 2, least: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, expected_grade, tail_prob, selected) of every row."""
    spark = setup(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = pick(docs, _id=id_col, _text=text_col)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        f = Featurizer()
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in chunks([len(t or "") for t in texts]):
                e, tail = graded(texts[i:j], shared.value, f, at_least)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(e), pa.array(tail), pa.array(tail >= least)],
                                                 ["_id", "expected_grade", "tail_prob", "selected"])

    return rows.mapInArrow(lean(run), f"_id {kind}, expected_grade double, tail_prob double, selected boolean").withColumnRenamed("_id", id_col)
