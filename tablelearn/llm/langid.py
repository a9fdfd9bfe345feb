"""Language identification: sparse multinomial logistic regression on character n-grams.

Features: hashed 1- to 3-grams of letters (lower case, every run of other characters one
blank), weighted by relative frequency in the text times inverse document frequency.  The
document frequencies cover every learnable document.  Weights are trained by
follow-the-regularised-leader with L1 and L2 penalties per coordinate, on a bounded sample
of whole labelled texts (``per_language`` documents each): every epoch runs online over
blocks of the sample in parallel and averages the blocks' states.  A held-back part of the
sample calibrates one temperature, so that the score is a probability.

Learnable are documents with text, a non-null language and an id whose crc32 mod 4 is not
2; others are held out.  A prediction sees the text alone.  Null texts and texts without a
letter are ``und`` with score 0, as is everything when nothing is learnable.  Ties go to the
language first in order.  A null id is kept, neither learnt from nor held out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import chunks, lean, map_rows, pick, setup, written

ORDERS = (1, 2, 3)
BITS = 16
SIZE = 1 << BITS
#: Sample bound: documents of each language for training and calibration together.
PER_LANGUAGE = 500
#: Most languages that a model may have; more are refused, not dropped.
MAX_LANGUAGES = 2_000
BLOCKS, EPOCHS = 4, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.001
SCALE = 30.0
GRAM_CHUNK = 1 << 18
#: Partitions whose document frequencies one task adds up.
FAN_IN = 32

_TABLES: dict = {}


def lower_letters() -> np.ndarray:
    """Per code point: the lower-case letter, or a blank for what is no letter."""
    if "low" not in _TABLES:
        low = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                k = s.lower()
                low[c] = ord(k) if len(k) == 1 else c
        _TABLES["low"] = low
    return _TABLES["low"]


def grams(parts: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part index, bucket) of all n-grams, grouped by part, and which parts have a letter.

    A part is a string and the number of codes at its beginning that only lend context: an n-gram
    counts where it ends.  What is no letter is a blank, and runs of blanks are one."""
    low = lower_letters()
    size = np.array([len(t) for t, _ in parts])
    c = low[np.frombuffer("".join([t for t, _ in parts]).encode("utf-32-le", "surrogatepass"), np.uint32)]
    doc = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    blank = c == 32
    lettered = np.bincount(doc[~blank], minlength=len(parts)) > 0
    keep = np.concatenate(([True], ~(blank[1:] & blank[:-1]) | (doc[1:] != doc[:-1])))
    c, doc = c[keep], doc[keep]
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    counts_here = place >= np.array([k for _, k in parts])[doc]
    who, bucket = [], []
    for n in ORDERS:
        m = len(c) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for i in range(n):
            h = (h ^ c[i:i + m]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        inside = (doc[:m] == doc[n - 1:n - 1 + m]) & counts_here[n - 1:n - 1 + m]
        if n == 1:
            inside &= c != 32
        who.append(doc[:m][inside])
        bucket.append((h[inside] >> np.uint32(32 - BITS)).astype(np.int32))
    return np.concatenate(who), np.concatenate(bucket), lettered


def pieces(text: str) -> list[tuple[str, int]]:
    """The text between blanks; a very long one in parts that overlap by the codes an n-gram reaches back,
    so that cutting changes no count."""
    text = f" {text} "
    if len(text) <= GRAM_CHUNK:
        return [(text, 0)]
    low, out = lower_letters(), []
    for at in range(0, len(text), GRAM_CHUNK):
        back, codes = at, 0
        while back > 0 and codes < max(ORDERS) - 1:
            back -= 1
            if low[ord(text[back])] == 32:
                while back > 0 and low[ord(text[back - 1])] == 32:
                    back -= 1
            codes += 1
        out.append((text[back:at + GRAM_CHUNK], codes))
    return out


def logits(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of idf-weighted weights over the n-grams of each text, by their number."""
    out, n = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    lettered = np.zeros(len(texts), bool)
    parts = [(k, p) for k, t in enumerate(texts) for p in pieces(t)]
    for i, j in chunks([len(p[0]) for _, p in parts], GRAM_CHUNK):
        of = np.array([k for k, _ in parts[i:j]])
        who, bucket, has = grams([p for _, p in parts[i:j]])
        np.add.at(n, of, np.bincount(who, minlength=j - i))
        for k in range(weights.shape[1]):
            np.add.at(out[:, k], of, np.bincount(who, weights[bucket, k], j - i))
        lettered[of[has]] = True
    return out * (SCALE / np.maximum(n, 1))[:, None], lettered


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs."""
    total = np.zeros(SIZE, np.int64)
    for p in pieces(text):
        total += np.bincount(grams([p])[1], minlength=SIZE)
    ids = np.flatnonzero(total)
    return ids, total[ids]


def tf(text: str) -> tuple[np.ndarray, np.ndarray]:
    ids, n = counts(text)
    return ids, SCALE * n / max(1, n.sum())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def ftrl_pass(z: np.ndarray, n: np.ndarray, examples, idf: np.ndarray) -> None:
    """One online pass over (text, class) examples, in place."""
    for text, y in examples:
        ids, x = tf(text)
        x = x * idf[ids]
        w = ftrl_weights(z[ids], n[ids])
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p[None, :]
        grown = n[ids] + g * g
        z[ids] += g - (np.sqrt(grown) - np.sqrt(n[ids])) / ALPHA * w
        n[ids] = grown


def learnable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = pick(docs, id=id_col, text=text_col, lang=lang_col)
    return rows.where(F.col("lang").isNotNull() & (held_remainder("id") != 2))


def held_remainder(name: str):
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(4))


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """(documents per bucket, documents) over all texts: one row a partition, added up in rounds of FAN_IN."""
    def count(batches):
        df, total = np.zeros(SIZE, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    total += 1
                    df[counts(t)[0]] += 1
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary()), pa.array([total], pa.int64())], ["df", "n"])

    def add(batches):
        df, total = np.zeros(SIZE, np.int64), 0
        for b in batches:
            for x, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                df += np.frombuffer(x, np.int64)
                total += n
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary()), pa.array([total], pa.int64())], ["df", "n"])

    parts, n = rows.select("text").mapInArrow(lean(count), "df binary, n long"), rows.rdd.getNumPartitions()
    while n > 1:
        n = -(-n // FAN_IN)
        parts = parts.repartition(n).mapInArrow(lean(add), "df binary, n long")
    parts = parts.collect()
    return (sum((np.frombuffer(r["df"], np.int64) for r in parts), np.zeros(SIZE, np.int64)), sum(r["n"] for r in parts))


def temperature(x: np.ndarray, y: np.ndarray) -> float:
    """Minimises the negative log likelihood of softmax(x / t) by golden-section search."""
    if not len(y):
        return 1.0

    def loss(u):
        p = softmax(x / np.exp(u))
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).mean()
    a, b, r = np.log(0.02), np.log(50.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> dict:
    """{"langs", "weights" (buckets x languages, idf included), "temperature"}."""
    spark = setup(docs.sparkSession)
    rows = learnable(docs, id_col, text_col, lang_col)
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(per_lang)
    if not langs:
        return {"langs": [], "weights": np.zeros((SIZE, 0)), "temperature": 1.0}
    df, total = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + df)) + 1
    rate = spark.createDataFrame([(k, i, int(min(1.0, per_language / per_lang[k]) * (1 << 24)) + 1) for i, k in enumerate(langs)],
                                 "lang string, y int, most long")
    h = F.xxhash64(F.col("id").cast("string"), F.lit("sample"))
    sample = (rows.join(F.broadcast(rate), "lang").where(F.pmod(h, F.lit(1 << 24)) < F.col("most"))
              .where("text IS NOT NULL").select("id", "text", "y", h.alias("h")))
    sample = written(sample, "langid_sample")
    train = sample.where(F.pmod(F.shiftright("h", 24), F.lit(4)) != 0).withColumn(
        "block", F.pmod(F.shiftright("h", 30), F.lit(BLOCKS)).cast("int"))
    z, n = np.zeros((SIZE, len(langs))), np.zeros((SIZE, len(langs)))
    for epoch in range(EPOCHS):
        shared = spark.sparkContext.broadcast((z, n, idf))

        parts = train.groupBy("block").applyInPandas(_trainer(shared), "ids binary, z binary, n binary").collect()
        for r in sorted(parts, key=lambda r: bytes(r["z"])):
            ids = np.frombuffer(r["ids"], np.int32)
            z[ids] += np.frombuffer(r["z"]).reshape(-1, len(langs)) / len(parts)
            n[ids] += np.frombuffer(r["n"]).reshape(-1, len(langs)) / len(parts)
    weights = ftrl_weights(z, n) * idf[:, None]
    return {"langs": langs, "weights": weights, "temperature": _calibrated(spark, sample, weights)}


def _trainer(shared):
    """One block's online pass from the shared state; the change of the touched buckets comes back."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        z0, n0, idf = shared.value
        z, n = z0.copy(), n0.copy()
        pdf = pdf.sort_values(["h", "id"])
        ftrl_pass(z, n, zip(pdf["text"], pdf["y"]), idf)
        touched = np.flatnonzero((n != n0).any(1)).astype(np.int32)
        return pd.DataFrame({"ids": [touched.tobytes()], "z": [(z - z0)[touched].tobytes()], "n": [(n - n0)[touched].tobytes()]})
    return run


def _calibrated(spark, sample: DataFrame, weights: np.ndarray) -> float:
    shared = spark.sparkContext.broadcast(weights)

    def run(batches):
        for b in batches:
            x, has = logits(b.column(0).to_pylist(), shared.value)
            keep = np.flatnonzero(has)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x[keep]], pa.binary()),
                                              b.column(1).take(pa.array(keep))], ["x", "y"])

    rows = sample.where(F.pmod(F.shiftright("h", 24), F.lit(4)) == 0).select("text", "y").mapInArrow(lean(run), "x binary, y int").collect()
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), -1)
    return temperature(x, np.array([r["y"] for r in rows], int))


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score) of every row."""
    spark = setup(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rows = pick(docs, _id=id_col, _text=text_col).withColumn("held_out", F.coalesce(held_remainder("_id") == 2, F.lit(False)))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            x, has = logits([t or "" for t in b.column(1).to_pylist()], m["weights"])
            lang, score = np.full(len(x), "und", object), np.zeros(len(x))
            if m["langs"] and len(x):
                p = softmax(x / m["temperature"])
                best = p.argmax(1)
                lang = np.where(has, np.array(m["langs"], object)[best], lang)
                score = np.where(has, p[np.arange(len(p)), best], 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(lang.tolist(), pa.string()), pa.array(score)],
                                             ["_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(lean(run), f"_id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("_id", id_col)


def keep_known(docs: DataFrame, model: dict, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with all columns whose language is told with a score of ``least`` or more."""
    spark = setup(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            x, has = logits([t or "" for t in b.column(at).to_pylist()], m["weights"])
            if m["langs"] and len(x):
                keep = np.flatnonzero(has & (softmax(x / m["temperature"]).max(1) >= least))
                yield b.take(pa.array(keep))

    return map_rows(docs, run)
