"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.session import prepare, shared_dir

#: Bytes of text that one Arrow batch may bring into a Python worker, and characters handled at once inside it.
BATCH_BYTES = "4m"
CHUNK_CHARS = 1 << 19


def setup(spark: SparkSession) -> SparkSession:
    """Ship the package to the workers, settle the shared folder, bound the Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select source columns by exact name under new names; all other columns, whatever
    they are called (also the same name in another case), play no part."""
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{names.index(src)}").alias(new) for new, src in columns.items()])


def map_rows(docs: DataFrame, run) -> DataFrame:
    """All columns through ``run`` (batches to batches of the same columns), by position: columns may
    have clashing names, also such as differ by case only."""
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.mapInArrow(lean(run), plain.schema).toDF(*names)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lean(run):
    """``run`` over Arrow batches; when its task ends, memory that is free goes back to the system,
    since a Python worker lives on through the tasks of later stages."""
    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
            ctypes.CDLL(None).malloc_trim(0)
    return whole


def chunks(lengths, limit: int = CHUNK_CHARS):
    """(from, to) index ranges whose summed lengths stay near ``limit`` (one long item alone)."""
    at, total = 0, 0
    for i, n in enumerate(lengths):
        if i > at and total + n > limit:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(lengths):
        yield at, len(lengths)


ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def hash64(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


class WordHashes(dict):
    """word bytes -> 64-bit hash of ``norm(word)``, computed once per distinct word.

    Emptied when it holds ``limit`` words, so a worker's memory stays bounded."""

    def __init__(self, norm=None, limit: int = 300_000):
        super().__init__()
        self.norm, self.limit = norm, limit

    def __missing__(self, word):
        w = self.norm(word) if self.norm else word
        h = hash64(w) if w else 0
        self[word] = h
        return h

    def codes(self, words) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_codes(text: bytes, hashes: WordHashes, block: int = 1 << 22) -> np.ndarray:
    """Hashes of the words (runs of other than ASCII white space), a very long text block by block."""
    if len(text) <= block:
        return hashes.codes(text.split())
    out, at = [], 0
    while at < len(text):
        m = _SPACE.search(text, at + block)
        end = m.start() if m else len(text)
        out.append(hashes.codes(text[at:end].split()))
        at = end
    return np.concatenate(out)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public domain constants) over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n-word shingles of one word-code sequence, in order, repeats kept.

    Fewer than n words: one shingle of the whole sequence; no word: none."""
    if len(codes) == 0:
        return codes
    n = min(n, len(codes))
    m = len(codes) - n + 1
    h = np.full(m, n, np.uint64)
    for i in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + m])
    return h
