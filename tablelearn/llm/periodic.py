"""Periodic runs of words by seed and extend on the diagonals of a document.

A run is a stretch of consecutive words in which words a smallest period q apart are identical,
of length at least max(MIN_LENGTH, 2 q), that no neighbouring word extends.  Its words i and
i + q agree on a stretch of the diagonal of lag q that is at least max(MIN_LENGTH - q, q) long.

Lags are taken in octaves: 1 up to 2 K, then 2 K to 4 K, 4 K to 8 K and so on (K = 6).  Every run
of an octave holds equal k-grams at its lag, k being the overlap that the octave guarantees, so
k-grams are indexed by exact names (doubled from octave to octave; a k-gram that occurs once
in its document drops out for good) and the pairs of occurrences in one document whose distance
lies in the octave are the seeds.  Seeds go by lag and position; a table with the furthest
position covered on every lag suppresses those that an extension has passed already.

Inside a run of a short period the seeds of longer lags would multiply.  A k-gram that lies in such
a run and does not begin it needs no seed of its own: the left end of a longer run always
pairs with an occurrence that begins its short run or lies in none.  So the number of
seeds stays near n log n words even where one word fills a text.

Many documents are handled in one flat array; a word is named by its document too, so that
nothing agrees across documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.bpe import ranges
from tablelearn.llm.common import chunks, lean, pick, setup

#: Shortest run in words.
MIN_LENGTH = 12
#: Positions whose seeds are in memory at a time.
SLICE = 1 << 17
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def renamed(keys: np.ndarray) -> np.ndarray:
    """Names 0, 1, ... of equal keys; -1 where a key occurs once."""
    out = np.full(len(keys), -1, np.int64)
    if not len(keys):
        return out
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.concatenate(([True], s[1:] != s[:-1]))
    group = np.cumsum(first) - 1
    repeated = np.bincount(group)[group] > 1
    out[order] = np.where(repeated, group, -1)
    return out


def joined(names: np.ndarray, shift: int) -> np.ndarray:
    """Names of the grams made of two, the second one ``shift`` words on (they may overlap); -1 where one occurs once."""
    n = len(names)
    at = np.flatnonzero(names[:max(0, n - shift)] >= 0)
    at = at[names[at + shift] >= 0]
    out = np.full(n, -1, np.int64)
    out[at] = renamed(names[at] * (n + 1) + names[at + shift])
    return out


def extension(levels: list, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words agree from a and b on (or before them, going back), by whole grams, longest first."""
    n = len(levels[0][1])
    total = np.zeros(len(a), np.int64)
    for k, names in reversed(levels):
        live = np.arange(len(a))
        while len(live):
            i, j = (a[live] - total[live] - k, b[live] - total[live] - k) if back else (a[live] + total[live], b[live] + total[live])
            ok = i >= 0 if back else j + k <= n
            live, i, j = live[ok], i[ok], j[ok]
            same = (names[i] == names[j]) & (names[i] >= 0)
            live = live[same]
            total[live] += k
    return total


def seeds(order: np.ndarray, key: np.ndarray, names: np.ndarray, anchor: np.ndarray, lo: int, hi: int, width: int, a: int, b: int):
    """(lag, position) of the pairs i, j of equal names with i in [a, b), lo <= j - i < hi, of which one is an anchor.

    ``order`` holds the positions by name and place, ``key`` their name * width + place."""
    def pairs(some, at_least, below):
        left = np.searchsorted(key, names[some] * width + at_least)
        n = np.maximum(np.searchsorted(key, names[some] * width + below) - left, 0)
        return np.repeat(some, n), order[ranges(left, n)]

    i = np.flatnonzero((names[a:b] >= 0) & anchor[a:b]) + a
    i, j = pairs(i, i + lo, i + hi)
    q = np.flatnonzero((names[a + lo:b + hi - 1] >= 0) & anchor[a + lo:b + hi - 1]) + a + lo
    q, p = pairs(q, np.maximum(q - hi + 1, a), np.minimum(q - lo + 1, b))
    both = np.unique(np.concatenate((j - i, q - p)) * width + np.concatenate((i, p)))
    return both // width, both % width


def find(words: np.ndarray, doc: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) rows of the runs in a flat array of word numbers; ``doc`` numbers the documents in order."""
    n = len(words)
    if not n:
        return np.zeros((0, 3), np.int64)
    k = max(1, min_length // 2)
    levels = [(1, renamed(doc * (int(words.max()) + 1) + words))]
    while levels[-1][0] < k:
        size, names = levels[-1]
        levels.append((min(2 * size, k), joined(names, min(size, k - size))))
    longest = int(np.bincount(doc).max())
    width = 4 * n + 4
    found: dict[tuple, int] = {}
    lo, hi = 1, 2 * k
    while True:
        k, names = levels[-1]
        live = np.flatnonzero(names >= 0)
        if not len(live):
            break
        order = live[np.argsort(names[live], kind="stable")]
        key = names[order] * width + order
        anchor = np.ones(n, bool)
        if found:
            reach = np.zeros(n + 1, np.int64)
            short = [(s + 1, e) for (s, e), q in found.items() if 2 * q <= k]
            if short:
                at, end = np.array(short).T
                np.maximum.at(reach, at, end)
                anchor = np.maximum.accumulate(reach)[:n] < np.arange(n) + k
        covered: dict[int, int] = {}
        new = []
        for a in range(0, n, SLICE):
            lag, i = seeds(order, key, names, anchor, lo, hi, width, a, min(n, a + SLICE))
            new += extended(levels, lag, i, covered)
        for q, s, e in sorted(new):
            # Stretches of one extent: the longer lag is a multiple of the smallest period.
            if e - s >= max(min_length, 2 * q):
                found.setdefault((s, e), q)
        lo, hi = hi, 2 * hi
        if 2 * lo > longest:
            break
        levels.append((2 * k, joined(names, k)))
    return np.array(sorted((s, e - s, q) for (s, e), q in found.items()), np.int64).reshape(-1, 3)


def extended(levels: list, lag: np.ndarray, i: np.ndarray, covered: dict[int, int]):
    """(lag, start, end) of the maximal stretches through the seeds, each extended once.

    Round by round the first seed of every lag is extended; the seeds that it passes go."""
    if covered and len(lag):
        lags, inverse = np.unique(lag, return_inverse=True)
        keep = i >= np.array([covered.get(q, 0) for q in lags.tolist()])[inverse]
        lag, i = lag[keep], i[keep]
    while len(lag):
        first = np.flatnonzero(np.concatenate(([True], lag[1:] != lag[:-1])))
        a, q = i[first], lag[first]
        end = a + extension(levels, a, a + q)
        start = a - extension(levels, a, a + q, back=True)
        covered.update(zip(q.tolist(), end.tolist()))
        yield from zip(q.tolist(), start.tolist(), (end + q).tolist())
        keep = i >= np.repeat(end, np.diff(np.append(first, len(lag))))
        lag, i = lag[keep], i[keep]


class Numbers(dict):
    def __missing__(self, word):
        self[word] = len(self)
        return self[word]


def runs_of(texts: list[bytes], min_length: int = MIN_LENGTH):
    """For some texts: (words of each, runs of each as rows (start, length, period), kept words as a mask over all words)."""
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    number = Numbers()
    flat = np.fromiter((number[x] for w in words for x in w), np.int64, int(n.sum()))
    doc = np.repeat(np.arange(len(words)), n)
    rows = find(flat, doc, min_length)
    drop = np.zeros(len(flat) + 1, np.int64)
    np.add.at(drop, rows[:, 0] + rows[:, 2], 1)
    np.add.at(drop, rows[:, 0] + rows[:, 1], -1)
    kept = np.cumsum(drop)[:-1] == 0
    begin = np.cumsum(n) - n
    of = doc[rows[:, 0]] if len(rows) else np.zeros(0, np.int64)
    rows[:, 0] -= begin[of]
    return words, rows, np.bincount(of, minlength=len(words)), kept


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, n_words long, runs array of (start, length, period) by start and period, collapsed string) of every row.

    Words are runs of other than ASCII white space in the whole text, numbered from 0.  ``collapsed``
    joins by one blank the words that no run repeats: all but those after a run's first period.  Null
    and empty texts have no words, no runs and an empty string; repeated rows give repeated rows; a
    null id is kept; an empty table gives an empty one; other columns play no part, whatever their
    names.  A very long text is one array of numbers in its task, without pairs of all its words."""
    spark = setup(df.sparkSession)
    rows = pick(df, _id=id_col, _text=text_col)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [(x or "").encode() for x in b.column(1).to_pylist()]
            for i, j in chunks([len(x) for x in texts]):
                words, found, per_doc, kept = runs_of(texts[i:j], min_length)
                collapsed, at = [], 0
                for w in words:
                    mask = kept[at:at + len(w)]
                    collapsed.append(b" ".join(w if mask.all() else [w[p] for p in np.flatnonzero(mask).tolist()]).decode())
                    at += len(w)
                triples = pa.StructArray.from_arrays([pa.array(found[:, c]) for c in range(3)], ["start", "length", "period"])
                ends = pa.array(np.concatenate(([0], np.cumsum(per_doc))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(w) for w in words], pa.int64()),
                     pa.ListArray.from_arrays(ends, triples), pa.array(collapsed, pa.string())],
                    ["_id", "n_words", "runs", "collapsed"])

    out = rows.mapInArrow(lean(run), f"_id {id_type}, n_words long, runs {RUN}, collapsed string")
    return out.withColumnRenamed("_id", id_col)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period; nulls without a run), and digests."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return found.withColumn("_best", best).select(
        F.col(id_col), F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def looped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): the texts with periodic tails written into a tenth of the documents.

    With h the CRC-32 of the decimal id and g = h // 10, where h % 10 = 0 and there are n > 0 words,
    every word i from a = g % n on becomes word a + (i - a) % p with p = 1 + (n - a) // (3 + g % 8),
    and the words are joined by blanks.  Other texts, and those with a null id, stay as they are."""
    spark = setup(df.sparkSession)
    h = F.crc32(F.col("_id").cast("string").cast("binary"))
    rows = pick(df, _id=id_col, _text=text_col).select("_id", "_text", h.alias("_h"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for k, h in enumerate(b.column(2).to_pylist()):
                if h is not None and h % 10 == 0 and (w := (texts[k] or "").encode().split()):
                    g, n = h // 10, len(w)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    turns = -(-(n - a) // p)
                    texts[k] = b" ".join(w[:a] + (w[a:a + p] * turns)[:n - a]).decode()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["_id", "text"])

    return rows.mapInArrow(lean(run), f"_id {id_type}, text string").withColumnRenamed("_id", id_col)
