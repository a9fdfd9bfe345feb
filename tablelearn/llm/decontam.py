"""Benchmark decontamination by size-partitioned MinHash containment search.

Items of one shingle are looked up exactly.  The others are partitioned by the size of their
shingle set, each partition twice as wide as the one before.  Against a partition of sizes up to ``hi`` a document is cut into blocks of hi/2
shingles; any three adjacent blocks form a window, so a passage of one item always lies
inside one window, whatever the document's length, and the item's similarity to that window
stays high.  Window and item share a MinHash value for one of HASHES hashes with probability
1 - (1 - J)^HASHES; a candidate is any shared value.  A candidate is confirmed by its exact
containment: the share of the item's shingles that the whole document holds.

Items are taken in blocks of ITEM_SHINGLES shingles at most, and one block's sketches go to
all tasks at a time, so the broadcast is bounded however many items there are.  Documents
are only read: nothing but the confirmed pairs is shuffled or written.

Words are runs of other than ASCII white space, lower-cased, without punctuation at either
end; words of punctuation alone do not count.  Shingles have ``n`` words; a text of fewer
words has the whole sequence as its one shingle, so such an item is found only in a document
that is that sequence.  Null and empty texts have no shingles and match nothing; repeated
rows match each; rows with a null id are matched under the null id; items without an id are ignored.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import WordHashes, chunks, lean, map_rows, pick, setup, shingle_hashes, word_codes, written
from tablelearn.llm.neardup import A, B, fold32

HASHES = 48
ITEM_SHINGLES = 200_000
#: Characters handled at once: 48 hashes over small arrays would cost more in calls than in work.
TEXT_CHARS = 1 << 20
_EDGE = string.punctuation


def plain(word: bytes) -> bytes:
    return word.decode("utf-8", "replace").lower().strip(_EDGE).encode()


def shingles(text: str | None, hashes: WordHashes, n: int) -> np.ndarray:
    """Shingle hashes in order, repeats kept."""
    codes = word_codes((text or "").encode("utf-8", "surrogatepass"), hashes)
    return shingle_hashes(codes[codes != 0], n)


class Partition:
    """Items with sizes in (hi / 2, hi]: their MinHash values, sorted for each hash."""

    def __init__(self, hi: int, items: list[int], sketches: np.ndarray):
        self.block = max(1, -(-hi // 2))
        order = np.argsort(sketches, axis=0, kind="stable")
        self.value = np.take_along_axis(sketches, order, 0).T.copy()
        self.item = np.array(items)[order].T.copy()
        self.mask = np.zeros((HASHES, 1 << 13), bool)
        for k in range(HASHES):
            self.mask[k, self.value[k] & 0x1FFF] = True


class Index:
    """A block of items: exact shingle sets, the items of one shingle sorted by it, and the size
    partitions of the others with their sketches."""

    def __init__(self, ids: list, sets: list[np.ndarray]):
        self.ids, self.sets, self.parts = ids, sets, []
        one = [i for i, s in enumerate(sets) if len(s) == 1]
        single = np.array([sets[i][0] for i in one], np.uint64)
        order = np.argsort(single, kind="stable")
        self.single, self.one = single[order], np.array(one, np.int64)[order]
        sketch = np.empty((len(sets), HASHES), np.uint32)
        for i, s in enumerate(sets):
            f = fold32(s)
            for k in range(HASHES):
                sketch[i, k] = (f * A[k] + B[k]).min()
        classes: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if len(s) == 1:
                continue
            hi = 2
            while hi < len(s):
                hi *= 2
            classes.setdefault(hi, []).append(i)
        self.parts = [Partition(hi, items, sketch[items]) for hi, items in sorted(classes.items())]

    def candidates(self, docs: list[np.ndarray]) -> set:
        """(document, item) pairs with a common MinHash value in some window, or with the item's one shingle."""
        size = np.array([len(d) for d in docs])
        at = np.cumsum(size) - size
        flat = np.concatenate(docs)
        found = self.singles(flat, at) if len(self.one) else set()
        flat = fold32(flat)
        cuts = []
        for p in self.parts:
            n = -(-size // p.block)
            doc = np.repeat(np.arange(len(docs)), n)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            one = np.concatenate((doc[1:] != doc[:-1], [True]))  # last block of its document
            two = np.concatenate((doc[2:] != doc[:-2], [True, True][:len(doc)])) if len(doc) > 1 else np.ones(1, bool)
            cuts.append((at[doc] + nth * p.block, doc, one, two))
        for k in range(HASHES):
            h = flat * A[k] + B[k]
            for p, (starts, doc, one, two) in zip(self.parts, cuts):
                low = np.minimum.reduceat(h, starts)
                top = np.uint32(0xFFFFFFFF)
                low1 = np.where(one, top, np.concatenate((low[1:], [top])))
                low2 = np.where(two, top, np.concatenate((low[2:], [top, top][:len(low)]))) if len(low) > 1 else np.array([top])
                window = np.minimum(low, np.minimum(low1, low2))
                hit = np.flatnonzero(p.mask[k, window & np.uint32(0x1FFF)])
                if not len(hit):
                    continue
                a = np.searchsorted(p.value[k], window[hit], "left")
                b = np.searchsorted(p.value[k], window[hit], "right")
                for w, x, y in zip(hit[b > a], a[b > a], b[b > a]):
                    found.update((int(doc[w]), int(i)) for i in p.item[k, x:y])
        return found

    def singles(self, flat: np.ndarray, at: np.ndarray) -> set:
        a = np.searchsorted(self.single, flat, "left")
        hit = np.flatnonzero(self.single[np.minimum(a, len(self.single) - 1)] == flat)
        doc = np.searchsorted(at, hit, "right") - 1
        return {(d, int(i)) for d, x in set(zip(doc.tolist(), a[hit].tolist()))
                for i in self.one[x:np.searchsorted(self.single, self.single[x], "right")]}

    def matches(self, docs: list[np.ndarray], least: float):
        """(document, item id, shingles of the item, shared) of the confirmed candidates."""
        known: dict[int, np.ndarray] = {}
        for d, i in sorted(self.candidates(docs)):
            if d not in known:
                known = {d: np.unique(docs[d])}
            shared = int(np.isin(self.sets[i], known[d], assume_unique=True).sum())
            if shared >= least * len(self.sets[i]) - 1e-9:
                yield d, self.ids[i], len(self.sets[i]), shared


def item_blocks(items: DataFrame, n: int, id_col: str, text_col: str):
    """Blocks of (ids, shingle sets), each of bounded size, read one after another."""
    rows = pick(items, id=id_col, text=text_col).where("id IS NOT NULL").select(F.col("id").cast("long"), F.col("text").cast("string"))
    words = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-words // ITEM_SHINGLES))
    for b in range(blocks):
        hashes, ids, sets = WordHashes(plain), [], []
        for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).distinct().orderBy("id", "text").toLocalIterator():
            s = np.unique(shingles(r["text"], hashes, n))
            if len(s):
                ids.append(r["id"])
                sets.append(s)
        if ids:
            yield ids, sets


def contaminated(docs: DataFrame, items: DataFrame, n: int = 5, least: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, item_shingles, shared, containment) of every document that holds at least
    ``least`` of an item's shingles."""
    spark = setup(docs.sparkSession)
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), F.col("text").cast("string"))
    schema = "id long, item_id long, item_shingles long, shared long"
    out = None
    for ids, sets in item_blocks(items, n, item_id, item_text):
        shared = spark.sparkContext.broadcast(Index(ids, sets))

        def run(batches, shared=shared):
            hashes = WordHashes(plain)
            for b in batches:
                key, texts = (c.to_pylist() for c in b.columns)
                for i, j in chunks([len(t or "") for t in texts], TEXT_CHARS):
                    docs = [shingles(t, hashes, n) for t in texts[i:j]]
                    who = [i + k for k, d in enumerate(docs) if len(d)]
                    docs = [d for d in docs if len(d)]
                    if docs:
                        got = [(key[who[d]], *rest) for d, *rest in shared.value.matches(docs, least)]
                        if got:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)],
                                                             ["id", "item_id", "item_shingles", "shared"])

        part = written(rows.mapInArrow(lean(run), schema), "decontam_matches")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.select(F.col("id").alias(id_col), "item_id", "item_shingles", "shared",
                      (F.col("shared") / F.col("item_shingles")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, n: int = 5, least: float = 0.8, text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of documents that hold no item, all columns; a filter row by row, without shuffle."""
    spark = setup(docs.sparkSession)
    at, out = docs.columns.index(text_col), docs
    for ids, sets in item_blocks(items, n, item_id, item_text):
        shared = spark.sparkContext.broadcast(Index(ids, sets))

        def run(batches, shared=shared):
            hashes = WordHashes(plain)
            for b in batches:
                texts, keep = b.column(at).to_pylist(), np.ones(b.num_rows, bool)
                for i, j in chunks([len(t or "") for t in texts], TEXT_CHARS):
                    some = [(i + k, d) for k, d in enumerate(shingles(t, hashes, n) for t in texts[i:j]) if len(d)]
                    if some:
                        for d, *_ in shared.value.matches([d for _, d in some], least):
                            keep[some[d][0]] = False
                yield b.filter(pa.array(keep))

        out = map_rows(out, run)
    return out
