"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

All symbols of many words lie in one flat array.  Each round looks every adjacent pair up
by binary search over the sorted pair keys, takes the lowest rank of each word, merges all
its non-overlapping occurrences left to right, and drops finished words.  Distinct text
units are encoded once per worker; a document is a gather over the unit table.

``encode`` gives the ids as packed little-endian unsigned 32-bit integers, ``decode`` turns
such ids back into text.  Null text counts as empty: no ids, empty text.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import chunks, lean, pick, setup

# Fixed value: the split pattern of byte-level BPE.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = regex.compile(SPLIT)
_OTHER_SPACE = re.compile(r"[^\S \n]")
_UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Words of more bytes than this are merged with a heap, since rounds grow with a word's length.
LONG_WORD = 512
#: Texts of more characters than this are encoded part by part.
LONG_TEXT = 1 << 22
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Distinct units that a worker keeps encoded.
MAX_UNITS = 400_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], extra = chr(256 + extra), extra + 1
    return out


class Tables:
    """Arrays of one vocabulary: byte ids, sorted pair keys with ranks and results, token bytes."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        chars = byte_chars()
        self.byte_id = np.array([vocab[c] for c in chars], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = {c: b for b, c in enumerate(chars)}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        tokens |= {i: t.encode() for t, i in self.special.items()}
        blobs = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.tok_len = np.array([len(b) for b in blobs], np.int64)
        self.tok_at = np.concatenate(([0], np.cumsum(self.tok_len)[:-1]))
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)

    @classmethod
    def read(cls, path: str) -> "Tables":
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))


NONE = np.iinfo(np.int64).max


def pair_ranks(t: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if not len(t.keys):
        return np.full(len(left), NONE)
    key = (left << 32) | right
    at = np.minimum(np.searchsorted(t.keys, key), len(t.keys) - 1)
    return np.where(t.keys[at] == key, t.rank[at], NONE)


def merge_rounds(t: Tables, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and how many each word has."""
    lens = np.array([len(w) for w in words], np.int64)
    sym = t.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    wid = np.repeat(np.arange(len(words)), lens)
    done_sym, done_wid = [sym[:0]], [wid[:0]]
    while len(sym):
        rank = np.full(len(sym), NONE)
        inside = np.flatnonzero(wid[1:] == wid[:-1])
        rank[inside] = pair_ranks(t, sym[inside], sym[inside + 1])
        starts = np.flatnonzero(np.concatenate(([True], wid[1:] != wid[:-1])))
        size = np.diff(np.concatenate((starts, [len(sym)])))
        low = np.repeat(np.minimum.reduceat(rank, starts), size)
        alive = low != NONE
        done_sym.append(sym[~alive])
        done_wid.append(wid[~alive])
        hit = np.flatnonzero(alive & (rank == low))
        if not len(hit):
            break
        first = np.concatenate(([True], np.diff(hit) != 1))  # "aaa": every second of a run
        run = np.arange(len(hit)) - np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
        hit = hit[run % 2 == 0]
        sym[hit] = t.merged[rank[hit]]
        alive[hit + 1] = False
        sym, wid = sym[alive], wid[alive]
    sym, wid = np.concatenate(done_sym), np.concatenate(done_wid)
    return sym[np.argsort(wid, kind="stable")], np.bincount(wid, minlength=len(words))


def merge_long(t: Tables, word: bytes) -> np.ndarray:
    """The same merges for one very long word, in O(n log n)."""
    sym = t.byte_id[np.frombuffer(word, np.uint8)].tolist()
    n = len(sym)
    prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
    alive = [True] * n

    def rank(i):
        j = nxt[i]
        if j < 0:
            return NONE
        return int(pair_ranks(t, np.array([sym[i]]), np.array([sym[j]]))[0])

    first = pair_ranks(t, np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64)) if n > 1 else []
    heap = [(int(r), i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r != NONE]
    heapq.heapify(heap)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j < 0 or sym[i] != a or sym[j] != b:
            continue
        sym[i], alive[j], nxt[i] = int(t.merged[r]), False, nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        for k in (prev[i], i):
            if k >= 0 and (r := rank(k)) != NONE:
                heapq.heappush(heap, (r, k, sym[k], sym[nxt[k]]))
    return np.array([s for s, ok in zip(sym, alive) if ok], np.int64)


class Encoder:
    """Encodes batches of texts; keeps the ids of the distinct units it has seen."""

    def __init__(self, t: Tables):
        self.t = t
        self.special = re.compile("|".join(sorted((re.escape(s) for s in t.special if s), key=len, reverse=True))) \
            if any(t.special) else None
        self.forget()

    def forget(self):
        self.unit: dict[str, int] = {}
        self.at = np.zeros(1024, np.int64)
        self.len = np.zeros(1024, np.int64)
        self.flat = np.zeros(1 << 14, np.int64)
        self.used = 0

    def learn(self, units: list[str]):
        """Encode units not seen before."""
        split = [_SPLIT.findall(u) if u not in self.t.special else [u] for u in units]
        seen: dict[str, int] = {}
        code = np.array([seen.setdefault(w, len(seen)) for ws in split for w in ws], np.int64)
        words = list(seen)
        raw = [w.encode() for w in words]
        odd = {k: np.array([self.t.special[w]]) if w in self.t.special else merge_long(self.t, raw[k])
               for k, w in enumerate(words) if w in self.t.special or len(raw[k]) > LONG_WORD}
        flat, n = merge_rounds(self.t, [b"" if k in odd else w for k, w in enumerate(raw)])
        at = np.cumsum(n) - n
        end = len(flat)
        flat = np.concatenate([flat, *odd.values()])
        for k, ids in odd.items():
            at[k], n[k], end = end, len(ids), end + len(ids)
        ids = flat[ranges(at[code], n[code])]
        per_unit = np.cumsum([len(ws) for ws in split])
        total = np.concatenate(([0], np.cumsum(n[code])))[per_unit]
        m, k = len(self.unit), len(self.unit) + len(units)
        self.unit.update(zip(units, range(m, k)))
        for name, need in (("at", k), ("len", k), ("flat", self.used + len(ids))):
            a = getattr(self, name)
            if need > len(a):
                setattr(self, name, np.concatenate((a, np.zeros(max(need, 2 * len(a)) - len(a), a.dtype))))
        self.len[m:k] = np.diff(total, prepend=0)
        self.at[m:k] = self.used + total - self.len[m:k]
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def units(self, text: str) -> list[str]:
        """Pieces that can be encoded on their own: a run of white space with what follows it,
        or the pattern's own words where there is other white space than blanks and line ends."""
        if self.special is not None and self.special.search(text):
            out, at = [], 0
            for m in self.special.finditer(text):
                out += [*self._plain(text[at:m.start()]), m.group()]
                at = m.end()
            return out + self._plain(text[at:])
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        return _SPLIT.findall(text) if _OTHER_SPACE.search(text) else _UNIT.findall(text)

    def batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        if len(self.unit) > MAX_UNITS:
            self.forget()
        split = [self.units(x) for x in texts]
        missing = set().union(*split).difference(self.unit)
        if missing:
            self.learn(list(missing))
        n_units = np.array([len(us) for us in split], np.int64)
        code = np.concatenate([np.fromiter(map(self.unit.__getitem__, us), np.int64, len(us)) for us in split])
        n = self.len[code]
        ids = self.flat[ranges(self.at[code], n)]
        ends = np.cumsum(n_units)
        total = np.concatenate(([0], np.cumsum(n)))
        return ids, total[ends] - total[ends - n_units]


def parts(text: str) -> list[str]:
    """A very long text in parts that can be encoded on their own: cut before a single blank
    between other characters, where the split pattern always starts a new word."""
    out, at = [], 0
    while len(text) - at > LONG_TEXT and (m := _CUT.search(text, at + LONG_TEXT)):
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]]


def ranges(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [at, at + n)."""
    shift = np.repeat(at - (np.cumsum(n) - n), n)
    return shift + np.arange(len(shift))


def decode_ids(t: Tables, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of consecutive runs of ids; bytes that are no UTF-8 become the replacement character."""
    n = t.tok_len[ids]
    raw = t.blob[ranges(t.tok_at[ids], n)].tobytes()
    total = np.concatenate(([0], np.cumsum(n)))
    ends = np.cumsum(counts)
    return [raw[total[e - c]:total[e]].decode("utf-8", "replace") for e, c in zip(ends.tolist(), counts.tolist())]


_ENCODERS: dict = {}


def _encoder(shared) -> Encoder:
    key = shared.value["path"]
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Tables(shared.value["spec"]))
    return _ENCODERS[key]


def _shared(spark, path: str):
    """The vocabulary file (a few MB whatever the corpus) sent once to each executor."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast({"path": path, "spec": json.load(f)})


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, n_tokens long, ids binary[, decoded string]) of every row, whole texts.

    Nulls and empty texts have no ids; repeated rows give repeated rows; a null id is kept."""
    spark = setup(df.sparkSession)
    rows = pick(df, _id=id_col, _text=text_col)
    shared = _shared(spark, path)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        enc = _encoder(shared)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            for i, j in chunks([len(x) for x in texts]):
                n, packed, back = [], [], []
                for some in (texts[i:j],) if j - i > 1 or len(texts[i]) <= LONG_TEXT else ([p] for p in parts(texts[i])):
                    ids, k = enc.batch(some)
                    ends = np.cumsum(k).tolist()
                    n += k.tolist()
                    packed += [ids[e - c:e].astype("<u4").tobytes() for e, c in zip(ends, k.tolist())]
                    back += decode_ids(enc.t, ids, k) if decoded else []
                if len(n) > j - i:
                    n, packed, back = [sum(n)], [b"".join(packed)], ["".join(back)]
                cols = [b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(packed, pa.binary())]
                if decoded:
                    cols.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["_id", "n_tokens", "ids", "decoded"][:len(cols)])

    out = rows.mapInArrow(lean(run), f"_id {id_type}, n_tokens long, ids binary" + ", decoded string" * decoded)
    return out.withColumnRenamed("_id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from packed ids; null ids give an empty text, ids outside the vocabulary nothing."""
    spark = setup(df.sparkSession)
    rows = pick(df, _id=id_col, _ids=ids_col)
    shared = _shared(spark, path)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        t = _encoder(shared).t
        for b in batches:
            packed = [x or b"" for x in b.column(1).to_pylist()]
            for i, j in chunks([len(x) for x in packed]):
                ids = np.frombuffer(b"".join(x[:len(x) // 4 * 4] for x in packed[i:j]), "<u4").astype(np.int64)
                n = np.array([len(x) // 4 for x in packed[i:j]], np.int64)
                known = ids < len(t.tok_len)
                if not known.all():
                    part = np.repeat(np.arange(len(n)), n)
                    n = np.bincount(part[known], minlength=len(n))
                    ids = ids[known]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(decode_ids(t, ids, n), pa.string())],
                                                 ["_id", "text"])

    return rows.mapInArrow(lean(run), f"_id {id_type}, text string").withColumnRenamed("_id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """SHA-256 of the packed ids and of the decoded text."""
    return encoded.select(F.col(id_col), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
