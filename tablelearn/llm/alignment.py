"""Two tokenisations of one text aligned by byte offsets.

Tokens of both sides become rows (document, start, end, id).  One ``pandas.merge_asof`` per
direction and batch, keyed by document, gives for every token start the covering token of the
other side; the union of both directions holds every overlapping pair.  Where an overlapping pair
ends at the same byte, a group of tokens ends.  All pairs of the two sides inside one group
are linked.

``align`` gives the groups and the linked id pairs of every text; ``pair_counts`` counts, for every
id pair of the corpus, the documents that hold it linked; ``scored`` looks these counts up.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm import bpe
from tablelearn.llm.bpe import byte_chars, ranges
from tablelearn.llm.common import chunks, lean, pick, setup, written

#: Bytes of text that are aligned at a time, and characters beyond which a text is taken part by part.
CHUNK_BYTES = 1 << 19
LONG_TEXT = 1 << 20
#: Linked id pairs that are multiplied out at a time.
PAIR_BLOCK = 1 << 21
#: Counted pairs that may be broadcast (16 bytes each); beyond, counts are joined block by block of documents.
MAX_BROADCAST = 1_000_000
#: Documents of one task that share a block of the joined lookup.
BLOCK_DOCS = 2000
#: Where both tokenisers begin anew: one blank between ASCII letters or digits.
_CUT = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


class ByteSide:
    """Byte-level BPE of a blank and the text; special strings are plain text.

    The vocabulary's ids follow the order of its merges (checked), so the tiktoken library gives the same
    ids by rank; a text with white space too long for its split takes this package's own encoder."""

    def __init__(self, spec: str):
        import tiktoken

        spec = json.loads(spec) | {"added_tokens": []}
        vocab, byte_of = spec["model"]["vocab"], {c: b for b, c in enumerate(byte_chars())}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.own = bpe.Encoder(bpe.Tables(spec))
        self.lengths = self.own.t.tok_len
        ids = [vocab[a + b] for a, b in pairs]
        self.fast = None
        if ids == sorted(ids) and set(vocab.values()) >= set(range(256)) and ids[:1] > [255]:
            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if all(c in byte_of for c in t)}
            made = set(ids) | set(range(256))
            self.fast = tiktoken.Encoding("a", pat_str=bpe.SPLIT, mergeable_ranks={t: i for t, i in ranks.items() if i in made},
                                          special_tokens={})

    def one(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except (ValueError, AttributeError):
            return self.own.batch([text])[0]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        ids = [self.one(" " + x) for x in texts]
        return np.concatenate(ids).astype(np.int64), np.array([len(x) for x in ids], np.int64)


class PieceSide:
    """Pieces of the text by the sentencepiece library, which puts a blank before it."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.t = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.t.id_to_piece(i) for i in range(self.t.vocab_size())]
        self.bytes = [bytes([int(x[3:5], 16)]) if self.t.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has; -1 for a text that the pieces do not give back."""
        got = self.t.encode(texts, num_threads=1)
        for t, ids in enumerate(got):
            if b"".join(map(self.bytes.__getitem__, ids)) != (" " + texts[t]).encode():
                got[t] = None
        n = np.array([-1 if ids is None else len(ids) for ids in got], np.int64)
        return np.fromiter(chain.from_iterable(filter(None, got)), np.int64, int(n[n > 0].sum())), n


def rows(ids: np.ndarray, n: np.ndarray, keep: np.ndarray, lengths: np.ndarray) -> pd.DataFrame:
    """Rows (doc, start, end, id) of the texts to keep; offsets run on over all of them."""
    doc = np.repeat(np.arange(len(n)), np.maximum(n, 0))
    some = keep[doc]
    doc, ids = doc[some], ids[some]
    end = np.cumsum(lengths[ids])
    return pd.DataFrame({"doc": doc, "start": end - lengths[ids], "end": end, "id": ids}, copy=False)


def covering(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all overlapping tokens: every start of either side with the other side's token over it."""
    def cover(x, y):
        over = y[["doc", "start"]].assign(place=np.arange(len(y)))
        return pd.merge_asof(x[["doc", "start"]], over, on="start", by="doc")["place"].to_numpy(np.int64)

    over_a, over_b = cover(a, b), cover(b, a)
    # Tokens that start together are in the first direction already.
    more = np.flatnonzero(b["start"].to_numpy() != a["start"].to_numpy()[over_b])
    return np.concatenate((np.arange(len(a)), over_b[more])), np.concatenate((over_a, more))


def groups(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every token of both sides; a group ends where an overlapping pair ends at one byte."""
    i, j = covering(a, b)
    same = a["end"].to_numpy()[i] == b["end"].to_numpy()[j]
    out = []
    for side, last in ((a, i[same]), (b, j[same])):
        ends = np.zeros(len(side) + 1, np.int64)
        ends[last + 1] = 1
        out.append(np.cumsum(ends)[:-1])
    return out[0], out[1]


def products(doc: np.ndarray, ga: np.ndarray, a: np.ndarray, gb: np.ndarray, b: np.ndarray):
    """(doc, a id << 32 | b id, links): per document the linked id pairs and how often they are linked.

    ``doc`` gives the document of every group.  A group of one token on each side is one pair.  In
    others equal ids are counted first, and only PAIR_BLOCK products are held at a time."""
    def counted(g, ids):
        key, n = np.unique(g << 32 | ids, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, n

    one = (np.bincount(ga, minlength=len(doc)) == 1) & (np.bincount(gb, minlength=len(doc)) == 1)
    one_a, one_b = one[ga], one[gb]
    single = a[one_a] << 32 | b[one_b]
    done = [summed(doc[ga[one_a]], single, np.ones(len(single), np.int64))]
    ga, a, na = counted(ga[~one_a], a[~one_a])
    gb, b, nb = counted(gb[~one_b], b[~one_b])
    first = np.searchsorted(gb, ga)
    width = np.searchsorted(gb, ga, side="right") - first
    ends = np.cumsum(width)
    at = 0
    while at < len(ga):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIR_BLOCK, side="right")))
        left = np.repeat(np.arange(at, to), width[at:to])
        right = ranges(first[at:to], width[at:to])
        done.append(summed(doc[ga[left]], a[left] << 32 | b[right], na[left] * nb[right]))
        if len(done) > 8:
            done = [summed(*map(np.concatenate, zip(*done)))]
        at = to
    return summed(*map(np.concatenate, zip(*done))) if len(done) > 1 else done[0]


def summed(doc, pair, n):
    """Sums of n by document and pair, in their order."""
    if not len(doc):
        return doc, pair, n
    a, b = pair >> 32, pair & 0xFFFFFFFF
    wide = (int(a.max()) + 1, int(b.max()) + 1)
    if (int(doc.max()) + 1) * wide[0] * wide[1] < 1 << 63:  # one key to sort by
        order = np.argsort((doc * wide[0] + a) * wide[1] + b)
    else:
        order = np.lexsort((pair, doc))
    doc, pair, n = doc[order], pair[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1]))))
    return doc[first], pair[first], np.add.reduceat(n, first)


class Aligner:
    """Both sides, and the texts of their ids with every mark that may follow one in the groups' notation."""

    def __init__(self, a_spec: str, b_model: bytes):
        self.a, self.b = ByteSide(a_spec), PieceSide(b_model)
        n = max(len(self.a.lengths), len(self.b.lengths))
        self.marked = [f"{i}{mark}" for i in range(n) for mark in ",|;"]

    def batch(self, texts: list[str]):
        """For each text (n_a, n_b, n_groups, n_links, groups, pairs, links): the pairs sorted, with the links of each."""
        (ids_a, n_a), (ids_b, n_b) = self.a.encode(texts), self.b.encode(texts)
        keep = (n_b >= 0) & np.array([bool(x) for x in texts], bool)
        a, b = rows(ids_a, n_a, keep, self.a.lengths), rows(ids_b, n_b, keep, self.b.lengths)
        ga, gb = groups(a, b) if len(a) else (np.zeros(0, np.int64),) * 2
        da, db, ia, ib = (x.to_numpy(np.int64) for x in (a["doc"], b["doc"], a["id"], b["id"]))
        doc = np.zeros(int(ga[-1]) + 1 if len(ga) else 0, np.int64)
        doc[ga] = da
        size_a, size_b = np.bincount(ga, minlength=len(doc)), np.bincount(gb, minlength=len(doc))
        count = [np.bincount(x, minlength=len(texts)) for x in (da, db, doc)]
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, doc, size_a * size_b)
        notes = self.notes(ga, ia, gb, ib, size_a, size_b)
        ends = np.cumsum(count[0] + count[1])
        of, pair, links = products(doc, ga, ia, gb, ib)
        cut = np.searchsorted(of, np.arange(len(texts) + 1))
        for t in range(len(texts)):
            some = "".join(map(self.marked.__getitem__, notes[ends[t] - count[0][t] - count[1][t]:ends[t]].tolist()))
            yield (int(count[0][t]), int(count[1][t]), int(count[2][t]), int(n_links[t]), some[:-1],
                   pair[cut[t]:cut[t + 1]], links[cut[t]:cut[t + 1]])

    @staticmethod
    def notes(ga, a, gb, b, size_a, size_b) -> np.ndarray:
        """Places in ``marked``, in the order of the notation: the a ids of a group, then its b ids, group by group."""
        out = np.empty(len(a) + len(b), np.int64)
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        at = np.arange(len(a)) + before_b[ga]
        out[at] = 3 * a + (np.diff(ga, append=-1) != 0)
        at = np.arange(len(b)) + (before_a + size_a)[gb]
        out[at] = 3 * b + 2 * (np.diff(gb, append=-1) != 0)
        return out

    def one(self, text: str):
        """A very long text part by part: both sides begin anew at every cut, so groups end there."""
        parts, at = [], 0
        while len(text) - at > LONG_TEXT and (m := _CUT.search(text, at + LONG_TEXT)):
            parts.append(text[at:m.start()])
            at = m.start() + 1  # the blank that both sides put before a part
        parts.append(text[at:])
        total, noted, got = [0] * 4, [], None
        for p in parts:
            for row in self.batch([p]):
                if p and not row[0]:
                    return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
                total = [x + y for x, y in zip(total, row)]
                noted.append(row[4])
                more = (np.zeros(len(row[5]), np.int64), *row[5:])
                got = more if got is None else summed(*map(np.concatenate, zip(got, more)))
        return *total, ";".join(noted), got[1], got[2]


_ALIGNERS: dict = {}


def _aligner(shared) -> Aligner:
    paths, spec, model = shared.value
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(spec, model)
    return _ALIGNERS[paths]


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links long, groups string, pairs binary, links binary) of every row, whole texts.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``.  ``pairs`` holds the distinct linked id pairs, sorted, as
    64-bit integers a << 32 | b, ``links`` as 64-bit integers how often each is linked (little-endian).
    Texts that are null, empty or not given back byte by byte by both sides have no tokens: zeros
    and empty values.  Repeated rows give repeated rows; a null id is kept; an empty table gives an
    empty one; other columns play no part, whatever their names.  Texts beyond LONG_TEXT
    characters are taken part by part, with the same result."""
    spark = setup(df.sparkSession)
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # two vocabulary files, whatever the corpus
        shared = spark.sparkContext.broadcast(((a_path, b_path), f.read(), g.read()))
    rows = pick(df, _id=id_col, _text=text_col)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        aligner = _aligner(shared)
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            for i, j in chunks([len(x) for x in texts], CHUNK_BYTES):
                got = [aligner.one(texts[i])] if j == i + 1 else list(aligner.batch(texts[i:j]))
                cols = [pa.array([r[c] for r in got], pa.int64()) for c in range(4)] + [pa.array([r[4] for r in got], pa.string())]
                cols += [pa.array([r[c].astype("<i8").tobytes() for r in got], pa.binary()) for c in (5, 6)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *cols],
                                                 ["_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"])

    schema = f"_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, links binary"
    return rows.mapInArrow(lean(run), schema).withColumnRenamed("_id", id_col)


def unpacked(column) -> tuple[np.ndarray, np.ndarray]:
    """All integers of a column of packed ones, and how many each row has."""
    packed = column.to_pylist()
    return np.frombuffer(b"".join(packed), "<i8"), np.array([len(x) // 8 for x in packed], np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, docs, best): in how many documents each id pair is linked, and whether no pair of its a id has more.

    Every task adds up its own documents before the shuffle, so a frequent pair is one row per task and batch."""
    def run(batches):
        for b in batches:
            pair, n = np.unique(unpacked(b.column(0))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "docs"])

    some = aligned.select("pairs").mapInArrow(lean(run), "pair long, docs long")
    total = some.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", 32))
    total = written(total, "pair_counts")
    top = total.groupBy("a").agg(F.max("docs").alias("_top"))  # one row per id of one vocabulary
    return total.join(F.broadcast(top), "a").select("pair", "a", "docs", (F.col("docs") == F.col("_top")).alias("best"))


def looked_up(pair, docs, best, pairs, links, n) -> tuple[np.ndarray, np.ndarray]:
    """Per row (best links, sum of counts over links) from the sorted counted pairs."""
    at = np.searchsorted(pair, pairs)
    row = np.repeat(np.arange(len(n)), n)
    n_best, total = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    np.add.at(n_best, row, links * best[at])
    np.add.at(total, row, links * docs[at])
    return n_best, total


_FOUND = ["n_a", "n_b", "n_groups", "n_links"]


def scored(aligned: DataFrame, id_col: str = "doc_id", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The rows of a written ``align`` table with n_best (links whose count is the highest of their a id) and count_sum.

    Up to ``max_broadcast`` counted pairs go to all tasks; beyond, the distinct pairs of every block of
    BLOCK_DOCS documents are joined with the counts and come back to their block, so that a pair of
    every document is one row per block."""
    counts = written(pair_counts(aligned), "pair_best")
    keep = [c for c in aligned.columns if c not in ("pairs", "links")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name in keep)
    schema = fields + ", n_best long, count_sum long"
    rows = aligned.select(*keep, "pairs", "links")
    if counts.count() <= max_broadcast:
        table = counts.select("pair", "docs", "best").toArrow()
        order = np.argsort(table["pair"].to_numpy())
        shared = aligned.sparkSession.sparkContext.broadcast(
            tuple(table[c].to_numpy()[order].astype(np.int64) for c in ("pair", "docs", "best")))

        def run(batches):
            for b in batches:
                pairs, n = unpacked(b.column(len(keep)))
                found = looked_up(*shared.value, pairs, unpacked(b.column(len(keep) + 1))[0], n)
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], *map(pa.array, found)], [*keep, "n_best", "count_sum"])

        return rows.mapInArrow(lean(run), schema)

    blocks = written(rows.withColumn("_block", F.concat_ws("-", F.spark_partition_id(),
                                     F.floor(F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)) / BLOCK_DOCS))), "pair_blocks")

    def distinct(batches):
        """Pairs of the blocks; a block may come in several batches."""
        for b in batches:
            names, code = np.unique(np.array(b.column(0).to_pylist(), object), return_inverse=True)
            pairs, n = unpacked(b.column(1))
            for c, name in enumerate(names):
                some = np.unique(pairs[np.repeat(code == c, n)])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.int64())], ["_block", "pair"])

    wanted = blocks.select("_block", "pairs").mapInArrow(lean(distinct), "_block string, pair long").distinct()
    # A pair of every block would meet its one count in one task: both sides are spread over 16 places of it.
    spread = F.pmod(F.crc32(F.col("_block")), F.lit(16)).cast("int")
    everywhere = counts.select("pair", "docs", "best", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_s"))
    found = wanted.withColumn("_s", spread).join(everywhere.hint("shuffle_hash"), ["pair", "_s"]).select("_block", "pair", "docs", "best")

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("pair")
        pairs, n = unpacked(left["pairs"])
        got = looked_up(*(right[c].to_numpy().astype(np.int64) for c in ("pair", "docs", "best")), pairs, unpacked(left["links"])[0], n) \
            if len(pairs) else (np.zeros(len(n), np.int64),) * 2
        return pa.table([*(left[c] for c in keep), *map(pa.array, got)], [*keep, "n_best", "count_sum"])

    return blocks.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(together, schema)


def digests(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id") -> DataFrame:
    """Counts of every document's alignment and the SHA-256 of its groups ('' without tokens)."""
    sha = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    some = align(df, a_path, b_path, id_col).withColumn("groups_sha256", sha).drop("groups")
    return scored(written(some, "aligned"), id_col).select(id_col, *_FOUND, "n_best", "count_sum", "groups_sha256")
