"""MinHash near-duplicate groups with sequential Bayesian verification.

1. One pass over the texts: words, shingle set, MinHash signature, and a key of the word
   sequence.  Copies (equal keys) collapse to their smallest id by a pre-aggregated group.
2. Signatures are banded.  In each bucket every member is first compared with the bucket's
   smallest id only (a star), verified, and the verified links are contracted.  Buckets whose
   members then still lie in several components are compared across components, in blocks
   of bounded size spread over tasks.  So every candidate pair of the banding that could
   join two components is examined, no pair inside a component is enumerated, and no cap
   drops one.
3. A candidate's signatures are compared batch by batch.  With a uniform prior, m equal of n
   hashes leave P(similarity >= t) = P(Binomial(n + 1, t) <= m); a pair below the chosen
   miss probability is dropped at once.  Survivors are verified on their full sets.
4. Links become components by hooking to the smallest neighbour and pointer jumping.

Contract: shingles of ``n`` words, words are runs of other than ASCII white space after
lower-casing A-Z; fewer words than ``n`` make one shingle of them all; without words the set
is empty and linked with nothing.  Linked: 100 * |A & B| >= percent * |A | B|.  Shingles are
compared by 64-bit hashes.  The number of hash rows in a band is the largest that misses a pair at the
threshold with probability 1e-6 at most.  Repeated rows get the same result each; rows that
share an id but not a text each have the component of their text, and the id counts as
linked where any of its texts is.  Rows with a null id are linked with nothing, have a null
component and are kept.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import (ASCII_LOWER, WordHashes, chunks, lean, mix64, pick, setup, shingle_hashes,
                                   word_codes, written)

HASHES = 120
BATCH = 20
MISS = 1e-6
#: A block of the comparison across components: rows, and shingles of their sets together.
BLOCK = 256
BLOCK_SHINGLES = 1_000_000
#: Bits of the filter that keeps texts without candidate out of the verification's shuffle.
FILTER_WORDS = 1 << 16
_RNG = np.random.default_rng(20240601)
A = (_RNG.integers(1, 2 ** 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
B = _RNG.integers(0, 2 ** 32, HASHES, dtype=np.uint64).astype(np.uint32)


def band_rows(threshold: float) -> int:
    fits = [r for r in (3, 4, 5, 6, 8, 10) if (1 - threshold ** r) ** (HASHES // r) <= MISS]
    return max(fits, default=2)


def least_equal(threshold: float, miss: float = MISS) -> list[int]:
    """For n = BATCH, 2 BATCH, ...: the fewest equal hashes that keep a pair."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total > miss:
                break
            m += 1
        out.append(m)
    return out


def codes_of(text: str | None, hashes: WordHashes) -> np.ndarray:
    return word_codes((text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER), hashes)


def shingle_set(codes: np.ndarray, n: int) -> np.ndarray:
    return np.unique(shingle_hashes(codes, n))


def fold32(h: np.ndarray) -> np.ndarray:
    return (mix64(h) >> np.uint64(32)).astype(np.uint32)


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets, one row each."""
    flat = fold32(np.concatenate(sets))
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(flat * A[k] + B[k], starts)
    return out


def signatures(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(id, key, n_shingles, sig) of every row; key (128 bits of the word sequence) and sig are null
    without words."""
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), F.col("text").cast("string"))

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in chunks([len(t or "") for t in texts]):
                words = [codes_of(t, hashes) for t in texts[i:j]]
                sets = [shingle_set(w, n) for w in words]
                full = [k for k, s in enumerate(sets) if len(s)]
                sig = [None] * len(sets)
                if full:
                    for k, row in zip(full, minhash([sets[k] for k in full])):
                        sig[k] = row.tobytes()
                key = [hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None for w in words]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(key, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary())],
                    ["id", "key", "n_shingles", "sig"])

    return rows.mapInArrow(lean(run), "id long, key binary, n_shingles long, sig binary")


def sig_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def buckets(sigs: DataFrame, rows: int) -> DataFrame:
    """(bucket, id): one row per band of each signature."""
    bands = HASHES // rows

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            m = sig_matrix(b.column(1)).astype(np.uint64)
            key = np.empty((len(m), bands), np.uint64)
            for k in range(bands):
                h = np.full(len(m), k + 1, np.uint64)
                for r in range(rows):
                    h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + m[:, k * rows + r])
                key[:, k] = h
            ids = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(ids, bands))], ["bucket", "id"])

    return sigs.select("id", "sig").mapInArrow(lean(run), "bucket long, id long")


def bayes_keep(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Indices of the row pairs that survive every batch of the sequential test."""
    alive = np.arange(len(a))
    equal = np.zeros(len(a), np.int32)
    for k, m in enumerate(least):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        equal[alive] += (a[alive, cut] == b[alive, cut]).sum(1, dtype=np.int32)
        alive = alive[equal[alive] >= m]
    return alive


def bayes(pairs: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose signatures leave the threshold possible."""
    least = least_equal(threshold)
    s = sigs.select("id", "sig")
    both = (pairs.join(s.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
            .join(s.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for x in batches:
            if x.num_rows:
                keep = bayes_keep(sig_matrix(x.column(2)), sig_matrix(x.column(3)), least)
                yield x.select(["a", "b"]).take(pa.array(keep))

    return both.mapInArrow(lean(run), "a long, b long")


def bit_filter(ids: DataFrame) -> DataFrame:
    """(_w, _bits): a bit set of fixed size, FILTER_WORDS rows at most, with the bits of all ids."""
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_WORDS * 64))
    return (ids.select("id").withColumn("_p", slot).select(F.floor(F.col("_p") / 64).alias("_w"), _bit().alias("_bit"))
            .groupBy("_w").agg(F.bit_or("_bit").alias("_bits")))


def _bit():
    return F.expr("shiftleft(1L, cast(_p % 64 as int))")


def flagged(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with ``_maybe``: false where the id is surely not among ``ids``.  The bit set goes
    to all tasks, so rows without the flag need no shuffle."""
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_WORDS * 64))
    out = docs.withColumn("_p", slot).withColumn("_w", F.floor(F.col("_p") / 64)).join(F.broadcast(bit_filter(ids)), "_w", "left")
    maybe = F.col("id").isNotNull() & (F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(_bit()) != 0)
    return out.withColumn("_maybe", maybe).drop("_w", "_p", "_bits")


def needed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` that may be among ``ids``: a superset, a join follows."""
    return flagged(docs, ids).where("_maybe").select("id", "text")


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that pass the exact test on their full shingle sets."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    text = needed_texts(docs, ids)
    both = (pairs.join(text.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(text.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def run(batches):
        hashes, last, size = WordHashes(), {}, 0
        for x in batches:
            a, b, ta, tb = (c.to_pylist() for c in x.columns)
            keep = []
            for k in range(len(a)):
                sets = []
                for t in (ta[k], tb[k]):  # by text: rows may share an id but not a text
                    if t not in last:
                        if size > 1 << 20:
                            last, size = {}, 0
                        last[t] = shingle_set(codes_of(t, hashes), n)
                        size += len(last[t])
                    sets.append(last[t])
                one, two = sets
                inter = len(np.intersect1d(one, two, assume_unique=True))
                if inter and 100 * inter >= percent * (len(one) + len(two) - inter):
                    keep.append(k)
            yield x.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return both.mapInArrow(lean(run), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable from each linked id, itself included.

    Each round hooks every node to its smallest neighbour, jumps pointers to the roots and
    contracts the links; the nodes that still have links at least halve."""
    labels, edges = None, written(links.select("a", "b").where("a <> b").distinct(), "cc_edges")
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = written(both.groupBy("a").agg(F.min("b").alias("low"))
                       .select(F.col("a").alias("id"), F.least("a", "low").alias("root")), "cc_hook")
        while True:
            up = hook.select(F.col("id").alias("root"), F.col("root").alias("up"))
            jumped = written(hook.join(up, "root").select("id", "up", F.col("root").alias("was")), "cc_jump")
            hook = jumped.select("id", F.col("up").alias("root"))
            if not jumped.where("up <> was").limit(1).count():
                break
        if labels is None:
            labels = hook
        else:
            to = hook.select(F.col("id").alias("root"), F.col("root").alias("up"))
            labels = written(labels.join(to, "root", "left").select("id", F.coalesce("up", "root").alias("root")), "cc_labels")
        ra = hook.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        rb = hook.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(ra, "a").join(rb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                        .where("a <> b").distinct(), "cc_edges")
    return labels if labels is not None else links.select(F.col("a").alias("id"), F.col("b").alias("root")).limit(0)


def equal_hashes(sl: np.ndarray, sr: np.ndarray, least: list[int]) -> np.ndarray:
    """Mask of the row pairs of two blocks that survive every batch of the sequential test."""
    equal = (sl[:, None, :BATCH] == sr[None, :, :BATCH]).sum(2, dtype=np.int32)
    i, j = np.nonzero(equal >= least[0])
    equal = equal[i, j]
    for k, m in enumerate(least[1:], 1):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (sl[i, cut] == sr[j, cut]).sum(1, dtype=np.int32)
        i, j, equal = i[equal >= m], j[equal >= m], equal[equal >= m]
    mask = np.zeros((len(sl), len(sr)), bool)
    mask[i, j] = True
    return mask


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 1 << 13) -> np.ndarray:
    """Exact intersection sizes of all pairs of two blocks of sets, as products of 0/1 matrices
    over the shingles that both blocks hold."""
    out = np.zeros((len(left), len(right)), np.float32)
    lf, rf = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(lf, rf)
    lrow, rrow = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right))
    places = []
    for flat, row in ((lf, lrow), (rf, rrow)):
        at = np.minimum(np.searchsorted(common, flat), max(0, len(common) - 1))
        ok = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        order = np.argsort(at[ok], kind="stable")
        places.append((row[ok][order], at[ok][order]))
    for c in range(0, len(common), width):
        block = []
        for (row, at), n in zip(places, (len(left), len(right))):
            x = np.zeros((n, width), np.float32)
            i, j = np.searchsorted(at, (c, c + width))
            x[row[i:j], at[i:j] - c] = 1
            block.append(x)
        out += block[0] @ block[1].T
    return out.astype(np.int64)


def forest(pairs, roots: dict) -> list[tuple[int, int]]:
    """Those of the links that join parts which earlier links and roots have not joined."""
    up: dict = {}

    def find(x):
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x
    out = []
    for a, b in pairs:
        x, y = find(roots[a]), find(roots[b])
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((min(a, b), max(a, b)))
    return out


def across(members: DataFrame, sigs: DataFrame, roots: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Verified links between different components that meet in a bucket.

    Buckets of equal membership count once.  In each bucket the largest component is held
    against all others, and these against one another, by blocks of BLOCK rows and
    BLOCK_SHINGLES shingles.  A block pair runs the sequential test on the signatures, then the
    exact test on the sets of the survivors, and returns no more links than join its parts."""
    least = least_equal(percent / 100)
    m = members.join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    same = m.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.min("root").alias("lo"),
                                   F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"), F.max("root").alias("hi"))
    one = same.where("lo <> hi").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    m = m.join(one, "bucket", "left_semi").join(sigs.select("id", "n_shingles"), "id")
    m = written(m, "neardup_mixed")
    per = m.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))

    def blocks(rows, size):
        return F.greatest(F.ceil(rows / BLOCK), F.ceil(size / BLOCK_SHINGLES), F.lit(1)).cast("int")
    top = per.groupBy("bucket").agg(F.max(F.struct("n", "root", "s")).alias("top"), F.sum("n").alias("all"), F.sum("s").alias("sum"))
    top = top.select("bucket", F.col("top.root").alias("big"), blocks(F.col("top.n"), F.col("top.s")).alias("nb"),
                     blocks(F.col("all") - F.col("top.n"), F.col("sum") - F.col("top.s")).alias("no"))
    m = m.join(top, "bucket").withColumn("large", F.col("root") == F.col("big"))
    h = F.xxhash64("id")
    m = m.withColumn("own", F.when(F.col("large"), F.pmod(h, F.col("nb"))).otherwise(F.col("nb") + F.pmod(h, F.col("no"))).cast("int"))
    small = F.sequence(F.col("nb"), F.col("nb") + F.col("no") - 1)
    other = F.when(F.col("large"), small).otherwise(F.sequence(F.lit(0), F.col("nb") + F.col("no") - 1))
    m = m.withColumn("other", F.explode(other)).select(
        "bucket", "id", "root", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own")
    m = m.join(sigs.select("id", "sig"), "id").join(needed_texts(docs, m.select("id").distinct()), "id")
    hashes = WordHashes()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        p, q = int(pdf["p"].iat[0]), int(pdf["q"].iat[0])
        parts = [pdf[pdf["own"] == p]] if p == q else [pdf[pdf["own"] == p], pdf[pdf["own"] == q]]
        left, right = parts[0], parts[-1]
        sig = [np.frombuffer(b"".join(map(bytes, x["sig"])), np.uint32).reshape(-1, HASHES) for x in (left, right)]
        mask = equal_hashes(*sig, least) & (left["root"].to_numpy()[:, None] != right["root"].to_numpy()[None, :])
        i, j = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
        found = []
        if len(i):
            sets = [[shingle_set(codes_of(t, hashes), n) for t in x["text"].iloc[k]] for x, k in ((left, i), (right, j))]
            size = [np.array([len(s) for s in x]) for x in sets]
            both = overlaps(*sets)
            ok = mask[np.ix_(i, j)] & (both > 0) & (100 * both >= percent * (size[0][:, None] + size[1][None, :] - both))
            ids = [x["id"].to_numpy() for x in (left, right)]
            links = [(int(ids[0][i[a]]), int(ids[1][j[b]])) for a, b in zip(*np.nonzero(ok))]
            found = forest(links, dict(zip(pdf["id"].tolist(), pdf["root"].tolist())))
        return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    return m.groupBy("bucket", "p", "q").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    setup(docs.sparkSession)
    t, rows = percent / 100, band_rows(percent / 100)
    every = written(signatures(docs, n, id_col, text_col), "neardup_signatures")
    first = written(every.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("rep")),
                    "neardup_copies")
    texts = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long"), F.col("text").cast("string"))
    sigs = every.join(first.select(F.col("rep").alias("id"), "key"), ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    sigs = written(sigs.select("id", "n_shingles", "sig"), "neardup_distinct")
    banded = buckets(sigs, rows)
    stars = banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    members = written(banded.join(stars.select("bucket", "low"), "bucket"), "neardup_members")
    star = members.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    links = written(verified(written(bayes(star, sigs, t), "neardup_star"), texts, n, percent), "neardup_links")
    roots = components(links)
    more = written(across(members, sigs, roots, texts, n, percent), "neardup_across")
    if more.limit(1).count():
        roots = components(links.unionByName(more))
    of = first.join(roots.withColumnRenamed("id", "rep"), "rep", "left").select("key", F.coalesce("root", "rep").alias("root"))
    out = every.select("id", "key", "n_shingles").join(of, "key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("root", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows, all columns, of the documents that are the smallest id of their component.  Only rows
    that may have to go are shuffled."""
    drop = near_duplicates(docs, n, percent, id_col, text_col).where("NOT kept")
    drop = written(drop.select(F.col(id_col).alias("id")).distinct(), "neardup_dropped")
    names = docs.columns
    at = names.index(id_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("id", F.col(f"c{at}").cast("long"))
    rows = flagged(plain, drop)
    kept = rows.where("NOT _maybe").unionByName(rows.where("_maybe").join(drop, "id", "left_anti").select(rows.columns))
    return kept.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
