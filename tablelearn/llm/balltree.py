"""Exact top-k inner-product search: a ball tree per shard, branch and bound, shared k-th score.

Vectors are dealt to shards by a hash of their id.  Each shard builds a ball tree over its
vectors (median split along the widest direction; centre and radius per node).  A block of
queries descends the tree together; a node q.c + |q| r below a query's k-th best score so
far cannot hold a better row and is cut.  Leaves that survive are visited in the order of
their bounds.  The k-th score is shared: a first round searches only a hash sample of the
vectors, and every shard then starts from the k-th scores found there.  Slack on the bounds
covers floating-point error, so no row that could enter the result, ties included, is cut.

Queries are a stated set and are taken in blocks of bounded size, each broadcast to all
shards; per block and shard at most k rows a query leave the task.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows
without id.  Rows that share a query's id are its own.  Vectors of another length than the
query's are no candidates.  Ties go to the smaller id; repeated candidate rows count once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tablelearn.llm.common import pick, setup, written

LEAF = 128
#: Rows of a shard, rows of a query block, and what part of the vectors the first round searches.
SHARD_ROWS = 5_000
BLOCK_ROWS = 20_000
FIRST_PART = 16
LOW = np.iinfo(np.int64).min


def quantise(v, scale: float = 256.0):
    """floor(scale * x) as exact integers: int64, or Python integers beyond its safe range."""
    x = np.floor(np.asarray(v, np.float64) * scale)
    if x.size and np.abs(x).max() > 2 ** 62:
        return np.vectorize(int, otypes=[object])(x)
    return x.astype(np.int64)


class BallTree:
    """Nodes in one list, breadth first: centre, radius, children or rows."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        f = x.astype(np.float64)
        self.centre, self.radius, self.child, self.rows = [], [], [], []
        todo = [np.arange(len(x))]
        self._add(f, todo[0])
        at = 0
        while at < len(self.rows):
            rows = self.rows[at]
            if len(rows) > leaf and self.radius[at] > 0:
                far = f[rows] - self.centre[at]
                axis = far[np.argmax((far * far).sum(1))]
                side = far @ axis
                order = np.argsort(side, kind="stable")
                half = len(rows) // 2
                self.child[at] = (self._add(f, rows[np.sort(order[:half])]), self._add(f, rows[np.sort(order[half:])]))
                self.rows[at] = None
            at += 1
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.size = np.sqrt((self.centre * self.centre).sum(1)) + self.radius

    def _add(self, f, rows) -> int:
        c = f[rows].mean(0)
        d = f[rows] - c
        self.centre.append(c)
        self.radius.append(float(np.sqrt((d * d).sum(1).max())))
        self.child.append(None)
        self.rows.append(rows)
        return len(self.rows) - 1

    def leaves(self, q: np.ndarray, low: np.ndarray):
        """(query, leaf, bound) of all leaves that may hold a score of at least ``low``."""
        q = q.astype(np.float64)
        norm = np.sqrt((q * q).sum(1))
        found, level = [], [(0, np.arange(len(q)))]
        while level:
            below = []
            for node, who in level:
                bound = q[who] @ self.centre[node] + norm[who] * self.radius[node]
                bound += 1e-9 * (norm[who] * self.size[node] + 1)
                keep = bound >= low[who]
                if not keep.any():
                    continue
                if self.child[node] is None:
                    found.append((who[keep], np.full(int(keep.sum()), node), bound[keep]))
                else:
                    below += [(c, who[keep]) for c in self.child[node]]
            level = below
        return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, int)] * 2 + [np.zeros(0)]


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products, as int64; beyond 64 bits they saturate."""
    if q.dtype != object and x.dtype != object:
        top = np.sqrt((q.astype(float) ** 2).sum(1).max(initial=0) * (x.astype(float) ** 2).sum(1).max(initial=0))
        if top < 2 ** 52:
            return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
        if top < 2 ** 62 and max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) < 2 ** 62:
            return q @ x.T
    s = q.astype(object) @ x.astype(object).T
    return np.vectorize(lambda v: max(LOW + 1, min(-LOW - 1, v)), otypes=[np.int64])(s)


def search(ids: np.ndarray, x: np.ndarray, qid: np.ndarray, q: np.ndarray, low: np.ndarray, k: int) -> pd.DataFrame:
    """Best k rows of one shard for each query, none with a score under ``low``."""
    tree = BallTree(x)
    best = np.full((len(q), k), LOW, np.int64)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    who, leaf, bound = tree.leaves(q, low.astype(np.float64))
    order = np.lexsort((-bound, who))
    who, leaf, bound = who[order], leaf[order], bound[order]
    turn = np.arange(len(who)) - np.searchsorted(who, who)
    kth = low.astype(np.float64)
    for t in range(turn.max(initial=-1) + 1):
        now = np.flatnonzero(turn == t)
        now = now[bound[now] >= kth[who[now]]]
        if not len(now):
            break  # bounds fall along a query's leaves, so later ones are cut as well
        for node in np.unique(leaf[now]):
            mine = who[now[leaf[now] == node]]
            rows = tree.rows[node]
            s = exact_scores(q[mine], x[rows])
            s = np.where((ids[rows][None, :] == qid[mine][:, None]) | (s < low[mine][:, None]), LOW, s)
            if s.shape[1] > 4 * k:  # all rows that reach the k-th place of this leaf, ties included
                cut = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                cols = np.flatnonzero((s >= np.maximum(cut, best[mine, -1])[:, None]).any(0))
                s, rows = s[:, cols], rows[cols]
            both = np.concatenate((best[mine], s), 1)
            both_id = np.concatenate((best_id[mine], np.broadcast_to(ids[rows], s.shape)), 1)
            both_id = np.where(both == LOW, np.iinfo(np.int64).max, both_id)
            take = np.lexsort((both_id, ~both), axis=1)[:, :k]
            best[mine] = np.take_along_axis(both, take, 1)
            best_id[mine] = np.take_along_axis(both_id, take, 1)
            kth[mine] = np.maximum(kth[mine], best[mine, -1].astype(np.float64) * (1 - 1e-12))
    hit = best != LOW
    where = np.nonzero(hit)
    return pd.DataFrame({"query_id": qid[where[0]], "vec_id": best_id[hit], "score": best[hit]})


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part, repeated rows once."""
    v = F.col("_v").cast("array<double>")
    rows = pick(vectors, vec_id=id_col, _v=vec_col).select(F.col("vec_id").cast("long"), v.alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id ``every`` divides."""
    spark = setup(vectors.sparkSession)
    rows = written(valid(vectors, id_col, vec_col).dropDuplicates(["vec_id", "v"]), "balltree_vectors")
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS))
    rows = rows.withColumn("_h", F.xxhash64("vec_id")).withColumn("_shard", F.pmod("_h", F.lit(shards)).cast("int"))
    queries = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    out = None
    for b in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)) == b)
        part = _block(spark, rows, mine, k, scale, shards)
        out = part if out is None else out.unionByName(part)
    return out


def _block(spark, rows, mine, k, scale, shards):
    qs = mine.select("vec_id", "v").toPandas()  # a block of bounded size
    by_dim = {}
    for i, v in zip(qs["vec_id"].tolist(), qs["v"]):
        by_dim.setdefault(len(v), []).append((i, v))
    asked = {d: (np.array([i for i, _ in r], np.int64), quantise(np.stack([v for _, v in r]), scale))
             for d, r in by_dim.items()}
    schema = "query_id long, vec_id long, score long"

    def searcher(shared):
        def run(key, pdf):
            found = []
            known = shared.value
            for dim, part in pdf.groupby(pdf["v"].map(len)):
                if dim not in known["asked"]:
                    continue
                qid, q = known["asked"][dim]
                low = np.array([known["low"].get(i, LOW + 1) for i in qid.tolist()], np.int64)
                part = part.sort_values("vec_id")
                found.append(search(part["vec_id"].to_numpy(), quantise(np.stack(part["v"]), scale), qid, q, low, k))
            return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
        return run

    def best(df):
        w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return df.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    low = {}
    if shards > 1:
        first = rows.where(F.pmod(F.shiftright("_h", 20), F.lit(FIRST_PART)) == 0)
        shared = spark.sparkContext.broadcast({"asked": asked, "low": {}})
        first_shards = max(1, shards // FIRST_PART)
        seen = first.withColumn("_shard", F.pmod("_h", F.lit(first_shards)).cast("int")).groupBy("_shard") \
            .applyInPandas(searcher(shared), schema)
        low = {r["query_id"]: r["score"] for r in best(seen).where(F.col("rank") == k).collect()}
    shared = spark.sparkContext.broadcast({"asked": asked, "low": low})
    found = rows.repartition(shards, "_shard").groupBy("_shard").applyInPandas(searcher(shared), schema)
    return best(found).select("query_id", "rank", "vec_id", "score")
