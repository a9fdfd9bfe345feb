"""k-means: Spark ML fits with restarts (best inertia kept, canonical cluster ids),
fixed-init Lloyd steps, nearest-centroid assignment and the elbow curve.

Centroids are k×d (k bounded and checked), so assignment is a map-only projection
against a literal matrix; each Lloyd step is one groupBy with k output rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.errors import ModelError, SizeBoundError
from tablelearn.functions.exprs import WIDE_DIM, grouped_vector_sums, matrix_literal, order_hash, vec_sqdist
from tablelearn.operators import blocks

MAX_K = 1000
ROWS_PER_TASK = 20_000
#: Rows that a task compares with the centres of a run at a time.
SLICE_ROWS = 2048


def assemble(df: DataFrame, cols, out: str = "x") -> DataFrame:
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def assign(df: DataFrame, vec: str, centroids, out: str = "cluster") -> DataFrame:
    """Nearest centroid (squared Euclidean); ties go to the lower cluster id."""
    if len(centroids) > MAX_K:
        raise SizeBoundError("too many centroids for a literal assignment")
    mat = matrix_literal(centroids)
    d = F.transform(mat, lambda c, i: F.struct(vec_sqdist(F.col(vec), c).alias("d"), i.alias("c")))
    return df.withColumn(out, F.array_min(d)["c"].cast("int"))


def centroid_means(df: DataFrame, vec: str, cluster: str, dim: int, k: int, previous=None):
    """Per-cluster means (k rows collected); an empty cluster keeps its previous centre."""
    if dim > WIDE_DIM:
        got = {c: [s / n for s in sums] for c, (n, sums) in grouped_vector_sums(df, cluster, vec, dim, MAX_K).items()}
    else:
        rows = df.groupBy(cluster).agg(*[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(dim)]).collect()
        got = {r[cluster]: [float(r[f"m{i}"]) for i in range(dim)] for r in rows}
    return [got.get(c, previous[c] if previous else None) for c in range(k)]


def hash_seeds(df: DataFrame, key: str, vec: str, k: int, seed=42):
    """Initial centres: the k rows first in hash order (ids 0..k-1 in that order)."""
    rows = df.select(order_hash(key, seed).alias("_h"), F.col(key), F.col(vec)).orderBy("_h", key).limit(k).collect()
    if len(rows) < k:
        raise ModelError(f"need at least k={k} rows")
    return [list(map(float, r[vec])) for r in rows]


def lloyd(df: DataFrame, vec: str, centroids, steps: int):
    """``steps`` rounds of (assign, recompute means) from the given centres."""
    dim, k = len(centroids[0]), len(centroids)
    cents = centroids
    for _ in range(steps):
        cents = centroid_means(assign(df, vec, cents), vec, "cluster", dim, k, cents)
    return cents


def fit_kmeans(df: DataFrame, vec: str, k: int = 5, restarts: int = 10, max_iter: int = 300, seed: int = 42,
               tol: float = 1e-4, parallelism: int = 4):
    """Best of ``restarts`` Spark k-means fits (k-means|| init) by training cost.

    Returns (centroids relabelled canonically, inertia).  Canonical ids: clusters
    ordered by size descending, then by first centre coordinate.
    """
    data = df.select(array_to_vector(F.col(vec)).alias("features")).persist(StorageLevel.MEMORY_AND_DISK)
    n = data.count()
    if n < k:
        raise ModelError(f"k-means needs at least k={k} rows, got {n}")

    def one(s):
        m = KMeans(k=k, maxIter=max_iter, seed=seed + s, tol=tol, featuresCol="features").fit(data)
        return m.summary.trainingCost, s, m
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        fits = list(ex.map(one, range(restarts)))
    cost, _, best = min(fits, key=lambda t: (t[0], t[1]))
    sizes = best.summary.clusterSizes
    cents = [c.tolist() for c in best.clusterCenters()]
    order = sorted(range(k), key=lambda i: (-sizes[i], cents[i][0]))
    data.unpersist()
    return [cents[i] for i in order], float(cost)


def elbow(df: DataFrame, vec: str, key: str, ks=range(2, 11), restarts: int = 10, seed: int = 42, tol: float = 1e-4):
    """(k, inertia, between) for each k, all k and restarts in one pass per iteration; inertia plus
    between is the total sum of squares."""
    cached = df.select(key, vec).persist(StorageLevel.MEMORY_AND_DISK)
    fits = fit_kmeans_many(cached, vec, key, ks, restarts, seed=seed, tol=tol)
    rows = [(int(k), cost, between(cached, vec, cents)) for k, (cents, cost) in fits.items()]
    cached.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, between double")


def between(df: DataFrame, vec: str, centroids) -> float:
    """Sum over clusters of size times squared distance of the centre to the overall mean."""
    dim = len(centroids[0])
    sizes = {r["cluster"]: r["n"] for r in assign(df, vec, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(sizes.values())
    mean = [sum(sizes.get(c, 0) * v[i] for c, v in enumerate(centroids)) / n for i in range(dim)]
    return float(sum(sizes.get(c, 0) * sum((v[i] - mean[i]) ** 2 for i in range(dim)) for c, v in enumerate(centroids)))


def _uniform(seed: int, r, j, key: str):
    """Deterministic U(0,1] per (seed, restart, step, row key): recomputation-safe sampling."""
    h = F.xxhash64(F.lit(int(seed)), r, F.lit(int(j)), F.col(key))
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + 1.0) / float(1 << 52)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(centres, rows) squared distances; ``x`` is (dimensions, rows)."""
    out = np.zeros((len(centres), x.shape[1]))
    for i in range(len(x)):
        d = x[i] - centres[:, i, None]
        d *= d
        out += d
    return out


def _run_sums(packed: DataFrame, runs, dim: int) -> dict:
    """{(run, cluster): (rows, squared distances, sums per dimension)} of all runs in one pass over the
    packed rows; ties go to the lower centre.  The same centres always give the same sums, so a run whose
    rows stay where they are has come to rest."""
    centres = [np.array(r, np.float64) for r in runs]
    begin = np.cumsum([0, *map(len, centres)])
    shared = packed.sparkSession.sparkContext.broadcast(centres)

    def kernel(x):
        out = np.zeros((begin[-1], dim + 2))
        for at in range(0, len(x), SLICE_ROWS):
            some = x[at:at + SLICE_ROWS]
            cols, m = np.ascontiguousarray(some.T), len(some)
            table = np.concatenate((np.ones((m, 1)), np.zeros((m, 1)), some), 1)  # row, distance, coordinates
            for a, c in zip(begin, shared.value):
                d = _distances(cols, c)
                best = d.min(0)
                hit = d == best
                if np.count_nonzero(hit) == m:
                    table[:, 1] = best
                    out[a:a + len(c)] += hit.astype(np.float64) @ table
                    continue
                near = d.argmin(0)  # ties or values that are no numbers
                table[:, 1] = d[near, np.arange(m)]
                for i in range(dim + 2):
                    out[a:a + len(c), i] += np.bincount(near, table[:, i], len(c))
        return [out]
    got = blocks.total(packed, kernel, [(int(begin[-1]), dim + 2)])[0]
    shared.destroy()
    return {(i, c): (int(got[a + c, 0]), float(got[a + c, 1]), got[a + c, 2:].tolist())
            for i, (a, r) in enumerate(zip(begin, centres)) for c in range(len(r)) if got[a + c, 0] > 0}


def _next_seeds(data: DataFrame, vec: str, key: str, seeds, j: int, seed: int) -> dict:
    """{restart: next centre}: the row that wins an exponential race weighted by squared distance.  Each
    batch sends on its winners only."""
    centres = [np.array(s, np.float64) for s in seeds]
    draws = F.array(*[-F.log(_uniform(seed, F.lit(r), j, key)) for r in range(len(seeds))])

    def run(it):
        for b in it:
            if not len(b):
                continue
            x, draw = np.ascontiguousarray(blocks.matrix(b.column(1)).T), blocks.matrix(b.column(2))
            for r, c in enumerate(centres):
                d = _distances(x, c).min(0) if j else np.ones(len(b))
                with np.errstate(divide="ignore", invalid="ignore"):
                    race = draw[:, r] / d
                some = np.flatnonzero(~(d <= 0))  # a distance that is no number loses to all others
                if not len(some):
                    continue
                race = race[some]
                won = some[(race == np.nanmin(race)) if not np.isnan(race).all() else np.isnan(race)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(won), r, np.int32)), pa.array((draw[won, r] / d[won])),
                                                  b.column(0).take(pa.array(won)), b.column(1).take(pa.array(won))], ["_r", "_race", "_key", "_x"])
    kinds = f"_r int, _race double, _key {data.schema[key].dataType.simpleString()}, _x array<double>"
    x = data.select(F.col(key).alias("_key"), F.col(vec).cast("array<double>").alias("_x"), draws.alias("_draws")).mapInArrow(run, kinds)
    rows = x.groupBy("_r").agg(F.min_by("_x", F.struct("_race", "_key")).alias("c")).collect()
    return {r["_r"]: [float(v) for v in r["c"]] for r in rows}


def fit_kmeans_batched(df: DataFrame, vec: str, key: str, k: int = 5, restarts: int = 10, max_iter: int = 300,
                       tol: float = 1e-4, seed: int = 42):
    """(centres of the best restart relabelled canonically, its inertia); see ``fit_kmeans_many``."""
    return fit_kmeans_many(df, vec, key, [k], restarts, max_iter, tol, seed)[k]


def fit_kmeans_many(df: DataFrame, vec: str, key: str, ks, restarts: int = 10, max_iter: int = 300,
                    tol: float = 1e-4, seed: int = 42) -> dict:
    """k-means with k-means++ initialisation for every k and ``restarts`` runs each, batched into
    one data pass per step (like n_init): the rows are packed once, and a Lloyd iteration is one
    aggregation by (run, cluster) over the blocks, so all runs together cost one scan per iteration.

    Init: D²-weighted sampling of each next centre per restart via an exponential race
    (min of −ln(u)/d over rows, u hashed from (seed, restart, step, key)) — one job per step; the
    first k centres of a restart seed its run for k.
    Convergence per run: squared centre shift ≤ tol · mean feature variance (as the reference
    library defines tol).  Returns {k: (centres of the best run relabelled canonically, inertia)}.
    """
    ks, top = sorted(set(ks)), max(ks)
    data = df.select(F.col(key), F.col(vec)).persist(StorageLevel.MEMORY_AND_DISK)
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.first(F.size(vec)).alias("d")).first()
    n, dim = stats["n"], stats["d"]
    if n < top:
        raise ModelError(f"k-means needs at least k={top} rows, got {n}")
    if top > MAX_K:
        raise SizeBoundError(f"more than {MAX_K} clusters")
    whole, data = data, blocks.tasks(data, n, ROWS_PER_TASK).persist(StorageLevel.MEMORY_AND_DISK)  # one small job per step
    packed = blocks.pack(data, vec).persist()
    var = data.agg(*[F.var_pop(F.col(vec)[i]).alias(f"v{i}") for i in range(dim)]).first()
    tol_abs = tol * sum(float(var[f"v{i}"] or 0.0) for i in range(dim)) / dim
    # k-means++ seeding, all restarts per pass
    seeds = [[] for _ in range(restarts)]
    for j in range(top):
        got = _next_seeds(data, vec, key, seeds, j, seed)
        for r in range(restarts):
            seeds[r].append(got.get(r, seeds[r][-1] if seeds[r] else None))
    cents = {(k, r): seeds[r][:k] for k in ks for r in range(restarts)}
    # batched Lloyd
    active = sorted(cents)
    for _ in range(max_iter):
        if not active:
            break
        sums = _run_sums(packed, [cents[run] for run in active], dim)
        still = []
        for pos, run in enumerate(active):
            shift, new = 0.0, []
            for c in range(run[0]):
                row = sums.get((pos, c))
                nc = [v / row[0] for v in row[2]] if row else cents[run][c]
                shift += sum((u - v) ** 2 for u, v in zip(nc, cents[run][c]))
                new.append(nc)
            cents[run] = new
            if shift > tol_abs:
                still.append(run)
        active = still
    # inertia and sizes of every run in one pass; keep the best of each k
    runs = sorted(cents)
    sums = _run_sums(packed, [cents[run] for run in runs], dim)
    for d in (packed, data, whole):
        d.unpersist()
    cost, sizes = dict.fromkeys(runs, 0.0), {}
    for (i, c), (m, d, _) in sorted(sums.items()):
        cost[runs[i]] += d
        sizes[runs[i], c] = m
    out = {}
    for k in ks:
        best = min(((k, r) for r in range(restarts)), key=lambda run: (cost[run], run))
        order = sorted(range(k), key=lambda c: (-sizes.get((best, c), 0), cents[best][c][0]))
        out[k] = ([cents[best][c] for c in order], cost[best])
    return out
