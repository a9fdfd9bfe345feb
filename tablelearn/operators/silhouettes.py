"""Silhouette with Euclidean distance.

The mean distance of a row to a cluster has no closed form, so distances are needed, but never as
rows: a tile of rows against rows gives only, for each row, the sum of its distances per
cluster.  Up to ``exact_cost`` row pairs all tiles are computed: each block of rows meets every other
block in its own task, and what leaves the task is one row.  Beyond, every row is
measured against reference rows, the same number of every cluster with the smallest hashes,
and the spread between disjoint parts of the references gives the standard error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.errors import ModelError
from tablelearn.functions.exprs import col_of
from tablelearn.operators import blocks

#: Row pairs that are computed exactly, rows of one side of a tile, references per cluster and their parts.
EXACT_COST = 4_000_000_000
TILE_ROWS = 2048
REFERENCES = 1024
PARTS = 8
MAX_CLUSTERS = 1000


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all rows of b, feature by feature (no cancellation)."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j:j + 1] - b[None, :, j]
        out += d * d
    return np.sqrt(out)


def scores(sums: np.ndarray, sizes: np.ndarray, own: np.ndarray, itself: np.ndarray) -> np.ndarray:
    """Silhouettes from summed distances (rows, clusters) to ``sizes`` rows of each cluster; ``itself`` is
    1 where the row is among those of its own cluster."""
    rows = np.arange(len(sums))
    n_own = sizes[own] - itself
    with np.errstate(divide="ignore", invalid="ignore"):
        a = sums[rows, own] / n_own
        mean = sums / sizes
        mean[rows, own] = np.inf
        b = mean.min(1)
        top = np.maximum(a, b)
        return np.where((n_own <= 0) | (top == 0), 0.0, (b - a) / top)


def _numbered(df: DataFrame, vec: str, cluster: str) -> tuple[DataFrame, list, list[int]]:
    """(x, c): rows with the number of their cluster; rows with a null take no part."""
    rows = df.select(F.col(vec).cast("array<double>").alias("x"), col_of(cluster).alias("k")).dropna()
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLUSTERS + 1).collect()
    if len(sizes) > MAX_CLUSTERS:
        raise ModelError(f"more than {MAX_CLUSTERS} clusters")
    if len(sizes) < 2:
        raise ModelError("silhouette needs at least 2 clusters")
    sizes = sorted((r["k"], r["n"]) for r in sizes)
    number = F.create_map(*[F.lit(v) for i, (k, _) in enumerate(sizes) for v in (k, i)])
    return rows.select("x", number[F.col("k")].cast("double").alias("c")), [k for k, _ in sizes], [n for _, n in sizes]


def silhouette(df: DataFrame, vec: str, cluster: str, exact_cost: int = EXACT_COST, references: int = REFERENCES) -> DataFrame:
    """(silhouette, standard_error, n) in one row; the error is 0 where all pairs were computed."""
    rows, _, sizes = _numbered(df, vec, cluster)
    n = sum(sizes)
    rows = rows.persist()
    if n * n <= exact_cost:
        value, error = _exact(rows, n, np.array(sizes, np.float64)), 0.0
    else:
        value, error = _referenced(rows, n, np.array(sizes, np.float64), references)
    rows.unpersist()
    return df.sparkSession.createDataFrame([(value, error, n)], "silhouette double, standard_error double, n long")


def _exact(rows: DataFrame, n: int, sizes: np.ndarray) -> float:
    """Every tile: block i of the rows is sent to the tasks of all blocks."""
    n_blocks = max(1, -(-n // TILE_ROWS))
    tile = rows.withColumn("_b", F.pmod(F.xxhash64("x", F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int"))
    tile = tile.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def one(key: tuple, table: pa.Table) -> pa.Table:
        x, c = blocks.matrix(table["x"].combine_chunks()), table["c"].to_numpy().astype(int)
        mine = table["_b"].to_numpy() == key[0].as_py()
        some, own = x[mine], c[mine]
        sums = np.zeros((len(some), len(sizes)))
        for at in range(0, len(x), TILE_ROWS):
            d = distances(some, x[at:at + TILE_ROWS])
            cluster = c[at:at + TILE_ROWS]
            for k in np.unique(cluster):
                sums[:, k] += d[:, cluster == k].sum(1)
        return pa.table({"s": [float(scores(sums, sizes, own, np.ones(len(some))).sum())]})

    got = tile.groupBy("_to").applyInArrow(one, "s double")
    return got.agg(F.sum("s").alias("s")).first()["s"] / n


def _referenced(rows: DataFrame, n: int, sizes: np.ndarray, references: int) -> tuple[float, float]:
    """All rows against reference rows; the part of a reference is a hash, so all parts estimate the same."""
    marked = rows.withColumn("_id", F.monotonically_increasing_id())  # rows are persisted, so a row keeps its number
    share = [min(1.0, 1.5 * references / s) for s in sizes]
    limit = F.element_at(F.array(*[F.lit(int(v * (1 << 30)) + 1) for v in share]), F.col("c").cast("int") + 1)
    h = F.pmod(F.xxhash64(F.lit("reference"), "_id"), F.lit(1 << 30))
    near = marked.where(h < limit).select("x", "c", "_id", h.alias("_h")).collect()  # about 1.5 x references per cluster
    k = len(sizes)
    chosen = [r for c in range(k) for r in sorted((r for r in near if r["c"] == c), key=lambda r: r["_h"])[:references]]
    ref = np.array([r["x"] for r in chosen])
    who, ids = np.array([int(r["c"]) for r in chosen]), np.array([r["_id"] for r in chosen])
    part = np.arange(len(chosen)) % PARTS
    shared = rows.sparkSession.sparkContext.broadcast((ref, who, ids, part))

    def run(batches):
        ref, who, ids, part = shared.value
        slot = part * k + who
        count = np.bincount(slot, minlength=PARTS * k).reshape(PARTS, k)
        total = np.zeros(PARTS + 1)
        for b in batches:
            x, c, i = blocks.matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False).astype(int), b.column(2).to_numpy()
            for at in range(0, len(x), TILE_ROWS):
                some, own, me = x[at:at + TILE_ROWS], c[at:at + TILE_ROWS], i[at:at + TILE_ROWS]
                d = distances(some, ref)
                hit = me[:, None] == ids[None, :]
                sums = np.stack([d[:, slot == s].sum(1) for s in range(PARTS * k)], 1).reshape(-1, PARTS, k)
                for p in range(PARTS):
                    total[p] += scores(sums[:, p], count[p].astype(float), own, hit[:, part == p].sum(1)).sum()
                total[PARTS] += scores(sums.sum(1), count.sum(0).astype(float), own, hit.sum(1)).sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    got = marked.select("x", "c", "_id").mapInArrow(run, "v binary")
    sums = np.zeros(PARTS + 1)
    for r in got.collect():  # nine numbers per partition
        sums += np.frombuffer(r["v"], np.float64)
    shared.destroy()
    per_part = sums[:PARTS] / n
    return float(sums[PARTS] / n), float(per_part.std(ddof=1) / np.sqrt(PARTS))
