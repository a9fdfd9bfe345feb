"""Random forest by mixed growth.

While a node holds more than ``local_rows`` rows, it is split from histograms over bin edges: one
pass over the packed rows routes every row through all trees and counts (tree, node, feature,
bin, class) for a bounded set of open nodes; tasks add up the counts and choose the split of some nodes
each, so the driver gets splits, never counts by bin.  As soon as a node's rows fit a task, they are sent there
once and the whole subtree is grown by sorting the candidate columns, with every distinct value as
a possible threshold.  A table that fits a task skips the first part: its rows go once to every
group of trees, not once to every tree.

Nodes travel as parts, a tree's upper levels or one subtree each, compressed.  A forest of up to INLINE_NODES nodes
becomes a string of the model; of a larger one the parts stay in a table, and the rows are scored by groups of
parts, one group after another, so neither the driver nor a task ever holds the forest.

Bootstrap counts are a hash of row, tree and seed (Poisson 1), candidate features a hash of tree,
node and seed, and class counts are whole numbers, so one seed gives one forest however the rows
are partitioned.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelearn.errors import ModelError
from tablelearn.operators import blocks
from tablelearn.session import shared_dir

#: Rows and doubles that one task takes to finish a node, histogram cells of one pass, counts sorted at a
#: time inside a node, rows that choose bin edges.
LOCAL_ROWS = 50_000
LOCAL_VALUES = 1 << 25
HISTOGRAM_CELLS = 1 << 23
SORT_CELLS = 1 << 22
EDGE_ROWS = 10_000
BINS = 64
#: Nodes of a model that the driver holds; a larger one's are in a table.
INLINE_NODES = 1 << 19
#: Compressed bytes of the parts that go to the tasks in one piece, and doubles of the rows that are scored together.
GROUP_BYTES = 1 << 23
SCORE_VALUES = 1 << 22

_P = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, which spreads every bit over 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bootstrap(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1) of a hash, the limit of drawing with replacement."""
    with np.errstate(over="ignore"):
        h = mix(key.astype(np.uint64) + mix(np.array([seed * 1_000_003 + tree], np.uint64)))
    return np.searchsorted(_P, (h >> np.uint64(11)).astype(np.float64) / (1 << 53), side="right")


def candidates(width: int, count: int, tree: int, node: int, seed: int) -> np.ndarray:
    """The features a node may split on, in order."""
    if count >= width:
        return np.arange(width)
    return np.sort(np.random.default_rng((seed, tree, node)).choice(width, count, replace=False))


def best_split(left: np.ndarray, all_: np.ndarray):
    """Gain of every possible cut, from the class counts left of it (..., classes): the drop of n times the Gini impurity."""
    right = all_ - left
    n, m = left.sum(-1), right.sum(-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = (left * left).sum(-1) / n + (right * right).sum(-1) / m - (all_ * all_).sum() / all_.sum()
    return np.where((n > 0) & (m > 0), gain, -1.0)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int, tree: int, root: int, depth: int, count: int, seed: int):
    """Nodes (node, feature, threshold, class counts) of the subtree at ``root``; children of i are 2 i and 2 i + 1.

    The rows go left where x <= threshold, the middle between two neighbouring values."""
    rows = np.flatnonzero(w > 0)
    onehot = np.eye(n_classes)
    todo, out = [(root, rows, depth)], []
    while todo:
        node, rows, left_depth = todo.pop()
        ys, ws = y[rows], w[rows]
        counts = np.bincount(ys, ws, n_classes)
        if left_depth == 0 or len(rows) < 2 or np.count_nonzero(counts) < 2:
            out.append((node, -1, 0.0, counts))
            continue
        features = candidates(x.shape[1], count, tree, node, seed)
        mass = onehot[ys] * ws[:, None]
        best, split = 1e-9, None  # ties: the smallest feature, then the smallest value
        step = max(1, SORT_CELLS // (len(rows) * n_classes))
        for at in range(0, len(features), step):
            cols = x[np.ix_(rows, features[at:at + step])]
            order = np.argsort(cols, axis=0, kind="stable")
            value = np.take_along_axis(cols, order, 0)
            gain = best_split(np.cumsum(mass[order], axis=0)[:-1], counts)
            gain[value[1:] == value[:-1]] = -1.0
            f, cut = divmod(int(np.argmax(gain.T)), len(rows) - 1)
            if gain[cut, f] > best:
                best, split = gain[cut, f], (int(features[at + f]), value[cut, f], value[cut + 1, f])
        if split is None:
            out.append((node, -1, 0.0, counts))
            continue
        f, lo, hi = split
        threshold = lo + (hi - lo) / 2
        threshold = lo if threshold >= hi else threshold
        out.append((node, f, float(threshold), counts))
        goes = x[rows, f] <= threshold
        todo += [(2 * node, rows[goes], left_depth - 1), (2 * node + 1, rows[~goes], left_depth - 1)]
    return out


#: A part of a tree: its node ids start at ``root``, 0 being the upper levels, whose nodes of feature OPEN have a part of their own.
PART = "tree int, root long, size long, nodes binary"
OPEN = -2


def _part(tree: int, root: int, nodes) -> tuple:
    """A row of PART, without loss: ids follow from the order, counts of split nodes from the leaves', and counts are whole numbers."""
    nodes = sorted(nodes, key=lambda n: n[0])
    feature = np.array([n[1] for n in nodes], np.int32)
    threshold = np.array([n[2] for n in nodes], np.float64)[feature >= 0]
    counts = np.array([n[3] for n in nodes if n[1] < 0]).astype(np.int64)
    leaf, kind = np.nonzero(counts)
    each = np.bincount(leaf, minlength=len(counts)).astype(np.int32)
    raw = [np.array([len(nodes), len(leaf)], np.int64), feature, threshold, each, kind.astype(np.int32), counts[leaf, kind]]
    return tree, root, len(nodes), zlib.compress(b"".join(p.tobytes() for p in raw), 6)


def _part_batch(*part) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(part, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                                      ["tree", "root", "size", "nodes"])


def _unpacked(root: int, raw: bytes, n_classes: int):
    """Ids, features, thresholds, places of the left children and class counts of the nodes of a part, by id."""
    raw = zlib.decompress(raw)
    n, filled = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out
    feature = take(np.int32, n)
    inner = feature >= 0
    threshold, left, counts = np.zeros(n), np.full(n, -1, np.int64), np.zeros((n, n_classes))
    threshold[inner] = take(np.float64, int(inner.sum()))
    left[inner] = 2 * np.arange(int(inner.sum())) + 1
    leaf = np.repeat(np.flatnonzero(~inner), take(np.int32, n - int(inner.sum())))
    kind = take(np.int32, filled)
    counts[leaf, kind] = take(np.int64, filled)
    ids, levels, a, b = np.full(n, max(root, 1), np.int64), [], 0, 1
    while a < b:
        split = np.flatnonzero(inner[a:b]) + a
        ids[left[split]], ids[left[split] + 1] = 2 * ids[split], 2 * ids[split] + 1
        levels.append(split)
        a, b = b, b + 2 * len(split)
    for split in reversed(levels):
        counts[split] = counts[left[split]] + counts[left[split] + 1]
    return ids, feature, threshold, left, counts


def _received(parts, n_classes: int) -> pa.Table:
    """(tree, node, feature, threshold, counts) of the parts (tree, root, nodes) of whole trees."""
    out = []
    for tree, root, raw in parts:
        ids, feature, threshold, _, counts = _unpacked(root, raw, n_classes)
        keep = feature != OPEN
        n, counts = int(keep.sum()), np.ascontiguousarray(counts[keep])
        data = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, 8 * n_classes * (n + 1), 8 * n_classes, dtype=np.int32)),
                                                      pa.py_buffer(counts)])
        out.append(pa.RecordBatch.from_arrays([pa.array(np.full(n, tree, np.int32)), *(pa.array(c[keep]) for c in (ids, feature, threshold)), data],
                                              ["tree", "node", "feature", "threshold", "counts"]))
    return pa.Table.from_batches(out)


def shares(counts: np.ndarray) -> np.ndarray:
    return (counts / np.maximum(counts.sum(1, keepdims=True), 1e-300)).astype(np.float32)


def joined(parts, n_classes: int) -> dict[str, np.ndarray]:
    """Flat arrays, as ``votes`` takes them, of one tree from its parts (root, nodes) by root; where a part is
    missing, no class gets a share, nor does one from upper levels of root -1."""
    at, starts, some = 0, {}, []
    for root, raw in parts:
        ids, feature, threshold, left, counts = _unpacked(root, raw, n_classes)
        if root > 0:
            starts[root] = at
        some.append((ids, feature.copy(), threshold, np.where(left >= 0, left + at, -1), shares(counts)))
        at += len(ids)
    ids, feature, threshold, left, share = some[0]
    for i in np.flatnonzero(feature == OPEN):  # all rows go on to the part, none to the right
        if int(ids[i]) in starts:
            feature[i], threshold[i], left[i] = 0, np.inf, starts[int(ids[i])]
        share[i] = 0.0
    if parts[0][0] < 0:
        share[:] = 0.0
    cols = [np.concatenate(c) for c in list(zip(*some))[1:]]
    return {"begin": np.zeros(1, np.int64)} | dict(zip(("feature", "threshold", "left", "share"), cols))


def _arrays(table: pa.Table):
    """x, label and key of the blocks in a table of one group, in the order of their keys."""
    xs, ys, ks = [], [], []
    for b in table.to_batches():
        for x, y, k in blocks.unpack(b):
            xs.append(x)
            ys.append(y)
            ks.append(k)
    x, y, k = np.concatenate(xs), np.concatenate(ys).astype(np.int64), np.concatenate(ks)
    return x, y, k.view(np.int64)


def routed(x: np.ndarray, levels: dict) -> np.ndarray:
    """The open node that each row reaches in a tree whose split nodes are {node: (feature, threshold)}."""
    at = np.ones(len(x), np.int64)
    moving = np.arange(len(x))
    while len(moving):
        nodes, inverse = np.unique(at[moving], return_inverse=True)
        split = np.array([n in levels for n in nodes.tolist()])
        if not split.any():
            break
        f = np.array([levels.get(n, (0, 0.0))[0] for n in nodes.tolist()])
        t = np.array([levels.get(n, (0, 0.0))[1] for n in nodes.tolist()])
        keep = split[inverse]
        moving, inverse = moving[keep], inverse[keep]
        at[moving] = 2 * at[moving] + (x[moving, f[inverse]] > t[inverse])
    return at


def _edges(df: DataFrame, x: str, n: int) -> np.ndarray:
    """(features, BINS - 1) candidate thresholds: quantiles of EDGE_ROWS rows of smallest hash (all, if fewer)."""
    share = min(1.0, 1.2 * EDGE_ROWS / n)
    some = df.where(F.pmod(F.xxhash64(F.lit("edges"), "_key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = some.orderBy(F.xxhash64("_key"), x).limit(EDGE_ROWS).select(x).collect()
    m = np.array([r[0] for r in rows], np.float64)
    at = np.sort(m, axis=0)[(np.arange(1, BINS) * (len(m) - 1) / BINS).astype(int)]
    return np.ascontiguousarray(at.T)


def _top(packed: DataFrame, edges: np.ndarray, n: int, n_classes: int, trees: int, depth: int, count: int, seed: int, local_rows: int):
    """Split nodes per tree, finished nodes, and open nodes that fit a task with the class counts of each."""
    width = len(edges)
    done: list[dict] = [{} for _ in range(trees)]
    leaves, ready = [], []
    sc = packed.sparkSession.sparkContext
    level = [(t, 1) for t in range(trees)]
    per_pass = max(1, HISTOGRAM_CELLS // (count * (BINS + 1) * n_classes))
    while level:
        after = []
        for at in range(0, len(level), per_pass):
            some = level[at:at + per_pass]
            wanted: dict[int, list] = {}
            for slot, (t, node) in enumerate(some):
                wanted.setdefault(t, []).append((node, slot, candidates(width, count, t, node, seed)))
            shared = sc.broadcast((wanted, {t: done[t] for t in wanted}, edges))

            def kernel(x, y, key):
                wanted, splits, edges = shared.value
                out = np.zeros((len(some), count, BINS, n_classes))
                label, key = y.astype(np.int64), key.view(np.int64)
                for t, nodes in wanted.items():
                    w = bootstrap(key, t, seed)
                    where = routed(x, splits[t])
                    for node, slot, features in nodes:
                        rows = np.flatnonzero((where == node) & (w > 0))
                        for j, f in enumerate(features):
                            b = np.searchsorted(edges[f], x[rows, f], side="left")
                            out[slot, j] = np.bincount(b * n_classes + label[rows], w[rows], BINS * n_classes).reshape(BINS, n_classes)
                return [out]
            cells = count * BINS * n_classes

            def judge(_, hist):
                """Class counts, gain, feature and cut of the best split of every node in a piece."""
                out = []
                for h in hist.reshape(-1, count, BINS, n_classes):
                    counts = h[0].sum(0)
                    gain = best_split(np.cumsum(h, axis=1)[:, :-1], counts)
                    j, cut = divmod(int(np.argmax(gain)), BINS - 1)
                    out.append((counts, float(gain[j, cut]), j, cut))
                return out
            each = max(1, blocks.DIRECT_VALUES // cells)
            found = blocks.pieces(blocks.sums(packed, kernel, len(some) * cells), each * cells, -(-len(some) // each), judge).collect()
            shared.destroy()
            best = [v for _, part in sorted(found, key=lambda p: p[0]) for v in part]
            for (t, node), (counts, gain, j, cut) in zip(some, best):
                if 0 < counts.sum() <= local_rows:
                    ready.append((t, node, int(counts.sum())))
                    leaves.append((t, node, OPEN, 0.0, counts))
                    continue
                d = node.bit_length() - 1
                if d >= depth or np.count_nonzero(counts) < 2 or gain <= 1e-9:
                    leaves.append((t, node, -1, 0.0, counts))
                    continue
                f = int(candidates(width, count, t, node, seed)[j])
                done[t][node] = (f, float(edges[f, cut]))
                leaves.append((t, node, f, float(edges[f, cut]), counts))
                after += [(t, 2 * node), (t, 2 * node + 1)]
        level = after
    return done, leaves, ready


def fit(df: DataFrame, features: str, label: str, n_classes: int, num_trees: int = 200, max_depth: int = 20, n_candidates: int | None = None,
        seed: int = 42, local_rows: int = LOCAL_ROWS, key: str | None = None) -> "ForestModel":
    """A forest over ``features`` (vectors) with class numbers in ``label``; sqrt of the width as candidates.

    ``key`` names a column that tells rows apart for the bootstrap; without it the hash of the
    row's features and label does, so that equal rows are drawn alike.  Rows with nulls take no part."""
    x = vector_to_array(F.col(features))
    mark = F.xxhash64(F.col(key)) if key else F.xxhash64(x, F.col(label))
    # The key travels as the bits of a double.
    rows = df.select(x.alias("_x"), F.col(label).cast("double").alias("_y"), mark.alias("_key")).dropna().persist()
    first = rows.select(F.size("_x").alias("w")).first()
    if first is None:
        raise ModelError("cannot fit on an empty table")
    n, width = rows.count(), first["w"]
    count = n_candidates or max(1, math.ceil(math.sqrt(width)))
    local_rows = max(1, min(local_rows, LOCAL_VALUES // max(1, width)))
    packed = _packed(rows)
    spark = df.sparkSession
    if n <= local_rows:
        groups = max(1, min(num_trees, spark.sparkContext.defaultParallelism))

        def per_group(name: tuple, table: pa.Table):
            x, y, k = _arrays(table.drop_columns(["_g"]))
            for t in range(name[0].as_py(), num_trees, groups):
                yield _part_batch(*_part(t, 1, grow(x, y, bootstrap(k, t, seed), n_classes, t, 1, max_depth, count, seed)))

        sent = packed.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        sent = sent.select("rows", "x", "s0", "s1", "_g").repartitionByRange(groups, "_g")
        parts = sent.groupBy("_g").applyInArrow(lambda name, table: pa.Table.from_batches(list(per_group(name, table))), PART).persist()
    else:
        packed, path = packed.persist(), shared_dir(spark, "forest")
        edges = _edges(rows, "_x", n)
        done, top, ready = _top(packed, edges, n, n_classes, num_trees, max_depth, count, seed, local_rows)
        upper: dict[int, list] = {}
        for v in top:
            upper.setdefault(v[0], []).append(v[1:])
        spark.createDataFrame([_part(t, 0, nodes) for t, nodes in sorted(upper.items())], PART).write.parquet(path)
        wave, size = [], 0
        for r in [*sorted(ready), None]:  # a wave's rows are at most a few times the table's
            if r is not None and (not wave or size + r[2] <= 8 * n):
                wave.append(r)
                size += r[2]
                continue
            if wave:
                _finish(packed, done, wave, n_classes, max_depth, count, seed, path)
            wave, size = ([r], r[2]) if r else ([], 0)
        packed.unpersist()
        parts = spark.read.schema(PART).parquet(path)
    model = _model(parts, path if n > local_rows else "", features, num_trees, n_classes)
    rows.unpersist()
    parts.unpersist()
    return model


def _model(parts: DataFrame, path: str, features: str, num_trees: int, n_classes: int) -> "ForestModel":
    """The model of the parts, which are in the table ``path`` if it is given."""
    if parts.agg(F.sum("size")).first()[0] <= INLINE_NODES:
        nodes = _received(((r["tree"], r["root"], bytes(r["nodes"])) for r in parts.orderBy("tree", "root").collect()), n_classes)
        return ForestModel(featuresCol=features, trees=encoded(nodes, num_trees, n_classes), classes=n_classes)
    if not path:
        path = shared_dir(parts.sparkSession, "forest")
        parts.write.parquet(path)
    return ForestModel(featuresCol=features, table=path, classes=n_classes)


def _packed(rows: DataFrame) -> DataFrame:
    """(rows, x, label, key) blocks; the key is kept bit by bit."""
    def run(batches):
        for b in batches:
            step = max(1, blocks.BLOCK_VALUES // max(1, len(b.column(0)[0]) if len(b) else 1))
            for at in range(0, len(b), step):
                some = b.slice(at, step)
                cols = [blocks.matrix(some.column(0)), some.column(1).to_numpy(zero_copy_only=False), some.column(2).to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays([pa.array([len(some)], pa.int32()),
                                                  *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cols]],
                                                 ["rows", "x", "s0", "s1"])
    return rows.mapInArrow(run, "rows int, x binary, s0 binary, s1 binary")


def _finish(packed: DataFrame, done, wave, n_classes: int, max_depth: int, count: int, seed: int, path: str) -> None:
    """The parts below some open nodes, added to the table ``path``: each one's rows go to one task."""
    wanted: dict[int, list[int]] = {}
    for t, node, _ in wave:
        wanted.setdefault(t, []).append(node)
    spark = packed.sparkSession
    shared = spark.sparkContext.broadcast((wanted, {t: done[t] for t in wanted}))

    def send(batches):
        wanted, splits = shared.value
        for b in batches:
            for x, y, key in blocks.unpack(b):
                for t, nodes in wanted.items():
                    w = bootstrap(key.view(np.int64), t, seed)
                    where = np.where(w > 0, routed(x, splits[t]), 0)
                    for node in nodes:
                        r = np.flatnonzero(where == node)
                        if len(r):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([len(r)], pa.int32()), *[pa.array([c[r].tobytes()], pa.binary()) for c in (x, y, key)],
                                 pa.array([t], pa.int32()), pa.array([node], pa.int64())], ["rows", "x", "s0", "s1", "_t", "_n"])

    def subtree(name: tuple, table: pa.Table) -> pa.Table:
        t, node = name[0].as_py(), name[1].as_py()
        x, y, k = _arrays(table.drop_columns(["_t", "_n"]))
        left = max_depth - (node.bit_length() - 1)
        return pa.Table.from_batches([_part_batch(*_part(t, node, grow(x, y, bootstrap(k, t, seed), n_classes, t, node, left, count, seed)))])

    sent = packed.mapInArrow(send, "rows int, x binary, s0 binary, s1 binary, _t int, _n long")
    sent.groupBy("_t", "_n").applyInArrow(subtree, PART).write.mode("append").parquet(path)
    shared.destroy()


def flat(nodes: pa.Table, trees: int, n_classes: int) -> dict[str, np.ndarray]:
    """Trees as flat arrays: where each begins, feature, threshold, left child, class shares."""
    tree, node = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    order = np.lexsort((node, tree))
    tree, node = tree[order], node[order]
    feature, threshold = nodes["feature"].to_numpy()[order].astype(np.int32), nodes["threshold"].to_numpy()[order]
    counts = np.frombuffer(b"".join(nodes["counts"].to_pylist()), np.float64).reshape(-1, n_classes)[order]
    begin = np.searchsorted(tree, np.arange(trees))
    left = np.full(len(node), -1, np.int32)
    for t in range(trees):
        a, b = begin[t], begin[t + 1] if t + 1 < trees else len(node)
        split = np.flatnonzero(feature[a:b] >= 0) + a
        left[split] = np.searchsorted(node[a:b], 2 * node[split]) + a
    return {"begin": begin.astype(np.int64), "feature": feature, "threshold": threshold, "left": left, "share": shares(counts)}


def encoded(nodes: pa.Table, trees: int, n_classes: int) -> str:
    """The flat arrays, compressed."""
    a = flat(nodes, trees, n_classes)
    parts = [np.array([len(nodes), trees, n_classes], np.int64), *a.values()]
    return base64.b64encode(zlib.compress(b"".join(p.tobytes() for p in parts))).decode()


def grouped(rows):
    """Lists of (tree, its parts) of about GROUP_BYTES or one part, from rows of PART by tree and root; the upper levels of a tree
    are in every list that has parts of it."""
    some, size, upper = [], 0, None
    for r in rows:
        part = r["root"], bytes(r["nodes"])
        if some and size + len(part[1]) > GROUP_BYTES:
            yield some
            some, size = [], 0
        if not some or some[-1][0] != r["tree"]:
            # A list that goes on in a tree begins with this tree's upper levels, whose own leaves have been counted.
            again = [(-1, upper[1][1])] if part[0] and upper and upper[0] == r["tree"] else []
            some.append((r["tree"], again))
        if not part[0]:
            upper = r["tree"], part
        some[-1][1].append(part)
        size += len(part[1])
    if some:
        yield some


class _Writer(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        table = self.instance.getOrDefault(self.instance.table)
        super().saveImpl(path)
        if table:
            self.sparkSession.read.schema(PART).parquet(table).write.parquet(path.rstrip("/") + "/trees")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model._set(table=path.rstrip("/") + "/trees") if model.getOrDefault(model.table) else model


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Sum of the leaves' class shares over all trees; the class of the largest share is predicted.

    The trees are in ``trees`` or, if they are large, in the Parquet table ``table``, which is saved with the model."""

    trees = Param(Params._dummy(), "trees", "flat arrays of all trees, compressed", typeConverter=TypeConverters.toString)
    table = Param(Params._dummy(), "table", "folder of the parts of the trees; empty: they are in trees", typeConverter=TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction", probabilityCol="probability", rawPredictionCol="rawPrediction",
                 trees="", classes=2, table=""):
        super().__init__()
        self._setDefault(trees="", classes=2, table="")
        self._set(**self._input_kwargs)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def parts(self, spark) -> DataFrame:
        """The parts of a model in a table, by tree and root, in partitions of about GROUP_BYTES."""
        rows = spark.read.schema(PART).parquet(self.getOrDefault(self.table))
        size = rows.agg(F.sum(F.length("nodes"))).first()[0]
        return rows.repartitionByRange(max(1, -(-size // GROUP_BYTES)), "tree", "root").sortWithinPartitions("tree", "root")

    def arrays(self) -> dict[str, np.ndarray]:
        """All trees at once, which takes memory for the whole model."""
        if self.getOrDefault(self.table):
            got = self.parts(SparkSession.active()).collect()
            nodes = _received(((r["tree"], r["root"], bytes(r["nodes"])) for r in got), self.getOrDefault(self.classes))
            return flat(nodes, got[-1]["tree"] + 1, self.getOrDefault(self.classes))
        raw = zlib.decompress(base64.b64decode(self.getOrDefault(self.trees)))
        n, trees, k = np.frombuffer(raw, np.int64, 3).tolist()
        at, out = 24, {}
        for name, kind, count in (("begin", np.int64, trees), ("feature", np.int32, n), ("threshold", np.float64, n), ("left", np.int32, n),
                                  ("share", np.float32, n * k)):
            out[name] = np.frombuffer(raw, kind, count, at)
            at += out[name].nbytes
        return out | {"share": out["share"].reshape(n, k)}

    def _voting(self, spark):
        shared = spark.sparkContext.broadcast(self.arrays())

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def vote(s: pd.Series) -> pd.Series:
            return pd.Series(list(votes(shared.value, np.stack(s.to_numpy()))) if len(s) else [], dtype=object)
        return vote

    def _voting_by_groups(self, spark):
        """The driver passes on one group of parts at a time, a task takes them one after another for many rows."""
        if not hasattr(self, "_groups"):
            self._groups = [spark.sparkContext.broadcast(g) for g in grouped(self.parts(spark).toLocalIterator())]
        groups, k = self._groups, self.getOrDefault(self.classes)

        def voted(xs):
            x = np.concatenate(xs)
            out = np.zeros((len(x), k))
            for g in groups:
                for _, parts in g.value:
                    out += votes(joined(parts, k), x)
                if getattr(g, "_path", None):  # it is read again from its file when it is needed
                    g.__dict__.pop("_value", None)
            return pd.Series(list(out), dtype=object)

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            xs, size = [], 0
            for s in batches:
                if len(s):
                    xs.append(np.stack(s.to_numpy()))
                    size += xs[-1].size
                if size >= SCORE_VALUES:
                    yield voted(xs)
                    xs, size = [], 0
            if xs:
                yield voted(xs)
        return vote

    def _transform(self, df: DataFrame) -> DataFrame:
        vote = (self._voting_by_groups if self.getOrDefault(self.table) else self._voting)(df.sparkSession)
        raw, prob = self.getRawPredictionCol(), self.getProbabilityCol()
        out = df.withColumn(raw, vote(vector_to_array(F.col(self.getFeaturesCol()))))
        out = out.withColumn(self.getPredictionCol(), (F.array_position(raw, F.array_max(raw)) - 1).cast("double"))
        total = F.aggregate(raw, F.lit(0.0), lambda a, v: a + v)
        return out.withColumn(prob, array_to_vector(F.transform(raw, lambda v: v / total))).withColumn(raw, array_to_vector(F.col(raw)))


def votes(a: dict, x: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Summed class shares of the rows; all trees of some rows go down together."""
    out = np.empty((len(x), a["share"].shape[1]))
    step = max(1, block // max(1, len(a["begin"])))
    for at in range(0, len(x), step):
        some = x[at:at + step]
        node = np.tile(a["begin"], (len(some), 1))
        row = np.arange(len(some))[:, None]
        while True:
            f = a["feature"][node]
            if (f < 0).all():
                break
            right = some[row, np.maximum(f, 0)] > a["threshold"][node]
            node = np.where(f >= 0, a["left"][node] + right, node)
        out[at:at + step] = a["share"][node].sum(1, dtype=np.float64)
    return out
