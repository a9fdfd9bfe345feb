"""Feature vectors as packed matrix blocks, and sums of numpy kernels over all of them.

Iterative learners read the same rows many times and need only a few sums per step.  ``pack`` turns
rows into blocks of doubles once (to be persisted); ``total`` runs a kernel on every block,
adds up inside each task, and adds the tasks' sums piece by piece in further tasks, so the driver
receives few vectors however many partitions there are.  A feature map is applied to a slice of a block at a time while
the kernel runs: its image, often a thousand times as wide as the rows, is never kept or sent.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.session import ship_package

#: Doubles in one block, doubles of a feature map's image at a time, and doubles that the driver, or a
#: task that adds up, takes from all tasks of a step.
BLOCK_VALUES = 1 << 19
IMAGE_VALUES = 1 << 18
DIRECT_VALUES = 1 << 17


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def tasks(df: DataFrame, rows: int, least: int) -> DataFrame:
    """``df`` for iterative fits, which run one small job per step: tasks of ``least`` rows or more, and
    no more of them than the cores take in two rounds."""
    n = max(1, -(-rows // least))
    most = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(n) if n <= most else df.repartition(most)


def pack(df: DataFrame, vec: str, scalars=()) -> DataFrame:
    """(rows int, x binary, s0 binary, s1 ...): blocks of row-major doubles, one column per scalar.

    ``vec`` is an ML vector or an array of doubles; rows where it or a scalar is null are left out, as a
    fit can use neither."""
    ship_package(df.sparkSession)
    vector = df.schema[vec].dataType.typeName() == "vectorudt"
    if vector:
        from pyspark.ml.functions import vector_to_array
        x = vector_to_array(F.col(vec))
    else:
        x = F.col(vec).cast("array<double>")
    rows = df.select(x.alias("_x"), *[F.col(s).cast("double").alias(f"s{i}") for i, s in enumerate(scalars)]).dropna()
    names = [f"s{i}" for i in range(len(scalars))]

    def run(batches):
        for b in batches:
            step = max(1, BLOCK_VALUES // max(1, len(b.column(0)[0]) if len(b) else 1))
            for at in range(0, len(b), step):
                some = b.slice(at, step)
                cols = [np.ascontiguousarray(matrix(some.column(0)), np.float64).tobytes()]
                cols += [some.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for i in range(len(scalars))]
                yield pa.RecordBatch.from_arrays([pa.array([len(some)], pa.int32()), *[pa.array([c], pa.binary()) for c in cols]],
                                                 ["rows", "x", *names])

    return rows.mapInArrow(run, "rows int, x binary" + "".join(f", {s} binary" for s in names))


def unpack(b: pa.RecordBatch):
    """(x, scalar, ...) arrays of every block in a batch."""
    for i in range(len(b)):
        n = b.column(0)[i].as_py()
        x = np.frombuffer(b.column(1)[i].as_buffer(), np.float64).reshape(n, -1)
        yield x, *(np.frombuffer(b.column(c)[i].as_buffer(), np.float64) for c in range(2, b.num_columns))


def slices(row, via=None):
    """(x, scalar, ...) arrays of a row of ``pack``; with ``via``, x is the image of some rows at a time."""
    x = np.frombuffer(row[1], np.float64).reshape(row[0], -1)
    scalars = [np.frombuffer(c, np.float64) for c in row[2:]]
    if via is None:
        yield x, *scalars
        return
    step = max(1, IMAGE_VALUES // max(1, via(x[:1]).shape[1]))
    for at in range(0, len(x), step):
        yield via(x[at:at + step]), *(c[at:at + step] for c in scalars)


def pieces(parts, piece: int, chunks: int, finish=None):
    """The sum of the vectors (index, array) that an RDD holds, as (number, piece of ``piece`` values): every
    piece is added up in a task of its own, in the order of the partitions, and goes through ``finish``."""
    def add(group):
        v = sum(v for _, v in sorted(group[1], key=lambda p: p[0]))
        return group[0], finish(group[0], v) if finish else v

    most = parts.context.defaultParallelism
    return parts.flatMap(lambda p: ((c, (p[0], p[1][c * piece:(c + 1) * piece])) for c in range(chunks))).groupByKey(min(chunks, most), int).map(add)


def added(parts, size: int) -> np.ndarray:
    """The sum of the vectors (index, array) that an RDD holds, one per partition; the driver gets few more
    values than one vector has.  The same tasks give the same sum each time."""
    n = parts.getNumPartitions()
    if n > 1 and n * size > DIRECT_VALUES:
        piece = max(1, -(-size // -(-n * size // DIRECT_VALUES)))
        return np.concatenate([v for _, v in sorted(pieces(parts, piece, -(-size // piece)).collect(), key=lambda p: p[0])])
    return sum((v for _, v in parts.collect()), np.zeros(size))


def sums(blocks: DataFrame, kernel, size: int, via=None):
    """An RDD with (partition, sum over its blocks of what ``kernel`` returns, laid end to end)."""
    def run(i, rows):
        out = np.zeros(size)
        for r in rows:
            for some in slices(r, via.value if via else None):
                at = 0
                for g in kernel(*some):
                    g = np.asarray(g, np.float64).ravel()
                    out[at:at + len(g)] += g
                    at += len(g)
        yield i, out
    return blocks.rdd.mapPartitionsWithIndex(run)


def total(blocks: DataFrame, kernel, shapes, via=None) -> list[np.ndarray]:
    """Sums over all blocks of the arrays (of the given shapes) that ``kernel(x, *scalars)`` returns, x
    being the rows or, with a broadcast feature map ``via``, their image.

    This is the inner step of iterative fits, so it is an aggregation over the rows of the (persisted)
    blocks rather than a query: there is nothing to optimise, and planning would cost more than the
    step.  Tasks are added in the order of their partitions, so a step on the same blocks gives the same sums
    each time.  Call it again on the same DataFrame, which keeps its row view."""
    size = sum(math.prod(s) for s in shapes)

    flat = added(sums(blocks, kernel, size, via), size)
    out, at = [], 0
    for s in shapes:
        out.append(flat[at:at + math.prod(s)].reshape(s))
        at += math.prod(s)
    return out
