"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group that no shard boundary may cut.  Groups are sorted by size
and each enters the bin whose remaining capacity is the tightest that still holds it, found
in a balanced tree of remaining capacities.  ``pack`` minimises shards of a fixed capacity;
``level`` searches the smallest capacity for which a fixed number of shards suffices, which
makes their sizes near equal (the ``bytes`` law).

At scale the packed items are bounded: a group above 1/64 of a mean shard is an item of its
own (at most 64 per shard can exist), all smaller groups join one of 256 hash cells per
shard (fewer, 64 at least, beyond some thousand shards), whole, and the cells are items.  So the driver packs at most 320 items per shard
whatever the number of rows, and each row finds its shard by two bounded broadcast joins.

Null text has size 8 like empty text and shares its group and its checksum (0).  Repeated
rows each take a slot; a null id is kept; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tablelearn.llm.common import pick, setup, written

CELLS_PER_SHARD = 256
LARGE_PER_SHARD = 64
#: Units that the driver packs, or twice as many where cells were halved to fit.
MAX_UNITS = 2_000_000


class Capacities:
    """Treap of (remaining, bin): ``tightest(size)`` takes out the smallest remaining >= size."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _node(key):
        return [key, zlib.crc32(repr(key).encode()), None, None]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, remaining: int, which: int) -> None:
        left, right = self._split(self.root, (remaining, which))
        self.root = self._join(self._join(left, self._node((remaining, which))), right)

    def tightest(self, size: int):
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        first = right
        while first[2] is not None:
            first = first[2]
        key = first[0]
        _, rest = self._split(right, (key[0], key[1] + 1))
        self.root = self._join(left, rest)
        return key


def pack(items: list[tuple], capacity: int, most: int | None = None) -> dict | None:
    """{key: bin} by best-fit decreasing; None if more than ``most`` bins or a larger item."""
    tree, out, bins = Capacities(), {}, 0
    for key, size in sorted(items, key=lambda x: (-x[1], str(x[0]))):
        if size > capacity:
            return None
        found = tree.tightest(size)
        if found is None:
            if bins == most:
                return None
            found, bins = (capacity, bins), bins + 1
        out[key] = found[1]
        tree.add(found[0] - size, found[1])
    return out


def level(items: list[tuple], shards: int) -> dict:
    """{key: shard} with the smallest capacity that needs no more than ``shards`` bins; a group
    larger than an equal share of what is left has a shard to itself."""
    out, left = {}, sorted(items, key=lambda x: (-x[1], str(x[0])))
    total, at = sum(s for _, s in left), 0
    while left and at < shards - 1 and left[0][1] * (shards - at) > total:
        key, size = left.pop(0)
        out[key], total, at = at, total - size, at + 1
    if not left:
        return out
    low = max(left[0][1], -(-total // (shards - at)))
    high, step = low, max(1, low // 4096)
    while (best := pack(left, high, shards - at)) is None:
        high, step = high + step, step * 2
    while low < high:  # not quite monotone, but each success is a valid packing
        mid = (low + high) // 2
        found = pack(left, mid, shards - at)
        if found is None:
            low = mid + 1
        else:
            best, high = found, mid
    return out | {k: at + b for k, b in best.items()}


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, _group): one pass over the texts, nothing wide leaves it."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    return pick(docs, _id=id_col, _text=text_col).select(
        F.col("_id").alias(id_col), (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_group"))


def _unit(cells: int):
    return F.pmod(F.col("_group"), F.lit(cells)).cast("int")


def fill(items: list[tuple], capacity: int) -> dict:
    """{key: shard} by best-fit decreasing into shards of a fixed capacity, as few as it finds; an item
    above the capacity has a shard to itself."""
    large = [k for k, s in sorted(items, key=lambda x: (-x[1], str(x[0]))) if s > capacity]
    rest = pack([x for x in items if x[1] <= capacity], capacity)
    return {k: i for i, k in enumerate(large)} | {k: len(large) + b for k, b in rest.items()}


def placement(rows: DataFrame, shards: int | None, capacity: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Shard of each large group and of each cell, both of bounded size, and the cell count: ``shards``
    shards of near equal bytes, or as few as fit of ``capacity`` bytes."""
    spark = rows.sparkSession
    groups = rows.groupBy("_group").agg(F.sum("size").alias("size"))
    groups = written(groups, "binpack_groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    about = shards if capacity is None else max(1, -(-total // capacity))
    cells = about * max(LARGE_PER_SHARD, min(CELLS_PER_SHARD, MAX_UNITS // about))
    large = F.col("size") > (total // (LARGE_PER_SHARD * about) if capacity is None else capacity // LARGE_PER_SHARD)
    while True:
        units = (groups.select(F.when(large, F.col("_group")).alias("g"), F.when(~large, _unit(cells)).alias("cell"), "size")
                 .groupBy("g", "cell").agg(F.sum("size").alias("size")).limit(MAX_UNITS * 2 + 1).collect())
        if len(units) > MAX_UNITS * 2:
            raise ValueError(f"more than {MAX_UNITS * 2} units to pack; raise the capacity")
        if capacity is None or all(r["size"] <= capacity for r in units if r["cell"] is not None):
            break
        cells *= 2  # a cell must fit a shard
    items = [((r["g"], r["cell"]), r["size"]) for r in units]
    shard = level(items, shards) if capacity is None else fill(items, capacity)
    big = [(k[0], v) for k, v in shard.items() if k[0] is not None]
    small = [(k[1], v) for k, v in shard.items() if k[1] is not None]
    return (spark.createDataFrame(big, "_group long, _big int"), spark.createDataFrame(small, "_cell int, _small int"),
            cells)


def place(rows: DataFrame, plan: tuple) -> DataFrame:
    """Add ``shard``; both join sides have a bound that does not grow with the rows."""
    big, small, cells = plan
    out = (rows.withColumn("_cell", _unit(cells)).join(F.broadcast(big), "_group", "left")
           .join(F.broadcast(small), "_cell", "left"))
    return out.withColumn("shard", F.coalesce("_big", "_small")).drop("_big", "_small", "_cell")


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                    rows_per_run: int = 200_000, capacity: int | None = None) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard): slots are gapless in each shard.

    With ``capacity`` the law is ``capacity``: as few shards as fit, none above so many bytes but
    for a single group that is larger.  A shard is numbered run by run: rows fall into hash runs of
    about ``rows_per_run``, runs are counted, and only the rows of one run are ranked together;
    rows that are alike in everything fall apart by their place in the written table."""
    setup(docs.sparkSession)
    rows = written(measured(docs, id_col, text_col).withColumn("_place", F.monotonically_increasing_id()), "binpack_rows")
    plan = placement(rows, None if capacity else shards, capacity)
    if capacity:
        shards = 1 + max(t.agg(F.coalesce(F.max(c), F.lit(0))).first()[0] for t, c in zip(plan, ("_big", "_small")))
    runs = max(16, -(-rows.count() // (shards * rows_per_run)))
    placed = place(rows, plan).withColumn("_run", F.pmod(F.xxhash64("_place", F.lit("run")), F.lit(runs)).cast("int"))
    counts = placed.groupBy("shard", "_run").agg(F.count(F.lit(1)).alias("_n"))  # at most shards * runs rows
    before = W.partitionBy("shard").orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = placed.withColumn("_rank", F.row_number().over(
        W.partitionBy("shard", "_run").orderBy(id_col, "text_crc32", "size", "_place")))
    return (ranked.join(F.broadcast(starts), ["shard", "_run"])
            .select(id_col, "size", "text_crc32", F.lit("capacity" if capacity else "bytes").alias("law"), "shard",
                    (F.col("_start") + F.col("_rank") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = 24, text_col: str = "text", capacity: int | None = None) -> None:
    """Write the rows, all columns, into one folder per shard; groups stay whole.  With ``capacity`` as
    few shards as fit.  A column ``shard`` of the rows moves the folders to ``_shard``; an empty
    table writes no folder."""
    setup(docs.sparkSession)
    at = docs.columns.index(text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumn("_group", F.xxhash64(F.coalesce(f"c{at}", F.lit(""))))
    size = F.octet_length(F.coalesce(f"c{at}", F.lit(""))).cast("long") + 8
    placed = place(plain, placement(plain.select("_group", size.alias("size")), None if capacity else shards, capacity))
    clash = {"shard"} & {n.lower() for n in docs.columns}
    out = placed.select(F.col("shard").alias("_shard" if clash else "shard"),
                        *[F.col(f"`{n}`").alias(o) for n, o in zip(names, docs.columns)])
    out.write.partitionBy(out.columns[0]).parquet(path)
