"""Many small files packed into few large ones, once.

A folder of small files costs a task its opening time per file, and Spark plans its tasks by the number
of files.  ``pack_files`` and ``pack_images`` copy a folder into Parquet packs of near equal bytes, in
the order of the paths, beside a manifest (path, length, pack).  A pack is one file written by
one task, so later jobs follow bytes.  ``pack_files`` keeps the contents as they are; ``pack_images``
keeps the decoded pixels, with height -1 where a file is no image, so that readers treat bad files
as they do unpacked.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelearn.errors import DataLoadError
from tablelearn.session import shared_dir
from tablelearn.sources.tables import paths_exist

PACK_BYTES = 128 << 20
#: Packs of one folder, whose first paths go to all tasks.
MAX_PACKS = 1_000_000


def plan(files: DataFrame, pack_bytes: int) -> DataFrame:
    """(path, length, pack): a file belongs to the pack in which its first byte lies, all files of the
    folder in the order of their paths.

    The running sum is taken inside range partitions and shifted by the sums of those before, so
    no task sees more than one partition's paths."""
    spark = files.sparkSession
    at = shared_dir(spark, "pack_paths")
    files.select("path", "length").repartitionByRange("path").withColumn("_p", F.spark_partition_id()).write.parquet(at)
    placed = spark.read.parquet(at)
    before, shift = 0, []
    for r in placed.groupBy("_p").agg(F.sum("length").alias("n")).orderBy("_p").collect():  # one row per partition
        shift.append((r["_p"], before))
        before += r["n"] or 0
    shifts = spark.createDataFrame(shift or [(0, 0)], "_p int, _shift long")
    own = F.sum("length").over(Window.partitionBy("_p").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(own, F.lit(0)) + F.col("_shift")
    return placed.join(F.broadcast(shifts), "_p").select("path", "length", F.floor(start / F.lit(pack_bytes)).cast("int").alias("pack"))


def _pack_of(first: list[tuple[str, int]]):
    """path → its pack, from the first path of every pack."""
    paths, packs = [p for p, _ in first], [k for _, k in first]

    @F.pandas_udf("int")
    def pack(path: pd.Series) -> pd.Series:
        return pd.Series([packs[bisect.bisect_right(paths, p) - 1] for p in path], dtype="int32")
    return pack


def _write(spark: SparkSession, files: DataFrame, rows: DataFrame, out: str, pack_bytes: int, on: Column) -> str:
    """Packs and manifest of ``files``; ``rows`` holds what is kept of them, ``on`` the path of a row."""
    at = shared_dir(spark, "pack_plan")
    plan(files, pack_bytes).write.parquet(at)
    planned = spark.read.parquet(at)
    first = planned.groupBy("pack").agg(F.min("path").alias("path")).orderBy("path").limit(MAX_PACKS + 1).collect()
    if not first:
        raise DataLoadError("no files to pack")
    if len(first) > MAX_PACKS:
        raise DataLoadError(f"more than {MAX_PACKS} packs; raise pack_bytes")
    number = {r["pack"]: i for i, r in enumerate(first)}  # packs without a first byte of a file do not exist
    pack = _pack_of([(r["path"], number[r["pack"]]) for r in first])
    # The contents cross the network once; a pack's number is its partition.
    rows.withColumn("pack", pack(on)).repartitionById(len(first), "pack").sortWithinPartitions("path").write.mode("overwrite").parquet(f"{out}/packs")
    renumbered = spark.createDataFrame([(k, v) for k, v in number.items()], "pack int, _n int")
    manifest = planned.join(F.broadcast(renumbered), "pack").select("path", "length", F.col("_n").alias("pack"))
    manifest.repartitionByRange("path").write.mode("overwrite").parquet(f"{out}/manifest")
    return out


def pack_files(spark: SparkSession, root: str, out: str, glob: str | None = None, pack_bytes: int = PACK_BYTES) -> str:
    """(path, length, content, pack) of every file under ``root``; empty files are left out, as Spark's
    file readers leave them out."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    read = read.option("pathGlobFilter", glob) if glob else read
    files = read.load(root)
    return _write(spark, files.select("path", "length"), files.select("path", "length", "content"), out, pack_bytes, F.col("path"))


def pack_images(spark: SparkSession, root: str, out: str, pack_bytes: int = PACK_BYTES) -> str:
    """(path, height, width, channels, data, pack) of every file with an image's extension under ``root``."""
    from tablelearn.sources import images

    files = images.list_files(spark, root).where(images.has_image_ext(F.col("path")))
    rows = images.decoded(spark, root)
    # The image source writes file:///a where the listing has file:/a.
    same = rows.withColumn("path", F.regexp_replace("path", "^file:///", "file:/")).where(images.has_image_ext(F.col("path")))
    return _write(spark, files.withColumn("path", F.regexp_replace("path", "^file:///", "file:/")), same, out, pack_bytes, F.col("path"))


def is_packed(spark: SparkSession, root: str) -> bool:
    return paths_exist(spark, [f"{root}/manifest", f"{root}/packs"])


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/manifest")


def read_packs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/packs").drop("pack")
