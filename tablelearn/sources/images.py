"""Image file sources.  Discovery and label parsing read only paths (``binaryFile`` with the
content column pruned); decoding is Spark's ``image`` source on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.errors import DataLoadError
from tablelearn.sources import packing

IMAGE_EXT = r"(?i)\.(png|jpe?g)$"


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def prefix_label_name(path: Column) -> Column:
    """'cat.12.jpg' → 'cat': first '.'-part of the stem, lower-cased."""
    return F.lower(F.split(stem(path), r"\.").getItem(0))


def tree_parts(path: Column) -> tuple[Column, Column]:
    """'<subject>/<class>/<file>' → (subject, class)."""
    return (F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+$", 1), F.regexp_extract(path, r"([^/]+)/([^/]+)/[^/]+$", 2))


def has_image_ext(path: Column) -> Column:
    return F.regexp_extract(path, IMAGE_EXT, 0) != ""


def class_table(spark: SparkSession, classes) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(classes)], "class_name string, label int")


def label_by_prefix(df: DataFrame, path: str, classes) -> tuple[DataFrame, DataFrame]:
    """(kept rows with ``label``, skipped rows) — unknown prefixes are skipped, not failed."""
    spark = df.sparkSession
    x = df.withColumn("class_name", prefix_label_name(F.col(path)))
    ct = F.broadcast(class_table(spark, [c.lower() for c in classes]))
    return x.join(ct, "class_name"), x.join(ct, "class_name", "left_anti")


def index_tree(df: DataFrame, path: str, classes) -> DataFrame:
    """Keep image files whose class folder is in ``classes``; label = position in the list."""
    spark = df.sparkSession
    subj, cls = tree_parts(F.col(path))
    x = df.where(has_image_ext(F.col(path))).withColumn("subject", subj).withColumn("class_name", cls)
    return x.join(F.broadcast(class_table(spark, classes)), "class_name")


def list_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Paths (and sizes) only; the ``content`` column is never read.  A packed folder lists its manifest."""
    if not glob and packing.is_packed(spark, root):
        return packing.read_manifest(spark, root).select("path", "length")
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(root).select("path", "length")


def decoded(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, height, width, channels, data) of every file, height -1 where it is no image."""
    if packing.is_packed(spark, root):
        return packing.read_packs(spark, root)
    df = (spark.read.format("image").option("dropInvalid", "false")
          .option("recursiveFileLookup", str(recursive).lower()).load(root))
    return df.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                     F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"),
                     F.col("image.data").alias("data"))


def read_images(spark: SparkSession, root: str, on_bad: str = "skip", recursive: bool = True) -> DataFrame:
    """Decode with the ``image`` source → (path, height, width, channels, data BGR bytes).

    on_bad="skip" drops unreadable files; "fail" raises if any file cannot be decoded
    (bad files come back with height −1 when not dropped)."""
    df = decoded(spark, root, recursive)
    if on_bad == "fail":
        bad = df.where("height < 0").limit(1).count()
        if bad:
            raise DataLoadError(f"unreadable image under {root}")
    elif on_bad != "skip":
        raise ValueError(on_bad)
    return df.where("height >= 0")


def skipped_counts(spark: SparkSession, root: str, group: Column | None = None) -> DataFrame:
    """(group, n_valid, n_invalid): how many files decode and how many ``on_bad="skip"`` leaves out."""
    df = decoded(spark, root)
    return df.groupBy((group if group is not None else F.lit("all")).alias("grp")).agg(*valid_counts(F.col("height") >= 0))


def valid_counts(ok: Column) -> list[Column]:
    """Counts of usable and of skipped rows, as the readers report them."""
    return [F.count_if(ok).cast("bigint").alias("n_valid"), F.count_if(~ok).cast("bigint").alias("n_invalid")]
