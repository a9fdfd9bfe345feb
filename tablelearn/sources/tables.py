"""Table sources: parquet/CSV scans with explicit schemas, and source-with-fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablelearn.errors import DataLoadError

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Parquet scan; selecting ``columns`` lets Catalyst prune the ReadSchema."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass; types cannot drift)."""
    try:
        return (spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
                .option("nanValue", "NaN").csv(path))
    except Exception as e:  # analysis errors, missing path
        raise DataLoadError(f"cannot read CSV at {path}: {e}") from e


def paths_exist(spark: SparkSession, paths) -> bool:
    """Hadoop FS existence check for every path, on the driver (no job)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        if not jp.getFileSystem(hconf).exists(jp):
            return False
    return True


def is_folder(spark: SparkSession, path: str) -> bool:
    jp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jp).isDirectory())


def read_or_default(spark: SparkSession, paths, reader, default_df: DataFrame | None,
                    allow_default: bool = True, persist_to: str | None = None) -> tuple[DataFrame, str]:
    """Use the real sources only if *all* exist; otherwise the caller's substitute.

    Returns ``(df, origin)`` with origin ``"real"`` or ``"default"``.  The substitute
    is written to ``persist_to`` when given, as the real files would have been.
    """
    paths = list(paths)
    if paths and paths_exist(spark, paths):
        return reader(paths), "real"
    if not allow_default or default_df is None:
        raise DataLoadError(f"sources missing and no fallback allowed: {paths}")
    if persist_to:
        default_df.write.mode("overwrite").parquet(persist_to)
        default_df = spark.read.parquet(persist_to)
    return default_df, "default"
