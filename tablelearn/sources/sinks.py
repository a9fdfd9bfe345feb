"""Sinks: tables (parquet/CSV), JSON reports, an append-only runs table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                single_file: bool = False, partition_by=None) -> str:
    """Distributed write; ``single_file`` only when the caller asks (it funnels one task)."""
    w = (df.coalesce(1) if single_file else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def report_json(df: DataFrame, name_col: str | None = None, out: str = "json") -> DataFrame:
    """Each row as one JSON object string (nested columns kept)."""
    cols = [c for c in df.columns if c != name_col]
    j = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]))
    return df.select(*([name_col] if name_col else []), j.alias(out))


def write_report(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def append_run(spark: SparkSession, runs_path: str, row: DataFrame) -> DataFrame:
    """Append a one-row run summary to the runs table and return the table."""
    row.write.mode("append").parquet(runs_path)
    return spark.read.parquet(runs_path)
