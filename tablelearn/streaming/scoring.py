"""Stream scoring with Structured Streaming: new rows of a table are scored by a fitted
model and appended to a parquet sink.  Offsets and sink metadata live in the shared
checkpoint folder, so a restarted (or executor-lost) query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablelearn.session import shared_dir
from tablelearn.sources.tables import is_folder, table_path


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A file stream over one table of ``sf_dir``, a file or a folder of part files (schema taken
    from the batch footer)."""
    path = table_path(sf_dir, name)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, path):  # every part file, also those still to come
        return stream.parquet(path)
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def run_to_sink(scored: DataFrame, sink: str | None = None, checkpoint: str | None = None,
                available_now: bool = True):
    """Start the streaming query into a parquet sink; with ``available_now`` it processes
    everything present and stops.  Returns (query, sink path)."""
    spark = scored.sparkSession
    sink = sink or shared_dir(spark, "stream_sink")
    checkpoint = checkpoint or shared_dir(spark, "stream_ckpt")
    w = scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.outputMode("append").start()
    if available_now:
        q.awaitTermination()
    return q, sink
