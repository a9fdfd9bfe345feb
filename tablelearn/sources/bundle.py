"""Model bundle: one saved Spark PipelineModel plus a one-row metadata table
(ordered feature names, classes, metrics).  Loading fails if any part is missing."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tablelearn.errors import ModelError
from tablelearn.sources.tables import paths_exist


def save_bundle(spark: SparkSession, model, path: str, features, classes=None, metrics: dict | None = None) -> str:
    pm = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    pm.write().overwrite().save(f"{path}/model")
    meta = spark.createDataFrame(
        [([str(f) for f in features], [str(c) for c in (classes or [])],
          {k: float(v) for k, v in (metrics or {}).items()})],
        "features array<string>, classes array<string>, metrics map<string,double>")
    meta.write.mode("overwrite").parquet(f"{path}/meta")
    return path


def load_bundle(spark: SparkSession, path: str):
    if not paths_exist(spark, [f"{path}/model", f"{path}/meta"]):
        raise ModelError(f"incomplete model bundle at {path}")
    model = PipelineModel.load(f"{path}/model")
    meta = spark.read.parquet(f"{path}/meta").first()
    return model, list(meta["features"]), list(meta["classes"]), dict(meta["metrics"] or {})
