"""Image-classification workflow (the reference's projects D and F).

images (files, or the 8×8 embedding stand-in as RGB) → stratified split by key →
HOG + colour histogram at 64×64 (one kernel per Arrow batch, features persisted once) →
scaler fitted on train → classifier by backend name → report, confusion, predictions with
a lookup table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.operators import classify, images, metrics, scale, split
from tablelearn.plans.views import emb_images


def stand_in_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = emb_images(spark, sf_dir)
    rgb = F.flatten(F.zip_with("pixels", F.reverse("pixels"), lambda r, g: F.array(r, g, 255 - r)))
    return e.select("vec_id", "label", rgb.alias("rgb"))


def featurize(df: DataFrame, key: str, h: int, w: int, size: int = 64, hist_mode: str = "density") -> DataFrame:
    f = images.image_features(df, key, "rgb", h, w, size, hist_mode, keep=("label", "split"))
    return f.select(key, "label", "split", array_to_vector("features").alias("raw"))


def run(spark: SparkSession, sf_dir: str, backend: str = "forest", test: float = 0.2, val: float = 0.0,
        seed: int = 42, n_classes: int = 10, **model_kw) -> dict[str, DataFrame]:
    src = stand_in_rgb(spark, sf_dir)
    parts = split.stratified(src, "vec_id", "label", test, val, seed)
    feats = featurize(parts, "vec_id", 8, 8).persist(StorageLevel.MEMORY_AND_DISK)
    train = feats.where("split = 'train'")
    mean, std = scale.fit_vector_scaler(train, "raw")
    scaled = (scale.apply_vector_scaler(feats, "raw", mean, std, out="features").drop("raw")
              .persist(StorageLevel.MEMORY_AND_DISK))  # read by gamma, fit and scoring
    model = classify.fit_classifier(scaled.where("split = 'train'"), "features", "label", backend, n_classes, seed,
                                    **model_kw)
    pred = (model.transform(scaled.where("split <> 'train'"))
            .select("vec_id", "split", "label", F.col("prediction").cast("int").alias("prediction"))
            .persist(StorageLevel.MEMORY_AND_DISK))  # feeds three outputs; scoring runs once
    classes = list(range(n_classes))
    return {"predictions": pred,
            "report": metrics.report(pred, "label", "prediction", classes),
            "confusion": metrics.confusion(pred, "label", "prediction", classes)}
