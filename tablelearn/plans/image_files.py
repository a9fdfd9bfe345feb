"""Image workflows on files (the reference's projects D, F and G as a user runs them).

Layouts: "folder" (<class>/<file>, classes sorted), "prefix" (<label>.<n>.jpg, classes
given), "tree" (<subject>/<class>/<file>, classes given, subject kept for group splits).
Decoding is Spark's image source; unreadable files are skipped or fail the job (on_bad).
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelearn.errors import DataLoadError
from tablelearn.operators import classify, images, metrics, scale, split
from tablelearn.operators import score as scoring
from tablelearn.sources import images as imgsrc
from tablelearn.sources import sinks


MAX_CLASSES = 10_000


def label_files(df: DataFrame, layout: str, classes) -> DataFrame:
    """Add label (and subject for "tree") from the path alone; files of other classes go."""
    if layout == "folder":
        df = df.withColumn("class_name", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
        return df.join(F.broadcast(imgsrc.class_table(df.sparkSession, classes)), "class_name")
    if layout == "prefix":
        return imgsrc.label_by_prefix(df, "path", classes)[0]
    if layout == "tree":
        return imgsrc.index_tree(df, "path", classes)
    raise ValueError(layout)


def class_names(spark: SparkSession, root: str) -> list[str]:
    """Folder names that hold images, sorted; reads paths only."""
    files = imgsrc.list_files(spark, root).where(imgsrc.has_image_ext(F.col("path")))
    names = files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("c")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(names) > MAX_CLASSES:
        raise DataLoadError(f"more than {MAX_CLASSES} class folders under {root}")
    return sorted(r["c"] for r in names)


def labelled_images(spark: SparkSession, root: str, layout: str = "folder", classes=None,
                    on_bad: str = "skip") -> tuple[DataFrame, list]:
    """(path, label, [subject], height, width, channels, data) for every decodable, labelled image."""
    if layout == "folder" and classes is None:
        classes = class_names(spark, root)
    if label_files(imgsrc.list_files(spark, root), layout, classes).isEmpty():
        raise DataLoadError(f"no labelled images under {root}")
    return label_files(imgsrc.read_images(spark, root, on_bad=on_bad), layout, classes), list(classes)


def train_classifier(spark: SparkSession, root: str, layout: str = "folder", classes=None, backend: str = "forest",
                     test: float = 0.2, val: float = 0.0, seed: int = 42, on_bad: str = "skip",
                     hist_mode: str = "density", resample: str | None = None, runs_path: str | None = None, **model_kw) -> dict:
    """Projects D/F: HOG + histogram, split by path hash (stratified), scaler on train, classifier.

    ``resample`` defaults to the reference's: bicubic for the folder layout (F), else bilinear (D).
    ``runs_path`` appends a summary row (run id, start, elapsed, images used and skipped, accuracy).

    Every image is read and decoded once, into a persisted feature table; the split reads that
    table's path and label."""
    began = time.time()
    resample = resample or ("bicubic" if layout == "folder" else "bilinear")
    df, classes = labelled_images(spark, root, layout, classes, on_bad)
    feats = (images.image_features_sized(df, "path", 64, hist_mode, ("label",), resample)
             .select("path", "label", array_to_vector("features").alias("raw"))
             .persist(StorageLevel.MEMORY_AND_DISK))
    parts = split.stratified(feats, "path", "label", test, val, seed)
    mean, std = scale.fit_vector_scaler(parts.where("split = 'train'"), "raw")
    scaled = (scale.apply_vector_scaler(parts, "raw", mean, std, out="features").drop("raw")
              .persist(StorageLevel.MEMORY_AND_DISK))  # read by gamma, fit and scoring
    model = classify.fit_classifier(scaled.where("split = 'train'"), "features", "label", backend, len(classes), seed,
                                    **model_kw)
    pred = (model.transform(scaled.where("split <> 'train'"))
            .select("path", "split", "label", F.col("prediction").cast("int").alias("prediction"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    pred.count()
    out = {}
    if runs_path:
        n = feats.count()
        found = label_files(imgsrc.list_files(spark, root).where(imgsrc.has_image_ext(F.col("path"))), layout, classes).count()
        row = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")).select(
            F.lit(time.strftime("%Y%m%d_%H%M%S", time.gmtime(began))).alias("run_id"), F.lit(began).alias("started"),
            F.lit(time.time() - began).alias("elapsed_seconds"), F.lit(n).cast("long").alias("n_images"),
            F.lit(found - n).cast("long").alias("n_skipped"), "accuracy")
        out["runs"] = sinks.append_run(spark, runs_path, row)
    for df in (scaled, feats):
        df.unpersist()
    return out | {"model": model, "classes": classes, "scaler": (mean, std), "predictions": pred,
            "report": metrics.report(pred, "label", "prediction", list(range(len(classes))))}


def score_folder(spark: SparkSession, root: str, model, scaler, classes, hist_mode: str = "density",
                 on_bad: str = "skip", resample: str = "bilinear") -> DataFrame:
    """Unlabelled images → (id, predicted_class): the file stem is the id; no image is an error."""
    if imgsrc.list_files(spark, root).where(imgsrc.has_image_ext(F.col("path"))).isEmpty():
        raise DataLoadError(f"no images under {root}")
    feats = images.image_features_sized(imgsrc.read_images(spark, root, on_bad=on_bad), "path", 64, hist_mode, resample=resample)
    rows = scale.apply_vector_scaler(feats.select("path", array_to_vector("features").alias("raw")), "raw", *scaler, out="features")
    names = F.array(*[F.lit(c) for c in classes])
    return model.transform(rows).select(imgsrc.stem(F.col("path")).alias("id"),
                                        F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("predicted_class"))


def predictions_with_kcal(pred: DataFrame, classes, kcal: DataFrame) -> DataFrame:
    """Project F's predictions table: true/predicted class, their kcal (default for unknown), correct."""
    t = scoring.predictions_table(pred, "label", "prediction", classes, kcal, "class", "kcal")
    return t.select(F.col("true_class"), F.col("predicted_class"), F.col("true_value").alias("true_calories_kcal_100g"),
                    F.col("predicted_value").alias("predicted_calories_kcal_100g"), "correct")


def train_gestures(spark: SparkSession, root: str, classes, test: float = 0.15, val: float = 0.15, seed: int = 42,
                   hidden=(64,), rounds: int = 8, iters_per_round: int = 5, patience: int = 4, copies: int = 1,
                   lr: float | None = None) -> dict:
    """Project G: <subject>/<class>/<frame> tree → grey 64×64 → train part augmented (``copies``
    rotated/shifted versions beside each frame) → [-1, 1] → MLP trained in warm-started rounds with
    a validation history, learning-rate schedule (``lr``), early stop and best checkpoint → report."""
    df, classes = labelled_images(spark, root, "tree", classes)
    gray = images.gray_sized(df, "path", 64, keep=("label",)).persist(StorageLevel.MEMORY_AND_DISK)
    parts = split.stratified(gray, "path", "label", test, val, seed)

    def vectors(d):
        return d.select("path", "label", array_to_vector(images.normalize_pixels("gray")).alias("features"))
    train = parts.where("split = 'train'")
    px = vectors(train)
    if copies:
        px = px.unionByName(vectors(images.augment(train, "path", "gray", 64, 64, copies, seed, keep=("label",))))
    hist, best = classify.epoch_training(px, vectors(parts.where("split = 'val'")), "features", "label", len(classes),
                                         hidden=hidden, rounds=rounds, iters_per_round=iters_per_round, seed=seed,
                                         patience=patience, lr=lr)
    schema = "epoch int, train_loss double, train_acc double, val_loss double, val_acc double" + ", lr double" * (lr is not None)
    out = {"history": spark.createDataFrame(hist, schema), "best_model": best, "classes": classes}
    if best is not None:
        pred = best.transform(vectors(parts.where("split = 'test'"))).select(
            "path", "label", F.col("prediction").cast("int").alias("prediction")).persist(StorageLevel.MEMORY_AND_DISK)
        pred.count()
        out["report"] = metrics.report(pred, "label", "prediction", list(range(len(classes))))
        out["predictions"] = pred
    gray.unpersist()
    return out
