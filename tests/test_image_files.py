import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.errors import DataLoadError
from tablelearn.plans import image_files
from tablelearn.sources import images as imgsrc
from tests.conftest import write_png


def _make(root, rel, colour, rng, size=(12, 16)):
    h, w = size
    base = np.array(colour, dtype=float)
    img = np.clip(base + rng.normal(0, 8, size=(h, w, 3)), 0, 255).astype(int)
    path = os.path.join(root, rel)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    write_png(path, [[tuple(int(v) for v in img[y, x]) for x in range(w)] for y in range(h)])


def test_folder_layout_forest_and_kcal_table(spark, tmpdir_path):
    rng = np.random.default_rng(0)
    for i in range(10):
        _make(tmpdir_path, f"pizza/{i}.png", (220, 40, 30), rng)
        _make(tmpdir_path, f"sushi/{i}.png", (30, 60, 220), rng, size=(16, 12))
    with open(os.path.join(tmpdir_path, "sushi", "bad.png"), "wb") as f:
        f.write(b"fake")
    out = image_files.train_classifier(spark, tmpdir_path, "folder", backend="forest", num_trees=100, max_depth=5,
                                       runs_path=f"{tmpdir_path}-runs")
    run = out["runs"].first()
    assert (run["n_images"], run["n_skipped"]) == (20, 1) and run["elapsed_seconds"] > 0 and 0 <= run["accuracy"] <= 1
    assert out["classes"] == ["pizza", "sushi"]
    pred = out["predictions"]
    assert pred.count() == 4
    acc = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert acc >= 0.75  # 16 training images, 1812-d: the point is the file path, not the learner
    new = {}
    for i in range(3):
        _make(tmpdir_path + "-new", f"in/p{i}.png", (220, 40, 30), rng, size=(20, 10))
    for r in image_files.score_folder(spark, tmpdir_path + "-new/in", out["model"], out["scaler"], out["classes"]).collect():
        new[r["id"]] = r["predicted_class"]
    assert set(new) == {"p0", "p1", "p2"} and set(new.values()) <= {"pizza", "sushi"}
    kcal = spark.createDataFrame([("pizza", 266), ("default", 250)], "class string, kcal int")
    t = image_files.predictions_with_kcal(pred, out["classes"], kcal).collect()
    assert {r["true_class"]: r["true_calories_kcal_100g"] for r in t} == {"pizza": 266, "sushi": 250}


def test_prefix_layout_svm(spark, tmpdir_path):
    rng = np.random.default_rng(1)
    for i in range(10):
        _make(tmpdir_path, f"train/cat.{i}.png", (200, 200, 200), rng)
        _make(tmpdir_path, f"train/dog.{i}.png", (20, 20, 20), rng)
    out = image_files.train_classifier(spark, f"{tmpdir_path}/train", "prefix", ["cat", "dog"], backend="svm_rbf",
                                       test=0.2, val=0.1, C=5.0, n_components=300)
    sizes = {r["split"]: r["n"] for r in out["predictions"].groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"test": 4, "val": 2}


def test_gesture_tree_epochs(spark, tmpdir_path):
    rng = np.random.default_rng(2)
    for s in ("s1", "s2"):
        for i in range(6):
            _make(tmpdir_path, f"{s}/fist/{i}.png", (240, 240, 240), rng)
            _make(tmpdir_path, f"{s}/palm/{i}.png", (10, 10, 10), rng)
            _make(tmpdir_path, f"{s}/other/{i}.txt.png", (120, 0, 0), rng)
    sched = image_files.train_gestures(spark, tmpdir_path, ["fist", "palm"], rounds=2, iters_per_round=2, lr=0.03, copies=0)
    assert [r["lr"] for r in sched["history"].orderBy("epoch").collect()][0] == 0.03
    out = image_files.train_gestures(spark, tmpdir_path, ["fist", "palm"], rounds=3, iters_per_round=3)
    h = out["history"].collect()
    assert 1 <= len(h) <= 3 and all(0 <= r["val_acc"] <= 1 for r in h)
    if "report" in out:
        assert {r["label"] for r in out["report"].collect()} >= {"0", "1", "accuracy"}


def test_no_images_is_an_error_and_labels_come_from_paths(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/none")
    with open(f"{tmpdir_path}/none/a.txt", "w") as f:
        f.write("x")
    with pytest.raises(DataLoadError):
        image_files.score_folder(spark, f"{tmpdir_path}/none", None, None, [])
    rng = np.random.default_rng(0)
    for c in ("a", "b"):
        _make(tmpdir_path, f"imgs/{c}/1.png", (1, 2, 3), rng)
    assert image_files.class_names(spark, f"{tmpdir_path}/imgs") == ["a", "b"]
    plan = image_files.label_files(imgsrc.list_files(spark, f"{tmpdir_path}/imgs"), "folder", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "content" not in plan
