import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.errors import DataLoadError
from tablelearn.operators import images
from tablelearn.plans import image_files
from tablelearn.sources import images as imgsrc
from tablelearn.sources import packing
from tests.test_image_files import _make


def _tree(root):
    rng = np.random.default_rng(3)
    for i in range(14):
        _make(root, f"pizza/{i}.png", (220, 40, 30), rng, size=(8 + i, 12))
        _make(root, f"sushi/{i}.png", (30, 60, 220), rng, size=(12, 9 + i))
    with open(os.path.join(root, "sushi", "bad.png"), "wb") as f:
        f.write(b"fake")
    with open(os.path.join(root, "notes.txt"), "w") as f:
        f.write("not an image")


def test_packed_images_give_the_same_features(spark, tmpdir_path):
    root, out = tmpdir_path + "/in", tmpdir_path + "/packed"
    _tree(root)
    packing.pack_images(spark, root, out, pack_bytes=3000)
    manifest = packing.read_manifest(spark, out).toPandas()
    size = {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".png")}
    assert {p.removeprefix("file:"): n for p, n in zip(manifest["path"], manifest["length"])} == size
    per_pack = manifest.groupby("pack")["length"].sum()
    assert len(per_pack) >= sum(size.values()) // 3000 and per_pack.max() < 3000 + max(size.values())
    assert sorted(per_pack.index) == list(range(len(per_pack)))
    ordered = manifest.sort_values("path")["pack"].tolist()
    assert ordered == sorted(ordered)
    files = [f for f in os.listdir(out + "/packs") if f.endswith(".parquet")]
    assert len(files) == len(per_pack)  # one file, one task a pack

    def features(r):
        d = images.image_features_sized(imgsrc.read_images(spark, r), "path", 32, "density")
        return {x["path"].replace("file:///", "file:/"): x["features"] for x in d.collect()}
    plain, packed = features(root), features(out)
    assert plain == packed and len(plain) == 28
    assert [tuple(r) for r in imgsrc.skipped_counts(spark, out).collect()] == [("all", 28, 1)]
    with pytest.raises(DataLoadError):
        imgsrc.read_images(spark, out, on_bad="fail")


def test_training_from_packs(spark, tmpdir_path):
    root, out = tmpdir_path + "/in", tmpdir_path + "/packed"
    _tree(root)
    packing.pack_images(spark, root, out)
    assert image_files.class_names(spark, out) == ["pizza", "sushi"]
    got = image_files.train_classifier(spark, out, "folder", backend="svm_linear", runs_path=tmpdir_path + "/runs")
    run = got["runs"].first()
    assert got["classes"] == ["pizza", "sushi"] and (run["n_images"], run["n_skipped"]) == (28, 1) and run["accuracy"] > 0.8


def test_packed_files_keep_their_bytes(spark, tmpdir_path):
    root, out = tmpdir_path + "/in", tmpdir_path + "/packed"
    os.makedirs(root + "/a/b")
    contents = {f"{root}/a/{i:03}": os.urandom(i * 7 % 50) for i in range(40)} | {f"{root}/a/b/x.bin": b"", f"{root}/z": os.urandom(500)}
    for p, c in contents.items():
        with open(p, "wb") as f:
            f.write(c)
    packing.pack_files(spark, root, out, pack_bytes=200)
    rows = packing.read_packs(spark, out).collect()
    assert {r["path"].removeprefix("file:"): bytes(r["content"]) for r in rows} == {p: c for p, c in contents.items() if c}
    m = packing.read_manifest(spark, out)
    assert m.groupBy("pack").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] < 700
    os.makedirs(tmpdir_path + "/none")
    with pytest.raises(DataLoadError):
        packing.pack_files(spark, tmpdir_path + "/none", out + "2")
