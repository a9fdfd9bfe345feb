import numpy as np
import pytest

from tablelearn.errors import DataLoadError, ModelError
from tablelearn.operators import images
from tablelearn.sources import bundle
from tablelearn.sources import images as imgsrc
from tests.conftest import write_png


def test_pixel_255_in_last_bin():
    x = np.array([[[[255, 0, 128]]]], dtype=np.float64)
    h = images.color_hist_batch(x, 16, "joint").reshape(3, 16)
    assert h[0, 15] > 0 and h[1, 0] > 0 and h[2, 8] > 0


def test_ramp_hog_single_bin():
    ramp = np.tile(np.arange(16, dtype=float) * 3, (16, 1))[None]
    cells, blocks = images.hog_batch(ramp, 9, 8, 2)
    assert cells[..., 1:].sum() == 0 and cells[..., 0].sum() > 0
    assert blocks.shape == (1, 36)


def test_resize_weights_and_constant_image():
    w = images.resize_weights(8, 4)
    assert np.allclose(w.sum(1), 1.0)
    img = np.full((1, 10, 12, 3), 77, dtype=np.uint8)
    out = images.resize_batch(img, 64, 64, uint8=True)
    assert out.shape == (1, 64, 64, 3) and (out == 77).all()


def test_feature_dimension_1812(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [int(v) for v in rng.integers(0, 256, 64 * 64 * 3)]) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, rgb array<int>")
    f = images.image_features(df, "id", "rgb", 64, 64).collect()
    assert all(len(r["features"]) == 1812 for r in f)


def test_image_source_bgr_to_rgb_and_bad_files(spark, tmpdir_path):
    import os
    os.makedirs(f"{tmpdir_path}/imgs/cat")
    write_png(f"{tmpdir_path}/imgs/cat/a.png", [[(255, 0, 0), (0, 255, 0)], [(0, 0, 255), (10, 20, 30)]])
    with open(f"{tmpdir_path}/imgs/cat/broken.png", "wb") as f:
        f.write(b"fake")
    df = imgsrc.read_images(spark, f"{tmpdir_path}/imgs", on_bad="skip")
    (at, rgb), = images.same_size_batches(df.toPandas())
    assert list(at) == [0] and rgb.ravel().tolist() == [255, 0, 0, 0, 255, 0, 0, 0, 255, 10, 20, 30]
    n = imgsrc.skipped_counts(spark, f"{tmpdir_path}/imgs").first()
    assert (n["n_valid"], n["n_invalid"]) == (1, 1)
    with pytest.raises(DataLoadError):
        imgsrc.read_images(spark, f"{tmpdir_path}/imgs", on_bad="fail")


def test_label_parsing_without_decoding(spark, tmpdir_path):
    for name in ("cat.0.jpg", "dog.0.jpg", "Cat.5.JPG", "bird.1.jpg"):
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(b"fake")
    files = imgsrc.list_files(spark, tmpdir_path, glob="*.[jJ][pP][gG]")
    kept, skipped = imgsrc.label_by_prefix(files, "path", ["cat", "dog"])
    got = sorted((r["class_name"], r["label"]) for r in kept.collect())
    assert got == [("cat", 0), ("cat", 0), ("dog", 1)] and skipped.count() == 1


def test_bundle_roundtrip_and_missing_part(spark, tmpdir_path):
    from tablelearn.operators import regress
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, y double")
    m = regress.fit_ols(df, ["x"], "y")
    bundle.save_bundle(spark, m, f"{tmpdir_path}/b", ["x"], metrics={"rmse": 0.0})
    loaded, feats, _, met = bundle.load_bundle(spark, f"{tmpdir_path}/b")
    a = [r["prediction"] for r in m.transform(df).collect()]
    b = [r["prediction"] for r in loaded.transform(df).collect()]
    assert a == b and feats == ["x"] and met == {"rmse": 0.0}
    with pytest.raises(ModelError):
        bundle.load_bundle(spark, f"{tmpdir_path}/nothing")


def test_bicubic_weights_keep_constants_and_reach_over():
    from tablelearn.operators.images import resize_batch, resize_weights
    w = resize_weights(9, 4, "bicubic")
    assert np.allclose(w.sum(1), 1) and (w < 0).any() and np.allclose(resize_weights(5, 5, "bicubic"), np.eye(5))
    x = np.full((2, 9, 7, 3), 200, np.uint8)
    assert (resize_batch(x, 4, 4, uint8=True, resample="bicubic") == 200).all()


def test_augmentation_is_a_rotation_and_shift():
    from tablelearn.operators.images import augment_batch
    x = np.arange(50, dtype=float).reshape(2, 5, 5)
    assert (augment_batch(x, [0, 0], [0, 0], [0, 0]) == x).all()
    assert (augment_batch(x, [0, 0], [1, 0], [0, 2])[0, 1:] == x[0, :-1]).all() and (augment_batch(x, [0, 0], [1, 0], [0, 2])[1, :, 2:] == x[1, :, :-2]).all()
    assert (augment_batch(x, [180, 90], [0, 0], [0, 0])[0] == x[0, ::-1, ::-1]).all()


def test_empty_prediction_set_is_an_error(spark):
    from tablelearn.operators import metrics
    with pytest.raises(Exception, match="empty prediction set"):
        metrics.regression(spark.createDataFrame([], "y double, p double"), "y", "p").collect()
