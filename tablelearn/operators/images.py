"""Image feature jobs.  Decoding is Spark's ``image`` source (JVM, on executors); the
per-image maths runs as numpy kernels over whole Arrow batches through ``mapInPandas``
(one ``N×H×W`` array per batch and image size, no per-row Python loop).

Definitions (public library documentation, fixed here by tests):
* resize: separable triangle ("bilinear") filter on pixel centres, support widened by the
  down-scale factor (antialiased), optionally in 8-bit fixed point with rounding per pass;
* grey: weighted channel sum (0.2125, 0.7154, 0.0721) on [0, 1], or (0.299, 0.587, 0.114);
* HOG: central differences (zero on the border), unsigned orientation in [0, 180),
  hard binning, cell value = Σ magnitude / cell area, overlapping blocks, L2-Hys (eps 1e-5,
  clip 0.2); block-major, then cell row, cell column, bin;
* colour histogram: per channel, equal bins over [0, 255], last bin closed; "density"
  divides by (N · bin width), "joint" divides all channels' counts by (total + 1e-8).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Greyscale weights of the two reference libraries, HOG and histogram settings.
GRAY_SKIMAGE = (0.2125, 0.7154, 0.0721)
GRAY_PIL_L = (0.299, 0.587, 0.114)
HOG_ORIENTATIONS = 9
HOG_CELL = 8
HOG_BLOCK = 2
HIST_BINS = 16
L2HYS_CLIP = 0.2
L2HYS_EPS = 1e-5
JOINT_EPS = 1e-8


# ------------------------------------------------------------------ numpy kernels
def resize_weights(n_in: int, n_out: int, resample: str = "bilinear") -> np.ndarray:
    """n_out×n_in weights on pixel centres: a triangle of support 1 ("bilinear") or the cubic
    convolution kernel with a = −1/2 and support 2 ("bicubic"), widened by the down-scale factor."""
    scale = n_in / n_out
    fs = max(scale, 1.0)
    centers = (np.arange(n_out) + 0.5) * scale
    d = np.abs(np.arange(n_in) + 0.5 - centers[:, None]) / fs
    if resample == "bilinear":
        w = np.clip(1.0 - d, 0.0, None)
    elif resample == "bicubic":
        w = np.where(d < 1, 1.5 * d ** 3 - 2.5 * d ** 2 + 1, np.where(d < 2, -0.5 * d ** 3 + 2.5 * d ** 2 - 4 * d + 2, 0.0))
    else:
        raise ValueError(resample)
    return w / w.sum(axis=1, keepdims=True)


def resize_batch(imgs: np.ndarray, out_h: int, out_w: int, uint8: bool = False, resample: str = "bilinear") -> np.ndarray:
    """Resize N×H×W(×C) images: horizontal pass then vertical pass (Wy @ img @ Wx.T).

    ``uint8=True`` mimics 8-bit fixed-point resampling: 22-bit integer coefficients and
    rounding to 0–255 after each pass."""
    n, h, w = imgs.shape[:3]
    wx, wy = resize_weights(w, out_w, resample), resize_weights(h, out_h, resample)
    x = imgs.astype(np.float64)
    if not uint8:
        x = np.einsum("ow,nhw...->nho...", wx, x)
        return np.einsum("oh,nhw...->now...", wy, x)
    prec = 22
    kx = np.floor(wx * (1 << prec) + 0.5).astype(np.int64)
    ky = np.floor(wy * (1 << prec) + 0.5).astype(np.int64)
    xi = imgs.astype(np.int64)
    t = np.einsum("ow,nhw...->nho...", kx, xi)
    t = np.clip((t + (1 << (prec - 1))) >> prec, 0, 255)
    t = np.einsum("oh,nhw...->now...", ky, t)
    return np.clip((t + (1 << (prec - 1))) >> prec, 0, 255).astype(np.uint8)


def rgb_to_gray(imgs: np.ndarray, weights=GRAY_SKIMAGE, unit: bool = True) -> np.ndarray:
    """N×H×W×3 → N×H×W.  ``unit`` scales 0–255 input to [0, 1] first."""
    x = imgs.astype(np.float64)
    if unit:
        x = x / 255.0
    return x @ np.asarray(weights, dtype=np.float64)


def hog_batch(gray: np.ndarray, orientations: int = HOG_ORIENTATIONS, cell: int = HOG_CELL,
              block: int = HOG_BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Cells (N, cy, cx, bins) and L2-Hys blocks flattened (N, by·bx·block·block·bins)."""
    g = gray.astype(np.float64)
    n, h, w = g.shape
    gx = np.zeros_like(g)
    gy = np.zeros_like(g)
    gx[:, :, 1:-1] = g[:, :, 2:] - g[:, :, :-2]
    gy[:, 1:-1, :] = g[:, 2:, :] - g[:, :-2, :]
    mag = np.hypot(gx, gy)
    ori = np.rad2deg(np.arctan2(gy, gx)) % 180.0
    width = 180.0 / orientations
    bins = np.minimum(np.floor(ori / width).astype(np.int64), orientations - 1)
    cy, cx = h // cell, w // cell
    mag = mag[:, :cy * cell, :cx * cell]
    bins = bins[:, :cy * cell, :cx * cell]
    onehot = (bins[..., None] == np.arange(orientations)) * mag[..., None]
    cells = onehot.reshape(n, cy, cell, cx, cell, orientations).sum(axis=(2, 4)) / float(cell * cell)
    by, bx = cy - block + 1, cx - block + 1
    out = []
    for i in range(by):
        for j in range(bx):
            v = cells[:, i:i + block, j:j + block, :].reshape(n, -1)
            v = v / np.sqrt((v * v).sum(axis=1, keepdims=True) + L2HYS_EPS ** 2)
            v = np.minimum(v, L2HYS_CLIP)
            v = v / np.sqrt((v * v).sum(axis=1, keepdims=True) + L2HYS_EPS ** 2)
            out.append(v)
    blocks = np.concatenate(out, axis=1) if out else np.zeros((n, 0))
    return cells, blocks


def color_hist_batch(imgs: np.ndarray, bins: int = HIST_BINS, mode: str = "density") -> np.ndarray:
    """N×H×W×C → N×(C·bins) histograms over [0, 255], last bin closed."""
    x = imgs.astype(np.float64)
    n, c = x.shape[0], x.shape[-1]
    width = 255.0 / bins
    idx = np.minimum(np.floor(x / width).astype(np.int64), bins - 1).reshape(n, -1, c)
    counts = np.stack([(idx[:, :, ch, None] == np.arange(bins)).sum(axis=1) for ch in range(c)], axis=1)
    counts = counts.astype(np.float64)  # N×C×bins
    npx = idx.shape[1]
    if mode == "density":
        h = counts / width / npx
    elif mode == "joint":
        h = counts / (counts.reshape(n, -1).sum(axis=1)[:, None, None] + JOINT_EPS)
    else:
        raise ValueError(mode)
    return h.reshape(n, -1)


def augment_batch(imgs: np.ndarray, angle, shift_y, shift_x) -> np.ndarray:
    """Rotate each image by its angle (degrees) and shift it by its pixels, nearest neighbour."""
    n, h, w = imgs.shape[:3]
    yy, xx = np.mgrid[0:h, 0:w].astype(np.float64)
    cy, cx = (h - 1) / 2.0, (w - 1) / 2.0
    a, ty, tx = (np.asarray(v, np.float64)[:, None, None] for v in (np.deg2rad(angle), shift_y, shift_x))
    iy = np.rint(np.cos(a) * (yy - cy - ty) - np.sin(a) * (xx - cx - tx) + cy).astype(int)
    ix = np.rint(np.sin(a) * (yy - cy - ty) + np.cos(a) * (xx - cx - tx) + cx).astype(int)
    ok = (iy >= 0) & (iy < h) & (ix >= 0) & (ix < w)
    out = imgs[np.arange(n)[:, None, None], np.clip(iy, 0, h - 1), np.clip(ix, 0, w - 1)]
    out[~ok] = 0
    return out


# ------------------------------------------------------------------ Spark wrappers
def _stack(series: pd.Series, h: int, w: int, c: int | None) -> np.ndarray:
    shape = (h, w) if c is None else (h, w, c)
    return np.stack([np.asarray(v, dtype=np.float64).reshape(shape) for v in series]) if len(series) else \
        np.zeros((0,) + shape)


def map_arrays(df: DataFrame, key: str, col: str, fn, out_schema: str, keep=()) -> DataFrame:
    """Apply ``fn(batch_array_column) -> dict of output columns`` per Arrow batch."""
    keep = list(keep)

    def run(it):
        for pdf in it:
            res = fn(pdf[col])
            out = pd.DataFrame({key: pdf[key].values, **{k: pdf[k].values for k in keep}})
            for name, val in res.items():
                out[name] = list(val) if isinstance(val, np.ndarray) and val.ndim > 1 else val
            yield out
    return df.select(key, col, *keep).mapInPandas(run, out_schema)


def resize_column(df: DataFrame, key: str, col: str, h: int, w: int, out_h: int, out_w: int,
                  channels: int | None = None, uint8: bool = False) -> DataFrame:
    """Flattened images in ``col`` → resized flattened images ``resized`` (array<double>)."""
    def fn(s):
        r = resize_batch(_stack(s, h, w, channels), out_h, out_w, uint8=uint8)
        return {"resized": r.reshape(len(s), -1).astype(np.float64)}
    kt = df.schema[key].dataType.simpleString()
    return map_arrays(df, key, col, fn, f"{key} {kt}, resized array<double>")


def gray_column(df: DataFrame, key: str, rgb_col: str, weights=GRAY_SKIMAGE, unit: bool = True) -> DataFrame:
    """Flattened H·W·3 RGB arrays → flattened grey arrays ``gray``."""
    def fn(s):
        x = np.stack([np.asarray(v, dtype=np.float64).reshape(-1, 3) for v in s]) if len(s) else np.zeros((0, 1, 3))
        return {"gray": rgb_to_gray(x, weights, unit)}
    kt = df.schema[key].dataType.simpleString()
    return map_arrays(df, key, rgb_col, fn, f"{key} {kt}, gray array<double>")


def hog_column(df: DataFrame, key: str, col: str, h: int, w: int, cell: int = HOG_CELL, block: int = HOG_BLOCK,
               orientations: int = HOG_ORIENTATIONS) -> DataFrame:
    """Flattened grey images → ``cells`` (cy·cx·bins) and ``blocks`` (L2-Hys) arrays."""
    def fn(s):
        cells, blocks = hog_batch(_stack(s, h, w, None), orientations, cell, block)
        return {"cells": cells.reshape(len(s), -1), "blocks": blocks}
    kt = df.schema[key].dataType.simpleString()
    return map_arrays(df, key, col, fn, f"{key} {kt}, cells array<double>, blocks array<double>")


def hist_column(df: DataFrame, key: str, rgb_col: str, bins: int = HIST_BINS, mode: str = "density") -> DataFrame:
    def fn(s):
        x = np.stack([np.asarray(v, dtype=np.float64).reshape(-1, 1, 3) for v in s]) if len(s) else np.zeros((0, 1, 1, 3))
        return {"hist": color_hist_batch(x, bins, mode)}
    kt = df.schema[key].dataType.simpleString()
    return map_arrays(df, key, rgb_col, fn, f"{key} {kt}, hist array<double>")


def normalize_pixels(col: str):
    """(x/255 − 0.5)/0.5 element-wise, JVM-side."""
    return F.transform(F.col(col), lambda x: (x.cast("double") / 255.0 - 0.5) / 0.5)


def image_features(df: DataFrame, key: str, rgb_col: str, h: int, w: int, size: int = 64,
                   hist_mode: str = "density", keep=()) -> DataFrame:
    """RGB images (flattened H·W·3, 0–255) → resize → grey → HOG blocks ++ colour histogram.

    One kernel call per Arrow batch; output ``features`` array<float> (1812-d at 64×64)."""
    def fn(s):
        x = _stack(s, h, w, 3)
        if (h, w) != (size, size):
            x = resize_batch(x, size, size, uint8=True).astype(np.float64)
        _, blocks = hog_batch(rgb_to_gray(x))
        hist = color_hist_batch(x, HIST_BINS, hist_mode)
        return {"features": np.concatenate([blocks, hist], axis=1).astype(np.float32)}
    kt = df.schema[key].dataType.simpleString()
    extra = "".join(f", {k} {df.schema[k].dataType.simpleString()}" for k in keep)
    return map_arrays(df, key, rgb_col, fn, f"{key} {kt}{extra}, features array<float>", keep=keep)


def augment_parameters(key: str, copy: str, seed: int, h: int, w: int, max_rot: float = 10.0, max_shift: float = 0.05):
    """Angle in ±max_rot degrees and shifts in ±max_shift of the size from md5(seed:key:copy:name), so
    that a retried task, or another engine, gets the same copy."""
    def unit(name):
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col(copy).cast("string"), F.lit(name)))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 31) - 1
    return [(unit("angle") * max_rot).alias("angle"), (unit("y") * (max_shift * h)).alias("shift_y"),
            (unit("x") * (max_shift * w)).alias("shift_x")]


def augment(df: DataFrame, key: str, col: str, h: int, w: int, copies: int = 1, seed: int = 42,
            channels: int | None = None, keep=()) -> DataFrame:
    """Train-only augmentation: ``copies`` rotated/shifted versions per row (deterministic)."""
    keep = list(keep)
    x = df.select(key, col, *keep).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    x = x.select(key, col, *keep, "copy", *augment_parameters(key, "copy", seed, h, w))

    def run(it):
        for pdf in it:
            if len(pdf):
                res = augment_batch(_stack(pdf[col], h, w, channels), pdf["angle"], pdf["shift_y"], pdf["shift_x"])
                out = pdf[[key, *keep, "copy", "angle", "shift_y", "shift_x"]].copy()
                out[col] = list(res.reshape(len(pdf), -1).astype(np.float64))
                yield out
    kinds = ", ".join(f"{k} {x.schema[k].dataType.simpleString()}" for k in [key, *keep])
    return x.mapInPandas(run, f"{kinds}, copy int, angle double, shift_y double, shift_x double, {col} array<double>")


def same_size_batches(pdf: pd.DataFrame):
    """(row positions, N×H×W×3 RGB uint8) for each image size in a batch of decoded images
    (columns height, width, channels, data: BGR(A) or grey bytes)."""
    for (h, w, c), at in pdf.groupby(["height", "width", "channels"]).indices.items():
        raw = np.frombuffer(b"".join(bytes(pdf["data"].iat[i]) for i in at), np.uint8).reshape(len(at), h, w, c)
        yield at, np.repeat(raw, 3, axis=3) if c == 1 else raw[:, :, :, 2::-1]


def _resized(pdf: pd.DataFrame, size: int, resample: str) -> np.ndarray:
    x = np.empty((len(pdf), size, size, 3), np.uint8)
    for at, rgb in same_size_batches(pdf):
        x[at] = resize_batch(rgb, size, size, uint8=True, resample=resample)
    return x


def _from_bytes(df: DataFrame, key: str, fn, column: str, element: str, keep) -> DataFrame:
    """Decoded images → one feature array, straight from the bytes."""
    keep = list(keep)

    def run(it):
        for pdf in it:
            if len(pdf):
                out = pdf[[key, *keep]].copy()
                out[column] = list(fn(pdf))
                yield out
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in [key, *keep])
    return df.select(key, "height", "width", "channels", "data", *keep).mapInPandas(run, f"{kinds}, {column} array<{element}>")


def image_features_sized(df: DataFrame, key: str, size: int = 64, hist_mode: str = "density", keep=(),
                         resample: str = "bilinear") -> DataFrame:
    """Like ``image_features`` for decoded images of differing sizes: the images of one size are
    resized together to size×size (8-bit fixed point), then the batch is featurised."""
    def fn(pdf):
        x = _resized(pdf, size, resample).astype(np.float64)
        _, blocks = hog_batch(rgb_to_gray(x))
        return np.concatenate([blocks, color_hist_batch(x, HIST_BINS, hist_mode)], axis=1).astype(np.float32)
    return _from_bytes(df, key, fn, "features", "float", keep)


def gray_sized(df: DataFrame, key: str, size: int = 64, weights=GRAY_PIL_L, keep=()) -> DataFrame:
    """Grey ('L' weights on 0–255, rounded) first, then resize to size×size: ``gray`` 0–255, flat."""
    def fn(pdf):
        x = np.empty((len(pdf), size, size), np.float64)
        for at, rgb in same_size_batches(pdf):
            g = np.clip(np.rint(rgb_to_gray(rgb, weights, unit=False)), 0, 255)
            x[at] = resize_batch(g, size, size, uint8=True)
        return x.reshape(len(pdf), -1)
    return _from_bytes(df, key, fn, "gray", "double", keep)
