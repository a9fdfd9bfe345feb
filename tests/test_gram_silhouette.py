import numpy as np
import pytest

from tablelearn.errors import ModelError
from tablelearn.operators import gram, regress, silhouettes


def _frame(spark, x, y, fold=None):
    cols = [f"a{i}" for i in range(x.shape[1])]
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold if fold is not None else np.zeros(len(y)))]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", y double, fold int").repartition(4), cols


def _plain(x, y):
    """Minimum-norm least squares with an intercept: the pseudo-inverse of the centred design."""
    b = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-10)[0]
    return y.mean() - b @ x.mean(0), b


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_minimum_norm_on_a_rank_deficient_design(spark, offset):
    """Seven columns like the engineered price features, three of them made from the others."""
    rng = np.random.default_rng(1)
    base = np.c_[rng.normal(1500, 400, 200), rng.normal(900, 200, 200), rng.integers(1, 5, 200), rng.integers(1950, 2015, 200)] + offset
    x = np.c_[base, base[:, 0] + base[:, 1], base[:, 2] + 0.5 * base[:, 1], 2024 - base[:, 3]]
    y = base @ [50.0, 20.0, 1000.0, 30.0] + rng.normal(0, 100, 200)
    df, cols = _frame(spark, x, y)
    got = gram.fit(df, cols, "y")
    a, b = _plain(x, y)
    assert np.abs(got.coefficients - b).max() < 1e-5 * np.abs(b).max() and abs(got.intercept - a) < 1e-5 * max(abs(a), np.abs(y).max())
    pred = regress.fit_ols(df, cols, "y").transform(df).select("y", "prediction").toPandas()
    want = a + x @ b
    assert abs(((pred["y"] - pred["prediction"]) ** 2).mean() - ((y - want) ** 2).mean()) < 1e-6 * y.var()
    rows = {r["feature"]: r["coefficient"] for r in regress.ols_coefficients(df, cols, "y").collect()}
    assert list(rows) == ["intercept", *cols]


def test_constant_columns_nulls_and_empty_tables(spark):
    x = np.c_[np.arange(20.0), np.full(20, 7.0)]
    df, cols = _frame(spark, x, 3 * x[:, 0] + 1)
    got = gram.fit(df.unionByName(spark.createDataFrame([(None, 1.0, 5.0, 0), (1.0, 1.0, None, 0)], df.schema)), cols, "y")
    assert np.allclose(got.coefficients, [3, 0]) and abs(got.intercept - 1) < 1e-9
    with pytest.raises(ModelError):
        gram.fit(df.limit(0), cols, "y")


def test_left_out_folds_are_a_subtraction(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(5, 3, (150, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=150)
    fold = rng.integers(0, 4, 150)
    df, cols = _frame(spark, x, y, fold)
    for f, rmse, n, fit in gram.cross_validated(df, cols, "y", "fold"):
        a, b = _plain(x[fold != f], y[fold != f])
        e = y[fold == f] - a - x[fold == f] @ b
        assert n == (fold == f).sum() and abs(rmse - np.sqrt((e * e).mean())) < 1e-9 and np.allclose(fit.coefficients, b)
    assert regress.cv_summary(regress.cross_validate(df, cols, "y", "fold")).first()["folds"] == 4


def _points(spark, n=500, seed=0, d=3):
    rng = np.random.default_rng(seed)
    c = rng.integers(0, 4, n)
    x = rng.normal(size=(4, d))[c] * 3 + rng.normal(size=(n, d))
    return x, c, spark.createDataFrame([([float(v) for v in r], int(k) + 10) for r, k in zip(x, c)], "x array<double>, k int").repartition(5)


def _plain_silhouette(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, c == k].mean() for k in np.unique(c) if k != c[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return np.mean(out)


@pytest.mark.parametrize("tile", [2048, 64])
def test_silhouette_equals_all_pairs(spark, tile, monkeypatch):
    monkeypatch.setattr(silhouettes, "TILE_ROWS", tile)
    x, c, df = _points(spark)
    x, c = np.r_[x, [[50.0, 0, 0]], x[:3]], np.r_[c, [77], c[:3]]  # one row alone in its cluster, repeated rows
    more = spark.createDataFrame([([50.0, 0.0, 0.0], 87), *[([float(v) for v in r], int(k) + 10) for r, k in zip(x[-3:], c[-3:])],
                                  (None, 10), ([1.0, 1.0, 1.0], None)], df.schema)
    r = silhouettes.silhouette(df.unionByName(more), "x", "k").first()
    assert r["n"] == 504 and r["standard_error"] == 0.0 and abs(r["silhouette"] - _plain_silhouette(x, c)) < 1e-10


def test_silhouette_from_references_with_its_error(spark):
    x, c, df = _points(spark, 3000, 1)
    want = _plain_silhouette(x, c)
    r = silhouettes.silhouette(df, "x", "k", exact_cost=1000, references=200).first()
    assert 0 < r["standard_error"] < 0.01 and abs(r["silhouette"] - want) < max(4 * r["standard_error"], 0.004)
    with pytest.raises(ModelError):
        silhouettes.silhouette(df.where("k = 10"), "x", "k")
