import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablelearn.errors import ModelError
from tablelearn.operators import align, classify, cluster, epochs, metrics, regress


def test_perfect_regression_metrics(spark):
    df = spark.createDataFrame([(100.0, 100.0), (200.0, 200.0), (300.0, 300.0)], "y double, p double")
    r = metrics.regression(df, "y", "p").first()
    assert (r["rmse"], r["mae"], r["r2"], r["mape"], r["n"]) == (0.0, 0.0, 1.0, 0.0, 3)


def test_mape_infinite_on_zero_target(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double")
    assert math.isinf(metrics.regression(df, "y", "p").first()["mape"])


def test_ols_predictions_equal_lstsq(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=50), rng.normal(size=50)
    y = 3 * a + 2 * b + 10 + rng.normal(scale=0.01, size=50)
    df = spark.createDataFrame([(float(x1), float(x2), float(x1 + x2), float(t)) for x1, x2, t in zip(a, b, y)],
                               "a double, b double, ab double, y double")
    m = regress.fit_ols(df, ["a", "b", "ab"], "y")  # collinear column on purpose
    pred = np.array([r["prediction"] for r in m.transform(df).orderBy("a").collect()])
    X = np.c_[np.ones(50), a, b, a + b]
    coef, *_ = np.linalg.lstsq(X, y, rcond=None)
    want = (X @ coef)[np.argsort(a)]
    assert np.allclose(pred, want, atol=1e-6)
    r = regress.ols_two(df, "a", "b", "y").first()
    assert abs(r["b1"] - 3) < 0.01 and abs(r["b2"] - 2) < 0.01 and abs(r["b0"] - 10) < 0.01


def test_binary_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = metrics.binary(df, "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_report_and_confusion_full_class_list(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "y int, p int")
    rep = {r["label"]: r for r in metrics.report(df, "y", "p", [0, 1, 2]).collect()}
    assert rep["2"]["support"] == 0 and rep["2"]["f1"] == 0.0
    assert rep["accuracy"]["f1"] == 0.75
    assert math.isclose(rep["macro avg"]["precision"], (1.0 + 2 / 3 + 0.0) / 3)
    conf = metrics.confusion(df, "y", "p", [0, 1, 2]).collect()
    assert len(conf) == 9 and sum(r["n"] for r in conf) == 4


def _blobs(spark, k=3, n=25, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-10, 10, size=(k, 2))
    rows, pts, lab = [], [], []
    for c in range(k):
        for _ in range(n):
            x = centres[c] + rng.normal(scale=0.5, size=2)
            rows.append((len(rows), [float(x[0]), float(x[1])], c))
            pts.append(x)
            lab.append(c)
    return spark.createDataFrame(rows, "id long, x array<double>, label int"), np.array(pts), np.array(lab)


def test_silhouette_sq_equals_brute_force(spark):
    df, X, lab = _blobs(spark)
    got = metrics.silhouette_sq(df, "x", "label", 2).first()["silhouette"]
    d = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    assert abs(got - np.mean(s)) < 1e-9 and got > 0.5


def test_davies_bouldin_equals_numpy(spark):
    df, X, lab = _blobs(spark)
    got = metrics.davies_bouldin(df, "x", "label", 2).first()["davies_bouldin"]
    ks = sorted(set(lab))
    cen = np.array([X[lab == c].mean(0) for c in ks])
    s = np.array([np.linalg.norm(X[lab == c] - cen[c], axis=1).mean() for c in ks])
    r = [max((s[i] + s[j]) / np.linalg.norm(cen[i] - cen[j]) for j in ks if j != i) for i in ks]
    assert abs(got - np.mean(r)) < 1e-9


def test_kmeans_restarts_reproducible_and_elbow_monotone(spark):
    df, _, _ = _blobs(spark, k=4, n=20, seed=3)
    c1, cost1 = cluster.fit_kmeans(df, "x", k=4, restarts=3, seed=5)
    c2, cost2 = cluster.fit_kmeans(df, "x", k=4, restarts=3, seed=5)
    assert np.allclose(c1, c2, rtol=1e-9) and math.isclose(cost1, cost2, rel_tol=1e-9)
    sizes = cluster.assign(df, "x", c1).groupBy("cluster").count().collect()
    assert sum(r["count"] for r in sizes) == 80
    el = [r["inertia"] for r in cluster.elbow(df, "x", "id", range(2, 6), restarts=3).orderBy("k").collect()]
    assert all(a >= b - 1e-9 for a, b in zip(el, el[1:]))
    with pytest.raises(ModelError):
        cluster.fit_kmeans(df.limit(3), "x", k=4, restarts=1)


def test_early_stop_margin_rule(spark):
    losses = [1.0, 0.9, 0.899995, 0.95, 0.95, 0.95]
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(losses)], "run int, epoch int, loss double")
    r = epochs.early_stop(df, "run", "epoch", "loss", patience=4).first()
    assert r["stop_epoch"] == 6 and r["best_epoch"] == 2 and r["best_loss"] == 0.9


def test_lr_plateau_matches_loop(spark):
    losses = [1.0, 0.99, 0.995, 0.999, 0.98, 1.0, 1.0, 1.0, 1.0, 0.5, 0.6, 0.6, 0.6, 0.6, 0.6, 0.6]
    best, bad, lr, red = math.inf, 0, 0.001, 0
    for v in losses:
        if v < best * (1 - 1e-4):
            best, bad = v, 0
        else:
            bad += 1
        if bad > 2:
            if lr - lr * 0.5 > 1e-8:
                lr, red = lr * 0.5, red + 1
            bad = 0
    df = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate(losses)], "run int, epoch int, loss double")
    r = epochs.lr_plateau(df, "run", "epoch", "loss").first()
    assert r["final_lr"] == lr and r["n_reductions"] == red


def test_best_checkpoint_first_strict_max(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.7), (1, 3, 0.7), (2, 1, 0.0)], "run int, epoch int, acc double")
    r = {x["run"]: x for x in epochs.best_checkpoint(df, "run", "epoch", "acc").collect()}
    assert r[1]["best_epoch"] == 2 and 2 not in r


def test_lookup_default(spark):
    dim = spark.createDataFrame([("pizza", 266), ("sushi", 150), ("default", 250)], "class string, kcal int")
    df = spark.createDataFrame([("pizza",), ("unknown",), ("default",)], "class string")
    r = {x["class"]: x["kcal"] for x in align.lookup_default(df, dim, "class", "kcal").collect()}
    assert r == {"pizza": 266, "unknown": 250, "default": 250}
    assert [x["class"] for x in align.missing_keys(df, dim, "class").collect()] == ["unknown"]


def test_rff_kernel_and_rbf_svm_rings(spark):
    rng = np.random.default_rng(0)
    n = 300
    r = np.r_[rng.normal(1.0, 0.1, n), rng.normal(3.0, 0.1, n)]
    t = rng.uniform(0, 2 * np.pi, 2 * n)
    X = np.c_[r * np.cos(t), r * np.sin(t)]
    y = np.r_[np.zeros(n), np.ones(n)]
    w, b = classify.rff_matrix(2, 2000, 0.5, 42)
    Z = np.sqrt(2 / 2000) * np.cos(X[:50] @ w.T + b)
    K = np.exp(-0.5 * ((X[:50, None] - X[None, :50]) ** 2).sum(-1))
    assert np.abs(Z @ Z.T - K).mean() < 0.05
    df = spark.createDataFrame([(i, [float(a), float(c)], int(lab)) for i, ((a, c), lab) in enumerate(zip(X, y))],
                               "id long, x array<double>, label int").select("id", "label", array_to_vector("x").alias("features"))
    m = classify.fit_classifier(df, "features", "label", "svm_rbf", 2, C=5.0, n_components=500, gamma=0.5)
    acc = m.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.95
    with pytest.raises(ModelError):
        classify.fit_classifier(df, "features", "label", "keras_cnn", 2)


def test_batched_kmeans_restarts_reach_optimum(spark):
    df, X, _ = _blobs(spark, k=4, n=30, seed=3)
    c1, cost1 = cluster.fit_kmeans_batched(df, "x", "id", 4, restarts=5, seed=1)
    c2, cost2 = cluster.fit_kmeans_batched(df, "x", "id", 4, restarts=5, seed=1)
    assert c1 == c2 and cost1 == cost2
    d = ((X[:, None, :] - np.array(c1)[None]) ** 2).sum(-1).min(1).sum()
    assert math.isclose(d, cost1, rel_tol=1e-9)
    _, spark_cost = cluster.fit_kmeans(df, "x", 4, restarts=5, seed=1)
    assert cost1 <= spark_cost * (1 + 1e-6)


def _stop(h, patience=4, delta=1e-5):
    best, be, cnt, stop = math.inf, 0, 0, None
    for e, v in h:
        if stop is None:
            if v < best - delta:
                best, be, cnt = v, e, 0
            else:
                cnt += 1
                stop = e if cnt >= patience else None
    return stop, best, be, len(h)


def _plateau(h, lr=0.001, factor=0.5, patience=2, thr=1e-4, eps=1e-8):
    best, bad, red = math.inf, 0, 0
    for _, v in h:
        bad = 0 if v < best * (1 - thr) else bad + 1
        best = v if bad == 0 else best
        if bad > patience:
            bad = 0
            if lr - lr * factor > eps:
                lr, red = lr * factor, red + 1
    return lr, red


def _histories():
    rng = np.random.default_rng(0)
    out = {}
    for r in range(30):
        n = 900 if r == 7 else int(rng.integers(1, 40))
        base = np.cumsum(rng.normal(-0.01 if r % 3 else 0.0, 0.05, n)) + (0 if r % 5 else np.linspace(0, -3, n))
        out[r] = [(e + 1, float(round(base[e], 5))) for e in range(n)]
    out[98] = [(i + 1, v) for i, v in enumerate([math.inf, math.nan, 3.0, math.nan, 2.0, math.inf, 2.0, 2.0, 2.0])]
    out[99] = [(i + 1, v) for i, v in enumerate([1.0, 0.9, 0.95, 0.95, 0.95, 0.95])]
    out[100] = [(10 * (i + 1), 1.0) for i in range(9)]  # gaps count as given
    return out


@pytest.mark.parametrize("block", [1, 7, 300, 100_000])
def test_histories_equal_the_plain_loop_at_any_block(spark, block):
    hist = {r: h for r, h in _histories().items() if block > 1 or len(h) < 12}
    df = spark.createDataFrame([(r, e, v) for r, h in hist.items() for e, v in h], "run int, epoch int, loss double").repartition(8)
    got = {x["run"]: tuple(x)[1:] for x in epochs.early_stop(df, "run", "epoch", "loss", block=block).collect()}
    assert got == {r: _stop(h) for r, h in hist.items()}
    got = {x["run"]: tuple(x)[1:] for x in epochs.lr_plateau(df, "run", "epoch", "loss", block=block).collect()}
    assert got == {r: _plateau(h) for r, h in hist.items()}


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_long_run_and_epoch_numbers(spark, parts):
    rng = np.random.default_rng(5)
    v = np.minimum.accumulate(rng.normal(size=120_000)) + np.abs(rng.normal(size=120_000)) * 0.1 - np.linspace(0, 1, 120_000)
    rows = [(1, i, float(x)) for i, x in enumerate(v)] + [(None, i, float(-i)) for i in range(50)] + [(2, 5, 1.0), (2, 3, 2.0)]
    df = spark.createDataFrame(rows, "run int, at int, loss double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        h = epochs.with_epoch_index(df, "run", ["at"]).persist()
        assert h.where("run = 1 AND epoch <> at + 1").count() == 0 and h.count() == len(rows)
        assert sorted((r["at"], r["epoch"]) for r in h.where("run = 2").collect()) == [(3, 1), (5, 2)]
        got = {r["run"]: tuple(r)[1:] for r in epochs.early_stop(h, "run", "epoch", "loss", patience=500).collect()}
        assert got[1] == _stop([(i + 1, float(x)) for i, x in enumerate(v)], 500) and got[None] == (None, -49.0, 50, 50)
        got = {r["run"]: tuple(r)[1:] for r in epochs.lr_plateau(h, "run", "epoch", "loss").collect()}
        assert got[1] == _plateau([(i + 1, float(x)) for i, x in enumerate(v)])
        h.unpersist()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_kmeans_passes_equal_a_plain_loop_and_repeat(spark):
    import numpy as np

    from tablelearn.operators import blocks, cluster

    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(300, 3)), np.tile([1.0, 2.0, 3.0], (20, 1))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(40)
    packed = blocks.pack(df, "x").persist()
    runs = [[[0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [1.0, 1.0, 1.0]], [[2.0, 0.0, 0.0], [-1.0, 0.5, 0.0]]]
    got = cluster._run_sums(packed, runs, 3)
    assert got == cluster._run_sums(packed, runs, 3)
    for i, c in enumerate(runs):
        d = ((x[:, None] - np.array(c)) ** 2).sum(2)
        near = d.argmin(1)  # of two equal centres the lower one
        for k in range(len(c)):
            rows = near == k
            assert ((i, k) in got) == rows.any()
            if rows.any():
                n, cost, total = got[i, k]
                assert n == rows.sum() and abs(cost - d[rows, k].sum()) < 1e-9 and np.allclose(total, x[rows].sum(0))
