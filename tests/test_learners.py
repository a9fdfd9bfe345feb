"""The learners against plain numpy versions of the same thing."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tablelearn.operators import blocks, calibrate, classify, forest, hinge, landmarks, network


def frame(spark, x, y, parts=5, **more):
    cols = "id long, x array<double>, label int" + "".join(f", {k} int" for k in more)
    rows = [(i, [float(v) for v in r], int(t), *(int(m[i]) for m in more.values())) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, cols).withColumn("features", array_to_vector("x")).drop("x").repartition(parts)


def blobs(n=400, d=4, k=3, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, n)
    return rng.normal(size=(k, d))[y] * 2 + rng.normal(size=(n, d)) * spread, y


def plain_hinge(x, s, c, steps=200):
    """Newton's method on the squared hinge; the loss is quadratic wherever the active rows stay the same."""
    n, d = x.shape
    xb, w = np.c_[x, np.ones(n)], np.zeros(d + 1)
    ridge = np.r_[np.full(d, 1.0 / (n * c)), 0.0]

    def f(w):
        return 0.5 * (ridge * w * w).sum() + (np.maximum(0, 1 - s * (xb @ w)) ** 2).mean()
    for _ in range(steps):
        slack = np.maximum(0, 1 - s * (xb @ w))
        g = ridge * w - 2 * xb.T @ (s * slack) / n
        a = xb[slack > 0]
        p = np.linalg.solve(np.diag(ridge) + 2 * a.T @ a / n + 1e-14 * np.eye(d + 1), -g)
        t = 1.0
        while f(w + t * p) > f(w) and t > 1e-10:
            t /= 2
        w = w + t * p
        if np.abs(g).max() < 1e-13:
            break
    return w


def test_hinge_cells_equal_single_newton_fits(spark):
    x, y = blobs()
    fold = np.arange(len(y)) % 3
    packed = blocks.pack(frame(spark, x, y, fold=fold), "features", ["label", "fold"]).persist()
    cells = [hinge.Cell(c, float(p), f) for c in (0.5, 5.0) for f in (0, 2, -1) for p in range(3)] + [hinge.Cell(1.0, 2.0, 1, 0.0)]
    w = hinge.fit_cells(packed, 4, cells, tol=1e-11, max_iter=500)
    for k, c in enumerate(cells):
        use = (fold != c.skip) & (np.isnan(c.negative) | (y == c.negative) | (y == c.positive))
        want = plain_hinge(x[use], np.where(y[use] == c.positive, 1.0, -1.0), c.c)
        assert np.abs(w[:, k] - want).max() < 1e-6, c
    alone = hinge.fit_cells(packed, 4, [cells[3]], tol=1e-11, max_iter=500)
    assert np.abs(alone[:, 0] - w[:, 3]).max() < 1e-6
    right = hinge.hits(packed, w, [[0, 1, 2]], [0], [0.0, 1.0, 2.0])[0]
    rows = fold == 0
    assert right == (np.argmax(x[rows] @ w[:-1, :3] + w[-1, :3], 1) == y[rows]).sum()
    packed.unpersist()


def test_grid_search_accuracies_and_best_model(spark, tmpdir_path):
    x, y = blobs(300, 3, 2, seed=4, spread=1.6)
    fold = np.arange(len(y)) % 3
    df = frame(spark, x, y, fold=fold)
    rows, model = classify.grid_search(df, "features", "label", "fold", gammas=("scale", "auto"), n_components=60, tol=1e-9, max_iter=400)
    assert [(g, c) for g, c, _, _ in rows] == [(g, c) for g in ("scale", "auto") for c in (0.5, 1.0, 5.0, 10.0)]
    gamma = {"scale": 1 / (3 * x.var()), "auto": 1 / 3}
    for g, c, acc, n in rows:
        z = classify.rff_map(*classify.rff_matrix(3, 60, gamma[g], 42))(x)
        want = []
        for f in range(3):
            w = plain_hinge(z[fold != f], np.where(y[fold != f] == 1, 1.0, -1.0), c)
            want.append(((z[fold == f] @ w[:-1] + w[-1] > 0) == (y[fold == f] == 1)).mean())
        assert n == 300 and abs(acc - np.mean(want)) < 1e-9
    best = max(rows, key=lambda r: r[2])
    assert best[2] > 0.8
    model.write().overwrite().save(tmpdir_path + "/m")
    again = PipelineModel.load(tmpdir_path + "/m")
    a, b = (m.transform(df).orderBy("id").select(vector_to_array("rawPrediction")[1]).toPandas().iloc[:, 0] for m in (model, again))
    z = classify.rff_map(*classify.rff_matrix(3, 60, gamma[best[0]], 42))(x)
    w = plain_hinge(z, np.where(y == 1, 1.0, -1.0), next(r[1] for r in rows if r[2] == best[2]))
    assert np.abs(a - (z @ w[:-1] + w[-1])).max() < 1e-5 and np.array_equal(a, b)


def test_grid_search_of_three_classes(spark):
    x, y = blobs(240, 3, 3, seed=5)
    df = frame(spark, x, y, fold=np.arange(240) % 3)
    rows, model = classify.grid_search(df, "features", "label", "fold", gammas=(0.1,), cs=(1.0, 10.0), n_components=80)
    assert min(r[2] for r in rows) > 0.85
    p = model.transform(df).toPandas()
    assert (p["label"] == p["prediction"]).mean() > 0.9


def test_weak_ridges_take_few_passes(spark, monkeypatch):
    """All cells on a mapped space are at their optimum within 20 passes, rare rows among them; one that goes on for long weights too."""
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=(2950, 3)), rng.normal(size=(50, 3)) * 5.0]
    y = ((x ** 2).sum(1) + 0.6 * rng.normal(size=3000) > 3).astype(int)
    fold = np.arange(3000) % 3
    monkeypatch.setattr(hinge, "NEWTON_ROWS", 1000, raising=False)
    monkeypatch.setattr(hinge, "LEFT", 1e-4, raising=False)
    packed = blocks.pack(frame(spark, x, y, fold=fold), "features", ["label", "fold"]).persist()
    via = classify.rff_map(*classify.rff_matrix(3, 600, 1 / 3, 1))
    cells = [hinge.Cell(c, 1.0, f) for c in (1.0, 100.0) for f in (0, -1)]
    w = hinge.fit_cells(packed, 600, cells, 1e-4, 20, spark.sparkContext.broadcast(via))
    z = via(x)
    for k, c in enumerate(cells):
        zz, sign = z[fold != c.skip], np.where(y[fold != c.skip] == 1, 1.0, -1.0)

        def f(v):
            return 0.5 * (v[:-1] ** 2).sum() / (len(zz) * c.c) + (np.maximum(0, 1 - sign * (zz @ v[:-1] + v[-1])) ** 2).mean()
        best = f(plain_hinge(zz, sign, c.c))
        assert best * 0.999999 <= f(w[:, k]) <= best * 1.001, (c, f(w[:, k]), best)
    packed.unpersist()


def test_landmarks_of_all_rows_are_the_exact_kernel_machine(spark):
    x, y = blobs(500, 3, 2, seed=2, spread=1.5)
    x = np.round(x, 2)
    gamma, c = 0.4, 3.0
    m = classify.fit_classifier(frame(spark, x, y), "features", "label", "svm_rbf", 2, C=c, gamma=gamma, kernel_map="landmarks",
                                n_components=500, tol=1e-9, max_iter=600)
    got = m.transform(frame(spark, x, y)).orderBy("id").select(vector_to_array("rawPrediction")[1]).toPandas().iloc[:, 0].to_numpy()
    # Newton in the space of the kernel expansion (Chapelle 2007): f = K a + b, solved on the rows within the margin.
    k, s = landmarks.rbf(x, x, gamma), np.where(y == 1, 1.0, -1.0)
    active = np.ones(500, bool)
    for _ in range(100):
        i = np.flatnonzero(active)
        system = np.zeros((len(i) + 1, len(i) + 1))
        system[:-1, :-1] = k[np.ix_(i, i)] + np.eye(len(i)) / (2 * c)
        system[:-1, -1] = system[-1, :-1] = 1.0
        sol = np.linalg.solve(system, np.r_[s[i], 0.0])
        f = k[:, i] @ sol[:-1] + sol[-1]
        now = s * f < 1
        if (now == active).all():
            break
        active = now
    assert np.abs(got - f).max() < 1e-3 and np.abs(got - f).mean() < 1e-4


def test_few_landmarks_tell_rings_apart(spark):
    rng = np.random.default_rng(0)
    r = np.r_[rng.normal(1.0, 0.1, 300), rng.normal(3.0, 0.1, 300)]
    t = rng.uniform(0, 2 * np.pi, 600)
    df = frame(spark, np.c_[r * np.cos(t), r * np.sin(t)], np.r_[np.zeros(300), np.ones(300)])
    m = classify.fit_classifier(df, "features", "label", "svm_rbf", 2, gamma=0.5, kernel_map="landmarks", n_components=40)
    assert m.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.98


def plain_tree(x, y, w, k, tree, node, depth, count, seed):
    """Every feature and threshold in turn."""
    rows = w > 0
    counts = np.bincount(y[rows], w[rows], k)
    if depth == 0 or rows.sum() < 2 or (counts > 0).sum() < 2:
        return {node: (-1, counts.tolist())}

    def impurity(c):
        return c.sum() - (c * c).sum() / c.sum()
    best = None
    for f in forest.candidates(x.shape[1], count, tree, node, seed):
        v = np.unique(x[rows, f])
        for lo, hi in zip(v, v[1:]):
            left = rows & (x[:, f] <= lo)
            a, b = np.bincount(y[left], w[left], k), np.bincount(y[rows & ~left], w[rows & ~left], k)
            gain = impurity(counts) - impurity(a) - impurity(b)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, f, lo + (hi - lo) / 2
    if best is None:
        return {node: (-1, counts.tolist())}
    _, f, t = best
    left = x[:, f] <= t
    return {node: (int(f), counts.tolist())} | plain_tree(x, y, np.where(left, w, 0), k, tree, 2 * node, depth - 1, count, seed) \
        | plain_tree(x, y, np.where(left, 0, w), k, tree, 2 * node + 1, depth - 1, count, seed)


def test_trees_by_sorting_equal_trees_by_trying(monkeypatch):
    x, y = blobs(60, 5, 3, seed=1, spread=2.0)
    x = np.round(x, 1)
    w = forest.bootstrap(np.arange(60), 3, 7)
    for cells in (1 << 22, 1):
        monkeypatch.setattr(forest, "SORT_CELLS", cells)
        got = {n: (f, c.tolist()) for n, f, _, c in forest.grow(x, y, w, 3, 3, 1, 6, 2, 7)}
        assert got == plain_tree(x, y, w, 3, 3, 1, 6, 2, 7)


def test_bootstrap_is_poisson():
    w = np.concatenate([forest.bootstrap(np.arange(50_000), t, 1) for t in range(4)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


@pytest.mark.parametrize("local_rows", [50_000, 60])
def test_one_seed_gives_one_forest(spark, local_rows):
    x, y = blobs(400, 6, 3, seed=3, spread=2.0)
    fits = [forest.fit(frame(spark, x, y, parts), "features", "label", 3, 12, 8, seed=5, local_rows=local_rows, key="id") for parts in (1, 7)]
    a, b = (f.getOrDefault(f.trees) for f in fits)
    assert a == b


def test_mixed_growth_predicts_as_well_as_the_library_forest(spark, tmpdir_path):
    from pyspark.ml.classification import RandomForestClassifier
    x, y = blobs(1500, 8, 4, seed=8, spread=2.2)
    df = frame(spark, x, y)
    train, test = df.where("id < 1000"), df.where("id >= 1000").persist()

    def accuracy(m):
        return m.transform(test).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    library = accuracy(RandomForestClassifier(labelCol="label", numTrees=60, maxDepth=12, featureSubsetStrategy="sqrt", seed=1).fit(train))
    local = forest.fit(train, "features", "label", 4, 60, 12, seed=1)
    mixed = forest.fit(train, "features", "label", 4, 60, 12, seed=1, local_rows=150)
    assert accuracy(local) >= library - 0.02 and accuracy(mixed) >= library - 0.02
    local.write().overwrite().save(tmpdir_path + "/f")
    again = forest.ForestModel.load(tmpdir_path + "/f")
    cols = ["id", "prediction", vector_to_array("probability").alias("p")]
    a, b = (m.transform(test).select(*cols).orderBy("id").collect() for m in (local, again))
    assert a == b and all(abs(sum(r["p"]) - 1) < 1e-9 for r in a)


def test_routing_and_finished_subtrees_agree(spark):
    """Every row of a mixed forest reaches, in every tree, a leaf that counted its class."""
    x, y = blobs(300, 4, 3, seed=6, spread=2.5)
    m = forest.fit(frame(spark, x, y), "features", "label", 3, 5, 20, seed=2, local_rows=40, key="id")
    a = m.arrays()
    assert (a["left"][a["feature"] >= 0] > 0).all()
    inner = np.flatnonzero(a["feature"] >= 0)
    assert len(np.unique(np.r_[a["left"][inner], a["left"][inner] + 1, a["begin"]])) == len(a["feature"])
    assert (forest.votes(a, x).argmax(1) == y).mean() > 0.9


@pytest.mark.parametrize("root", [1, 5])
def test_parts_keep_every_node(root):
    x, y = blobs(200, 5, 3, seed=1, spread=2.0)
    w = forest.bootstrap(np.arange(200), 3, 7)
    nodes = sorted(forest.grow(x, y, w, 3, 3, root, 9, 2, 7))
    tree, first, size, raw = forest._part(3, root, nodes)
    assert (tree, first, size) == (3, root, len(nodes))
    ids, feature, threshold, left, counts = forest._unpacked(root, raw, 3)
    assert [n[:3] for n in nodes] == list(zip(ids.tolist(), feature.tolist(), threshold.tolist()))
    assert (np.array([n[3] for n in nodes]) == counts).all()
    assert (ids[left[feature >= 0]] == 2 * ids[feature >= 0]).all() and (left[feature < 0] == -1).all()


@pytest.mark.parametrize("local_rows,group", [(50_000, 400), (40, 1000), (40, 1 << 23)])
def test_a_large_forest_stays_in_a_table(spark, monkeypatch, tmpdir_path, local_rows, group):
    """No node comes to the driver but in groups of parts, which split trees too; votes are those of the model in memory."""
    x, y = blobs(300, 4, 3, seed=6, spread=2.5)
    df = frame(spark, x, y)
    args = (df, "features", "label", 3, 5, 20, None, 2, local_rows, "id")
    small = forest.fit(*args)
    assert small.getOrDefault(small.table) == ""
    received = []
    monkeypatch.setattr(forest, "INLINE_NODES", 10)
    monkeypatch.setattr(forest, "GROUP_BYTES", group)
    monkeypatch.setattr(forest, "SCORE_VALUES", 100)
    monkeypatch.setattr(forest, "_received", lambda *a, f=forest._received: received.append(1) or f(*a))
    large = forest.fit(*args)
    assert large.getOrDefault(large.trees) == "" and large.getOrDefault(large.table)
    cols = ["id", "prediction", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p")]
    want, got = (m.transform(df).select(*cols).orderBy("id").collect() for m in (small, large))
    assert want == got and not received
    groups = [b.value for b in large._groups]
    assert all(sum(len(raw) for _, ps in g for _, raw in ps[1:]) <= group or sum(len(ps) for _, ps in g) <= 2 for g in groups)
    assert group > 1000 or len(groups) > 2
    a, b = small.arrays(), large.arrays()
    assert all((a[k] == b[k]).all() for k in a)
    large.write().overwrite().save(tmpdir_path + "/f")
    again = forest.ForestModel.load(tmpdir_path + "/f")
    assert again.getOrDefault(again.table) == tmpdir_path + "/f/trees"
    assert again.transform(df).select(*cols).orderBy("id").collect() == want
    PipelineModel(stages=[large]).write().overwrite().save(tmpdir_path + "/p")
    assert PipelineModel.load(tmpdir_path + "/p").transform(df).select(*cols).orderBy("id").collect() == want
    assert large.transform(df.limit(0)).count() == 0


def test_network_epoch_equals_a_plain_loop(spark):
    x, y = blobs(300, 4, 3, seed=9)
    df = frame(spark, x, y)
    t = network.Training(df, "features", "label", [4, 8, 5, 3], seed=3, rate=0.01, l2=0.01, batch_rows=64)
    assert t.n_batches == 5
    batch = {r["id"]: r["b"] for r in df.select("id", F.pmod(F.xxhash64(F.lit(3), vector_to_array("features")), F.lit(5)).alias("b")).collect()}
    batch = np.array([batch[i] for i in range(300)])
    w, m = network.initial([4, 8, 5, 3], 3), None
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for _ in range(2):
        loss, acc = t.epoch()
        total = hit = 0
        for b in range(5):
            rows = batch == b
            h1 = np.maximum(x[rows] @ w[0] + w[1], 0)
            h2 = np.maximum(h1 @ w[2] + w[3], 0)
            z = h2 @ w[4] + w[5]
            p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
            n, yy = rows.sum(), y[rows]
            total -= np.log(p[np.arange(n), yy]).sum()
            hit += (p.argmax(1) == yy).sum()
            d3 = (p - np.eye(3)[yy]) / n
            d2 = d3 @ w[4].T * (h2 > 0)
            d1 = d2 @ w[2].T * (h1 > 0)
            g = [x[rows].T @ d1 + 0.01 * w[0] / n, d1.sum(0), h1.T @ d2 + 0.01 * w[2] / n, d2.sum(0), h2.T @ d3 + 0.01 * w[4] / n, d3.sum(0)]
            step += 1
            for i in range(6):
                m[i] = 0.9 * m[i] + 0.1 * g[i]
                v[i] = 0.999 * v[i] + 0.001 * g[i] ** 2
                w[i] = w[i] - 0.01 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step) * m[i] / (np.sqrt(v[i]) + 1e-8)
        assert abs(loss - total / 300) < 1e-9 and acc == hit / 300
    assert max(np.abs(a - b).max() for a, b in zip(w, t.weights)) < 1e-9
    t.close()


def test_network_learns_and_reloads(spark, tmpdir_path):
    x, y = blobs(400, 4, 3, seed=10)
    df = frame(spark, x, y)
    m = classify.fit_classifier(df, "features", "label", "mlp", 3, hidden=[16], max_epochs=25, rate=0.02, batch_rows=200)
    m.write().overwrite().save(tmpdir_path + "/n")
    p = network.NetworkModel.load(tmpdir_path + "/n").transform(df).select("label", "prediction", vector_to_array("probability").alias("p")).collect()
    assert np.mean([r["label"] == r["prediction"] for r in p]) > 0.9 and all(abs(sum(r["p"]) - 1) < 1e-9 for r in p)
    hist, best = classify.epoch_training(df.where("id < 300"), df.where("id >= 300"), "features", "label", 3, hidden=(16,), rounds=6,
                                         iters_per_round=3, lr=0.02, batch_rows=150)
    assert [h[0] for h in hist] == list(range(1, len(hist) + 1)) and hist[-1][1] < hist[0][1] and max(h[4] for h in hist) > 0.85
    assert best.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.85


def plain_sigmoid(f, y, hi=1.0, lo=0.0):
    a = b = 0.0
    t = np.where(y == 1, hi, lo)
    for _ in range(60):
        p = 1 / (1 + np.exp(a * f + b))
        g = np.array([((t - p) * f).sum(), (t - p).sum()])
        v = p * (1 - p)
        a, b = np.array([a, b]) - np.linalg.solve([[(v * f * f).sum(), (v * f).sum()], [(v * f).sum(), v.sum()]], g)
    return a, b


def test_cross_fitted_sigmoids(spark):
    rng = np.random.default_rng(1)
    f = rng.normal(size=500)
    y = (rng.uniform(size=500) < 1 / (1 + np.exp(-2 * f + 0.3))).astype(int)
    fold = rng.integers(0, 4, 500)
    df = spark.createDataFrame([(i, float(v), int(t), int(k)) for i, (v, t, k) in enumerate(zip(f, y, fold))], "id long, f double, y int, k int")
    got = {r["id"]: r["p"] for r in calibrate.cross_fitted(df.repartition(6), "f", "y", "k", 4, "p").collect()}
    for k in range(4):
        a, b = plain_sigmoid(f[fold != k], y[fold != k])
        for i in np.flatnonzero(fold == k):
            assert abs(got[i] - 1 / (1 + np.exp(a * f[i] + b))) < 1e-7


def test_coupling_gives_back_consistent_pairs():
    p = np.array([[0.5, 0.3, 0.2], [0.1, 0.1, 0.8]])
    r = p[:, :, None] / (p[:, :, None] + p[:, None, :])
    assert np.abs(calibrate.coupled(r) - p).max() < 1e-12


@pytest.mark.parametrize("k", [2, 3])
def test_machine_probabilities_on_held_out_rows(spark, k, tmpdir_path):
    x, y = blobs(700, 3, k, seed=3, spread=1.5)
    df = frame(spark, x, y, fold=np.arange(700) % 5)
    train, test = df.where("id < 500"), df.where("id >= 500")
    m = classify.svm_probabilities(train, "features", "label", "fold", k, n_components=80)
    m.write().overwrite().save(tmpdir_path + "/p")
    rows = PipelineModel.load(tmpdir_path + "/p").transform(test).select("label", "prediction", vector_to_array("probability").alias("p")).collect()
    assert all(abs(sum(r["p"]) - 1) < 1e-9 and min(r["p"]) >= 0 for r in rows)
    loss = np.mean([-np.log(max(r["p"][r["label"]], 1e-12)) for r in rows])
    share = np.bincount(y[:500]) / 500
    assert loss < 0.75 * np.mean([-np.log(share[r["label"]]) for r in rows])
    # Against the sigmoid fitted on the training rows' own margins (two classes).
    if k == 2:
        own = classify.fit_classifier(train, "features", "label", "svm_rbf", 2, C=5.0, n_components=80)
        a, b = classify.platt_fit(classify.margin(own.transform(train)), "margin", "label")
        ms = [(r["label"], r["margin"]) for r in classify.margin(own.transform(test)).collect()]
        old = np.mean([np.logaddexp(0, a * v + b) if t == 1 else np.logaddexp(0, -(a * v + b)) for t, v in ms])
        assert loss <= old + 0.01


def test_sums_over_more_partitions_than_one_task_adds(spark):
    x, y = blobs(600, 3, 2, seed=1)
    packed = blocks.pack(frame(spark, x, y, parts=80), "features", ["label"])
    got = blocks.total(packed, lambda x, y: (x.sum(0), (x * y[:, None]).sum(0)), [(3,), (3,)])
    assert np.abs(got[0] - x.sum(0)).max() < 1e-9 and np.abs(got[1] - (x * y[:, None]).sum(0)).max() < 1e-9
    empty = blocks.total(blocks.pack(frame(spark, x, y).limit(0), "features", ["label"]), lambda x, y: [x.sum(0)], [(3,)])
    assert (empty[0] == 0).all()


def test_feature_maps_are_never_kept_or_sent(spark, monkeypatch):
    """The packed rows stay as wide as they came, and a map sees few rows at a time in fit and scoring."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    df = frame(spark, x, (x[:, 0] * x[:, 1] > 0).astype(int), parts=2)
    packed = blocks.pack(df, "features", ["label"]).persist()
    assert packed.agg(F.sum(F.length("x"))).first()[0] == x.size * 8
    via = spark.sparkContext.broadcast(classify.rff_map(*classify.rff_matrix(3, 2000, 0.5, 1)))
    widest, image = blocks.total(packed, lambda z, y: [[len(z) * z.shape[1]], z.sum(0)], [(1,), (2000,)], via)
    assert widest[0] == 3000 * 2000 and max(len(z) for r in packed.collect() for z, _ in blocks.slices(r, via.value)) * 2000 <= blocks.IMAGE_VALUES
    assert np.allclose(image, via.value(x).sum(0))
    kept = []
    pack = blocks.pack
    monkeypatch.setattr(blocks, "pack", lambda *a, **k: kept.append(pack(*a, **k)) or kept[-1])
    m = classify.fit_classifier(df, "features", "label", "svm_rbf", 2, C=5.0, gamma=0.5, n_components=500)
    assert [p.agg(F.sum(F.length("x"))).first()[0] for p in kept] == [x.size * 8]
    out = m.transform(df)
    assert not any(c == "_svm_in" for c in out.columns)
    assert out.where("prediction = label").count() > 0.95 * 3000


@pytest.mark.parametrize("parts,size", [(1, 7), (5, 7), (40, 5000), (9, 70_001)])
def test_sums_are_added_piece_by_piece_in_order(spark, parts, size):
    rng = np.random.default_rng(6)
    v = rng.normal(size=(parts, size)) * 10.0 ** rng.integers(-8, 8, (parts, 1))
    rdd = spark.sparkContext.parallelize(range(parts), parts).map(lambda i: (i, v[i]))
    want = np.zeros(size)
    for row in v:
        want = want + row
    assert blocks.added(rdd, size).tolist() == want.tolist()
    assert max(len(p) for _, p in blocks.pieces(rdd, 1000, -(-size // 1000)).collect()) <= 1000


def test_an_epoch_is_one_pass_in_lanes(spark, monkeypatch):
    """More minibatches than a lane takes: one job an epoch, all rows met, lanes averaged by their rows."""
    x, y = blobs(1000, 4, 3, seed=12)
    df = frame(spark, x, y)
    passes, added = [], blocks.added
    monkeypatch.setattr(blocks, "added", lambda rdd, size: passes.append(rdd.getNumPartitions()) or added(rdd, size))
    t = network.Training(df, "features", "label", [4, 8, 3], seed=3, rate=0.01, batch_rows=20)
    assert (t.n_batches, t.lanes) == (50, 4)
    mine = [[(a.copy(), b.copy()) for a, b in lane] for lane in t.blocks.glom().collect()]
    assert [len(m) for m in mine] == [len(range(i, 50, 4)) for i in range(4)] and sum(len(b) for m in mine for _, b in m) == 1000
    first = t.weights
    loss, _ = t.epoch()
    assert passes == [4] and loss > 0
    ends = []
    for m in mine:
        w, adam = first, network.Adam(first, 0.01)
        for a, b in m:
            *g, stats = network.gradients(w, a, b)
            w = adam.step(w, [(v + (1e-4 * u if u.ndim == 2 else 0)) / stats[2] for v, u in zip(g, w)])
        ends.append((sum(len(b) for _, b in m), w))
    for i, got in enumerate(t.weights):
        assert np.allclose(got, sum(n * w[i] for n, w in ends) / 1000, atol=1e-12)
    for _ in range(15):
        loss, right = t.epoch()
    assert right > 0.85
    t.close()
