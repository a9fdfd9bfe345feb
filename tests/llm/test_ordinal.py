import random

import numpy as np
import pytest

from tablelearn.llm import ordinal

SF = "/root/testdata/sf0.1"


def test_gradients_match_differences():
    theta, rng = np.array([-0.7, 0.2, 1.5]), np.random.default_rng(0)

    def loss(s, th, y):
        hi, lo = ordinal.edges(th, y, s)
        return -np.log(hi - lo)
    for _ in range(50):
        s, y = rng.normal(), int(rng.integers(0, 4))
        hi, lo = ordinal.edges(theta, y, s)
        assert abs((loss(s + 1e-6, theta, y) - loss(s - 1e-6, theta, y)) / 2e-6 - (1 - hi - lo)) < 1e-5


def test_thresholds_stay_ordered_and_calibration_recovers_them():
    assert (np.diff(ordinal.ordered(np.array([1.0, 0.0, 3.0]))) > 0).all()
    rng, true = np.random.default_rng(2), np.array([-1.0, 0.5])
    s = rng.normal(size=30000) * 2
    y = (rng.random(30000)[:, None] > ordinal.sigmoid(true[None] - 1.5 * s[:, None])).sum(1)
    a, theta = ordinal.calibrate(s, y, np.ones(30000), np.array([-0.2, 0.2]))
    assert abs(a - 1.5) < 0.1 and np.abs(theta - true).max() < 0.1


def test_tail_and_expectation_agree_with_the_formula():
    f = ordinal.Featurizer()
    ids, x = f("one two two, THREE!!")
    w = np.zeros(ordinal.SIZE + ordinal.SHAPES)
    w[ids] = 0.3
    m = {"values": [0, 1, 2], "w": w, "theta": np.array([-1.0, 1.0]), "scale": 2.0}
    e, t = ordinal.graded(["one two two, THREE!!", "", None], m, f, 2)
    s = 2 * 0.3 * x.sum()
    p = [1 / (1 + np.exp(-(h - s))) for h in m["theta"]]
    assert abs(t[0] - (1 - p[1])) < 1e-12 and abs(e[0] - (p[1] - p[0] + 2 * (1 - p[1]))) < 1e-12 and not e[1:].any() and not t[1:].any()


@pytest.fixture(scope="module")
def rated(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = ordinal.rated(spark.read.parquet(f"{SF}/labels.parquet"))
    return docs, labels


def test_held_out_ratings(rated):
    docs, labels = rated
    test = labels.where("id % 5 = 0")
    model = ordinal.fit(docs, labels.where("id % 5 <> 0"), per_grade=400)
    assert model["values"] == [0, 1, 2] and (np.diff(model["theta"]) > 0).all() and 0 < (model["w"] != 0).mean() < 0.2
    got = ordinal.grade(docs, model).join(test.withColumnRenamed("id", "doc_id"), "doc_id").collect()
    y, e = np.array([r["grade"] for r in got]), np.array([r["expected_grade"] for r in got])
    keep = np.array([r["selected"] for r in got])
    assert keep[y == 2].mean() > 0.97 and keep[y == 0].mean() < 0.1 and keep[y == 1].mean() < 0.35
    assert e[y == 0].mean() < e[y == 1].mean() < e[y == 2].mean() and ((e >= 0) & (e <= 2)).all()


def test_rows(spark):
    rnd = random.Random(1)
    text = lambda k: " ".join(rnd.choice(f"good{j} bad{j} so{j}".split()[k::3] + ["and", "the"]) for j in [rnd.randrange(5) for _ in range(20)])
    rows = [(i, text(i % 3), 1) for i in range(300)] + [(1000, None, 1), (1001, "", 1), (None, text(0) * 2000, 1), (5, rnd.choice("ab"), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, selected int")
    ratings = spark.createDataFrame([(i, {0: 2, 1: 0, 2: 1}[i % 3]) for i in range(300)] * 2 + [(None, 1), (7777, 2)], "id long, grade int")
    model = ordinal.fit(docs, ratings)
    got = {r["doc_id"]: r for r in ordinal.grade(docs, model).collect()}
    assert ordinal.grade(docs, model).count() == len(rows)
    assert got[1000]["expected_grade"] == 0 == got[1001]["tail_prob"] and got[None]["selected"]
    assert np.mean([got[i]["selected"] == (i % 3 == 0) for i in range(300) if i != 5]) > 0.95
    assert ordinal.fit(docs, ratings.limit(0)) is None and not any(r["selected"] for r in ordinal.grade(docs, None).collect())
    one = ordinal.fit(docs, ratings.where("grade = 2"))
    assert {r["expected_grade"] for r in ordinal.grade(docs, one).where("doc_id < 300").collect()} == {2.0}
    assert ordinal.grade(docs.limit(0), model).collect() == []
