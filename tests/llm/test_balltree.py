import numpy as np
import pytest

from tablelearn.llm import balltree


def brute(rows, k=5, every=50):
    vecs = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        vecs[(i, tuple(np.floor(256 * np.array(v, float)).astype(int).tolist()))] = 1
    out = {}
    for i, a in vecs:
        if i % every:
            continue
        s = {(-sum(x * y for x, y in zip(a, b)), j) for j, b in vecs if j != i and len(a) == len(b)}
        out.setdefault(i, set()).update(s)
    return sorted((i, r + 1, j, -s) for i, ss in out.items() for r, (s, j) in enumerate(sorted(ss)[:k]))


@pytest.mark.parametrize("shard,block", [(5000, 20000), (60, 4)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(balltree, "SHARD_ROWS", shard)
    monkeypatch.setattr(balltree, "BLOCK_ROWS", block)
    monkeypatch.setattr(balltree, "LEAF", 8)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(600)]
    rows += [(i, [0.5] * 6) for i in range(600, 760)]  # many copies: ties
    rows += [(100, rows[100][1]), (1000, None), (1050, []), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1150, [float("nan")] * 6),
             (1200, [float("inf")] * 6), (None, [1.0] * 6), (1250, [1.0, 2.0]), (1251, [1.0, 3.0]), (1300, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted(tuple(r) for r in balltree.top_k(df).collect())
    assert got == brute(rows)


def test_huge_components_and_empty_table(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 0.0]), (3, [3e7, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in balltree.top_k(df).orderBy("rank").collect()]
    assert got == [(1, 2 ** 63 - 1), (3, 2 ** 63 - 1), (2, -2 ** 63 + 1)]
    assert balltree.top_k(df.limit(0)).collect() == []


def test_tree_cuts_but_keeps_the_best():
    rng = np.random.default_rng(0)
    x = (rng.normal(size=(3000, 3)) * 200).astype(np.int64)
    tree = balltree.BallTree(x, 32)
    q = x[:5]
    s = q @ x.T
    low = np.sort(s, 1)[:, -5].astype(float)
    who, leaf, bound = tree.leaves(q, low)
    for k in range(5):
        seen = np.concatenate([tree.rows[n] for n in leaf[who == k]])
        assert set(np.flatnonzero(s[k] >= low[k])) <= set(seen) and len(seen) < 1500
