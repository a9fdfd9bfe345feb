import random

import numpy as np
import pytest

from tablelearn.llm import neardup


def shingles(text, n):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    inv = {}
    for i, s in sets.items():
        for x in s:
            inv.setdefault(x, []).append(i)
    near = {(a, b) for ids in inv.values() for a in ids for b in ids if a < b}
    for a, b in near:
        m = len(sets[a] & sets[b])
        if 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "été", "x\xa0y"]

    def mutate(w, k):
        w = list(w)
        for _ in range(k):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        return w
    rows, texts = [], []
    for _ in range(60):
        texts.append([rnd.choice(vocab) for _ in range(rnd.randint(1, 120))])
    base = [rnd.choice(vocab) for _ in range(160)]
    texts += [mutate(base, rnd.randint(0, 12)) for _ in range(150)]  # around the threshold, one bucket group
    chain = [rnd.choice(vocab) for _ in range(100)]
    for _ in range(25):  # a chain of small changes
        chain = mutate(chain, 2)
        texts.append(chain)
    for t in list(texts[:60]):
        texts += [mutate(t, rnd.randint(0, 3)) for _ in range(3)]
    rnd.shuffle(texts)
    for i, w in enumerate(texts):
        sep = rnd.choice([" ", "\n", "  ", "\t"])
        t = sep.join(w)
        rows.append((i * 3 + 1, t.upper() if rnd.random() < .2 and "É" not in t and "é" not in t else t))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "one"), (5004, "ONE"), (5005, "one two"), (5006, "long " * 30000)]
    return rows


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, monkeypatch, n, percent):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "a") for i, t in rows], "doc_id long, text string, kept int, id string")
    want = brute(rows, n, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, n, percent).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows) - 50


def test_repeated_null_and_empty(spark):
    t = "a b c d e f g h"
    rows = [(3, t), (3, t), (2, t + " "), (None, t), (7, None), (7, None)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect()), key=str)
    assert got == sorted([(3, 6, 2, False)] * 2 + [(2, 6, 2, True), (None, 6, None, True)] + [(7, 0, 7, True)] * 2, key=str)
    assert neardup.near_duplicates(out.limit(0).withColumnRenamed("kept", "text"), 3, 85).collect() == []


def test_sequential_test_keeps_what_it_must():
    least = neardup.least_equal(0.85)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2 ** 32, (20000, neardup.HASHES), dtype=np.uint32)
    same = rng.random(a.shape) < 0.85
    assert len(neardup.bayes_keep(a, np.where(same, a, a + 1), least)) == 20000
    assert len(neardup.bayes_keep(a, np.where(rng.random(a.shape) < 0.4, a, a + 1), least)) < 100


def test_components_of_a_path(spark):
    ids = list(range(1, 200))
    random.Random(3).shuffle(ids)
    links = spark.createDataFrame([(min(x, y), max(x, y)) for x, y in zip(ids, ids[1:])], "a long, b long")
    assert {r["root"] for r in neardup.components(links).collect()} == {1}


def test_long_text_in_blocks_has_the_same_words():
    from tablelearn.llm.common import WordHashes, word_codes
    text = " ".join(f"word{i}\t\n" for i in range(5000)).encode()
    whole = word_codes(text, WordHashes())
    for block in (1, 7, 1000):
        assert np.array_equal(word_codes(text, WordHashes(), block), whole)
    assert len(whole) == 5000 and len(word_codes(b"", WordHashes(), 1)) == 0


def test_texts_that_share_an_id_are_each_compared(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for k in range(40):
        some = [[f"v{rnd.randrange(10 ** 6)}" for _ in range(60)] for _ in range(3)]
        near = some[k % 3][:-1] + ["other"]
        first, second = 10 * k, 10 * k + 1
        mine, yours = (first, second) if k % 2 else (second, first)
        rows += [(mine, " ".join(w)) for w in some] + [(yours, " ".join(near))]
        want |= {first: first, second: first}
    for k in range(40, 60):  # candidates that fail, both with an empty text besides
        w = [f"v{rnd.randrange(10 ** 6)}" for _ in range(120)]
        far = w[:40] + ["x"] + w[41:80] + ["y"] + w[81:100] + ["z"] * 8 + w[108:]
        rows += [(10 * k, " ".join(w)), (10 * k, ""), (10 * k + 1, " ".join(far)), (10 * k + 1, None)]
        want |= {10 * k: 10 * k, 10 * k + 1: 10 * k + 1}
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert len(out) == len(rows) and {(r["doc_id"], r["component_id"]) for r in out} == set(want.items())
