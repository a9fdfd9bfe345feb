import zlib
from collections import Counter

import numpy as np
import pytest

from tablelearn.llm import langid

SF = "/root/testdata/sf0.01"


def naive_grams(text):
    c = "".join(x.lower() if x.isalpha() else " " for x in f" {text} ")
    c = " " + " ".join(c.split()) + " " if c.split() else " "
    out = Counter(x for x in c if x != " ")
    for n in (2, 3):
        out.update(c[i:i + n] for i in range(len(c) - n + 1))
    return out


def test_grams_equal_a_plain_count():
    texts = ["Hello, Wörld 12 é", "", "  ..!", "a", "Übung\n\nmacht   den Meister", "x1y2z"]
    who, bucket, has = langid.grams([p for t in texts for p in langid.pieces(t)])
    assert has.tolist() == [any(c.isalpha() for c in t) for t in texts]
    for k, t in enumerate(texts):
        mine = bucket[who == k]
        want = naive_grams(t)
        assert len(mine) == sum(want.values()) and sorted(Counter(mine.tolist()).values()) == sorted(want.values()), t


def test_cutting_a_long_text_changes_no_count(monkeypatch):
    import random
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab é.1  ß\n") for _ in range(rnd.randint(0, 60))) for _ in range(400)] + ["a" * 50, " " * 50, "..a.." * 9, "a" + "." * 40 + "b"]
    whole = [langid.counts(t) for t in texts]
    w = np.random.default_rng(0).normal(size=(langid.SIZE, 3))
    scores = langid.logits(texts, w)
    for chunk in (1, 2, 3, 7):
        monkeypatch.setattr(langid, "GRAM_CHUNK", chunk)
        for t, (ids, n) in zip(texts, whole):
            got = langid.counts(t)
            assert got[0].tolist() == ids.tolist() and got[1].tolist() == n.tolist(), (t, chunk)
        cut = langid.logits(texts, w)
        assert np.allclose(cut[0], scores[0]) and (cut[1] == scores[1]).all()


def test_ftrl_follows_the_formula():
    texts, idf = ["aa ab", "ba bb", "ab ab"], np.linspace(1, 2, langid.SIZE)
    z, n = np.zeros((langid.SIZE, 2)), np.zeros((langid.SIZE, 2))
    langid.ftrl_pass(z, n, [(t, k % 2) for k, t in enumerate(texts)], idf)
    zz, nn = {}, {}
    for k, t in enumerate(texts):
        ids, v = langid.tf(t)
        x = {int(i): a * idf[i] for i, a in zip(ids, v)}
        w = {}
        for i in x:
            for y in (0, 1):
                a, b = zz.get((i, y), 0.0), nn.get((i, y), 0.0)
                w[i, y] = 0.0 if abs(a) <= langid.L1 else -(a - np.sign(a) * langid.L1) / ((langid.BETA + b ** .5) / langid.ALPHA + langid.L2)
        s = np.array([sum(x[i] * w[i, y] for i in x) for y in (0, 1)])
        p = np.exp(s) / np.exp(s).sum()
        for i in x:
            for y in (0, 1):
                g = x[i] * (p[y] - (y == k % 2))
                b = nn.get((i, y), 0.0)
                zz[i, y] = zz.get((i, y), 0.0) + g - ((b + g * g) ** .5 - b ** .5) / langid.ALPHA * w[i, y]
                nn[i, y] = b + g * g
    assert all(abs(z[i, y] - v) < 1e-9 for (i, y), v in zz.items()) and np.count_nonzero(n) == len([v for v in nn.values() if v])


def test_temperature_recovers_the_scale():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20000, 3))
    y = (langid.softmax(x).cumsum(1) > rng.random((20000, 1))).argmax(1)
    assert abs(langid.temperature(4 * x, y) - 4) < 0.3


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs)


def test_document_frequencies_cover_all_learnable(docs):
    rows = langid.learnable(docs, "doc_id", "text", "lang")
    df, n = langid.document_frequencies(rows)
    texts = [r["text"] for r in rows.collect()]
    want = np.zeros(langid.SIZE, int)
    for t in texts:
        want[np.unique(langid.grams(langid.pieces(t))[1])] += 1
    assert n == len(texts) and (df == want).all()


def test_held_out_accuracy(docs, model):
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.identify(docs, model).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    right = np.array([r["lang_pred"] == lang[r["doc_id"]] for r in held])
    score = np.array([r["score"] for r in held])
    assert right.mean() > 0.96 and ((score > 0) & (score <= 1)).all() and abs(score.mean() - right.mean()) < 0.05
    assert 0 < (model["weights"] != 0).mean() < 0.5  # sparse


def test_rows(spark, docs, model):
    rows = [(1, None, "en", 3), (2, "", "en", 3), (3, "12 !!", None, 3), (4, "the of and", None, 4), (4, "the of and", None, 4),
            (None, "der die und " * 60000, "xx", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in langid.identify(df, model).collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de")], key=str)
    kept = langid.keep_known(df, model)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [4, 4, None]
    none = langid.fit(df.where("doc_id < 3").withColumn("lang", df["lang"].substr(9, 1)).where("lang > 'a'"))
    assert none["langs"] == [] and {r["lang_pred"] for r in langid.identify(df, none).collect()} == {"und"}
    assert langid.keep_known(df, none).collect() == [] == langid.identify(df.limit(0), model).collect()


def test_predictions_see_the_text_alone(spark, docs, model):
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    other = docs.withColumn("lang", docs["source"]).withColumn("doc_id", docs["doc_id"] + 100000)
    b = {r["doc_id"] - 100000: (r["lang_pred"], r["score"]) for r in langid.identify(other, model).collect()}
    assert a.keys() == b.keys() and all(a[k][0] == b[k][0] and abs(a[k][1] - b[k][1]) < 1e-9 for k in a)
