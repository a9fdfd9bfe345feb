import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablelearn.llm import bpe
from tablelearn.llm.queries import vocabulary


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def _texts():
    rnd = random.Random(5)
    al = " \n\t  ab'sréß1!%中😀<|endoftext|>\r\xa0\x85\x1c"
    odd = ["", " ", "<|endoftext|>", " <|endoftext|> x", "a" * 3000, "xyz" * 700 + "q", "ab" * 2500, "a  b\n\n c\n  d",
           "it's we'll 'quoted'  123abc", "0123456789" * 300, " " * 2000, "\n" * 700 + " x"]
    return odd + ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 80))) for _ in range(3000)]


def test_same_ids_and_text_as_the_tokenizers_library(reference):
    enc = bpe.Encoder(bpe.Tables.read(vocabulary()))
    texts = _texts()
    ids, n = enc.batch(texts)
    back, at = bpe.decode_ids(enc.t, ids, n), 0
    for text, k, ref, b in zip(texts, n.tolist(), reference.encode_batch(texts, add_special_tokens=False), back):
        assert ids[at:at + k].tolist() == ref.ids, text[:60]
        assert b == reference.decode(ref.ids, skip_special_tokens=False)
        at += k


def test_every_code_point(reference):
    enc = bpe.Encoder(bpe.Tables.read(vocabulary()))
    chars = [chr(c) for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x2100)]
    texts = [f"a{c}b 1{c}! {c}\n" for c in chars]
    ids, n = enc.batch(texts)
    want = [i for r in reference.encode_batch(texts, add_special_tokens=False) for i in r.ids]
    assert ids.tolist() == want


def test_cache_reset_changes_nothing(monkeypatch):
    t = bpe.Tables.read(vocabulary())
    a, b = bpe.Encoder(t), bpe.Encoder(t)
    texts = _texts()[:400]
    whole = a.batch(texts)
    monkeypatch.setattr(bpe, "MAX_UNITS", 10)
    parts = [b.batch(texts[i:i + 20]) for i in range(0, 400, 20)]
    assert np.array_equal(whole[0], np.concatenate([p[0] for p in parts]))


def test_on_spark(spark, reference):
    rows = [(1, "Hello  world", "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "ab " * 40000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumnRenamed("n_tokens", "ids")
    out = bpe.encode(df, vocabulary(), decoded=True)
    got = {(r["doc_id"], r["n_tokens"]): r for r in out.collect()}
    assert len(out.collect()) == 5
    for i, text, _ in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        r = got[(i, len(ids))]
        assert r["ids"] == np.array(ids, "<u4").tobytes() and r["decoded"] == (text or "")
    d = {r["doc_id"]: r for r in bpe.digests(out).collect()}
    assert d[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest() == d[2]["decoded_sha256"]
    back = {r["doc_id"]: r["text"] for r in bpe.decode(out.drop("decoded"), vocabulary()).collect()}
    assert back == {i: t or "" for i, t, _ in rows}
    assert bpe.encode(df.limit(0), vocabulary()).collect() == []


def test_long_texts_part_by_part(spark, reference, monkeypatch):
    import random as r
    rnd = r.Random(9)
    texts = ["".join(rnd.choice(["ab", " ", "  ", "\n", "é", "<|endoftext|>", "12", "!?", "'s", "\xa0", "x y"]) for _ in range(400)) for _ in range(60)]
    monkeypatch.setattr(bpe, "LONG_TEXT", 37)
    enc = bpe.Encoder(bpe.Tables.read(vocabulary()))
    for t in texts:
        some = bpe.parts(t)
        assert "".join(some) == t
        ids, n = enc.batch(some)
        assert ids.tolist() == reference.encode(t, add_special_tokens=False).ids
    assert sum(len(bpe.parts(t)) > 3 for t in texts) > 30


def test_a_text_beyond_the_limit(spark, reference):
    text = "some words in a row, " * 250_000
    r = bpe.encode(spark.createDataFrame([(1, text), (2, "b")], "doc_id long, text string"), vocabulary(), decoded=True).orderBy("doc_id").collect()
    ids = reference.encode(text, add_special_tokens=False).ids
    assert r[0]["n_tokens"] == len(ids) and r[0]["ids"] == np.array(ids, "<u4").tobytes() and r[0]["decoded"] == text and r[1]["decoded"] == "b"
