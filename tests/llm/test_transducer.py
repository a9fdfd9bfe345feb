import hashlib
import random

import numpy as np
import public_tokenizers as p
import pytest
import tiktoken

from tablelearn.llm import transducer

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def _ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.fixture(scope="module", params=FILES)
def both(request):
    ranks = transducer.read_ranks(p.path(request.param))
    return transducer.Encoder(transducer.Merges(ranks), p.PATTERN), \
        tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    rnd = random.Random(5)
    al = " \n\t  ab'sréß1!%中😀<|endoftext|>\r\xa0\x85\x1c"
    odd = ["", " ", "<|endoftext|>", "a" * 3000, "xyz" * 700 + "q", "ab" * 2500, "a  b\n\n c\n  d", "it's we'll 'quoted'  123abc",
           "0123456789" * 300, " " * 2000, "\n" * 700 + " x", "internationalization" * 90, "=" * 501]
    return odd + ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 80))) for _ in range(2000)]


def test_same_ids_as_the_tiktoken_library(both):
    enc, library = both
    for text in _texts():
        assert _ids(enc.text(text)) == library.encode_ordinary(text), text[:60]


def test_every_code_point(both):
    enc, library = both
    for c in [*range(0x2100), *range(0x2100, 0x30000, 7)]:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b 1{chr(c)}! {chr(c)}\n"
            assert _ids(enc.text(text)) == library.encode_ordinary(text), hex(c)


def test_random_ranks_against_the_merges():
    """Small made vocabularies with many overlapping tokens, also such as their own bytes do not merge to."""
    rnd = random.Random(3)
    for trial in range(120):
        ranks = {bytes([c]): c for c in range(256)}
        pool = [b"a", b"b", b"c"]
        while len(ranks) < 256 + rnd.randint(3, 25):
            t = rnd.choice(pool) + rnd.choice(pool) if trial % 3 else bytes(rnd.choice(b"abc") for _ in range(rnd.randint(2, 5)))
            if len(t) < 9 and t not in ranks:
                ranks[t] = len(ranks)
                pool.append(t)
        m = transducer.Merges(ranks)
        machine = transducer.Machine(m)
        for _ in range(60):
            w = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 30)))
            want = [ranks[w]] if w in ranks else [ranks[t] for t in transducer.merge(ranks, w)]
            assert _ids(machine.encode(w)) == want, (trial, w)


def test_output_lags_by_few_tokens_and_forgetting_changes_nothing(both, monkeypatch):
    enc, library = both
    assert max(len(path) for threads in enc.machine.states for path, _ in threads) < 64
    monkeypatch.setattr(transducer, "MAX_STATES", 40)
    monkeypatch.setattr(transducer, "MAX_CACHE", 2000)
    small = transducer.Encoder(enc.machine.merges, p.PATTERN)
    for text in _texts()[:300]:
        assert _ids(small.text(text)) == library.encode_ordinary(text)
    assert len(small.machine.states) < 3000 and small.held < 200_000


def test_utf8_machine_at_every_cut():
    rnd = random.Random(1)
    samples = ["añ中😀x".encode(), b"\xe0\xa0", b"\xf0\x90\x80", b"\xed\xa0\x80z", b"\xf4\x90\x80\x80", b"\xc3\xc3\xa9", b"\x80\x80a\xff",
               b"\xe4\xb8\xf0\x9f\x98\x80"] + [bytes(rnd.choice(b"a\x80\x9f\xa0\xbf\xc2\xe0\xe4\xed\xf0\xf1\xf4\xff") for _ in range(rnd.randint(1, 12)))
                                          for _ in range(3000)]
    for data in samples:
        for size in (1, 2, 3, 5):
            m = transducer.Utf8()
            got = "".join(m.feed(data[i:i + size]) for i in range(0, len(data), size)) + m.finish()
            assert got == data.decode("utf-8", "replace"), data


def test_on_spark(spark, monkeypatch):
    path = p.path(FILES[0])
    library = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=transducer.read_ranks(path), special_tokens={})
    long = "ab 中é " * 900_000
    rows = [(1, "Hello  world", "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "ab " * 40000, "z"), (7, long, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumnRenamed("lang", "Text")
    out = transducer.encode(df, path, p.PATTERN, decoded=True)
    got = out.collect()
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    for i, text, _ in rows:
        assert _ids(by[i]["ids"]) == library.encode_ordinary(text or "") and by[i]["n_tokens"] == len(by[i]["ids"]) // 4
        assert bytes(by[i]["decoded"]).decode() == (text or "")
    d = {r["doc_id"]: r for r in transducer.digests(out).collect()}
    assert d[2]["ids_sha256"] == hashlib.sha256(b"").hexdigest() == d[2]["decoded_sha256"]
    assert {r["doc_id"]: r["text"] for r in transducer.decode(out.drop("decoded"), path).collect()} == {i: t or "" for i, t, _ in rows}
    odd = spark.createDataFrame([(1, np.array([10 ** 6, 15496], "<u4").tobytes() + b"\x01")], "doc_id long, ids binary")
    assert transducer.decode(odd, path).collect()[0]["text"] == "Hello"
    assert transducer.encode(df.limit(0), path).collect() == []
