import collections
import hashlib
import random

import numpy as np
import public_tokenizers as p
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablelearn.llm import alignment

A, B = p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")


def _texts():
    rnd = random.Random(5)
    al = " \n\t  ab'sréß1!%中😀<|endoftext|>\r\xa0▁"
    some = ["Hello world", "", None, "   lead and  two ", "<s>x</s> <unk> <|endoftext|> <0x41>", "a▁b", "naïve café", "中文字 ok", "=" * 90,
            "x" * 700, " " * 333, "tab\tand\nline", "A" * 64 + "😀" * 9, "Hello world", "The theory of thermodynamics"]
    return some + ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 60))) for _ in range(150)]


def plain(texts):
    """Everything by hand, token by token and pair by pair."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    from tablelearn.llm.bpe import byte_chars
    byte_of = {c: b for b, c in enumerate(byte_chars())}
    out, docs = [], collections.Counter()
    for text in texts:
        row = {"groups": [], "links": collections.Counter(), "n": (0, 0)}
        out.append(row)
        if not text:
            continue
        e = t.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(byte_of[c] for c in tok)) for i, tok in zip(e.ids, e.tokens)]
        b = [(i, bytes([int(tok[3:5], 16)]) if sp.is_byte(i) else tok.replace("▁", " ").encode())
             for i, tok in zip(sp.encode(text), sp.encode(text, out_type=str))]
        want = (" " + text).encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            continue
        row["n"] = len(a), len(b)
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (a, b)]
        shared = ends[0] & ends[1]
        gs, sides = [], []
        for side in (a, b):
            split, now, at = [], [], 0
            for i, x in side:
                at += len(x)
                now.append(i)
                if at in shared:
                    split.append(now)
                    now = []
            sides.append(split)
        for x, y in zip(*sides):
            gs.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            for i in x:
                for j in y:
                    row["links"][i, j] += 1
        row["groups"] = gs
        docs.update(row["links"].keys())
    top = collections.Counter()
    for (i, j), n in docs.items():
        top[i] = max(top[i], n)
    for row in out:
        row["best"] = sum(n for (i, j), n in row["links"].items() if docs[i, j] == top[i])
        row["sum"] = sum(n * docs[k] for k, n in row["links"].items())
    return out


@pytest.mark.parametrize("block", [alignment.PAIR_BLOCK, 5])
def test_groups_and_links_by_hand(block, monkeypatch):
    monkeypatch.setattr(alignment, "PAIR_BLOCK", block)
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    texts = [x or "" for x in _texts()]
    for text, row, want in zip(texts, aligner.batch(texts), plain(texts)):
        assert row[:2] == want["n"] and row[4] == ";".join(want["groups"]) and row[2] == len(want["groups"]), text
        assert row[3] == sum(want["links"].values())
        assert dict(zip(row[5].tolist(), row[6].tolist())) == {i << 32 | j: n for (i, j), n in want["links"].items()}


def test_byte_side_gives_the_ids_of_the_tokenizers_library():
    with open(A, encoding="utf-8") as f:
        side = alignment.ByteSide(f.read())
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    assert side.fast is not None
    rnd = random.Random(7)
    texts = [x or "" for x in _texts()] + ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(128, 0x3000)])) for _ in range(40)) for _ in range(2000)]
    texts += [" " * 120_000 + "x", "\n " * 60_000, "ab" * 50_000]
    ids, n = side.encode(texts)
    want = [e.ids for e in t.encode_batch([" " + x for x in texts], add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_long_texts_part_by_part(monkeypatch):
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        aligner = alignment.Aligner(f.read(), g.read())
    rnd = random.Random(2)
    texts = ["".join(rnd.choice(["some", "words", " ", " ", "é", "1", "  ", "中", "x\n"]) for _ in range(300)) for _ in range(20)]
    whole = list(aligner.batch(texts))
    monkeypatch.setattr(alignment, "LONG_TEXT", 40)
    for t, w in zip(texts, whole):
        got = aligner.one(t)
        assert got[:5] == w[:5] and got[5].tolist() == w[5].tolist() and got[6].tolist() == w[6].tolist()
    assert aligner.one("some words here " * 20 + "a▁b")[:5] == (0, 0, 0, 0, "")


@pytest.mark.parametrize("broadcast", [True, False])
def test_query_by_hand(spark, broadcast, monkeypatch):
    """The whole result, with the counts sent to all tasks and joined block by block."""
    if not broadcast:
        plainly = alignment.scored
        monkeypatch.setattr(alignment, "scored", lambda df, id_col="doc_id": plainly(df, id_col, max_broadcast=0))
        monkeypatch.setattr(alignment, "BLOCK_DOCS", 7)
    texts = _texts()
    rows = [(i, x, "c") for i, x in enumerate(texts)] + [(None, "null id", "c"), (0, texts[0], "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumnRenamed("lang", "Text").repartition(3)
    got = alignment.digests(df, A, B).collect()
    assert len(got) == len(rows)
    want = dict(zip([r[0] for r in rows[:-1]], plain([r[1] for r in rows])))
    for r in got:
        w = want[r["doc_id"]]
        groups = ";".join(w["groups"])
        assert (r["n_a"], r["n_b"]) == w["n"] and r["n_groups"] == len(w["groups"]) and r["n_links"] == sum(w["links"].values())
        assert (r["n_best"], r["count_sum"]) == (w["best"], w["sum"]), r
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.digests(df, A, B).collect() == []
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in alignment.digests(df, A, B).collect()} == {(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")}
