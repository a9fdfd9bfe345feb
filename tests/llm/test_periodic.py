import hashlib
import random
import zlib

import numpy as np
import pytest

from tablelearn.llm import periodic


def smallest_period(w):
    fail = [0] * len(w)
    for i in range(1, len(w)):
        k = fail[i - 1]
        while k and w[i] != w[k]:
            k = fail[k - 1]
        fail[i] = k + (w[i] == w[k])
    return len(w) - fail[-1]


def plain_runs(w, min_length=12):
    """Every lag, every maximal stretch, kept where the lag is the smallest period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, 2 * q) and smallest_period(w[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def _fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def _cases(rnd):
    yield []
    yield ["x"]
    yield ["x"] * 11
    yield ["x"] * 12
    yield ["x"] * 700
    yield _fibonacci(400)
    yield list("ababa" * 2 + "c") * 6
    yield (["a"] * 40 + ["b"]) * 5 + ["a"] * 60
    yield list("abababab" * 3 + "c") * 4 + list("ab" * 20)
    for _ in range(250):
        n = rnd.randint(1, 120)
        yield [rnd.choice("ab") for _ in range(n)]
    for _ in range(150):
        out = [rnd.choice("abc") for _ in range(rnd.randint(0, 5))]
        for _ in range(rnd.randint(1, 4)):
            p = [rnd.choice("abcd") for _ in range(rnd.randint(1, 40))]
            out += (p * 12)[:rnd.randint(1, 200)]
        yield out
    for _ in range(60):  # periods within periods
        p = [rnd.choice("ab") for _ in range(rnd.randint(1, 4))] * rnd.randint(2, 15) + [rnd.choice("abc")]
        p = (p * rnd.randint(1, 3) + [rnd.choice("ac")]) * rnd.randint(1, 3)
        yield (p * 5)[rnd.randint(0, 5):][:400]


@pytest.mark.parametrize("min_length", [12, 2, 3, 7, 11])
def test_same_runs_as_every_lag(min_length):
    for w in _cases(random.Random(min_length)):
        _, got, _, _ = periodic.runs_of([" ".join(w).encode()], min_length)
        assert [tuple(r) for r in got.tolist()] == plain_runs(w, min_length), w


def test_many_documents_at_once_and_small_slices(monkeypatch):
    docs = list(_cases(random.Random(4)))
    monkeypatch.setattr(periodic, "SLICE", 37)
    words, got, per_doc, kept = periodic.runs_of([" ".join(w).encode() for w in docs])
    ends = np.cumsum(per_doc)
    at = 0
    for w, e, c in zip(docs, ends, per_doc):
        want = plain_runs(w)
        assert [tuple(r) for r in got[e - c:e].tolist()] == want
        drop = {i for s, n, q in want for i in range(s + q, s + n)}
        assert kept[at:at + len(w)].tolist() == [i not in drop for i in range(len(w))]
        at += len(w)


def test_one_word_fills_a_long_text(monkeypatch):
    seen = []
    plain = periodic.seeds

    def counted(*a):
        lag, i = plain(*a)
        seen.append(len(lag))
        return lag, i
    monkeypatch.setattr(periodic, "seeds", counted)
    n = 200_000
    _, got, _, kept = periodic.runs_of([b"w " * n])
    assert got.tolist() == [[0, n, 1]] and kept.sum() == 1
    block = (b"a " * 500 + b"b ") * 100
    _, got, _, _ = periodic.runs_of([block])
    assert [0, 50100, 501] in got.tolist() and len(got) == 101
    assert max(seen) < 12 * n and sum(seen) < 20 * n


def test_on_spark(spark):
    loop = "one two three four five\tsix " * 9
    rows = [(1, loop, "x"), (2, None, "y"), (3, "", None), (3, "", None), (None, "a\nb  c", "z"), (10, "p q r s t u v " * 30, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string").withColumnRenamed("n_words", "Text")
    out = periodic.runs(df)
    got = out.collect()
    rep = {r["doc_id"]: r for r in periodic.report(out).collect()}
    assert len(got) == 6
    by = {r["doc_id"]: r for r in got}
    assert [tuple(x) for x in by[1]["runs"]] == [(0, 54, 6)] and by[1]["collapsed"] == "one two three four five six"
    assert by[None]["collapsed"] == "a b c" and by[2]["n_words"] == 0 and by[3]["runs"] == []
    assert rep[1].asDict() == {"doc_id": 1, "n_runs": 1, "start": 0, "length": 54, "period": 6, "exponent_milli": 9000,
                               "runs_sha256": hashlib.sha256(b"0,54,6\n").hexdigest(),
                               "collapsed_sha256": hashlib.sha256(b"one two three four five six").hexdigest()}
    assert rep[2]["start"] is None and rep[2]["runs_sha256"] == hashlib.sha256(b"").hexdigest() == rep[2]["collapsed_sha256"]
    assert periodic.runs(df.limit(0)).collect() == []


def test_query_against_every_lag(spark):
    """The whole query on a small table with nulls, periodic tails and repeated words."""
    from tablelearn.llm.queries import op11_periodic_table
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice(["a", "bb", "cé"] if i % 3 else list("abcdefghijklmnop")) for _ in range(rnd.randint(0, 90)))) for i in range(300)]
    rows += [(300, None), (301, "")]
    got = {r["doc_id"]: r for r in op11_periodic_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    looped = 0
    for i, text in rows:
        w, h = (text or "").split(" ") if text else [], zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
            looped += 1
        want = plain_runs(w)
        drop = {x for s, m, q in want for x in range(s + q, s + m)}
        best = min(want, key=lambda r: (-r[1], r[0], r[2])) if want else (None,) * 3
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(want), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if want else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in drop).encode()).hexdigest()
    assert looped > 10
