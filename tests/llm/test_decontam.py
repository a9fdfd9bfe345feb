import random

import pytest

from tablelearn.llm import decontam


def words(text):
    w = [x.decode().lower().strip(decontam._EDGE) for x in (text or "").encode().split()]
    return [x for x in w if x]


def sets(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(docs, items, n=5, least=0.8):
    its = {(i, frozenset(s)) for i, t in items if i is not None and (s := sets(t, n))}
    return sorted(((d, i, len(s), m) for d, t in docs for own in [sets(t, n)] for i, s in its
                   if (m := len(s & own)) >= least * len(s) - 1e-9), key=str)


def data():
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([6, 9, 12, 20, 33, 60, 150]))) for i in range(80)]
    items += [(200, "only four words here"), (201, None), (202, ""), (None, text(9)), (203, "... !!"), (204, items[0][1])]
    docs = []
    for d in range(150):
        w = text(rnd.choice([5, 30, 300, 4000])).split()
        if d % 2:
            t = rnd.choice(items[:80])[1].split()
            cut = rnd.choice([0, 0, 1, len(t) // 8, len(t) // 3])
            at = rnd.randrange(len(w) + 1)
            w[at:at] = t[cut:]
        if d % 3 == 0:
            w = [x.upper() + rnd.choice([".", ",", "", "!"]) for x in w]
        docs.append((d, rnd.choice([" ", "\n"]).join(w)))
    half = items[5][1].split()
    docs.append((900, " ".join(half[:len(half) // 2 + 3]) + " " + text(500) + " " + " ".join(half[len(half) // 2 - 2:])))
    docs += [(901, None), (902, ""), (903, "only four words here"), (903, "Only four words here!"), (904, text(60000) + " " + items[3][1])]
    return docs, items


@pytest.mark.parametrize("block", [200_000, 400])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "ITEM_SHINGLES", block)
    docs, items = data()
    d = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contaminated(d, b)
    got = sorted(((r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in out.collect()), key=str)
    want = brute(docs, items)
    assert got == want and len(want) > 50
    bad = {w[0] for w in want}
    assert sorted(r["doc_id"] for r in decontam.clean(d, b).collect()) == sorted(i for i, _ in docs if i not in bad)


def test_empty_tables(spark):
    docs, items = data()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contaminated(d, b.limit(0)).collect() == [] == decontam.contaminated(d.limit(0), b).collect()
    assert decontam.clean(d, b.limit(0)).count() == len(docs) and decontam.clean(d.limit(0), b).collect() == []


def test_a_null_id_is_judged_by_its_own_text(spark):
    _, items = data()
    d = spark.createDataFrame([(None, items[3][1], 1), (None, "something else", 2)], "doc_id long, text string, _bad int")
    assert [r["_bad"] for r in decontam.clean(d, spark.createDataFrame(items, "item_id long, text string")).collect()] == [2]


def test_items_of_few_shingles_in_long_documents(spark):
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(5 + i % 4))) for i in range(4000)]
    items += [(9000, items[0][1]), (9001, items[0][1].upper())]
    docs = []
    for d in range(100):
        w = []
        for _, t in items[d * 40:d * 40 + 40]:
            w += [rnd.choice(vocab) for _ in range(60)] + t.split()
        docs.append((d, " ".join(w)))
    docs += [(100, items[4][1]), (101, "x " + items[8][1]), (102, items[0][1].rsplit(" ", 1)[0])]
    found = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((r["doc_id"], r["item_id"], r["item_shingles"], r["shared"]) for r in found.collect()), key=str)
    assert got == brute(docs, items) and len(got) >= 4004
