import zstandard

from tablelearn.llm import license_scan
from tablelearn.llm.license_scan import TEMPLATES, Scanner


def test_every_template_is_its_own_winner():
    s = Scanner()
    for name, texts in TEMPLATES.items():
        for t in texts:
            for form in (t, t.lower(), t.upper(), "  " + t.replace(" ", "  ")):
                assert s.judge(form)[0] == name, form
    for near in ("I lost my driving licence", "license", "Released under some other License.", "copyright 2020 somebody"):
        assert s.judge(near) is None


def test_reduction_is_that_of_raw_dictionaries():
    s = Scanner()
    block = "Licensed under CC BY-NC 4.0."
    d = zstandard.ZstdCompressionDict(block.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    plain = len(zstandard.ZstdCompressor(level=9).compress(block.lower().encode()))
    given = len(zstandard.ZstdCompressor(level=9, dict_data=d).compress(block.lower().encode()))
    assert given < plain and s.judge(block)[1] > 0.5 and s.judge(block)[2:] == (0, 0)


def test_small_changes_count_as_differences():
    s = Scanner()
    t = TEMPLATES["ISC"][0]
    assert s.judge(t.replace("software for any", "program for any"))[2:] == (1, 1)
    assert s.judge(t[:60]) is None
    assert s.judge("some words " + TEMPLATES["MIT"][0] + " and more words")[0] == "MIT"


def naive_lines(text):
    return {t for line in text.split("\n") for t, names in ((x, n) for n, xs in TEMPLATES.items() for x in xs) if line == t}


def test_documents_against_line_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = license_scan.scan(docs)
    got = {}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in found.collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])
        assert text[r["doc_id"]][r["block_start"]:r["block_end"]].strip()
    name = {x: n for n, xs in TEMPLATES.items() for x in xs}
    want = {i: {name[x] for x in naive_lines(t)} for i, t in text.items() if naive_lines(t)}
    assert want and {i: n - {"unknown"} for i, n in got.items() if n - {"unknown"}} == want
    assert {r["doc_id"] for r in license_scan.licenses(found).collect()} == set(got)


def test_rows(spark):
    mit = TEMPLATES["MIT"][0]
    rows = [(1, None, 1), (2, "", 1), (3, f"a\n{mit}\nb", 1), (3, f"a\n{mit}\nb", 1), (None, "x " * 100000 + f"\n{mit}\n" + "y " * 100000, 2),
            (4, "Copyright nobody", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = sorted(((r["doc_id"], r["license"], r["block_start"], r["block_end"]) for r in license_scan.scan(df).collect()), key=str)
    n = len(mit)
    assert got == sorted([(3, "MIT", 2, 2 + n)] * 2 + [(None, "MIT", 200001, 200001 + n), (4, "unknown", 0, 16)], key=str)
    assert license_scan.scan(df.limit(0)).collect() == []


def test_a_notice_inside_one_long_line(spark):
    plain = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").limit(400).collect()
    ordinary = [w for r in plain for w in r["text"].split() if w.isalpha() and "licen" not in w.lower()]
    s = Scanner()
    for chars in (3_000, 20_000, 100_000):
        line = " ".join(ordinary * (1 + chars * 2 // len(" ".join(ordinary))))[:chars]
        for name, texts in TEMPLATES.items():
            for t in texts:
                for at in (0, chars // 3, chars):
                    block = line[:at] + " " + t + " " + line[at:]
                    assert s.judge(block)[0] == name and s.judge(block)[2:] == (0, 0), (t, chars, at)
        assert s.judge(line + " copyright nobody " + line) is None
    t = TEMPLATES["ISC"][0].replace("Permission to use", "Consent to use")  # without its first word
    assert s.judge(line + " " + t + " " + line)[::2] == ("ISC", 1)


def test_every_notice_of_a_block_with_its_own_offsets(spark):
    every = [(n, t) for n, ts in TEMPLATES.items() for t in ts]
    dual = [("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("MIT", "Released under the MIT License.")]
    rows, want = [], []
    for i, (notices, sep) in enumerate([(dual, "\n"), (dual, "\n\n"), (dual[::-1], " or "), (every, "\n"), (every, " "), (every * 2, "\n * ")]):
        text = "Copyright somebody"
        for name, t in notices:
            text += sep
            want.append((i, name, len(text), len(text) + len(t), 0, 0))
            text += t
        rows.append((i, text))
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r[0], r[1], r[2], r[3], r[5], r[6]) for r in found.collect()) == sorted(want)
    got = {r["doc_id"]: (r["licenses"], r["blocks"]) for r in license_scan.licenses(found).collect()}
    assert got[0] == got[1] == got[2] == ("Apache-2.0,MIT", 2)


def test_a_larger_set_of_templates():
    many = {f"L{i}": [f"You may use this under the Common Terms of Licence number {i}."] for i in range(60)}
    text = "\n".join(t for ts in many.values() for t in ts)
    assert [n[2] for n in Scanner(many).found(text)] == list(many)


def everywhere(s, text):
    """Every template at every word, without compression: the most words explained win."""
    mine = [w for w in (license_scan.plain(x) for x in text.split()) if w]
    out = []
    for k, (name, _, theirs) in enumerate(s.notices):
        for at, w in enumerate(mine):
            if w in s.starts[k]:
                missing, extra, first, last = license_scan.differences(theirs, mine[at:at + len(theirs) + s.slack[k]])
                if missing <= len(theirs) // 20 and extra <= 0.2 * len(theirs):
                    out.append((missing + extra - len(theirs), k, name, at + first, at + last))
    kept = []
    for row in sorted(out):
        if all(row[4] <= k[3] or row[3] >= k[4] for k in kept):
            kept.append(row)
    return sorted(r[2] for r in kept)


def test_recall_against_every_template_everywhere():
    """At least 0.9 is asked for; on these texts all are found."""
    import random
    rnd = random.Random(3)
    s = Scanner()
    words = "the of and with one number of words in a text that says nothing about this software source copies under use".split()
    found = expected = 0
    for _ in range(150):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            parts.append(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120))))
            t = rnd.choice([x for ts in TEMPLATES.values() for x in ts]).split(" ")
            for _ in range(rnd.randint(0, len(t) // 25)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            parts.append(rnd.choice([" ", "\n", "\n\n"]).join(t))
        text = rnd.choice([" ", "\n"]).join(parts)
        want, got = everywhere(s, text), sorted(n[2] for n in s.found(text))
        expected += len(want)
        found += sum(min(want.count(x), got.count(x)) for x in set(want))
        assert len(got) <= len(want)
    assert expected > 200 and found >= 0.99 * expected


def test_compression_decides(monkeypatch):
    """Without its bytes saved no template is tried; with the order turned round a part of a notice wins over the whole."""
    text = "x\n" + TEMPLATES["Apache-2.0"][2] + "\n" + TEMPLATES["BSD-3-Clause"][1]
    s = Scanner()
    assert [n[2] for n in s.found(text)] == ["Apache-2.0", "BSD-3-Clause"]
    assert [(n[1] - n[0]) for n in s.found(text)] == [len(TEMPLATES["Apache-2.0"][2]), len(TEMPLATES["BSD-3-Clause"][1])]
    turned = Scanner()
    monkeypatch.setattr(turned, "ranked", lambda t: Scanner.ranked(turned, t)[::-1])
    assert turned.found(text) != s.found(text)
    nothing = Scanner()
    monkeypatch.setattr(nothing, "alone", nothing.given[0])
    monkeypatch.setattr(nothing, "given", [nothing.given[0]] * len(nothing.given))
    assert nothing.found(text) == []


def test_wrapped_notices_in_lines_of_any_length():
    s = Scanner()
    for name, texts in TEMPLATES.items():
        for t in texts:
            w = t.split(" ")
            for before in (0, 400, 3000, 30_000):
                filler = "lorem ipsum dolor sit amet " * (before // 27)
                wrapped = " ".join(w[:len(w) // 2]) + "\n" + " ".join(w[len(w) // 2:]) + " and then other text " + filler
                assert [n[2] for n in s.found(filler + wrapped)] == [name], (t, before)


def test_templates_without_any_general_cue():
    s = Scanner({"House": ["Kindly keep these pages among friends."], "Other": ["You owe the author one drink at least."]})
    text = "First words.\nPlease note: kindly keep these pages among friends. More " + "words " * 5000 + "you owe the\nauthor one drink at least"
    assert [n[2] for n in s.scan(text)] == ["House", "Other"]


def test_a_long_run_of_notices():
    s = Scanner()
    t = TEMPLATES["MIT"][2]
    text = "\n".join([t] * 40)
    assert [(n[0], n[2]) for n in s.found(text)] == [(i * (len(t) + 1), "MIT") for i in range(40)]
