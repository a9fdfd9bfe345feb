import datetime as dt
import random

from tablelearn.llm import url_lists

D0 = dt.date(2024, 1, 1)


def brute(captures, entries):
    out = []
    for i, url, day in captures:
        active = {}
        if url and day:
            rest = url.split("://", 1)[1] if "://" in url else url
            auth = rest
            for c in "/?#":
                auth = auth.split(c, 1)[0]
            h = auth.split("@")[-1].split(":")[0].lower().rstrip(".")
            path = rest[len(auth):].split("?")[0].split("#")[0]
            parts = [p for p in path.split("/") if p]
            for lst, eff, kind, pat, verb, d in entries:
                if None in (lst, eff, kind, pat, verb, d) or d > day:
                    continue
                ok = {"host": pat.lower() == h, "domain": h == pat.lower() or h.endswith("." + pat.lower()),
                      "prefix": pat.rstrip("/") in [h + "/" + "/".join(parts[:k]) for k in range(1, len(parts) + 1)]}[kind]
                if ok and h:
                    key = (lst, eff, kind, pat.rstrip("/") if kind == "prefix" else pat.lower())
                    active[key] = max(active.get(key, (d, "")), (d, verb))
        on = [k for k, (_, v) in active.items() if v == "add"]
        out.append((i, day, any(k[1] == "block" for k in on) and not any(k[1] == "allow" for k in on), len(on),
                    ",".join(sorted({k[0] for k in on}))))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(3)
    hosts = ["a.com", "www.a.com", "x.www.a.com", "b.org", "B.org", "c.net"]
    urls = [f"http{rnd.choice(['', 's'])}://{rnd.choice(['', 'u:p@'])}{rnd.choice(hosts)}{rnd.choice(['', ':80', '.'])}"
            f"{rnd.choice(['', '/', '/p', '/p/q/r', '/p//q?x=/z', '#f', '?a=b'])}" for _ in range(300)]
    day = lambda: D0 + dt.timedelta(rnd.randrange(200))
    captures = [(i, u, day()) for i, u in enumerate(urls)]
    captures += [(900, None, day()), (901, "", day()), (902, urls[0], None), (903, "http://", day()), (None, urls[1], day()), (1, urls[2], D0)]
    captures += [(2000 + i, "http://a.com/hot", D0 + dt.timedelta(50)) for i in range(300)]
    entries = []
    for _ in range(150):
        kind = rnd.choice(["host", "domain", "prefix"])
        pat = {"host": hosts, "domain": ["a.com", "com", "www.a.com", "org"], "prefix": ["a.com/p", "b.org/p/q/", "c.net/p/q/r", "a.com/hot"]}[kind]
        entries.append((rnd.choice(["l1", "l2", "l3"]), rnd.choice(["block", "block", "allow"]), kind, rnd.choice(pat), rnd.choice(["add", "remove"]), day()))
    entries += entries[:10] + [(None, "block", "host", "a.com", "add", D0), ("l1", "block", "host", None, "add", D0), ("l1", "block", "host", "a.com", "add", None)]
    c = spark.createDataFrame([(*x, "k") for x in captures], "page_id long, url string, fetched date, key string")
    e = spark.createDataFrame(entries, "list string, effect string, kind string, pattern string, verb string, day date")
    # one instant: remove beats add
    got = sorted((tuple(r) for r in url_lists.filter_captures(c, e).collect()), key=str)
    assert got == brute(captures, entries) and any(r[2] for r in got)
    assert url_lists.filter_captures(c.limit(0), e).collect() == []
    assert {r["n_matches"] for r in url_lists.filter_captures(c, e.limit(0)).collect()} == {0}


def test_plan_has_no_python(spark):
    c = spark.createDataFrame([(1, "http://a.com/", D0)], "page_id long, url string, fetched date")
    e = spark.createDataFrame([("l", "block", "host", "a.com", "add", D0)], "list string, effect string, kind string, pattern string, verb string, day date")
    plan = url_lists.filter_captures(c, e)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
