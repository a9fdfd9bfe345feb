"""Personal data: fixed rules, then candidate spans judged by gradient-boosted trees.

Base spans come from four fixed patterns (email, ip, card, phone) and always stay.  High-recall
generators then propose overlapping spans for what the rules miss: addresses with (at) and
[dot], numbers without a leading plus, dotted or bracketed addresses.  Boosted trees score
each candidate from format and context features; a candidate clear of all base spans is added
when its score reaches the threshold of its kind, calibrated on held-out candidates.

The trees learn by weak supervision from all documents: base spans and rewritings of them (plus sign
dropped, other separators, (at) and [dot]) are positive, candidates that no rule confirms are
negative.  The examples are packed once; every level of a tree is one pass that adds up gradients by
node, feature and bin, and one more pass counts the held-out third by score for the thresholds.
Extraction and scoring cover every whole text, in one pass without shuffle.

Null text counts as empty: no spans.  Offsets are code points, ends exclusive.  Repeated rows
give repeated rows, a null id is kept, an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.common import chunks, hash64, lean, map_rows, pick, setup
from tablelearn.operators import blocks

KINDS = ("email", "ip", "card", "phone")
#: Examples of a task when the trees learn, and steps of the score when held-out candidates are counted.
EXAMPLES_PER_TASK = 20_000
SCORE_STEPS = 1 << 16
#: Share of added spans, on held-out candidates, that must be confirmed.
PRECISION = 0.99

# The characters and shapes of the four rules.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """Leftmost matches of local part, @ and dotted domain: the part before an @ starts where the
    run of its characters starts (or the last match ended), so only the @ signs are visited."""
    end, at = 0, text.find("@")
    while at >= 0:
        # the domain's own characters are local ones too, but none of them is an @
        seg = text[max(end, at - 4096):at]
        start = at - (len(seg) - len(seg.rstrip(_LOCAL)))
        if start == at - 4096 > end:
            seg = text[end:at]
            start = at - (len(seg) - len(seg.rstrip(_LOCAL)))
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four rules, in the order of KINDS, then start."""
    out = [("email", *s) for s in emails(text)]
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = only_digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(only_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


# Generators of candidates; every repeat is bounded, so each start costs little.
_GENERATORS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:[\[({]\x20?at\x20?[\])}]|@)\x20?"
                         r"[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[({]\x20?(?:dot|\.)\x20?[\])}])\x20?[A-Za-z0-9-]{1,63}){1,6}", re.I)),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|[\[({]\.[\])}])[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{2,7}){2,5}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,5}(?![0-9])")),
)
_CUES = re.compile(r"phone|tel|call|fax|mobile|card|visa|credit|account|mail|contact|address|host|server|\bip\b", re.I)
_GROUPS = re.compile(r"[0-9]+")
_NEEDED = re.compile(r"[0-9@]|[\[({]\x20?at", re.I)


#: Numbers side by side, and how a candidate inside them may begin.
_RUN = re.compile(r"(?<![0-9])[+(]{0,2}[0-9]+\)?(?:[\x20./_-]{1,2}[+(]{0,2}[0-9]+\)?)+")
_SPANS = [(kind, p) for kind, p in _GENERATORS if kind in ("card", "phone")]
MOST_GROUPS = 6


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals: the matches of every generator, and inside a run of numbers every stretch of
    at most MOST_GROUPS neighbouring digit groups that a generator accepts, so that numbers side by
    side are proposed alone as well as together."""
    out = {(kind, *m.span()) for kind, p in _GENERATORS for m in p.finditer(text)}
    for run in _RUN.finditer(text):
        groups = [g.span() for g in _GROUPS.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            while start > run.start() and text[start - 1] in "+(":
                start -= 1
            for _, end in groups[i + 1:i + MOST_GROUPS]:
                end += text[end:end + 1] == ")"
                out.update((kind, start, end) for kind, p in _SPANS if p.fullmatch(text, start, end))
    return sorted(out, key=lambda c: (KINDS.index(c[0]), c[1], c[2]))


def features(kind: str, surface: str, before: str, after: str) -> list[float]:
    """Format and context of a span; ``before`` and ``after`` are up to 24 characters."""
    groups = [len(g) for g in _GROUPS.findall(surface)]
    digits = only_digits(surface)
    parts = [int(g[:6]) for g in _GROUPS.findall(surface)][:8]
    sep = [c for c in surface if not c.isalnum()]
    tail = re.split(r"[^A-Za-z0-9]+", surface.rstrip())[-1]

    def side(c):
        return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4

    return [*(float(kind == k) for k in KINDS), len(surface), len(digits), len(sep), len(set(sep)),
            surface.startswith("+") or surface.startswith("00"), "(" in surface, "@" in surface, surface.count("."),
            surface.count(" "), len(groups), max(groups, default=0), min(groups, default=0), max(parts, default=0),
            bool(digits) and luhn(digits), len(set(digits)), sum(map(str.isalpha, surface)) / len(surface),
            len(tail) if tail.isalpha() else 0, side(before[-1:]), side(after[:1]), before[-1:] in ("=", '"', "'", "#", "/"),
            after[:1] in (".", ",", ";") and after[1:2].isdigit(), bool(_CUES.search(before))]


def rewritings(kind: str, surface: str) -> list[str]:
    """The same datum in forms that the rules miss."""
    if kind == "email":
        local, _, domain = surface.rpartition("@")
        return [f"{local} (at) {domain}", f"{local}[at]{domain.replace('.', '[dot]')}", f"{local} @ {domain}"]
    if kind == "ip":
        return [surface.replace(".", "[.]")]
    d = only_digits(surface)
    if kind == "card":
        return [".".join(d[i:i + 4] for i in range(0, len(d), 4)), "  ".join(d[i:i + 4] for i in range(0, len(d), 4))]
    return [surface.lstrip("+"), "00" + surface.lstrip("+"), f"({d[-10:-7]}) {d[-7:-4]}-{d[-4:]}", f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}"]


def context(text: str, start: int, end: int) -> tuple[str, str]:
    return text[max(0, start - 24):start], text[end:end + 24]


def clear_of(spans, start: int, end: int) -> bool:
    return all(e <= start or s >= end for _, s, e in spans)


def examples(text: str):
    """(label, features) of one text for training."""
    base = base_spans(text)
    for kind, s, e in base:
        around = context(text, s, e)
        yield 1, features(kind, text[s:e], *around)
        for r in rewritings(kind, text[s:e]):
            if any(p.fullmatch(r) for k, p in _GENERATORS if k == kind):
                yield 1, features(kind, r, *around)
                if kind in ("card", "phone"):  # beside its like: each alone is right, what reaches across is not
                    pair, n = f"{r} {r}", len(r)
                    for k, a, b in candidates(pair):
                        whole = k == kind and (a, b) in ((0, n), (n + 1, len(pair)))
                        if whole or a <= n < b:
                            yield int(whole), features(k, pair[a:b], (around[0] + pair[:a])[-24:], (pair[b:] + around[1])[:24])
    for kind, s, e in candidates(text):
        if clear_of(base, s, e):
            yield 0, features(kind, text[s:e], *context(text, s, e))


def _walk(tree: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """The node of a tree that each binned row ends in."""
    at = np.zeros(len(b), int)
    for _ in range(depth):
        j = tree[at, 0].astype(int)
        go = b[np.arange(len(b)), np.maximum(j, 0)] <= tree[at, 1]
        at = np.where(j < 0, at, np.where(go, tree[at, 2], tree[at, 3]).astype(int))
    return at


class Boosted:
    """Gradient-boosted trees for the logistic loss over binned features."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.n, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        b = self._binned(x)
        p = min(max(y.mean(), 1e-4), 1 - 1e-4)
        self.start, self.trees = float(np.log(p / (1 - p))), []
        f = np.full(len(y), self.start)
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-f))
            tree = []
            f += self._grow(tree, b, np.arange(len(y)), p - y, p * (1 - p), self.depth)
            self.trees.append(tree)
        return self

    def _binned(self, x):
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], 1).astype(np.int16)

    def _grow(self, tree, b, rows, g, h, depth):
        """Append the subtree of ``rows``; return the step of every example (0 elsewhere)."""
        out, at = np.zeros(len(g)), len(tree)
        sg, sh = g[rows].sum(), h[rows].sum()
        tree.append([-1, 0, 0, 0, -self.rate * sg / (sh + self.ridge)])
        best = (1e-3, None, None)
        if depth:
            for j in range(b.shape[1]):
                n = len(self.cuts[j]) + 1
                gl = np.cumsum(np.bincount(b[rows, j], g[rows], n))[:-1]
                hl = np.cumsum(np.bincount(b[rows, j], h[rows], n))[:-1]
                gain = gl ** 2 / (hl + self.ridge) + (sg - gl) ** 2 / (sh - hl + self.ridge) - sg ** 2 / (sh + self.ridge)
                gain = np.where((hl > 1e-3) & (sh - hl > 1e-3), gain, 0)
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
        if best[1] is None:
            out[rows] = tree[at][4]
            return out
        left = b[rows, best[1]] <= best[2]
        tree[at][:2] = best[1:]
        tree[at][2] = len(tree)
        out += self._grow(tree, b, rows[left], g, h, depth - 1)
        tree[at][3] = len(tree)
        return out + self._grow(tree, b, rows[~left], g, h, depth - 1)

    def fit_all(self, packed: DataFrame, cuts, positive: float, rows: float) -> "Boosted":
        """The same trees from packed examples (x, label, held out) of any number: one pass a level.
        Held-out rows take no part; ``cuts`` are the bin edges of every feature."""
        self.cuts = cuts
        p = min(max(positive / rows, 1e-4), 1 - 1e-4)
        start, width, bins = float(np.log(p / (1 - p))), len(cuts), 1 + max(map(len, cuts))
        self.start, self.trees = start, []
        binned, rate, ridge, most = self._binned, self.rate, self.ridge, self.depth

        def first(block):
            x, y, held = next(blocks.slices(block))
            return binned(x[held == 0]), y[held == 0], np.full(int((held == 0).sum()), start)
        data = packed.rdd.map(first).persist(StorageLevel.MEMORY_AND_DISK)
        for _ in range(self.n):
            tree, open_ = [[-1, 0, 0, 0, 0.0]], [0]
            for depth in range(most + 1):
                size = len(open_) * width * bins * 2

                def level(i, some, tree=tree, open_=open_, size=size):
                    out = np.zeros((len(open_), width, 2, bins))
                    t = np.array(tree, float)
                    for b, y, f in some:
                        at, p = _walk(t, b, most), 1 / (1 + np.exp(-f))
                        for k, node in enumerate(open_):
                            r = np.flatnonzero(at == node)
                            g, h = (p - y)[r], (p * (1 - p))[r]
                            for j in range(width):
                                out[k, j, 0] += np.bincount(b[r, j], g, bins)
                                out[k, j, 1] += np.bincount(b[r, j], h, bins)
                    yield i, out.ravel()
                hist = blocks.added(data.mapPartitionsWithIndex(level), size).reshape(len(open_), width, 2, bins)
                after = []
                for node, h in zip(open_, hist):
                    sg, sh = h[0].sum(1)
                    tree[node][4] = -rate * sg / (sh + ridge)
                    if depth == most:
                        continue
                    gl, hl = np.cumsum(h, 2)[:, :, :-1].transpose(1, 0, 2)
                    gain = gl ** 2 / (hl + ridge) + (sg - gl) ** 2 / (sh - hl + ridge) - sg ** 2 / (sh + ridge)
                    gain = np.where((hl > 1e-3) & (sh - hl > 1e-3), gain, 0)
                    j, cut = divmod(int(gain.argmax()), bins - 1)
                    if gain[j, cut] > 1e-3:
                        tree[node][:4] = j, cut, len(tree), len(tree) + 1
                        after += [len(tree), len(tree) + 1]
                        tree += [[-1, 0, 0, 0, 0.0], [-1, 0, 0, 0, 0.0]]
                open_ = after
                if not open_:
                    break
            self.trees.append(tree)

            def step(block, t=np.array(tree, float)):
                b, y, f = block
                return b, y, f + t[_walk(t, b, most), 4]
            data, old = data.map(step).persist(StorageLevel.MEMORY_AND_DISK), data
            data.count()
            old.unpersist()
        data.unpersist()
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        b, f = self._binned(np.asarray(x, float)), np.full(len(x), self.start)
        for tree in self.trees:
            t, at = np.array(tree), np.zeros(len(x), int)
            for _ in range(self.depth):
                j = t[at, 0].astype(int)
                go = b[np.arange(len(x)), np.maximum(j, 0)] <= t[at, 1]
                at = np.where(j < 0, at, np.where(go, t[at, 2], t[at, 3]).astype(int))
            f += t[at, 4]
        return 1 / (1 + np.exp(-f))


def thresholds(score: np.ndarray, y: np.ndarray, kind: np.ndarray) -> dict:
    """Per kind, the lowest score from which on PRECISION of the candidates is confirmed, 0.9 at
    least; none (a kind is then not added to) where the held-out candidates never reach that."""
    out = {}
    for k, name in enumerate(KINDS):
        s, t = score[kind == k], y[kind == k]
        order = np.argsort(-s, kind="stable")
        s, ok = s[order], np.cumsum(t[order]) / np.arange(1, len(s) + 1)
        last = np.append(s[1:] != s[:-1], True)[:len(s)]  # a threshold takes ties whole
        good = np.flatnonzero((ok >= PRECISION) & last)
        if len(good):
            out[name] = max(0.9, float(s[good[-1]]))
    return out


def counted_thresholds(right: np.ndarray, rows: np.ndarray) -> dict:
    """``thresholds`` from counts (kinds, SCORE_STEPS) of held-out candidates by score."""
    out, n = {}, rows.shape[1]
    for name, t, m in zip(KINDS, right, rows):
        ok, seen = np.cumsum(t[::-1])[::-1], np.cumsum(m[::-1])[::-1]
        good = np.flatnonzero((m > 0) & (ok >= PRECISION * seen))
        if len(good):
            out[name] = max(0.9, good[0] / n)
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(trees, thresholds) from all documents; (None, {}) where they show only one label."""
    setup(docs.sparkSession)
    part = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("string"), "text")
    width = len(features("ip", "1", "", ""))

    def run(batches):
        for b in batches:
            for i, t in zip(*(c.to_pylist() for c in b.columns)):
                if t and _NEEDED.search(t) and (some := list(examples(t))):
                    held = np.array([(hash64(f"{i}:{k}".encode()) >> 1) % 3 == 0 for k in range(len(some))], float)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(some)], pa.int32()), pa.array([np.array([x for _, x in some], float).tobytes()], pa.binary()),
                         pa.array([np.array([y for y, _ in some], float).tobytes()], pa.binary()), pa.array([held.tobytes()], pa.binary())],
                        ["rows", "x", "s0", "s1"])

    found = part.mapInArrow(lean(run), "rows int, x binary, s0 binary, s1 binary").persist()
    try:
        n = found.agg(F.sum("rows")).first()[0] or 0
        packed = joined_blocks(blocks.tasks(found, n, EXAMPLES_PER_TASK)).persist()
        (positive, rows), = blocks.total(packed, lambda x, y, held: [[y[held == 0].sum(), (held == 0).sum()]], [(2,)])
        if not 0 < positive < rows:
            return None, {}
        model = Boosted()
        model.fit_all(packed, bin_edges(packed, width, model.bins), positive, rows)

        def judge(x, y, held):
            x, y = x[held == 1], y[held == 1]
            at = x[:, :4].argmax(1) * SCORE_STEPS + np.minimum(model.predict(x) * SCORE_STEPS, SCORE_STEPS - 1).astype(int)
            return np.bincount(at, y, 4 * SCORE_STEPS), np.bincount(at, minlength=4 * SCORE_STEPS)
        right, all_ = blocks.total(packed, judge, [(4, SCORE_STEPS)] * 2)
        packed.unpersist()
        return model, counted_thresholds(right, all_)
    finally:
        found.unpersist()


def joined_blocks(found: DataFrame) -> DataFrame:
    """The blocks of a batch as one."""
    def run(batches):
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array([sum(b.column(0).to_pylist())], pa.int32()),
                                                  *[pa.array([b"".join(c.to_pylist())], pa.binary()) for c in b.columns[1:]]], b.schema.names)
    return found.mapInArrow(run, found.schema)


def bin_edges(packed: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Distinct quantiles of every feature over all examples that are not held out: the values are
    counted exactly, feature by feature."""
    def values(batches):
        for b in batches:
            for x, _, held in blocks.unpack(b):
                for j, col in enumerate(x[held == 0].T):
                    v, n = np.unique(col, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), j, np.int32)), pa.array(v), pa.array(n)], ["j", "v", "n"])
    at = [float(q) for q in np.linspace(0, 1, bins + 1)[1:-1]]
    counts = packed.mapInArrow(values, "j int, v double, n long").groupBy("j", "v").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("j").agg(F.percentile("v", F.array(*map(F.lit, at)), F.col("n")).alias("q")).collect()
    got = {r["j"]: np.unique(r["q"]) for r in rows}
    return [got[j] for j in range(width)]


def all_spans(texts: list[str], model, limit: dict) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; added spans are clear of base spans and each other."""
    base = [base_spans(t) if _NEEDED.search(t) else [] for t in texts]
    found = [(i, c, features(c[0], texts[i][c[1]:c[2]], *context(texts[i], c[1], c[2])))
             for i, t in enumerate(texts) if limit and _NEEDED.search(t) for c in candidates(t)
             if c[0] in limit and clear_of(base[i], c[1], c[2])]
    whole = [list(b) for b in base]
    if found:
        score = model.predict(np.array([f for _, _, f in found], float))
        for s, (i, c, _) in sorted(zip(score.tolist(), found), key=lambda z: (-z[0], z[1][0], z[1][1])):
            if s >= limit[c[0]] and clear_of(whole[i], c[1], c[2]):
                whole[i].append(c)
    order = {k: n for n, k in enumerate(KINDS)}
    return [(b, sorted(w, key=lambda c: (order[c[0]], c[1]))) for b, w in zip(base, whole)]


def masked(text: str, spans) -> str:
    """The text with spans replaced by [KIND]; overlapping ones go together, named by the first."""
    out, at, name, start, end = [], 0, None, 0, 0
    for kind, s, e in [*sorted(spans, key=lambda c: (c[1], -c[2])), (None, len(text) + 1, 0)]:
        if name is not None and s < end:
            end = max(end, e)
            continue
        if name is not None:
            out += [text[at:start], f"[{name.upper()}]"]
            at = end
        name, start, end = kind, s, e
    return "".join([*out, text[at:]])


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_spans, spans, redacted) of every row; the counts
    are of base spans."""
    spark = setup(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model or fit(docs, id_col, text_col))
    rows = pick(docs, _id=id_col, _text=text_col)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in chunks([len(t) for t in texts]):
                got = all_spans(texts[i:j], *shared.value)
                counts = [pa.array([sum(c[0] == k for c in base) for base, _ in got], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), *counts, pa.array([joined(x) for x, _ in got], pa.string()),
                     pa.array([joined(x) for _, x in got], pa.string()),
                     pa.array([masked(t, x) for t, (_, x) in zip(texts[i:j], got)], pa.string())],
                    ["_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans", "redacted"])

    schema = f"_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, spans string, redacted string"
    return rows.mapInArrow(lean(run), schema).withColumnRenamed("_id", id_col)


def redact(docs: DataFrame, text_col: str = "text", model=None, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns with the text redacted; null texts stay null."""
    spark = setup(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model or fit(docs, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            for i, j in chunks([len(t or "") for t in texts]):
                some = [t or "" for t in texts[i:j]]
                got = [masked(t, x) for t, (_, x) in zip(some, all_spans(some, *shared.value))]
                new = pa.array([g if t is not None else None for g, t in zip(got, texts[i:j])], pa.string())
                cols = [new if k == at else b.column(k).slice(i, j - i) for k in range(b.num_columns)]
                yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return map_rows(docs, run)
