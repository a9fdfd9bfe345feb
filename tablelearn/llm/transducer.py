"""Byte-level BPE by a finite-state transducer that is determinised as it is used.

A token sequence is what the merges give exactly when every two neighbours in it are what the
merges give for their joined bytes, so the valid sequences form a language of pairs.  The
transducer for it reads bytes: a thread is a valid sequence for some prefix together with the
trie node of the token begun after it.  A state of the deterministic machine is the set of
threads that are alive; reading a byte moves every thread down the trie, and the one valid way
to end a token there starts a new thread.  What all threads agree on is emitted, so output lags
behind by the few tokens still open.  States and transitions are compiled on first use and kept;
a word then costs one lookup per byte.

Decoding gathers token bytes block by block and turns them into text with an incremental
UTF-8 state machine, which holds an unfinished character over to the next block.
"""

from __future__ import annotations

import base64
import contextlib
import gc

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelearn.llm.bpe import LONG_TEXT, SPLIT, parts, ranges
from tablelearn.llm.common import chunks, lean, pick, setup

#: Compiled states, and bytes of encoded words, that a worker keeps before it starts afresh.
MAX_STATES = 250_000
MAX_CACHE = 128 << 20
#: Words of more characters than this are encoded but not kept.
LONG_WORD = 1000
#: Token ids that are decoded at a time.
DECODE_BLOCK = 1 << 20
#: A token begun is dropped at once if no ending can follow, where the endings are at most so many.
FEW = 8
NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 bytes and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(n) for a, n in map(bytes.split, filter(None, map(bytes.strip, f)))}


def merge(ranks: dict[bytes, int], word: bytes) -> list[bytes]:
    """The merges themselves, lowest rank first and leftmost on ties: how short tokens are taken apart."""
    out = [word[i:i + 1] for i in range(len(word))]
    while len(out) > 1:
        best = min(range(len(out) - 1), key=lambda i: ranks.get(out[i] + out[i + 1], NEVER))
        if ranks.get(out[best] + out[best + 1], NEVER) == NEVER:
            break
        out[best:best + 2] = [out[best] + out[best + 1]]
    return out


class Merges:
    """A vocabulary by rank: the trie of its tokens, and which token may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.root = 0
        self.child: dict[int, int] = {}
        self.token = [-1]
        self.open = [True]  # nodes with children
        self.joint: dict[int, int] = {}
        self.bytes_of = {r: t for t, r in ranks.items()}
        for t, r in ranks.items():
            self._add(t, r)
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    self.joint[a << 32 | b] = r
        self.below = self._few_below()
        self.spines: dict[int, tuple] = {}
        self.odd: set[int] = set()

    def _few_below(self) -> list:
        """Per node the tokens strictly below it, or None where they are more than FEW."""
        out: list = [()] * len(self.token)
        for key in sorted(self.child, key=self.child.get, reverse=True):  # children are numbered after their parents
            parent, node = key >> 8, self.child[key]
            mine = out[node]
            if mine is not None and self.token[node] >= 0:
                mine = (*mine, self.token[node])
            out[parent] = None if mine is None or out[parent] is None or len(mine) + len(out[parent]) > FEW else (*out[parent], *mine)
        return out

    def _add(self, t: bytes, r: int):
        node = self.root
        for c in t:
            key = node << 8 | c
            self.open[node] = True
            if key not in self.child:
                self.child[key] = len(self.token)
                self.token.append(-1)
                self.open.append(False)
            node = self.child[key]
        self.token[node] = r

    def spine(self, t: int) -> tuple:
        """(left, right): from the first and from the last byte of a token up to the token itself,
        each part with the rank of the merge that swallows it.  A token that the merges do not
        give for its own bytes, or that is ranked below a part of it, is noted as odd."""
        if t in self.spines:
            return self.spines[t]
        word, left, right = self.bytes_of[t], [(t, NEVER)], [(t, NEVER)]
        if len(word) > 1:
            halves = merge({b: r for b, r in self._within(word) if b != word}, word)
            if len(halves) != 2 or max(self.ranks.get(h, NEVER) for h in halves) > t:
                self.odd.add(t)
            else:
                a, b = (self.ranks[h] for h in halves)
                left = [(p, t if d == NEVER else d) for p, d in self.spine(a)[0]] + left
                right = [(p, t if d == NEVER else d) for p, d in self.spine(b)[1]] + right
                if a in self.odd or b in self.odd:
                    self.odd.add(t)
        self.spines[t] = left, right
        return self.spines[t]

    def _within(self, word: bytes):
        for i in range(len(word)):
            for j in range(i + 1, len(word) + 1):
                r = self.ranks.get(word[i:j])
                if r is not None:
                    yield word[i:j], r

    def whole(self, t: int) -> bool:
        """Whether the merges of a token's own bytes give the token."""
        self.spine(t)
        return t not in self.odd or merge(self.ranks, self.bytes_of[t]) == [self.bytes_of[t]]

    def follows(self, t: int, u: int) -> bool:
        """Whether the merges of the joined bytes of two tokens give just these two.

        They do unless a merge across the border comes before one of the two parts at the border
        is swallowed by its own token (on equal ranks the leftmost merge comes first)."""
        right, left = self.spine(t)[1], self.spine(u)[0]
        if t in self.odd or u in self.odd:
            a, b = self.bytes_of[t], self.bytes_of[u]
            return merge(self.ranks, a + b) == [a, b]
        i = j = 0
        while True:
            x, x_end = right[i]
            y, y_end = left[j]
            r = self.joint.get(x << 32 | y)
            if r is not None and r < x_end and r <= y_end:
                return False
            if x_end == NEVER and y_end == NEVER:
                return True
            if x_end <= y_end:
                i += 1
            else:
                j += 1


class State(dict):
    """byte -> (next state, packed ids emitted on the way); compiled on first use."""

    __slots__ = ("machine", "threads", "tail")

    def __init__(self, machine: "Machine", threads: tuple, tail: bytes):
        super().__init__()
        self.machine, self.threads, self.tail = machine, threads, tail

    def __missing__(self, byte: int):
        step = self[byte] = self.machine.step(self.threads, byte)
        return step


class Machine:
    """The deterministic transducer.  A thread is (path, node): the path starts with the last
    token emitted (-1 where it cannot matter any more), then come the tokens still held back."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.packed = {r: int(r).to_bytes(4, "little") for r in merges.bytes_of}
        self.allowed: dict[int, bool] = {}
        self.useful: dict[int, bool] = {}
        self.states: dict[tuple, State] = {}
        self.forget()

    def forget(self):
        for state in self.states.values():  # transitions form cycles, which only clearing takes apart
            state.clear()
        self.states: dict[tuple, State] = {}
        self.start = self.state((((-1,), self.merges.root),))

    def state(self, threads: tuple) -> State:
        found = self.states.get(threads)
        if found is None:
            found = self.states[threads] = State(self, threads, b"".join([self.packed[t] for t in threads[-1][0][1:]]))
        return found

    def may_follow(self, t: int, u: int) -> bool:
        key = t << 32 | u
        ok = self.allowed.get(key)
        if ok is None:
            if len(self.allowed) > 1_000_000:
                self.allowed.clear()
            ok = self.allowed[key] = self.merges.follows(t, u) if t >= 0 else self.merges.whole(u)
        return ok

    def any_follows(self, t: int, node: int, ends: tuple) -> bool:
        """Whether a token begun after ``t`` can still end below a node."""
        key = t << 32 | node
        ok = self.useful.get(key)
        if ok is None:
            if len(self.useful) > 1_000_000:
                self.useful.clear()
            ok = self.useful[key] = any(self.may_follow(t, u) for u in ends)
        return ok

    def step(self, threads: tuple, byte: int) -> tuple[State, bytes]:
        """Threads in the order of their start; the last one has just ended a token."""
        m = self.merges
        child, token, more, below = m.child, m.token, m.open, m.below
        alive, ended, held = [], None, True
        for path, node in threads:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            if ended is None and token[node] >= 0 and self.may_follow(path[-1], token[node]):
                ended = (*path, token[node])
            if more[node]:
                ends = below[node]
                if ends is not None and not self.any_follows(path[-1], node, ends):
                    continue
                alive.append((path, node))
                held &= len(path) > 1
        if ended is None:
            raise ValueError(f"byte {byte} is not in the vocabulary")
        alive.append((ended, m.root))
        if not held:  # a thread without a token of its own: nothing to agree on
            return self.state(tuple(alive)), b""
        shared, shortest = 1, min([len(p) for p, _ in alive])
        while shared < shortest and len({p[shared] for p, _ in alive}) == 1:
            shared += 1
        out = b"".join([self.packed[t] for t in ended[1:shared]])
        context = (ended[shared - 1],) if shortest == shared else (-1,)
        return self.state(tuple([(context + p[shared:], n) for p, n in alive])), out

    def encode(self, word: bytes) -> bytes:
        """Packed ids of one word."""
        whole = self.merges.ranks.get(word)
        if whole is not None:
            return self.packed[whole]
        if len(self.states) > MAX_STATES:
            self.forget()
        state, out = self.start, []
        if len(word) > LONG_WORD:  # the table of states stays bounded inside a long word too
            for i in range(0, len(word), 1024):
                if len(self.states) > MAX_STATES:
                    threads = state.threads
                    self.forget()
                    state = self.state(threads)
                for c in word[i:i + 1024]:
                    state, emitted = state[c]
                    if emitted:
                        out.append(emitted)
        else:
            for c in word:
                state, emitted = state[c]
                if emitted:
                    out.append(emitted)
        out.append(state.tail)
        return b"".join(out)


class Encoder:
    """Encodes texts; packed ids of the words last seen are kept, in two generations of bounded size."""

    def __init__(self, merges: Merges, pattern: str = SPLIT):
        self.machine = Machine(merges)
        self.split = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def text(self, text: str) -> bytes:
        words = self.split(text)
        if self.held > MAX_CACHE // 2:
            self.young, self.old, self.held = {}, self.young, 0
        young, old, encode, long = self.young, self.old, self.machine.encode, []
        for w in set(words).difference(young):
            ids = old.get(w)
            if ids is None:
                ids = encode(w.encode())
            young[w] = ids
            if len(w) > LONG_WORD:
                long.append(w)
            else:
                self.held += 170 + len(ids)
        out = b"".join(map(young.__getitem__, words))
        for w in long:
            del young[w]
        return out


def utf8_table() -> np.ndarray:
    """Transitions of the UTF-8 machine, state by byte; 0 is between characters, -1 an error.

    States 1 to 3 want that many continuation bytes; 4 to 7 want a second byte from a
    narrower range, after E0, ED, F0 and F4."""
    t = np.full((8, 256), -1, np.int8)
    t[0, :0x80] = 0
    t[0, 0xC2:0xE0] = 1
    t[0, 0xE0:0xF0] = 2
    t[0, 0xF0:0xF5] = 3
    t[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    for state, lo, hi, after in ((1, 0x80, 0xC0, 0), (2, 0x80, 0xC0, 1), (3, 0x80, 0xC0, 2), (4, 0xA0, 0xC0, 1),
                                 (5, 0x80, 0xA0, 1), (6, 0x90, 0xC0, 2), (7, 0x80, 0x90, 2)):
        t[state, lo:hi] = after
    return t


_UTF8 = utf8_table().tolist()


class Utf8:
    """Bytes in, text out, in pieces cut anywhere; what is no UTF-8 becomes the replacement character."""

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        """The text of all characters that are complete or cannot be completed.

        The state after a block depends on its last three bytes only: the machine starts at the
        last byte there that can begin a character, and all before that byte is complete."""
        data = self.held + data
        at = len(data)
        for i in range(len(data) - 1, max(len(data) - 4, -1), -1):
            if data[i] >= 0xC0:
                state = 0
                for c in data[i:]:
                    state = _UTF8[state][c]
                    if state <= 0:
                        break
                at = i if state > 0 else at
                break
        self.held = data[at:]
        return data[:at].decode("utf-8", "replace")

    def finish(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class Decoder:
    """Packed ids to bytes and text, block by block."""

    def __init__(self, ranks: dict[bytes, int]):
        blobs = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, r in ranks.items():
            blobs[r] = t
        self.len = np.array([len(b) for b in blobs], np.int64)
        self.at = np.cumsum(self.len) - self.len
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)

    def blocks(self, packed: bytes):
        """Token bytes of at most DECODE_BLOCK ids at a time; ids outside the vocabulary give nothing."""
        ids = np.frombuffer(packed, "<u4", len(packed) // 4)
        for i in range(0, len(ids), DECODE_BLOCK):
            some = ids[i:i + DECODE_BLOCK].astype(np.int64)
            some = some[some < len(self.len)]
            yield self.blob[ranges(self.at[some], self.len[some])].tobytes()

    def text(self, packed: bytes) -> str:
        machine = Utf8()
        return "".join([*map(machine.feed, self.blocks(packed)), machine.finish()])


@contextlib.contextmanager
def resting_collector():
    """No cyclic garbage collection over the millions of parts of a machine, which live as long as the
    worker (``forget`` takes its cycles apart); what is there at the end is left out of later ones too."""
    gc.disable()
    try:
        yield
    finally:
        gc.freeze()
        gc.enable()


_BUILT: dict = {}


def _shared(spark, path: str):
    """The ranks (under a megabyte, whatever the corpus) sent once to each executor."""
    return spark.sparkContext.broadcast((path, read_ranks(path)))


def _of(shared, kind, *more):
    path, ranks = shared.value
    key = (path, kind, *more)
    if key not in _BUILT:
        _BUILT[key] = kind(Merges(ranks) if kind is Encoder else ranks, *more)
    return _BUILT[key]


def encode(df: DataFrame, path: str, pattern: str = SPLIT, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id, n_tokens long, ids binary[, decoded binary]) of every row, whole texts.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` the bytes decoded from them.
    Each match of ``pattern`` is encoded on its own; text that no match covers is left out.  A text
    beyond ``LONG_TEXT`` characters is encoded part by part, with the same ids.  Null and empty
    texts have no ids; repeated rows give repeated rows; a null id is kept; an empty table gives an
    empty one; other columns play no part, whatever their names."""
    spark = setup(df.sparkSession)
    rows = pick(df, _id=id_col, _text=text_col)
    shared = _shared(spark, path)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        enc, dec = _of(shared, Encoder, pattern), _of(shared, Decoder)
        with resting_collector():
            yield from encoded(batches, enc, dec)

    def encoded(batches, enc, dec):
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            for i, j in chunks([len(x) for x in texts]):
                packed = [b"".join(map(enc.text, parts(x))) if pattern == SPLIT and len(x) > LONG_TEXT else enc.text(x)
                          for x in texts[i:j]]
                cols = [b.column(0).slice(i, j - i), pa.array([len(x) // 4 for x in packed], pa.int64()),
                        pa.array(packed, pa.binary())]
                if decoded:
                    cols.append(pa.array([b"".join(dec.blocks(x)) for x in packed], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, ["_id", "n_tokens", "ids", "decoded"][:len(cols)])

    out = rows.mapInArrow(lean(run), f"_id {id_type}, n_tokens long, ids binary" + ", decoded binary" * decoded)
    return out.withColumnRenamed("_id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) from packed ids, streamed block by block through the UTF-8 machine.

    Null ids give an empty text, ids outside the vocabulary nothing, bytes that are no UTF-8 the
    replacement character; a cut-off last id is left out."""
    spark = setup(df.sparkSession)
    rows = pick(df, _id=id_col, _ids=ids_col)
    shared = _shared(spark, path)
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        dec = _of(shared, Decoder)
        for b in batches:
            packed = [x or b"" for x in b.column(1).to_pylist()]
            for i, j in chunks([len(x) for x in packed]):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(map(dec.text, packed[i:j]), pa.string())],
                                                 ["_id", "text"])

    return rows.mapInArrow(lean(run), f"_id {id_type}, text string").withColumnRenamed("_id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """SHA-256 of the packed ids and of the decoded bytes."""
    return encoded.select(F.col(id_col), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
