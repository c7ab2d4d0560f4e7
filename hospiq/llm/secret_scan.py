"""Operator 6: secret scans with a linear-chain conditional random field.

Three fixed patterns give the base spans. On top, a CRF tags every token as
secret begin, inside or outside from its shape, its neighbours and features of
the whole file; spans it finds apart from the base ones are added. It learns
from a bounded sample of passages in which the base spans are the labels, with
the neighbouring words hidden now and then, so that shape and context both
count. All of a text is tokenised, scored and decoded with numpy.

Decoding is exact Viterbi: a bound on what a run of tags can add shows where
the best path is surely *outside*, so the chain falls apart there, and only the
short intervals around promising tokens are searched.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytetext import LOWER_VALUE, Rolling
from .common import read_table
from .maptext import map_text

# fixed patterns of the base spans
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

PASSAGES = 300          # passages to learn from with a base span, and as many from other texts
PASSAGE = 500           # characters of one
EPOCHS, RATE, DECAY = 40, 0.3, 1e-4
WORDS = 4096            # hash buckets of a word feature
B, I, O = 0, 1, 2

_CLASS = np.full(256, 2, np.uint8)      # 0 white space, 1 word, 2 punctuation
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
for _r in (range(48, 58), range(65, 91), range(97, 123), range(128, 256), (0x2B, 0x2F, 0x5F, 0x2D)):
    _CLASS[list(_r)] = 1
_BIT = np.zeros(256, np.uint8)          # kinds of characters for the shape
_BIT[97:103], _BIT[103:123], _BIT[65:91], _BIT[48:58], _BIT[128:] = 1, 2, 4, 8, 16
_BIT[[0x2B, 0x2F, 0x5F, 0x2D]] = 32
_LENGTHS = np.array([2, 4, 8, 12, 16, 20, 32, 40])
# rows of the weight table, by feature
SHAPE, OWN, BEFORE, BEFORE2, NEXT, DIGITS, FILE = 0, 1024, 1024 + WORDS, 1024 + 2 * WORDS, 1024 + 3 * WORDS, 2048 + 3 * WORDS, 2112 + 3 * WORDS
ROWS = FILE + 16


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, ordered by start, then kind."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(out, key=lambda s: (s[0], s[2]))


def may_have_base(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that can contain a base span (exact for hex, keywords for the rest)."""
    n = len(offsets) - 1
    hit = np.zeros(n, bool)
    is_hex = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 102))
    edge = np.flatnonzero(np.diff(np.concatenate([[0], is_hex.view(np.int8), [0]])))
    long = edge[::2][edge[1::2] - edge[::2] >= 32]      # runs over a row border only add candidates
    for p in long:
        a = int(np.searchsorted(offsets, p, side="right")) - 1
        b = int(np.searchsorted(offsets, edge[1::2][np.searchsorted(edge[::2], p)], side="left"))
        hit[a:b] = True
    low = data.tobytes()
    found = [m.start() for m in re.finditer(rb"AKIA", low)]
    low = low.lower()
    for k in KEYWORDS:
        p = low.find(k)
        while p >= 0:
            found.append(p)
            p = low.find(k, p + 1)
    hit[np.searchsorted(offsets, np.array(found, np.int64), side="right") - 1] = True if found else False
    return hit


class Tokens:
    """The tokens of a block of texts and their feature rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        c = _CLASS[data]
        begin = np.empty(len(data), bool)
        begin[:1] = True
        begin[1:] = c[1:] != c[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[first] = True
        edges = np.append(np.flatnonzero(begin), len(data))
        start, end = edges[:-1], edges[1:]
        real = c[start] != 0 if len(start) else np.zeros(0, bool)
        self.start, self.end = start[real], end[real]
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        n = len(self.start)
        self.features = np.zeros((7, n), np.int32)
        if not n:
            return
        bits = np.bitwise_or.reduceat(_BIT[data], self.start_for_reduce(data))[: 2 * n: 2]
        size = self.end - self.start
        punct = c[self.start] == 2
        shape = bits.astype(np.int32) + 64 * np.searchsorted(_LENGTHS, size, side="left").clip(0, 7) + 512 * punct
        digit = np.concatenate([[0], np.cumsum(_BIT[data] == 8)])
        turn = np.zeros(len(data) + 1, np.int64)
        np.cumsum((_BIT[data][1:] == 8) != (_BIT[data][:-1] == 8), out=turn[1:len(data)])
        word = (Rolling(data, LOWER_VALUE).ranges(self.start, self.end) >> np.uint64(52)).astype(np.int32) % WORDS
        same1 = np.zeros(n, bool)
        same1[1:] = self.row[1:] == self.row[:-1]
        same2 = np.zeros(n, bool)
        same2[2:] = self.row[2:] == self.row[:-2]
        f = self.features
        f[0] = SHAPE + shape
        f[1] = OWN + word
        f[2, 1:] = word[:-1]
        f[2] = BEFORE + np.where(same1, f[2], 0)
        f[3, 2:] = word[:-2]
        f[3] = BEFORE2 + np.where(same2, f[3], 0)
        f[4, :-1] = np.where(same1[1:], shape[1:], 0)
        f[4] += NEXT
        share = (4 * (digit[self.end] - digit[self.start]) // size).clip(0, 3)
        f[5] = DIGITS + 8 * share + np.minimum(turn[self.end - 1] - turn[self.start], 7) + 32 * (size > 15)
        rows = len(offsets) - 1
        marks = np.concatenate([[0], np.cumsum(c == 2)])
        length = np.maximum(np.diff(offsets), 1)
        many_marks = np.searchsorted([0.01, 0.05, 0.15], np.diff(marks[offsets]) / length)
        many_digits = np.searchsorted([0.002, 0.02, 0.1], np.diff(digit[offsets]) / length)
        f[6] = FILE + (4 * many_marks + many_digits)[self.row] if rows else FILE

    def start_for_reduce(self, data: np.ndarray) -> np.ndarray:
        """start, end, start, end ... for reduceat (the odd results are unused)."""
        pairs = np.column_stack([self.start, np.minimum(self.end, len(data) - 1)]).ravel()
        return pairs


class CRF:
    def __init__(self):
        self.unary = np.zeros((ROWS, 3), np.float32)
        self.step = np.zeros((3, 3), np.float32)
        self.step[O, I] = -4.0

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = self.unary[features[0]]
        for f in features[1:]:
            out += self.unary[f]
        return out

    def train(self, sequences: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 3) -> None:
        """Full-batch AdaGrad on the conditional likelihood; all sequences take
        the forward and backward steps side by side."""
        rng = np.random.default_rng(seed)
        n, longest = len(sequences), max(len(y) for _, y in sequences)
        feats = np.zeros((7, n, longest), np.int32)
        gold = np.full((n, longest), O)
        live = np.zeros((n, longest), bool)
        for k, (f, y) in enumerate(sequences):
            feats[:, k, : len(y)], gold[k, : len(y)], live[k, : len(y)] = f, y, True
        g2u, g2s = np.full_like(self.unary, 1e-6), np.full_like(self.step, 1e-6)
        hot = np.eye(3, dtype=np.float32)[gold] * live[..., None]
        for _ in range(epochs):
            f = feats.copy()
            hide = rng.random((n, longest)) < 0.5         # neighbouring words are not always known
            f[1][rng.random((n, longest)) < 0.3] = OWN
            f[2][hide] = BEFORE
            f[3][hide] = BEFORE2
            u = self.scores(f)
            e = np.exp(self.step)
            alpha = np.zeros((longest, n, 3))
            alpha[0] = np.exp(u[:, 0] - u[:, 0].max(1, keepdims=True))
            alpha[0] /= alpha[0].sum(1, keepdims=True)
            ex = np.exp(u - u.max(2, keepdims=True)) * live[..., None] + ~live[..., None]
            for t in range(1, longest):
                a = np.where(live[:, t, None], (alpha[t - 1] @ e) * ex[:, t], alpha[t - 1])
                alpha[t] = a / a.sum(1, keepdims=True)
            beta = np.ones((n, 3))
            gu = np.zeros_like(u)
            gs = np.zeros((3, 3))
            for t in range(longest - 1, -1, -1):
                p = alpha[t] * beta
                p /= p.sum(1, keepdims=True)
                gu[:, t] = (p - hot[:, t]) * live[:, t, None]
                if t:
                    right = ex[:, t] * beta
                    pair = alpha[t - 1][:, :, None] * e[None] * right[:, None, :]
                    pair /= pair.sum((1, 2), keepdims=True)
                    on = live[:, t]
                    gs += pair[on].sum(0)
                    np.add.at(gs, (gold[on, t - 1], gold[on, t]), -1)
                    b = np.where(on[:, None], right @ e.T, beta)
                    beta = b / b.sum(1, keepdims=True)
            g = np.zeros_like(self.unary)
            flat = gu[live]
            for row in f:
                at = row[live]
                for s in range(3):
                    g[:, s] += np.bincount(at, flat[:, s], ROWS)
            g = g / n + DECAY * self.unary
            gs = gs / n + DECAY * self.step
            g2u += g * g
            g2s += gs * gs
            self.unary -= (RATE * g / np.sqrt(g2u)).astype(np.float32)
            self.step -= (RATE * gs / np.sqrt(g2s)).astype(np.float32)

    def undecided(self, u: np.ndarray, row: np.ndarray) -> list[tuple[int, int]]:
        """Intervals [a, b) outside of which the best path is surely *outside*.

        Turning a run of B and I tags into O changes the path's score by at
        least -(edge + sum of gain over the run), where ``gain`` bounds what a
        token and one inner transition can add and ``edge`` what the two ends
        can. So a run on the best path holds a seed (gain > -edge), and reaches
        no further from its seeds than their gains pay for."""
        t = self.step
        inner = max(t[p, q] for p in (B, I) for q in (B, I)) - t[O, O]
        enter = max(0.0, t[O, B] - t[O, O], t[O, I] - t[O, O])      # 0: a text's first token
        leave = max(0.0, t[B, O] - t[O, O], t[I, O] - t[O, O])
        edge = max(0.0, float(enter + leave - inner))
        gain = np.maximum(u[:, B], u[:, I]) - u[:, O] + inner
        seeds = np.flatnonzero(gain > -edge)
        if not len(seeds):
            return []
        pay = np.bincount(row[seeds], np.maximum(gain[seeds], 0)) + edge
        out: list[list[int]] = []
        for p in seeds.tolist():
            r, budget = row[p], float(pay[row[p]])
            if out and p < out[-1][1] and row[out[-1][1] - 1] == r:
                a = out[-1][0]
            else:
                a, left = p, budget
                while a > 0 and row[a - 1] == r and left > 0:
                    a -= 1
                    left += min(float(gain[a]), 0.0)
            b, left = p + 1, budget
            while b < len(row) and row[b] == r and left > 0:
                left += min(float(gain[b]), 0.0)
                b += 1
            if out and a <= out[-1][1] and row[out[-1][1] - 1] == r:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return [(a, b) for a, b in out]

    def decode(self, tokens: Tokens) -> np.ndarray:
        u = self.scores(tokens.features)
        tags = np.full(len(u), O, np.int8)
        step = self.step.tolist()
        for a, b in self.undecided(u, tokens.row):
            r = tokens.row[a]
            left = a > 0 and tokens.row[a - 1] == r
            right = b < len(u) and tokens.row[b] == r
            us = u[a:b].tolist()
            best = [x + (step[O][s] if left else 0.0) for s, x in enumerate(us[0])]
            back = []
            for x in us[1:]:
                choice = [max(range(3), key=lambda p, s=s: best[p] + step[p][s]) for s in range(3)]
                best = [best[choice[s]] + step[choice[s]][s] + x[s] for s in range(3)]
                back.append(choice)
            s = max(range(3), key=lambda q: best[q] + (step[q][O] if right else 0.0))
            for t in range(b - 1, a - 1, -1):
                tags[t] = s
                if t > a:
                    s = back[t - a - 1][s]
        return tags


def varied(text: str, rng: np.random.Generator) -> str:
    """The passage with each base value replaced by a random one of another
    alphabet and length, so that not only the shapes at hand are learned."""
    alphabets = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                 "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                 "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-")

    def other(m):
        letters = alphabets[int(rng.integers(len(alphabets)))]
        value = "".join(letters[k] for k in rng.integers(len(letters), size=int(rng.integers(16, 49))))
        return m[0][: m.start(2) - m.start()] + value
    return ASSIGN.sub(lambda m: other(m) if len(m[2]) >= 8 else m[0], text)


def labelled_sequence(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and tags of a passage; the values of its base spans are secret."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    tokens = Tokens(data, np.array([0, len(data)]))
    if not len(tokens.start):
        return None
    y = np.full(len(tokens.start), O)
    values = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    values += [(s, e) for s, e, k in base_spans(text) if k]
    for s, e in sorted(values):
        s, e = len(text[:s].encode()), len(text[:e].encode())
        i, j = np.searchsorted(tokens.end, s, side="right"), np.searchsorted(tokens.start, e)
        if j > i:
            y[i:j] = I
            y[i] = B
    return tokens.features, y


def learn(passages: list[str], seed: int = 17) -> CRF:
    """Train on passages as they are, and on varied ones of those with a secret."""
    rng = np.random.default_rng(seed)
    more = [varied(p, rng) for p in passages if ASSIGN.search(p)]
    model = CRF()
    model.train([s for p in passages + more if (s := labelled_sequence(p)) is not None])
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> CRF | None:
    """A CRF learned from at most PASSAGES passages around a base span and as
    many from other texts, those of the smallest hash of the id. One pass over
    all rows searches the pattern and counts both kinds; a threshold on the
    hash then lets little more than the sample of each through. None for a
    table without any base span."""
    pattern = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{8}|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("length(text) > 0")
    # a text's passage: around its first base span, else at a pseudorandom place
    at = F.regexp_instr("text", F.lit(pattern))
    place = F.when(at > 0, F.greatest(at - F.lit(PASSAGE // 2), F.lit(1))).otherwise(
        (F.pmod(F.xxhash64("id"), F.greatest(F.length("text") - PASSAGE, F.lit(0)) + 1) + 1).cast("int"))
    has = F.col("text").rlike(pattern)
    n = rows.agg(F.count_if(has).alias("with"), F.count_if(~has).alias("without")).first()
    if not n["with"]:
        return None
    got = []
    for kind, of in ((~has, n["without"]), (has, n["with"])):
        share = min(1.0, 2.0 * PASSAGES / max(of, 1))
        by_hash = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 30))
        # the hash first: the pattern is searched in the rows that it lets through
        thin = rows.filter((by_hash <= F.lit(int(share * (1 << 30)))) & kind)
        picked = thin.select("id", by_hash.alias("h"), F.substring("text", place, F.lit(PASSAGE)).alias("passage"))
        got += picked.orderBy("h", "id", "passage").limit(PASSAGES).collect()
    return learn([r["passage"] for r in got])


def scan(docs: DataFrame, model: CRF | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``spans array<struct<kind, start, end>>`` (code
    points, end exclusive, ordered by start, then kind) of every whole text.
    A null or empty text has none; without a model there are base spans only.
    A repeated row has the same spans."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def fn(data, offsets):
        n = len(offsets) - 1
        raw, o = data.tobytes(), offsets.tolist()
        extra: dict[int, list[tuple[int, int]]] = {}
        if model is not None:
            tokens = Tokens(data, offsets)
            tags = model.decode(tokens)
            at = np.flatnonzero(tags != O)
            for t in at.tolist():
                r, s, e = int(tokens.row[t]), int(tokens.start[t]), int(tokens.end[t])
                mine = extra.setdefault(r, [])
                joined = tags[t] == I and mine and t and tags[t - 1] != O and tokens.row[t - 1] == r
                if joined:
                    mine[-1] = (mine[-1][0], e)
                else:
                    mine.append((s, e))
        base = may_have_base(data, offsets)
        out: list[list] = [[] for _ in range(n)]
        for r in np.flatnonzero(base | np.isin(np.arange(n), list(extra))).tolist():
            text = raw[o[r]:o[r + 1]].decode()
            spans = base_spans(text) if base[r] else []
            taken = list(spans)
            for s, e in extra.get(r, []):
                a = len(raw[o[r]:s].decode())
                b = a + len(raw[s:e].decode())
                if all(b <= x or a >= y for x, y, _ in taken):
                    spans.append((a, b, 3))
            out[r] = [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in sorted(spans, key=lambda x: (x[0], x[2]))]
        return [pa.array(out, pa.list_(kind))]
    return map_text(docs, keep, fn, "spans array<struct<kind: string, start: long, end: long>>", text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = scan(docs, fit(docs), ["doc_id"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
