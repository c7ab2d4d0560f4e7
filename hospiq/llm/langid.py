"""Operator 4: language identification with a byte convolutional network.

Bytes are embedded, filters of several widths slide byte by byte over
fixed-length windows (and into the next one, so that no stretch of the text is
left out), each filter keeps its maximum, and a softmax layer names the
language. The
network learns from every window of all labelled rows, in passes whose
gradients the tasks add up; prediction reads every window of the whole text in batches and averages the windows'
probabilities by their bytes.
"""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import grouped_percentiles
from .bytetext import SMALL_BLOCK, blocks, buffers
from .common import bound_batches, fresh_names, materialize, read_table
from .maptext import bounded_sample, map_text, texts_of

WINDOW = 256            # bytes
WIDTHS = (2, 3, 4, 5)   # of the filters, in bytes
FILTERS = 8             # of each width
DIM = 8                 # of a byte's embedding
SEEN = WINDOW + max(WIDTHS) - 1     # bytes that the filters of a window read: also those that start at its last byte
PAD = 256
PER_LANGUAGE = 500      # labelled documents of a language in the start, at most
WINDOWS_PER_DOC = 3     # windows of each of them
STEPS, BATCH, RATE = 500, 64, 0.01
PASSES = 1              # over all windows of all labelled rows, after the start on some of them
PARAMETERS = ("embed", "conv", "bias", "out", "out_bias")
NOISE = 1500            # junk windows that a network with a background class learns from
# bytes of the clean texts at which the bound is measured, and on, doubled, until the longest is whole; between them it is interpolated
CUTS = (8, 16, 32, 64, 128, 256)
SET_ASIDE = 50          # fewer labelled documents set aside: the training rows set the bound
RARE = 0.002            # a bound is half the score that this share of the set-aside texts stays under
_LETTER = re.compile(r"[^\W\d_]")
# first and last letters of alphabets; a learned one among them does no harm
_ALPHABETS = ((0x61, 0x7A), (0x370, 0x3FF), (0x400, 0x45F), (0x5D0, 0x5EA), (0x620, 0x64A), (0x904, 0x939), (0xE01, 0xE2E),
              (0x3041, 0x3096), (0x4E00, 0x9FA0), (0xAC00, 0xD7A3), (0xC0, 0x17F))


class ByteCNN:
    def __init__(self, languages: list[str], background: bool = False, seed: int = 7):
        """``background``: one more class, after the languages, for junk."""
        rng = np.random.default_rng(seed)
        self.languages, self.background = languages, background
        self.classes = len(languages) + background
        self.least = None       # at CUTS: the smallest share of all languages of a text that is kept
        self.longer = np.zeros(0)   # at twice the last of CUTS, four times and so on
        span, n = max(WIDTHS), FILTERS * len(WIDTHS)
        self.embed = rng.normal(0, 0.5, (PAD + 1, DIM)).astype(np.float32)
        self.embed[PAD] = 0
        self.mask = np.zeros((span, DIM, n), np.float32)
        for k, w in enumerate(WIDTHS):
            self.mask[:w, :, k * FILTERS:(k + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(span * DIM, n)
        self.conv = (rng.normal(0, 0.3, (span * DIM, n)) * self.mask).astype(np.float32)
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, self.classes)).astype(np.float32)
        self.out_bias = np.zeros(self.classes, np.float32)

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        """(window, place, span * DIM): the embedded bytes under a filter, which
        starts at every byte of the window."""
        e = self.embed[windows]
        span = max(WIDTHS)
        s = e.strides
        view = np.lib.stride_tricks.as_strided(e, (len(e), windows.shape[1] - span + 1, span * DIM), s)
        return np.ascontiguousarray(view)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), self.classes), np.float32)
        for i in range(0, len(windows), 128):
            x = self._columns(windows[i:i + 128])
            top = (x.reshape(-1, x.shape[2]) @ self.conv).reshape(x.shape[0], x.shape[1], -1).max(1)
            z = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out[i:i + 128] = z / z.sum(1, keepdims=True)
        return out

    def gradient(self, w: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss of windows ``w`` with classes ``y``, for each parameter."""
        x = self._columns(w)
        a = (x.reshape(-1, x.shape[2]) @ self.conv).reshape(x.shape[0], x.shape[1], -1)
        at = a.argmax(1)
        top = np.take_along_axis(a, at[:, None, :], 1)[:, 0] + self.bias
        h = np.maximum(top, 0)
        z = h @ self.out + self.out_bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= weight.astype(np.float32)[:, None]
        g = {"out": h.T @ p, "out_bias": p.sum(0)}
        gh = (p @ self.out.T) * (top > 0)
        g["bias"] = gh.sum(0)
        under = np.take_along_axis(x, at[:, :, None], 1)            # (window, filter, span * DIM)
        g["conv"] = np.einsum("nfk,nf->kf", under, gh) * self.mask
        back = gh[:, :, None] * self.conv.T[None]                    # (window, filter, span * DIM)
        places = at[:, :, None] + np.arange(max(WIDTHS))
        bytes_at = w[np.arange(len(w))[:, None, None], places]
        back = back.reshape(-1, DIM)
        ge = np.stack([np.bincount(bytes_at.ravel(), back[:, d], PAD + 1) for d in range(DIM)], axis=1)
        ge[PAD] = 0
        g["embed"] = ge
        return g

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        names = PARAMETERS
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        by_label = [np.flatnonzero(labels == c) for c in range(self.classes)]
        for t in range(1, steps + 1):
            # balanced batches; a third of the windows is cut short, as ends of texts are
            each = [BATCH // len(by_label) + 1] * len(by_label)
            if self.background:
                each[-1] = max(each[-1], BATCH // 5)
            pick = np.concatenate([rng.choice(b, k) for b, k in zip(by_label, each, strict=True)])
            w = windows[pick].copy()
            cut = rng.random(len(w)) < 0.33
            w[cut[:, None] & (np.arange(SEEN) >= rng.integers(8, WINDOW, len(w))[:, None])] = PAD
            y = labels[pick]
            g = self.gradient(w, y, np.full(len(y), 1 / len(y)))
            g["out"] += 1e-4 * self.out
            rate = RATE * (1 - t / (steps + 1))
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                step = rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
                setattr(self, k, (getattr(self, k) - step).astype(np.float32))


def windows_of(data: np.ndarray, offsets: np.ndarray):
    """(windows, row, bytes): each row's text in windows of WINDOW bytes, the
    last one padded; an empty row has none."""
    size = np.diff(offsets)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), n)
    first = np.concatenate([[0], np.cumsum(n)])
    start = offsets[row] + (np.arange(len(row)) - first[row]) * WINDOW
    length = np.minimum(offsets[row + 1] - start, WINDOW)
    padded = np.concatenate([data.astype(np.int16), np.full(WINDOW, PAD, np.int16)])
    w = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    short = np.flatnonzero(length < WINDOW)
    w[short] = np.where(np.arange(WINDOW) < length[short, None], w[short], PAD)
    return w, row, length


def seen_windows(data: np.ndarray, offsets: np.ndarray):
    """``windows_of`` with the next bytes of the same row behind each window,
    so that filters start at every byte of the text."""
    w, row, length = windows_of(data, offsets)
    more = SEEN - WINDOW
    first = np.concatenate([[0], np.cumsum(-(-np.diff(offsets) // WINDOW))])
    start = offsets[row] + (np.arange(len(row)) - first[row] + 1) * WINDOW
    padded = np.concatenate([data.astype(np.int16), np.full(more + WINDOW, PAD, np.int16)])
    at = start[:, None] + np.arange(more)
    ahead = np.where(at < offsets[row + 1][:, None], padded[np.minimum(at, len(padded) - 1)], PAD)
    return np.concatenate([w, ahead.astype(np.int16)], axis=1), row, length


def noise(passages: list[str], n: int = NOISE, seed: int = 5) -> list[str]:
    """Junk for the background class: passages with their letters shuffled (as
    a whole, and inside each word) and random letters, with and without spaces
    and signs, of the passages' own alphabet and of others."""
    rng = random.Random(seed)
    own = "".join(sorted({c for t in passages for c in t if c.isalpha()})) or "a"
    others = ["".join(c for c in map(chr, range(a, b + 1)) if c.isalpha()) for a, b in _ALPHABETS]
    out = []
    for i in range(n):
        t = rng.choice(passages)
        if i % 4 == 0:
            t = "".join(rng.sample(t, len(t)))
        elif i % 4 == 1:
            t = " ".join("".join(rng.sample(w, len(w))) for w in t.split(" "))
        else:
            letters = rng.choice([own, others[0], "bcdfghjklmnpqrstvwxz"]) if i % 4 == 2 else rng.choice(others)
            if rng.random() < 0.3:
                letters = "".join(rng.choices(letters, k=rng.randint(1, 8)))
            more = rng.choice(["", " " * max(1, len(letters) // 5), string.digits + string.punctuation + "   "])
            t = "".join(rng.choices(letters + more, k=WINDOW))
        out.append(t)
    return out


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        background: bool = False) -> ByteCNN | None:
    """A network that learns from every window of every labelled row
    (``learn_all``); with ``background`` also from junk made of them. It starts
    from steps over WINDOWS_PER_DOC windows of at most PER_LANGUAGE documents of
    each language (all languages). None without labelled text."""
    bound_batches(labelled.sparkSession)
    # rows without an id are told apart by their texts
    own = F.pmod(F.xxhash64(text_col), F.lit(1 << 30)).cast(labelled.schema[id_col].dataType)
    rows = labelled.select(F.coalesce(F.col(id_col), own).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND length(text) > 0")
    sample = bounded_sample(rows, "lang", "id", PER_LANGUAGE)
    place = [F.substring("text", (F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.length("text") - SEEN, F.lit(0)) + 1)
                                  + 1).cast("int"), F.lit(SEEN)) for k in range(WINDOWS_PER_DOC)]
    got = sample.select("id", "lang", F.array(*place).alias("w")).orderBy("lang", "id").collect()
    if not got:
        return None
    languages = sorted({r["lang"] for r in got})
    number = {x: k for k, x in enumerate(languages)}
    raw = [(t.encode()[:SEEN], number[r["lang"]]) for r in got for t in r["w"]]
    if background:
        raw += [(t.encode()[:SEEN], len(languages)) for t in noise([t for r in got for t in r["w"]])]
    w = np.full((len(raw), SEEN), PAD, np.int16)
    for i, (b, _) in enumerate(raw):
        w[i, : len(b)] = np.frombuffer(b, np.uint8)
    model = ByteCNN(languages, background)
    model.train(w, np.array([y for _, y in raw]))
    learn_all(model, rows)
    return model


def learn_all(model: ByteCNN, rows: DataFrame, passes: int = PASSES) -> None:
    """Steps over all windows of all ``rows`` (text, lang). Each task adds up the
    gradients of its blocks, languages weighing alike however many windows they
    have; what goes over the driver are these sums, one set a task. A parameter
    moves by the mean gradient over the root of the blocks' mean square, as
    Adam's steps do. Junk is made of each block's own passages."""
    number = {x: k for k, x in enumerate(model.languages)}
    windows = F.ceil(F.octet_length("text") / WINDOW)
    count = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(windows).alias("n")).collect()}
    weight = np.array([1 / (model.classes * count[x]) for x in model.languages])
    total, background = sum(count.values()), model.background
    shapes = {k: getattr(model, k).shape for k in PARAMETERS}

    def sums(batches):
        part = TaskContext.get().partitionId()
        # of the languages, of junk; then the squares of both, and their windows
        acc, n = np.zeros((4, sum(int(np.prod(x)) for x in shapes.values()))), [0, 0]

        def add(kind, w, y, each):
            g = model.gradient(w, y, each)
            g = np.concatenate([g[k].ravel() for k in PARAMETERS]).astype(np.float64)
            acc[kind] += g
            acc[2 + kind] += g * g / len(y)
            n[kind] += len(y)
        for b in batches:
            labels = np.array([number[x] for x in b.column(1).to_pylist()], np.int64)
            data, o = buffers(b.column(0))
            for i, j in blocks(o, 1 << 20):
                w, row, _ = seen_windows(data[o[i]:o[j]], o[i:j + 1] - o[i])
                y = labels[i:j][row]
                for k in range(0, len(w), 128):
                    add(0, w[k:k + 128], y[k:k + 128], weight[y[k:k + 128]])
                if background and len(w):
                    own = [bytes(x[x < PAD].astype(np.uint8)).decode(errors="ignore") or " " for x in w[::20]]
                    junk = [x.encode()[:SEEN] for x in noise(own, len(own))]
                    z = np.full((len(junk), SEEN), PAD, np.int16)
                    for k, x in enumerate(junk):
                        z[k, :len(x)] = np.frombuffer(x, np.uint8)
                    for k in range(0, len(z), 128):
                        m = len(z[k:k + 128])
                        add(1, z[k:k + 128], np.full(m, len(number)), np.ones(m))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([acc.tobytes()]), *(pa.array([x], pa.int64()) for x in n)],
                                         names=["part", "sums", "windows", "junk"])
    for _ in range(passes):
        got = rows.select("text", "lang").mapInArrow(sums, "part int, sums binary, windows long, junk long").collect()
        got.sort(key=lambda r: r["part"])
        acc = sum(np.frombuffer(r["sums"]).reshape(4, -1) for r in got)
        junk = sum(r["junk"] for r in got)
        share = 1 / (model.classes * junk) if junk else 0.0
        mean, square = acc[0] + acc[1] * share, acc[2] * total + acc[3] * share * share * junk
        step = RATE * mean / (np.sqrt(square) + 1e-8)
        at = 0
        for k in PARAMETERS:
            size = int(np.prod(shapes[k]))
            setattr(model, k, (getattr(model, k) - step[at:at + size].reshape(shapes[k])).astype(np.float32))
            at += size


def shares(model: ByteCNN, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(row, class): the classes' probabilities, averaged by bytes over all
    windows; 0 for an empty row."""
    w, row, length = seen_windows(data, offsets)
    p = model.probabilities(w).astype(np.float64) * length[:, None]
    total = np.stack([np.bincount(row, p[:, c], len(offsets) - 1) for c in range(model.classes)], axis=1)
    return total / np.maximum(total.sum(1, keepdims=True), 1e-12)


def known_shares(model: ByteCNN, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, row offsets): the share of the languages together of each text
    cut to the sizes of ``cuts_to``, up to the first that holds it whole."""
    size, base = np.diff(offsets), len(CUTS)
    head = np.minimum(size, CUTS[-1])
    start = np.concatenate([[0], np.cumsum(head)])
    data_head = data[np.repeat(offsets[:-1] - start[:-1], head) + np.arange(start[-1])]
    inside = np.arange(start[-1]) - np.repeat(start[:-1], head)
    n = base + np.maximum(np.ceil(np.log2(np.maximum(size, 1) / CUTS[-1])), 0).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(first[-1])
    for k, cut in enumerate(CUTS):
        part = np.concatenate([[0], np.cumsum(np.minimum(head, cut))])
        out[first[:-1] + k] = shares(model, data_head[inside < cut], part)[:, :-1].sum(1)
    if (size > CUTS[-1]).any():
        w, _, length = seen_windows(data, offsets)
        p = model.probabilities(w).astype(np.float64)
        at = np.concatenate([[0], np.cumsum(-(-size // WINDOW))])
        # all windows, of the languages and of all classes, before each window
        before = np.concatenate([np.zeros((1, 2)), np.cumsum(np.stack([p[:, :-1].sum(1), p.sum(1)], axis=1) * length[:, None], axis=0)])
        for k in range(base, int(n.max())):
            cut = CUTS[-1] << (k - base + 1)
            rows = np.flatnonzero((n > k) & (size <= cut))
            both = before[at[rows + 1]] - before[at[rows]]
            out[first[rows] + k] = both[:, 0] / np.maximum(both[:, 1], 1e-12)
            rows = np.flatnonzero(size > cut)
            if not len(rows):
                continue
            last = at[rows] + cut // WINDOW - 1
            # the last window of a text that is cut here sees no byte behind it
            tail = w[last]
            tail[:, WINDOW:] = PAD
            p = model.probabilities(tail).astype(np.float64) * WINDOW
            both = before[last] - before[at[rows]] + np.stack([p[:, :-1].sum(1), p.sum(1)], axis=1)
            out[first[rows] + k] = both[:, 0] / np.maximum(both[:, 1], 1e-12)
    return out, first


def cuts_to(n: int) -> list[int]:
    """CUTS, and doubled on: ``n`` sizes."""
    return [*CUTS, *(CUTS[-1] << k for k in range(1, n - len(CUTS) + 1))]


def least_shares(model: ByteCNN, rows: DataFrame) -> np.ndarray | None:
    """The smallest share of the languages together that a text may have, at
    CUTS and on, doubled, until the longest is whole: half of what next to all
    of the clean texts of ``rows`` (text), cut to that size, reach, never more
    for a shorter text than for a longer one. All rows are counted, each with
    its whole text; None without rows."""
    def known(data, offsets):
        values, first = known_shares(model, data, offsets)
        return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.float64()))]
    each = materialize(map_text(rows.select("text"), [], known, "known array<double>", "text", SMALL_BLOCK), "language_shares")
    sizes = each.agg(F.max(F.size("known"))).first()[0]
    if sizes is None:
        return None
    # past the size that holds a text whole it counts as it is
    at = F.explode(F.sequence(F.lit(0), F.lit(sizes - 1)))
    each = each.select("known", at.alias("cut")).select(
        "cut", F.element_at("known", F.least(F.col("cut") + 1, F.size("known"))).alias("known"))
    got = grouped_percentiles(each, ["cut"], {"rare": ("known", RARE)}, parts=64).collect()
    out = [min(0.5, r["rare"] / 2) for r in sorted(got, key=lambda r: r["cut"])]
    return np.minimum.accumulate(np.array(out)[::-1])[::-1]


def bound_of(model: ByteCNN, n_bytes: np.ndarray) -> np.ndarray:
    """The bound for texts of these sizes: one function of the size."""
    least = np.concatenate([model.least, model.longer])
    return np.interp(np.log2(np.maximum(n_bytes, 1)), np.log2(cuts_to(len(least))), least)


def fit_stage(docs: DataFrame) -> ByteCNN | None:
    """A network with a background class, and the bound that the labelled rows
    set aside from training give it, all of them and their whole texts. With
    fewer than SET_ASIDE of these the training rows give it too; as the network
    knows them, their bound is halved once more."""
    # a row without an id is one to learn from
    aside = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = fit(docs.filter(~aside), background=True)
    if model is not None:
        rows = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        known = rows.filter(aside & F.col("lang").isin(model.languages))
        if known.limit(SET_ASIDE).count() >= SET_ASIDE:
            least = least_shares(model, known)
        else:
            least = least_shares(model, known.unionByName(rows.filter(~aside)))
            least = None if least is None else least / 2
        if least is not None:
            model.least, model.longer = least[:len(CUTS)], least[len(CUTS):]
    return model


def predict(docs: DataFrame, model: ByteCNN | None, keep: list[str], text_col: str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns, the predicted language and its probability for every
    row. A null or empty text and one without a letter are ``und`` with score
    0, as is every text when there was nothing to learn from, and one under the
    model's bound if it has bounds. Rows that repeat are predicted alike."""
    bound_batches(docs.sparkSession)

    def fn(data, offsets):
        n = len(offsets) - 1
        ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128)
        has = np.diff(np.concatenate([[0], np.cumsum(ascii_letter)])[offsets]) > 0
        for i in np.flatnonzero(~has):
            t = texts_of(data[offsets[i]:offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))[0]
            has[i] = any(m.group().isalpha() for m in _LETTER.finditer(t))
        lang, score = ["und"] * n, np.zeros(n)
        if model is not None and has.any():
            share = shares(model, data, offsets)
            best = share[:, :len(model.languages)].argmax(1)
            if model.least is not None:
                known = share[:, :len(model.languages)].sum(1)
                has &= known >= bound_of(model, np.diff(offsets))
            share = share[np.arange(n), best]
            lang = [model.languages[b] if h else "und" for b, h in zip(best.tolist(), has.tolist(), strict=True)]
            score = np.where(has, np.clip(share, 0, 1), 0.0)
        return [pa.array(lang), pa.array(score, pa.float64())]
    return map_text(docs, keep, fn, f"{names[0]} string, {names[1]} double", text_col, SMALL_BLOCK)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def keep_identified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the rows of no language (all text kept whole, columns
    as given): null texts, texts without a letter, and texts that the network
    takes for junk or for no language it learned, by a bound set from the
    labelled rows set aside (``fit_stage``). Without labelled rows to learn from
    (lang null in all, or none among the training rows) only null texts and
    texts without a letter are dropped."""
    model = fit_stage(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    names = tuple(fresh_names(docs, "stage_lang", "stage_score"))
    out = predict(docs, model, docs.columns, "text", names)
    return out.filter(F.col(names[0]) != "und").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = predict(docs, fit(training_rows(docs)), ["doc_id"])
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "lang_pred", "score")
