"""Operator 7: quality classifier on random-indexing word vectors.

Every word (a run of letters and digits, or of marks; case counts) has a sparse
random index vector, a function of its hash. Its word vector is the sum of the
index vectors of its neighbours over the whole corpus, kept in a table of a
fixed number of hash buckets. A document is pooled to the mean and spread of
its words' vectors, and a two-layer numpy network, fitted on a bounded sample
of labelled rows, scores it; a temperature fitted on rows set aside calibrates
the probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytetext import Rolling, blocks, buffers, mix
from .common import read_table
from .maptext import bounded_sample, map_text

BUCKETS = 1 << 14       # of words; the table is BUCKETS x DIM whatever the corpus
DIM = 64
NONZEROS = 2            # of an index vector
REACH = 2               # neighbours on each side
SLICES = 64             # parts in which the table is summed
PER_LABEL = 3000        # labelled rows of each label to learn from, at most
HIDDEN = 32
FEATURES = 2 * DIM + 3
EPOCHS, BATCH, RATE, DECAY = 60, 128, 0.005, 1e-3
THRESHOLD = 0.7

_CLASS = np.full(256, 2, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
for _r in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    _CLASS[list(_r)] = 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the words and marks of a block, in order."""
    c = _CLASS[data]
    begin = np.empty(len(data), bool)
    begin[:1] = True
    begin[1:] = c[1:] != c[:-1]
    begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    edge = np.append(np.flatnonzero(begin), len(data))
    start, end = edge[:-1], edge[1:]
    real = c[start] != 0 if len(start) else np.zeros(0, bool)
    start, end = start[real], end[real]
    return Rolling(data).ranges(start, end), np.searchsorted(offsets, start, side="right") - 1


def bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(50)).astype(np.int64) % BUCKETS


def index_entries(h: np.ndarray):
    """The NONZEROS (position, sign) pairs of the words' index vectors."""
    x = mix(h ^ np.uint64(0x5851F42D4C957F2D))
    for k in range(NONZEROS):
        y = (x >> np.uint64(16 * k)).astype(np.int64)
        yield y % DIM, np.where((y >> 8) & 1, 1, -1)


def neighbour_sums(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the neighbours' index vectors by bucket, for one block."""
    h, row = word_hashes(data, offsets)
    total = np.zeros(BUCKETS * DIM)
    at = bucket_of(h) * DIM
    for position, sign in index_entries(h):
        for d in range(1, REACH + 1):
            if len(h) <= d:
                break
            same = row[d:] == row[:-d]
            w = sign * 1.0
            total += np.bincount(at[:-d][same] + position[d:][same], w[d:][same], BUCKETS * DIM)
            total += np.bincount(at[d:][same] + position[:-d][same], w[:-d][same], BUCKETS * DIM)
    return total


def word_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The corpus' word vectors, (BUCKETS, DIM) unit rows. A task sums its rows
    into one table; tables meet slice by slice and are added as they stream by.
    All sums are whole numbers, so the result does not depend on the order."""
    part = BUCKETS * DIM // SLICES

    def gather(batches):
        total = np.zeros(BUCKETS * DIM, np.int64)
        for b in batches:
            data, o = buffers(b.column(0))
            for i, j in blocks(o):
                total += neighbour_sums(data[o[i]:o[j]], o[i:j + 1] - o[i]).astype(np.int64)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in total.reshape(SLICES, part)], pa.binary())],
                names=["slice", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                             names=["slice", "sums"])
    schema = "slice int, sums binary"
    rows = docs.select(text_col).mapInArrow(gather, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect()
    table = np.zeros((SLICES, part))
    for r in rows:
        table[r["slice"]] += np.frombuffer(r["sums"], np.int64)
    table = table.reshape(BUCKETS, DIM)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Features of each row: mean and standard deviation of its words' vectors,
    the mean likeness of words one and two apart, and the logarithm of the
    number of words; zeros without a word."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), np.float32)
    h, row = word_hashes(data, offsets)
    bucket = bucket_of(h)
    count = np.bincount(row, minlength=n)
    sums, squares = np.zeros((n, DIM)), np.zeros((n, DIM))
    like = np.zeros((2, n))
    step = 1 << 12
    for a in range(0, len(h), step):
        far, near = table[bucket[a:a + step + 2]], row[a:a + step + 2]
        for d in (1, 2):
            m = max(min(step, len(near) - d), 0)
            same = near[:m] == near[d:d + m]
            like[d - 1] += np.bincount(near[:m][same], np.einsum("ij,ij->i", far[:m][same], far[d:d + m][same]), n)
        v, r = far[:step], near[:step]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        sums[r[first]] += np.add.reduceat(v, first, axis=0)
        squares[r[first]] += np.add.reduceat(v * v, first, axis=0)
    m = np.maximum(count, 1)[:, None]
    mean = sums / m
    out[:, :DIM] = mean
    out[:, DIM:2 * DIM] = np.sqrt(np.maximum(squares / m - mean * mean, 0))
    out[:, -3:-1] = (like / m[:, 0]).T
    out[:, -1] = np.log1p(count) / 10
    return out


class Network:
    """Two layers (tanh, sigmoid) on standardised features, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        aside = np.zeros(len(x), bool)
        aside[rng.permutation(len(x))[: len(x) // 5]] = True
        if len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
            aside[:] = False
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)
        self.temperature = 1.0
        self._train((x[~aside] - self.mean) / self.scale, y[~aside], rng)
        if aside.any():
            z = self.logits(x[aside])
            grid = np.exp(np.linspace(-1.5, 2.5, 81))
            loss = [np.mean(np.logaddexp(0, -(2 * y[aside] - 1) * z / t)) for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _train(self, x, y, rng):
        names = ("w1", "b1", "w2", "b2")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        v = {k: np.zeros_like(getattr(self, k)) for k in names}
        t = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), BATCH):
                t += 1
                xb, yb = x[order[a:a + BATCH]], y[order[a:a + BATCH]]
                h = np.tanh(xb @ self.w1 + self.b1)
                d = (1 / (1 + np.exp(-(h @ self.w2 + self.b2))) - yb) / len(xb)
                back = d[:, None] * self.w2 * (1 - h * h)
                g = {"w2": h.T @ d + DECAY * self.w2, "b2": d.sum(keepdims=True), "w1": xb.T @ back + DECAY * self.w1, "b1": back.sum(0)}
                for k in names:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    step = RATE * (1 - epoch / EPOCHS) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                    setattr(self, k, getattr(self, k) - step)

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1)
        return h @ self.w2 + self.b2[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, table: np.ndarray) -> Network | None:
    """A network from at most PER_LABEL rows of each label (``labels``: doc_id,
    quality 0 or 1; nulls do not count). None unless both labels occur."""
    lab = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = bounded_sample(lab, "quality", "doc_id", PER_LABEL)
    # at most 2 * PER_LABEL short rows: a proven bound, so the texts stay where they are
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")

    def fn(data, offsets):
        return [pa.array([x.tobytes() for x in pooled(data, offsets, table)], pa.binary())]
    got = map_text(rows, ["doc_id", "quality"], fn, "features binary").orderBy("doc_id", "features").collect()
    y = np.array([r["quality"] for r in got], np.float64)
    if len(set(y)) < 2:
        return None
    x = np.array([np.frombuffer(r["features"], np.float32) for r in got], np.float64)
    return Network(x, y)


def score_quality(docs: DataFrame, table: np.ndarray, model: Network | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``score``, the probability of label 1, of every
    whole text (null as empty; an empty text has the score of no words; 0.5
    everywhere without a model). Equal texts score equally."""
    def fn(data, offsets):
        n = len(offsets) - 1
        p = np.full(n, 0.5) if model is None else model.probabilities(pooled(data, offsets, table).astype(np.float64))
        return [pa.array(p, pa.float64())]
    return map_text(docs, keep, fn, "score double", text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    table = word_table(docs)
    model = fit(docs, labels.filter(rest != 2), table)
    return score_quality(docs, table, model, ["doc_id"]).select(
        "doc_id", (rest == 2).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
