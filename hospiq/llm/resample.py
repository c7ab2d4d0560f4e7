"""Operator 12: importance resampling towards a target distribution.

1. The tokenizers library's untrained regex split finds the words of the
   ASCII-lowered text with their offsets. Windows of 1 to ``max_n`` words, each
   a pair of offsets, are the features; a feature's bucket is the CRC-32 of its
   words (joined by one space) modulo the number of buckets.
2. A document becomes a sparse bucket histogram, at most one number for each
   bucket however long its text is. The histograms of the corpus and of the
   target texts are summed, in every task first.
3. A bucket's gain is the logarithm of how much likelier the target is to hold
   it. A document's weight is the mean gain of its features; a pseudorandom
   Gumbel term, a hash of its id, makes the highest scores a sample without
   replacement, with odds as the weights say.
4. Scores are ranked by range partitions, so no task sorts the whole table.

Words hold no white space, so the library sees each distinct stretch between
spaces once per worker; a memo of bounded size holds its words.
"""

from __future__ import annotations

import math
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytetext import blocks, buffers
from .common import materialize, numbered, read_table, segments
from .maptext import texts_of

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_N = 1               # words of the longest window
BUCKETS = 10_000
PERCENT = 10            # of the documents that may be drawn
MIN_WORDS = 20          # of a document that may be drawn
SEED = "2024"
MEMO = 400_000          # stretches remembered by a worker
LONGEST = 200           # characters of a remembered stretch
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Splitter:
    """Words of one worker's texts, by the library's regex split."""

    def __init__(self, pattern: str = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, pre_tokenizers
        self.split = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
        self.memo: dict[str, tuple[bytes, tuple[bytes, ...]]] = {"": (b"", ())}

    def words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        """(word, (start, end)) of the ASCII-lowered text."""
        return self.split.pre_tokenize_str(text.translate(_LOWER)) if text else []

    def learn(self, stretches: list[str]) -> None:
        """Splits new stretches, many in one call: a word belongs to the
        stretch in which its offsets lie."""
        for i in range(0, len(stretches), 2000):
            part = stretches[i:i + 2000]
            ends = np.cumsum([len(s) + 1 for s in part])
            found: list[list[bytes]] = [[] for _ in part]
            got = self.words(" ".join(part))
            at = np.searchsorted(ends, [a for _, (a, _) in got], side="right").tolist()
            for k, (w, _) in zip(at, got, strict=True):
                found[k].append(w.encode())
            for s, ws in zip(part, found, strict=True):
                self.memo[s] = (b"".join(zlib.crc32(w).to_bytes(4, "little") for w in ws), tuple(ws))

    def features(self, text: str, max_n: int, carry: tuple[bytes, ...] = ()) -> tuple[np.ndarray, int, tuple[bytes, ...]]:
        """(CRC-32 of all windows that end in this text, its words, its last
        words); ``carry`` are the words just before it."""
        if len(self.memo) > MEMO:
            self.memo = {"": (b"", ())}
        stretches = text.replace("\n", " ").split(" ")
        got = list(map(self.memo.get, stretches))
        if None in got:
            new = list({s for s, g in zip(stretches, got, strict=True) if g is None})
            self.learn(new)
            got = list(map(self.memo.__getitem__, stretches))
            for s in new:
                if len(s) > LONGEST:
                    del self.memo[s]
        crc = np.frombuffer(b"".join([g[0] for g in got]), "<u4")
        if max_n == 1:
            return crc, len(crc), ()
        words = [*carry, *(w for g in got for w in g[1])]
        more, first = [], len(carry)
        for end in range(first, len(words)):
            for start in range(max(0, end - max_n + 1), end):
                more.append(zlib.crc32(b" ".join(words[start:end + 1])))
        return np.concatenate([crc, np.array(more, "<u4")]), len(crc), tuple(words[max(0, len(words) - max_n + 1):])


_SPLITTERS: dict[str, Splitter] = {}


def splitter(pattern: str) -> Splitter:
    if pattern not in _SPLITTERS:
        _SPLITTERS[pattern] = Splitter(pattern)
    return _SPLITTERS[pattern]


def text_histogram(text: str, max_n: int, n_buckets: int, pattern: str = WORDS) -> tuple[np.ndarray, np.ndarray, int]:
    """(buckets, counts, words) of one whole text; a long one goes by in pieces."""
    s, carry, n_words, total = splitter(pattern), (), 0, None
    for piece in segments(text):
        crc, n, carry = s.features(piece, max_n, carry)
        n_words += n
        b, c = np.unique(crc % np.uint32(n_buckets), return_counts=True)
        if total is None:
            total = (b, c)
        else:
            both, where = np.unique(np.concatenate([total[0], b]), return_inverse=True)
            total = both, np.bincount(where, np.concatenate([total[1], c])).astype(np.int64)
    return total[0], total[1], n_words


HISTOGRAM = "n_words long, n_features long, buckets array<int>, counts array<long>"


def histograms(docs: DataFrame, keep: list[str], text_col: str = "text", max_n: int = MAX_N, n_buckets: int = BUCKETS,
               pattern: str = WORDS) -> DataFrame:
    """``keep`` columns of every row and its bucket histogram. A null or empty
    text has no words."""
    src = docs.select(*keep, F.col(text_col).alias("histogram_text"))
    schema = docs.select(*keep).schema
    for f in docs.sparkSession.createDataFrame([], HISTOGRAM).schema.fields:
        schema = schema.add(f)
    names = schema.fieldNames()

    def run(batches):
        for b in batches:
            data, o = buffers(b.column(len(keep)))
            for i, j in blocks(o):
                got = [text_histogram(t, max_n, n_buckets, pattern) for t in texts_of(data[o[i]:o[j]], o[i:j + 1] - o[i])]
                at = pa.array(np.concatenate([[0], np.cumsum([len(g[0]) for g in got])]), pa.int32())
                cols = [pa.array([g[2] for g in got], pa.int64()), pa.array([int(g[1].sum()) for g in got], pa.int64()),
                        pa.ListArray.from_arrays(at, pa.array(np.concatenate([g[0] for g in got]).astype(np.int32))),
                        pa.ListArray.from_arrays(at, pa.array(np.concatenate([g[1] for g in got]).astype(np.int64)))]
                yield pa.RecordBatch.from_arrays([b.column(c).slice(i, j - i) for c in range(len(keep))] + cols, names=names)
    return src.mapInArrow(run, schema)


def bucket_totals(rows: DataFrame, n_buckets: int) -> np.ndarray:
    """The sum of all histograms: every task adds up its own, so at most
    ``n_buckets`` numbers leave it and as many reach the driver."""
    def run(batches):
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            k, c = (b.column(i).flatten().to_numpy() for i in (0, 1))
            np.add.at(total, k, c)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])
    out = np.zeros(n_buckets, np.int64)
    for r in rows.select("buckets", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths: the log of its smoothed share of the
    target over that of the corpus, rounded down."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * float(s_all + n) / ((s + 1) * float(t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def importance(hist: DataFrame, keep: list[str], gain: np.ndarray) -> DataFrame:
    """``keep``, ``n_words``, ``n_features`` and ``weight``: the floored mean
    gain of the features, 0 without any."""
    src = hist.select(*keep, "n_words", "n_features", "buckets", "counts")
    schema = hist.select(*keep, "n_words", "n_features").schema.add("weight", "long")
    k = len(keep) + 2

    def run(batches):
        for b in batches:
            lists = b.column(k)
            at = lists.offsets.to_numpy() if len(b) else np.zeros(1, np.int64)
            each = gain[lists.values.to_numpy()] * b.column(k + 1).values.to_numpy()
            sums = np.concatenate([[0], np.cumsum(each)])
            n = b.column(k - 1).to_numpy()
            weight = (sums[at[1:]] - sums[at[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in range(k)] + [pa.array(weight)], names=schema.fieldNames())
    return src.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED, max_n: int = MAX_N,
             n_buckets: int = BUCKETS, pattern: str = WORDS) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of
    ``docs``; rank is 1, 2, 3 ... for the drawn ones and null for the others.

    Of the N rows with at least ``min_words`` words, percent * N / 100 (rounded
    down) with the highest scores are drawn; equal scores go to the smaller id,
    a null id last. A null id has the random number of an empty one. A null or
    empty text has no features and weight 0. Repeated rows are scored, counted
    and ranked each; the same rows in another order give the same ranks. A
    document gets more than one feature of a bucket as often as it has it.
    Other columns are not read. Without target texts all targets count 0; an
    empty table gives an empty result.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hist = materialize(histograms(src, ["doc_id"], "text", max_n, n_buckets, pattern), "histograms")
    goal = histograms(target, [], target_text, max_n, n_buckets, pattern)
    gain = gains(bucket_totals(hist, n_buckets), bucket_totals(goal, n_buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")
    rows = (importance(hist, ["doc_id"], gain).withColumn("score", F.col("weight") + noise)
            .withColumn("eligible", F.col("n_words") >= min_words).withColumn("row", F.monotonically_increasing_id()))
    rows = materialize(rows, "scores")
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(),
             F.col("weight").asc(), F.col("row").asc()]
    drawn = rows.filter("eligible").count() * percent // 100
    ranked = numbered(rows, order, "place")
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score",
                         F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
step AS (SELECT i, c FROM bits WHERE k = 8),
texts AS (
  SELECT row_number() OVER () AS rid, doc_id, false AS target, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, true, text FROM benchmark),
words AS (
  SELECT rid, target, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
crc AS (
  SELECT w, hex(encode(w)) AS h, 0 AS pos, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT w FROM words)
  UNION ALL
  SELECT crc.w, crc.h, crc.pos + 1, xor(crc.c >> 8, step.c) FROM crc JOIN step
    ON step.i = xor(crc.c, CAST('0x' || substr(crc.h, 2 * crc.pos + 1, 2) AS BIGINT)) & 255
  WHERE 2 * crc.pos < length(crc.h)),
bucket AS (SELECT w, xor(c, 4294967295) % 10000 AS b FROM crc WHERE 2 * pos = length(h)),
f AS (SELECT rid, target, b FROM words JOIN bucket USING (w)),
per AS (SELECT b, count(*) FILTER (WHERE NOT target) AS s, count(*) FILTER (WHERE target) AS t FROM f GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                            / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS g FROM per),
weights AS (SELECT rid, count(*) AS n, floor(sum(g) / count(*)) AS weight FROM f JOIN gain USING (b) WHERE NOT target GROUP BY rid),
scored AS (
  SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
              AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (rid) WHERE NOT texts.target),
placed AS (
  SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS LAST, n_features, weight) AS place,
         count(*) FILTER (WHERE n_features >= 20) OVER () * 10 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM placed
"""
