"""Operator 13: packing documents into sequences, best two fit.

1. Tokens are counted and cut into pieces of at most ``capacity`` where the
   texts are read; only a piece's place, length and checksum go on.
2. Lengths are integers up to ``capacity``, so the table's lengths are a
   histogram of that many numbers at most, however many documents there are.
   The plan is made of *patterns*: the lengths that fill one sequence, found by
   best two fit, with the number of sequences filled alike. A pattern is
   repeated until a length runs short, so there are fewer than
   ``capacity * (1 + ln(capacity))`` patterns for any table.
3. Pieces are numbered in the order of their lengths by range partitions, and
   each looks up its sequence and offset in the plan by its number.

Best two fit fills a sequence greedily with the longest document that still
fits; then its smallest document is replaced by two unpacked ones if they fit
the gap that it leaves more tightly.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right, insort
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytetext import blocks, buffers
from .common import materialize, numbered, read_table, segments
from .maptext import texts_of

CAPACITY = 4096
END_ID = 1              # closes each document
MEMO = 600_000          # words remembered by a worker
LONGEST = 200           # characters of a remembered word
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
_LATIN = re.compile(_LETTERS)
# marks, letters, marks: no quote, after which a contraction may follow, and
# no character with which a special token starts or ends
_MARKS = r"[!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*"
_FORM = re.compile(f"({_MARKS})({_LETTERS})({_MARKS})")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of one worker's texts. The tokenizer's words hold no white
    space and its normaliser joins nothing across a space, so the library sees
    each distinct stretch between spaces once. Letters and the marks before and
    after them are words of their own, and letters count in lower case, so it
    sees the letters once however they are written and marked."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)    # tokens that end a word
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.memo: dict[str, bytes] = {"": b""}

    def _each(self, words: list[str]) -> None:
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.memo[w] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> list[str]:
        """Remember ``new``; the long words among what was added."""
        stems, marks, odd, built = set(), set(), [], []
        for w in new:
            if w.isalpha():
                lead, stem, tail = "", w, ""
            elif form := _FORM.fullmatch(w):
                lead, stem, tail = form.groups()
                marks.add(lead)
                marks.add(tail)
            else:
                odd.append(w)
                continue
            low = stem.lower()
            if low != stem and not _LATIN.fullmatch(stem):      # of these letters it is sure that the library lowers them alike
                low = stem
            stems.add(low)
            if low != w:
                built.append((w, lead, low, tail))
        words = list(stems.difference(self.memo))
        for i in range(0, len(words), 1000):        # letters only: one word each, so many go in one text
            part = words[i:i + 1000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) != len(part):              # a normalised letter is more than a letter
                self._each(part)
                continue
            raw, a = ids.tobytes(), 0
            for w, b in zip(part, (4 * stop).tolist(), strict=True):
                self.memo[w] = raw[a:b]
                a = b
        self._each(odd + list(marks.difference(self.memo)))
        memo = self.memo
        for w, lead, low, tail in built:
            memo[w] = memo[lead] + memo[low] + memo[tail]
        return [w for w in (*new, *words, *marks) if len(w) > LONGEST]

    def block(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of the texts of a block as little-endian 32-bit numbers.
        Each distinct stretch of the block is looked up once."""
        if len(self.memo) > MEMO:                   # common words came early, so the first ones stay
            self.memo = dict(islice(self.memo.items(), MEMO // 2))
        apart = (data == 32) | (data == 10)
        before = np.concatenate([[0], np.cumsum(~apart)])           # bytes of stretches before a place
        limit = np.append(apart, False)
        limit[offsets] = True
        edges = before[limit]
        edges = edges[np.append(True, edges[1:] > edges[:-1])]
        letters = np.ascontiguousarray(data[~apart])
        words = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(letters))
        words = words.dictionary_encode()
        distinct, index = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        got = list(map(self.memo.get, distinct))
        if None in got:
            new = [k for k, g in enumerate(got) if g is None]
            long = self._learn([distinct[k] for k in new])
            for k in new:
                got[k] = self.memo[distinct[k]]
            for w in long:
                self.memo.pop(w, None)
        each = np.fromiter(map(len, got), np.int64, len(got)) // 4
        ids, first = np.frombuffer(b"".join(got), "<u4"), np.cumsum(each) - each
        size = each[index]
        end = np.concatenate([[0], np.cumsum(size)])
        raw = ids[np.repeat(first[index] - end[:-1], size) + np.arange(end[-1])].tobytes()
        at = (4 * end[np.searchsorted(edges, before[offsets])]).tolist()
        return [raw[x:y] for x, y in zip(at, at[1:], strict=False)]

    def ids(self, text: str):
        """The ids of a text as little-endian 32-bit numbers, piece by piece."""
        for part in segments(text):
            data = np.frombuffer(part.encode(), np.uint8)
            yield self.block(data, np.array([0, len(data)]))[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(encoded, end_id: int, capacity: int):
    """A document's pieces (bytes of ids), the end id last."""
    held, width = bytearray(), 4 * capacity
    for part in encoded:
        held += part
        while len(held) > width:
            yield bytes(held[:width])
            del held[:width]
    held += end_id.to_bytes(4, "little")
    while len(held) > width:
        yield bytes(held[:width])
        del held[:width]
    yield bytes(held)


def pieces(docs: DataFrame, keep: list[str], text_col: str = "text", tokenizer: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``keep`` columns, ``piece, start, length, ids_crc32`` (and ``ids``,
    little-endian 32-bit numbers) of each piece of every row."""
    src = docs.select(*keep, F.col(text_col).alias("packed_text"))
    schema = docs.select(*keep).schema
    added = "piece int, start long, length int, ids_crc32 long" + (", ids binary" if with_ids else "")
    for f in docs.sparkSession.createDataFrame([], added).schema.fields:
        schema = schema.add(f)
    names = schema.fieldNames()

    def run(batches):
        enc = encoder(tokenizer or default_tokenizer())
        for b in batches:
            data, o = buffers(b.column(len(keep)))
            for i, j in blocks(o):
                rows, out = [], []
                part, at = data[o[i]:o[j]], o[i:j + 1] - o[i]
                # a block of one document, which may be huge, is encoded piece by piece
                encoded = [enc.ids(x) for x in texts_of(part, at)] if j == i + 1 else [[x] for x in enc.block(part, at)]
                for k, parts in enumerate(encoded):
                    start = 0
                    for n, raw in enumerate(cut(parts, end_id, capacity)):
                        rows.append(i + k)
                        out.append((n, start, len(raw) // 4, zlib.crc32(raw), raw if with_ids else None))
                        start += len(raw) // 4
                at, cols = pa.array(rows), list(zip(*out, strict=True))
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()][:len(names) - len(keep)]
                yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in range(len(keep))]
                                                 + [pa.array(c, t) for c, t in zip(cols, kinds, strict=False)], names=names)
    return src.mapInArrow(run, schema)


class _Stock:
    """What is left of each length, with the longest one up to any bound."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in histogram.items():
            self.left[length] = n
        self.sizes = sorted(k for k, n in histogram.items() if n)
        self.upto = np.zeros(capacity + 2, np.int64)
        for k in self.sizes:
            self.upto[k:] = k

    def take(self, length: int, n: int) -> None:
        before = self.left[length]
        self.left[length] = before - n
        if before and before == n or not before and n < 0:      # the length ran out, or came back
            if n > 0:
                self.sizes.remove(length)
            else:
                insort(self.sizes, length)
            at = bisect_right(self.sizes, length)
            top = self.sizes[at] if at < len(self.sizes) else len(self.upto)
            self.upto[length:top] = self.sizes[at - 1] if at else 0


def fill_one(stock: _Stock, capacity: int) -> tuple[list[int], dict[int, int]]:
    """(the lengths of one sequence, longest first; the most of each length
    that the search held at once). Takes them from the stock."""
    chosen, gap, held = [], capacity, {}
    while (k := int(stock.upto[gap])):
        chosen.append(k)
        stock.take(k, 1)
        held[k] = held.get(k, 0) + 1
        gap -= k
    if len(chosen) > 1 and gap:
        small = chosen[-1]
        room = gap + small
        first = np.array(stock.sizes[:bisect_right(stock.sizes, room)], np.int64)
        if len(first):
            second = stock.upto[room - first]
            twin = (second == first) & (stock.left[first] < 2)
            second = np.where(twin, stock.upto[np.maximum(first - 1, 0)], second)
            both = np.where(second > 0, first + second, 0)
            best = int(both.argmax())
            if both[best] > small:
                pair = sorted((int(first[best]), int(second[best])), reverse=True)
                for k in pair:
                    stock.take(k, 1)
                    held[k] = held.get(k, 0) + 1
                chosen.pop()
                stock.take(small, -1)
                chosen = sorted(chosen + pair, reverse=True)
    return chosen, held


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths, number of sequences filled so): best two fit over a histogram
    of lengths, which gives the sequences that filling them one by one gives. A
    pattern repeats as long as every length that its search held is there."""
    stock, out = _Stock(histogram, capacity), []
    while stock.sizes:
        chosen, held = fill_one(stock, capacity)
        uses = {k: chosen.count(k) for k in set(chosen)}
        more = min((int(stock.left[k]) + uses.get(k, 0) - n) // uses[k] for k, n in held.items() if uses.get(k))
        # a length that was held but not used limits nothing as long as it is there
        if any(k not in uses and stock.left[k] < n for k, n in held.items()):
            more = 0
        more = max(more, 0)
        if more:
            for k, n in uses.items():
                stock.take(k, n * more)
        out.append((chosen, more + 1))
    return out


def lookup(patterns: list[tuple[list[int], int]], histogram: dict[int, int]) -> dict[str, np.ndarray]:
    """The plan by piece number, pieces in the order of their lengths, longest
    first: entry e serves the numbers from ``first[e]``; of these the q-th goes
    to sequence ``base + q // uses`` at ``offset + (q % uses) * length``."""
    at, cursor = 0, {}
    for k in sorted(histogram, reverse=True):
        cursor[k] = at
        at += histogram[k]
    rows, base = [], 0
    for chosen, n in patterns:
        offset = 0
        for k in sorted(set(chosen), reverse=True):
            uses = chosen.count(k)
            rows.append((cursor[k], base, uses, offset, k))
            cursor[k] += uses * n
            offset += uses * k
        base += n
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("first", "base", "uses", "offset", "length"), a.T.copy(), strict=True))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of each
    piece (and its ``ids``): sequences are numbered from 0 and filled gapless
    from offset 0.

    A document is the ids of its whole text and the end id; one longer than
    ``capacity`` is cut into pieces of that length, the last may be shorter. A
    null or empty text is the end id alone. Repeated rows are documents each, a
    null id is kept. Other columns are not read. An empty table gives an empty
    result. The same rows give the same sequences in any order.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut_up = pieces(src, ["doc_id"], "text", tokenizer, capacity, end_id, with_ids)
    cut_up = materialize(cut_up.withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["count"] for r in cut_up.groupBy("length").count().collect()}
    table = lookup(plan(histogram, capacity), histogram)
    narrow = cut_up.drop("ids") if with_ids else cut_up
    placed = numbered(narrow, [F.col("length").desc(), F.col("doc_id").asc_nulls_last(), F.col("piece").asc(),
                               F.col("ids_crc32").asc(), F.col("row").asc()], "number")
    schema = placed.drop("number").schema.add("sequence_id", "long").add("offset", "long")
    last = placed.columns.index("number")

    def run(batches):
        for b in batches:
            n = b.column(last).to_numpy()
            e = np.searchsorted(table["first"], n, side="right") - 1
            q = n - table["first"][e]
            uses = table["uses"][e]
            cols = [b.column(c) for c in range(b.num_columns) if c != last]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(table["base"][e] + q // uses), pa.array(
                table["offset"][e] + (q % uses) * table["length"][e])], names=schema.fieldNames())
    placed = placed.mapInArrow(run, schema)
    if with_ids:
        placed = placed.join(cut_up.select("row", "ids"), "row")
    return placed.drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: the packed sequences themselves,
    with the place at which each of their documents starts. ``packed``: the
    result of ``pack(..., with_ids=True)``. A sequence has at most ``capacity``
    tokens, so a group is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))

    def run(batches):
        for b in batches:
            lists = b.column(1)
            at = lists.offsets
            raw = lists.values.field(2)
            ids, ends = [], [0]
            for x in raw:
                ids.append(np.frombuffer(x.as_buffer(), "<u4"))
                ends.append(ends[-1] + len(ids[-1]))
            flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
            tokens = pa.ListArray.from_arrays(pa.array(np.array(ends)[at.to_numpy()], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([b.column(0), tokens, pa.ListArray.from_arrays(at, lists.values.field(1)),
                                              pa.ListArray.from_arrays(at, lists.values.field(0))],
                                             names=["sequence_id", "ids", "doc_ids", "starts"])
    return rows.mapInArrow(run, "sequence_id long, ids array<int>, doc_ids array<long>, starts array<long>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
