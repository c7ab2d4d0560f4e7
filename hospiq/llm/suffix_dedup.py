"""Operator 8: long repeats from a logarithmic family of suffix arrays.

A suffix array of all positions would be many times the text. It is enough to
keep sampled suffixes: in every window of ``length`` bytes the K-byte gram with
the smallest hash is the anchor (the leftmost of equals), so equal windows have
their anchors at the same place. Neighbouring windows share an anchor; such a
run of windows is one entry: ``key`` (hash of the gram, under which suffixes
are ordered), ``cid`` (hash of all bytes of its windows and the anchor's place
in them), document and position.

* A batch's entries, ordered by key and merged where equal, are its suffix
  array. It is merge-scanned against the levels that exist, which gives the
  keys that repeat; equal-sized levels merge into one of the next size, so an
  entry is rewritten a logarithmic number of times.
* An entry whose ``cid`` occurs twice repeats as a whole. Only where one key
  has several contents, the bytes themselves are fetched (once per content) and
  every window is compared with the others of its key. A key with very many
  contents is compared window by window in an aggregation over all tasks.

Every window that occurs twice is found; positions are bytes of the input.

``remove_repeats`` adds a table in a few batches and forgets the family.
``SuffixIndex`` keeps it in a shared folder: later sessions add their batches,
only the levels that grow are rewritten, and the spans are those of one run
over all texts added.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import CommitConflict, VersionedTable
from .bytetext import BLOCK, Rolling, blocks, buffers, mix
from .common import materialize, read_table

LENGTH = 400            # bytes of a repeat
GRAM = 64               # bytes of an anchor
BATCHES = 4             # batches in which a table is added
HOT = 50_000            # contents of one key above which windows are aggregated by all tasks
NO_ID = (1 << 63) - 1
_U = np.uint64


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    total = len(x) - width + 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:total], x[width - size: width - size + total])


def sampled(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first window, windows, anchor's place, key, cid) of the entries of
    a block, the first window relative to the row."""
    out = []
    n, step = len(data), 2 * BLOCK
    for a in range(0, max(n - length + 1, 0), step):        # one step, but for a huge text
        piece = data[a:a + step + length - 1]
        roll = Rolling(piece)
        g = roll.grams(gram)
        rank = (g >> _U(32) << _U(32)) | np.arange(len(g), dtype=_U)
        anchor = (_sliding_min(rank, length - gram + 1) & _U(0xFFFFFFFF)).astype(np.int64)
        edge = np.zeros(n + 2, np.int8) if a == 0 else edge     # windows that lie within one row
        if a == 0:
            whole = np.diff(offsets) >= length
            np.add.at(edge, offsets[:-1][whole], 1)
            np.add.at(edge, offsets[1:][whole] - length + 1, -1)
            inside = np.cumsum(edge, dtype=np.int8).astype(bool)
        at = np.flatnonzero(inside[a:a + len(anchor)])
        if not len(at):
            continue
        anc = anchor[at]
        new = np.ones(len(at), bool)
        new[1:] = (anc[1:] != anc[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        lo = at[first]
        width = np.diff(np.append(first, len(at)))
        place = anc[first] - lo
        cid = mix(roll.ranges(lo, lo + width + length - 1) + place.astype(_U) * _U(0x9E3779B97F4A7C15))
        row = np.searchsorted(offsets, lo + a, side="right") - 1
        out.append((row, lo + a - offsets[row], width, place, g[anc[first]], cid))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.view(_U), z.view(_U)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


ENTRIES = "id long, rk long, lo long, w int, d int, key long, cid long"


def entries(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``docs``: id, rk, text."""
    def run(batches):
        for b in batches:
            data, o = buffers(b.column(2))
            ids, rk = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, j in blocks(o):
                row, lo, w, d, key, cid = sampled(data[o[i]:o[j]], o[i:j + 1] - o[i], length, gram)
                cols = [ids[i + row], rk[i + row], lo, w.astype(np.int32), d.astype(np.int32), key.view(np.int64), cid.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in ENTRIES.split(", ")])
    return docs.mapInArrow(run, ENTRIES)


class LevelFamily:
    """Suffix arrays of doubling sizes: level k holds 2**k batches or nothing.
    A level is a Parquet table ``key, cid, n, rep`` in key order: how often a
    content occurs and the smallest row key that has it. ``write`` puts a table
    into a folder and returns it as read from there."""

    def __init__(self, levels: list[DataFrame | None] | None = None, shared: list[DataFrame] | None = None, write=materialize):
        self.levels, self.shared, self.put = levels or [], shared or [], write

    def _write(self, rows: DataFrame) -> DataFrame:
        merged = rows.repartition("key").groupBy("key", "cid").agg(F.sum("n").alias("n"), F.min("rep").alias("rep"))
        return self.put(merged.sortWithinPartitions("key", "cid"), "level")

    def add(self, batch: DataFrame) -> None:
        """``batch``: entries. Finds the keys it repeats, in itself or from
        earlier batches, and makes it part of the family."""
        # equal entries meet on the map side before they are dealt by key
        new = self._write(batch.groupBy("key", "cid").agg(F.count(F.lit(1)).alias("n"), F.min("rk").alias("rep")))
        self.shared.append(new.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key"))
        for level in self.levels:
            if level is not None:
                self.shared.append(new.select("key").join(level.select("key"), "key", "left_semi"))
        for k, level in enumerate(self.levels):
            if level is None:
                self.levels[k] = new
                return
            new, self.levels[k] = self._write(level.unionByName(new)), None
        self.levels.append(new)

    def repeated(self) -> DataFrame:
        """``key, cid, n, rep`` of all contents of keys that occur twice."""
        kept = [x for x in self.levels if x is not None]
        rows = kept[0]
        for x in kept[1:]:
            rows = rows.unionByName(x)
        if len(kept) > 1:
            rows = rows.groupBy("key", "cid").agg(F.sum("n").alias("n"), F.min("rep").alias("rep"))
        keys = self.shared[0]
        for x in self.shared[1:]:
            keys = keys.unionByName(x)
        return rows.join(keys.distinct(), "key", "left_semi")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed for the shuffle."""
    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for b in batches:
            z = [codec.compress(t.as_buffer(), asbytes=True) for t in b.column(2).cast(pa.binary())]
            size = [len(t.as_buffer()) for t in b.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(z, pa.binary())],
                                             names=["id", "rk", "size", "packed"])
    return docs.mapInArrow(run, "id long, rk long, size long, packed binary")


def _unpack(size: int, packed) -> bytes:
    return pa.Codec("zstd").decompress(packed, decompressed_size=size, asbytes=True) if size else b""


CONTENTS = "key long, cid long, d int, n long, id long, rk long, lo long, hot boolean, content binary"


def _contents(asked: DataFrame, packed: DataFrame, length: int) -> DataFrame:
    """The bytes of the asked entries, cut from their documents."""
    wanted = asked.groupBy("id", "rk").agg(F.collect_list(F.struct("key", "cid", "d", "n", "lo", "w", "hot")).alias("asked"))

    def run(batches):
        for b in batches:
            out = []
            for i, rk, size, z, many in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                text = _unpack(size, z)
                out += [(a["key"], a["cid"], a["d"], a["n"], i, rk, a["lo"], a["hot"], text[a["lo"]:a["lo"] + a["w"] + length - 1])
                        for a in many]
                if len(out) > 5000:
                    yield _batch(out, CONTENTS)
                    out = []
            if out:
                yield _batch(out, CONTENTS)
    rows = packed.join(wanted, ["id", "rk"]).select("id", "rk", "size", "packed", "asked")
    return rows.mapInArrow(run, CONTENTS)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    fields = [x.split() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)],
                                      names=[n for n, _ in fields])


def _windows(t: pa.Table, length: int):
    """Per window of the contents: (row of the table, place in it, hash of its
    key, its offset from the anchor and its bytes)."""
    t = t.combine_chunks()
    col = t.column("content").chunk(0)
    sizes = np.array([len(x.as_buffer()) for x in col])
    data = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in col), np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    w = sizes - length + 1
    row = np.repeat(np.arange(len(w)), w)
    place = np.arange(len(row)) - np.repeat(np.cumsum(w) - w, w)
    p = start[row] + place
    key, d = t.column("key").to_numpy().view(_U), t.column("d").to_numpy().astype(np.int64)
    h = Rolling(data).ranges(p, p + length)
    return row, place, mix(h + mix(key)[row] + (place - d[row]).astype(_U) * _U(0x9E3779B97F4A7C15))


def _runs(row: np.ndarray, place: np.ndarray):
    """(row, first, last + 1) of the runs of consecutive places."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], place[first], place[last] + 1


SPANS = "id long, rk long, s long, e long"


def _spans_of(t: pa.Table, row, first, end, length: int) -> pa.RecordBatch:
    lo = t.column("lo").to_numpy()[row]
    return pa.RecordBatch.from_arrays([pa.array(t.column("id").to_numpy()[row]), pa.array(t.column("rk").to_numpy()[row]),
                                       pa.array(lo + first), pa.array(lo + end + length - 1)], names=["id", "rk", "s", "e"])


def _compared(contents: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the entries that occur once, as byte spans; all
    contents of a key meet in one task, in sorted order."""
    dealt = contents.drop("hot").repartition("key").sortWithinPartitions("key", "cid")

    def judge(t: pa.Table):
        key, cid = t.column("key").to_numpy(), t.column("cid").to_numpy()
        other = np.ones(len(key), bool)
        other[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])   # a content counts once
        t = t.filter(pa.array(other))
        row, place, h = _windows(t, length)
        n = t.column("n").to_numpy()
        _, inverse = np.unique(h, return_inverse=True)
        twice = (np.bincount(inverse, n[row])[inverse] > 1) & (n[row] == 1)
        if twice.any():
            yield _spans_of(t, *_runs(row[twice], place[twice]), length)

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            key = held.column("key").to_numpy()
            ends = np.flatnonzero(key[1:] != key[:-1]) + 1      # complete keys are judged, some thousand rows at a time
            done = 0
            while len(ends) and ends[-1] > done:
                far = ends[ends <= done + 4000]
                e = int(far[-1]) if len(far) and far[-1] > done else int(ends[ends > done][0])
                yield from judge(held.slice(done, e - done))
                done = e
            held = held.slice(done)
        if held is not None and held.num_rows:
            yield from judge(held)
    return dealt.mapInArrow(run, SPANS)


def _aggregated(contents: DataFrame, length: int) -> DataFrame:
    """The same for hot keys: windows are counted by an aggregation."""
    ddl = "h long, n long, id long, rk long, p long"

    def run(batches):
        for b in batches:
            for a in range(0, len(b), 2000):
                t = pa.Table.from_batches([b.slice(a, 2000)])
                row, place, h = _windows(t, length)
                cols = [h.view(np.int64), t.column("n").to_numpy()[row], t.column("id").to_numpy()[row],
                        t.column("rk").to_numpy()[row], t.column("lo").to_numpy()[row] + place]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in ddl.split(", ")])
    # one row for each content and row: equal contents of a hot key already met
    rows = contents.dropDuplicates(["key", "cid"]).mapInArrow(run, ddl)
    twice = rows.groupBy("h").agg(F.sum("n").alias("total")).filter("total > 1").select("h")
    return (rows.filter("n = 1").join(twice, "h", "left_semi")
            .select("id", "rk", F.col("p").alias("s"), (F.col("p") + length).alias("e")))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(spans: np.ndarray) -> list[tuple[int, int]]:
    """The union of (start, end) rows as maximal runs."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return list(zip(spans[first, 0].tolist(), reach[np.append(first[1:], len(spans)) - 1].tolist(), strict=True))


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """``id, rk, s, e``: byte spans (they may overlap) that together cover
    exactly the bytes of repeated windows. ``docs``: id, rk, text."""
    found = entries(docs, length, gram).withColumn("batch", F.pmod(F.xxhash64("id", "rk"), F.lit(batches)).cast("int"))
    found = materialize(found, "entries")
    family = LevelFamily()
    for k in range(batches):
        family.add(found.filter(F.col("batch") == k))
    return _spans(found.drop("batch"), family, _packed(docs), length, hot)


def _spans(found: DataFrame, family: LevelFamily, packed: DataFrame, length: int, hot: int) -> DataFrame:
    """The spans of the entries ``found``, all of which the family holds."""
    contents = materialize(family.repeated(), "repeated")
    open_keys = (contents.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.count_if(F.col("n") == 1).alias("single"))
                 .filter("c > 1 AND single > 0").select("key", (F.col("c") > hot).alias("hot")))
    status = found.join(contents, ["key", "cid"])
    whole = (F.col("lo") + F.col("w") + (length - 1)).alias("e")
    full = status.filter("n > 1").select("id", "rk", F.col("lo").alias("s"), whole)
    asked = status.filter("n = 1 OR rk = rep").join(open_keys, "key")
    got = materialize(_contents(asked, packed, length), "contents")
    return (full.unionByName(_compared(got.filter("NOT hot"), length))
            .unionByName(_aggregated(got.filter("hot"), length)))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.select("id", F.xxhash64("id", "text").alias("rk"), "text")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   batches: int = BATCHES, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    Each byte covered by a ``length``-byte string that also starts at another
    place of the table (the same text included) is removed; n_spans counts the
    maximal removed runs. A null or empty text has no bytes; one shorter than
    ``length`` loses nothing. Repeated rows are places of their own, so both
    lose their repeated bytes. A null id stays null. Other columns are not
    read; an empty table gives an empty result.
    """
    src = _source(docs, id_col, text_col)
    return _kept(_packed(src), repeat_spans(src, length, gram, batches, hot))


def _kept(packed: DataFrame, spans: DataFrame) -> DataFrame:
    """What is left of each text without its spans."""
    per = spans.groupBy("id", "rk").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    rows = packed.join(per, ["id", "rk"], "left").select("id", "size", "packed", "spans")

    def run(batches):
        for b in batches:
            col = b.column(3)
            bound = col.offsets.to_numpy() if len(b) else np.zeros(1, int)
            flat = col.values
            s, e = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            out = []
            for k, (i, size, z) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)):
                text = _unpack(size, z)
                cut = []
                if bound[k + 1] > bound[k]:
                    cut = _cut(np.column_stack([s[bound[k]:bound[k + 1]], e[bound[k]:bound[k + 1]]]))
                sha, at = hashlib.sha256(), 0
                for x, y in cut:
                    sha.update(text[at:x])
                    at = y
                sha.update(text[at:])
                out.append((None if i == NO_ID else i, size, sum(y - x for x, y in cut), len(cut), sha.hexdigest()))
            if out:
                yield _batch(out, RESULT)
    return rows.mapInArrow(run, RESULT)


LOG = "batch int, name string, kind string, slot int, path string, length int, gram int"


class SuffixIndex:
    """The family kept in a shared folder, to which any session adds batches.

    A batch's entries and packed texts are written once and stay; of the levels
    only those that merge are written anew. A log (a few rows a batch) names
    the folders of the last complete batch. The batch's number is taken when
    its rows are logged: of two sessions that add at once the second is told by
    ``CommitConflict`` and adds again; a session that dies leaves unlisted
    folders only. A batch whose name the log holds is skipped."""

    def __init__(self, spark: SparkSession, base: str, length: int = LENGTH, gram: int = GRAM):
        self.spark, self.base, self.length, self.gram = spark, base.rstrip("/"), length, gram
        self.log = VersionedTable(spark, f"{self.base}/log")

    def _listed(self) -> list:
        log = self.log.read()
        rows = [] if log is None else log.collect()
        if any((r.length, r.gram) != (self.length, self.gram) for r in rows):
            raise ValueError(f"{self.base} was made for repeats of other sizes")
        return rows

    def _read(self, rows: list, kind: str) -> DataFrame | None:
        paths = [r.path for r in rows if r.kind == kind]
        return self.spark.read.parquet(*paths) if paths else None

    def _family(self, rows: list, write=materialize) -> LevelFamily:
        last = max((r.batch for r in rows), default=0)
        at = {r.slot: r.path for r in rows if r.kind == "level" and r.batch == last}
        levels = [self.spark.read.parquet(at[k]) if k in at else None for k in range(max(at, default=-1) + 1)]
        shared = self._read(rows, "shared")
        return LevelFamily(levels, [] if shared is None else [shared], write)

    def add(self, docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> bool:
        """Add a batch of documents; False if a batch of this name is there."""
        rows = self._listed()
        if any(r.name == name for r in rows):
            return False
        number, paths = max((r.batch for r in rows), default=0) + 1, {}

        def write(df: DataFrame, kind: str) -> DataFrame:
            path = f"{self.base}/{kind}/{uuid.uuid4().hex}"
            df.write.parquet(path)
            out = self.spark.read.schema(df.schema).parquet(path)
            paths[id(out)] = path
            return out
        src = _source(docs, id_col, text_col)
        found, texts = write(entries(src, self.length, self.gram), "entries"), write(_packed(src), "texts")
        family = self._family(rows, write)
        old = {r.slot: r.path for r in rows if r.kind == "level" and r.batch == number - 1}
        before, known = list(family.levels), len(family.shared)
        family.add(found)
        keys = family.shared[known]
        for x in family.shared[known + 1:]:
            keys = keys.unionByName(x)
        keys = write(keys.distinct(), "shared")
        listed = [("entries", 0, paths[id(found)]), ("texts", 0, paths[id(texts)]), ("shared", 0, paths[id(keys)])]
        for k, level in enumerate(family.levels):
            if level is not None:
                kept = k < len(before) and level is before[k]
                listed.append(("level", k, old[k] if kept else paths[id(level)]))
        mine = [(number, name, *x, self.length, self.gram) for x in listed]
        self.log.append(self.spark.createDataFrame(mine, LOG), ("batch", number))
        if listed[0][2] not in {r.path for r in self._listed()}:
            raise CommitConflict(f"{self.base}: another batch {number} was first")
        return True

    def spans(self, hot: int = HOT) -> DataFrame | None:
        """As ``repeat_spans`` over all texts added; None before the first batch."""
        rows = self._listed()
        if not rows:
            return None
        return _spans(self._read(rows, "entries"), self._family(rows), self._read(rows, "texts"), self.length, hot)

    def remove_repeats(self, hot: int = HOT) -> DataFrame | None:
        """As the function of this name over all texts added."""
        spans = self.spans(hot)
        return None if spans is None else _kept(self._read(self._listed(), "texts"), spans)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
