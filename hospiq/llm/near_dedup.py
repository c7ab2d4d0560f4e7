"""Operator 9: near-duplicates by MinHash bands, odd sketches and full sets.

1. Every document becomes the set of its distinct word shingles. Documents
   with equal sets meet in one representative.
2. A representative's MinHash samples are cut into bands (equal bands make
   candidates) and folded into an odd sketch: each sample flips one bit of a
   bitmap, so the bits that differ between two sketches estimate high
   similarities closely. Pairs whose sketches differ too much are dropped.
3. What is left is confirmed on the full sets, and links make components.

All pairs of a bucket are never written out. First each representative meets
the smallest one of its buckets, the likeliest first; after that only members
of *different* components of a bucket are compared, in blocks of bounded size,
those outside a bucket's main component against all. A block holds the full
sets: an index of rare shingles and the sketches leave out what cannot be
similar, the rest is confirmed on the spot, and only links that join two
components of the block leave it, fewer than it has members. So no link
between documents that share a bucket is lost, and a hot bucket is split over
tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytetext import SMALL_BLOCK, blocks, buffers, mix, shingle_sets
from .common import bound_batches, fresh_names, materialize, read_table

SHINGLE = 2             # words
PERCENT = 80            # similarity to link, of 100
BANDS, ROWS = 32, 4     # a pair at 0.8 misses all bands once in 2e7
SAMPLES = 256           # MinHash samples; the first BANDS * ROWS make the bands
BITS = 1024             # of an odd sketch
SALT = 500              # pairs of one hub that are confirmed in one task
BLOCK = 1024            # members of a hot bucket compared in one task
BLOCK_SHINGLES = 1 << 19    # shingles of these members, unless one has more

_RNG = np.random.default_rng(99)
_XOR = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_FOLD = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_TURN = _RNG.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)


def most_apart(percent: int = PERCENT, samples: int = SAMPLES, bits: int = BITS, deviations: float = 4.5) -> int:
    """Differing sketch bits that a pair at the threshold reaches next to never:
    the expected number and ``deviations`` standard deviations (of the samples
    that differ, and of their places in the bitmap)."""
    q = 1 - percent / 100
    fill = np.exp(-4 * samples * q / bits)
    mean = bits / 2 * (1 - fill)
    spread = np.sqrt((2 * fill) ** 2 * samples * q * (1 - q) + bits / 4 * (1 - fill ** 2))
    return int(mean + deviations * spread)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), SAMPLES), np.uint32)
    for k, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(x), 4096):
            low = ((x[a:a + 4096, None] ^ _XOR) * _MUL).min(axis=0)
            out[k] = low if a == 0 else np.minimum(out[k], low)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    w = sig[:, : BANDS * ROWS].astype(np.uint64).reshape(len(sig), BANDS, ROWS)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(sig), BANDS))
    for r in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[:, :, r])
    return h.view(np.int64)


def odd_sketches(sig: np.ndarray) -> np.ndarray:
    place = ((sig * _FOLD + _TURN) >> np.uint32(32 - BITS.bit_length() + 1)).astype(np.int64)
    flat = (place + BITS * np.arange(len(sig))[:, None]).ravel()
    odd = (np.bincount(flat, minlength=BITS * len(sig)) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sig), BITS), axis=1).view(np.int64)


def fixed_lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1]), pa.int32()), pa.array(a.ravel()))


SET_ROWS = "id long, key binary, n long, set_id binary, bands array<long>, sketch array<long>"


def set_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """``docs``: id, key, text. One row a document: size and digest of its set, its
    band keys and its sketch (both empty for an empty set)."""
    def run(batches):
        for b in batches:
            data, o = buffers(b.column(2))
            for i, j in blocks(o, SMALL_BLOCK):
                sets = shingle_sets(data[o[i]:o[j]], o[i:j + 1] - o[i], shingle)
                sig = signatures(sets)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    fixed_lists(band_keys(sig)), fixed_lists(odd_sketches(sig))], names=["id", "key", "n", "set_id", "bands", "sketch"])
    return docs.mapInArrow(run, SET_ROWS)


def apart(a: Column, b: Column) -> Column:
    """Number of differing bits of two sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def alike_sizes(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _groups(batches, n_keys: int):
    """Groups of equal leading columns from sorted Arrow batches, as lists of
    batch slices; a group is handed on when it is complete."""
    key, held = None, []
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)]
        if not len(b):
            continue
        change = np.zeros(len(b), bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), len(b)]
        for a, e in zip(edges, edges[1:], strict=False):
            k = tuple(c[a] for c in cols)
            if k != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = k
            held.append(b.slice(a, e - a))
    if held:
        yield pa.Table.from_batches(held)


SETS = "id long, n long, shingles binary"


def full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``texts`` (id, text) as sorted shingle sets of 64-bit numbers."""
    def run(batches):
        for b in batches:
            data, o = buffers(b.column(1))
            for i, j in blocks(o, SMALL_BLOCK):
                sets = shingle_sets(data[o[i]:o[j]], o[i:j + 1] - o[i], shingle)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "n", "shingles"])
    return texts.mapInArrow(run, SETS)


def flat_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all shingles, borders) of a column of sets, without copying."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset:]
    return np.frombuffer(data, np.uint64, int(o[-1]) // 8) if o[-1] else np.zeros(0, np.uint64), o // 8


def alike(one: np.ndarray, flat: np.ndarray, start: np.ndarray, end: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets flat[start:end] are similar enough to ``one``."""
    n = end - start
    at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    x = flat[at]
    place = np.minimum(np.searchsorted(one, x), len(one) - 1)
    both = np.add.reduceat(one[place] == x, np.cumsum(n) - n)
    return 100 * both >= percent * (len(one) + n - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``sets``: as
    ``full_sets`` gives them. Pairs are dealt by b, the hub; one with many
    pairs is salted, and its set goes to each salt once."""
    salts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT).alias("salts"))
    member = (pairs.join(salts, "b").join(sets, F.col("a") == F.col("id"))
              .select("b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), F.lit(1).alias("role"), "a", "shingles"))
    hub = (salts.join(sets, F.col("b") == F.col("id"))
           .select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                   F.lit(0).alias("role"), F.col("b").alias("a"), "shingles"))
    dealt = member.unionByName(hub).repartition("b", "salt").sortWithinPartitions("b", "salt", "role")

    def run(batches):
        at, hub = None, None
        for batch in batches:
            flat, o = flat_sets(batch.column(4))
            b, salt, role, a = (batch.column(k).to_numpy() for k in range(4))
            new = np.ones(len(b), bool)
            new[1:] = (b[1:] != b[:-1]) | (salt[1:] != salt[:-1])
            edges = [*np.flatnonzero(new).tolist(), len(b)]
            for i, e in zip(edges, edges[1:], strict=False):
                if role[i] == 0:
                    at, hub = (b[i], salt[i]), flat[o[i]:o[i + 1]].copy()
                    i += 1
                if i < e and (b[i], salt[i]) == at:
                    ok = np.flatnonzero(alike(hub, flat, o[i:e], o[i + 1:e + 1], percent))
                    if len(ok):
                        yield pa.RecordBatch.from_arrays([pa.array(a[i + ok]), pa.array(b[i + ok])], names=["a", "b"])
    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """``node, comp``: the smallest node that links (a, b) reach, for every
    node of a link. Alternating large and small stars; each round is written
    to the shared folder. Cut off after some ``rounds``, nodes of one component
    may still carry different labels, never nodes of different ones the same:
    enough where labels only save comparisons."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark, done = materialize(edges, "edges"), None, 0
    while rounds is None or done < rounds:
        done += 1
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = materialize(small, "edges")
        if done == rounds:
            break
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark or not new[0]:
            break
        mark = new
    out = edges.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("node"), "comp")
    return out.unionByName(out.select(F.col("comp").alias("node"), "comp")).groupBy("node").agg(F.min("comp").alias("comp"))


def _with_comp(df: DataFrame, comps: DataFrame, column: str, name: str) -> DataFrame:
    c = comps.select(F.col("node").alias("__n"), F.col("comp").alias("__c"))
    return df.join(c, F.col(column) == F.col("__n"), "left").withColumn(name, F.coalesce("__c", column)).drop("__n", "__c")


def prefix_lists(flat: np.ndarray, o: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, owners) of the prefixes of some sets. With the shingles of all
    sets in one order, the rarest first, two sets at the similarity share one
    of the first n - ceil(n * percent / 100) + 1 of each: a pair that shares
    none of these needs no comparison."""
    n = np.diff(o)
    owner = np.repeat(np.arange(len(n)), n)
    _, token, often = np.unique(flat[o[0]:o[-1]], return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    token = rank[token]
    token = token[np.lexsort((token, owner))]
    place = np.arange(len(token)) - np.repeat(o[:-1] - o[0], n)
    first = place < np.repeat(n - -(-n * percent // 100) + 1, n)
    return token[first], owner[first]


class _Labels:
    """Union-find over the component labels of one block."""

    def __init__(self, labels: np.ndarray):
        self.root = {int(x): int(x) for x in np.unique(labels)}

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = x = self.root[self.root[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.root[max(x, y)] = min(x, y)
        return x != y


def block_links(g: pa.Table, percent: int, limit: int) -> list[tuple[int, int]]:
    """Links of one block that join two component labels: fewer than it has
    members. A pair is compared in the first bucket that it shares."""
    g = g.combine_chunks()
    key = g.column(0)[0].as_py()
    role, ids, n, comp = (g.column(k).to_numpy() for k in (3, 4, 5, 6))
    bands = g.column(7).chunk(0).flatten().to_numpy().reshape(len(ids), BANDS)
    # unsigned: of a negative number bitwise_count counts the bits of its absolute value
    sketch = g.column(8).chunk(0).flatten().to_numpy().view(np.uint64).reshape(len(ids), BITS // 64)
    flat, o = flat_sets(g.column(9).chunk(0))
    token, owner = prefix_lists(flat, o, percent)
    listed = owner[np.lexsort((owner, token))]
    listed_token = np.sort(token)
    own_end = np.searchsorted(owner, np.arange(len(ids) + 1))
    labels, out = _Labels(comp), []
    member = role == 1
    for x in np.flatnonzero(role == 0):
        mine = token[own_end[x]:own_end[x + 1]]
        lo, hi = np.searchsorted(listed_token, mine), np.searchsorted(listed_token, mine, side="right")
        y = np.unique(np.concatenate([listed[p:q] for p, q in zip(lo.tolist(), hi.tolist(), strict=True)]))
        y = y[member[y] & (comp[y] != comp[x])]
        y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent]
        y = y[np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1) <= limit]
        if len(out):
            top = labels.find(int(comp[x]))
            y = y[[labels.find(c) != top for c in comp[y].tolist()]] if len(y) else y
        if not len(y):
            continue
        y = y[bands[x][(bands[y] == bands[x]).argmax(axis=1)] == key]
        if len(y):
            y = y[alike(flat[o[x]:o[x + 1]], flat, o[y], o[y + 1], percent)]
            out += [(int(ids[k]), int(ids[x])) for k in y.tolist() if labels.join(int(comp[k]), int(comp[x]))]
    return out


def cross_links(buckets: DataFrame, reps: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one bucket but different components.
    ``buckets``: key, id, n. Members outside the bucket's main component meet
    all others in blocks of bounded size, which hold the full sets, so only
    links leave a block."""
    rows = _with_comp(buckets, comps, "id", "comp")
    by_comp = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))

    def in_blocks(members, shingles):
        return F.ceil(F.greatest(members / BLOCK, shingles / BLOCK_SHINGLES))
    # the main component of a bucket: the largest, then the smallest id
    stats = (by_comp.groupBy("key").agg(F.sum("c").alias("size"), F.sum("s").alias("shingles"), F.count(F.lit(1)).alias("parts"),
                                        F.max(F.struct("c", -F.col("comp"), "s")).alias("top"))
             .filter("parts > 1 AND size > 2")
             .select("key", (-F.col("top.col2")).alias("main"), in_blocks(F.col("size"), F.col("shingles")).alias("member_blocks"),
                     in_blocks(F.col("size") - F.col("top.c"), F.col("shingles") - F.col("top.s")).alias("out_blocks")))
    rows = (rows.join(stats, "key").join(reps.select("id", "bands", "sketch"), "id")
            .join(sets.select("id", "shingles"), "id"))
    h = F.xxhash64("id", F.lit(4))

    def up_to(c):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    cols = ["key", "mb", "ob", "role", "id", "n", "comp", "bands", "sketch", "shingles"]
    members = rows.select("*", F.pmod(h, F.col("member_blocks")).alias("mb"), F.lit(1).alias("role"), up_to("out_blocks").alias("ob"))
    outer = (rows.filter("comp <> main")
             .select("*", F.pmod(h, F.col("out_blocks")).alias("ob"), F.lit(0).alias("role"), up_to("member_blocks").alias("mb")))
    dealt = members.select(*cols).unionByName(outer.select(*cols)).repartition("key", "mb", "ob").sortWithinPartitions("key", "mb", "ob")
    limit = most_apart(percent)

    def run(batches):
        for g in _groups(batches, 3):
            got = block_links(g, percent, limit)
            if got:
                a, b = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return dealt.mapInArrow(run, "a long, b long")


def _once(rows: DataFrame, expected: int) -> DataFrame:
    """``rows`` with one row for each id; there are more than ``expected`` only
    where the table repeats rows of one id and text."""
    return rows if rows.count() == expected else materialize(rows.dropDuplicates(["id"]), "once")


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _linked(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, one_per_id: bool) -> tuple[DataFrame, DataFrame]:
    """``rows`` (id, key, n, set_id ...) of every document and ``nodes``: for
    each set that is not empty its first row (id, key; null ids last) and of
    its component the first row (top_id, top_set). Links are between sets,
    whatever the ids; ``one_per_id`` links the sets of one id too."""
    bound_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = materialize(set_rows(src, shingle), "sets")
    full = rows.filter("n > 0")
    first = full.groupBy("set_id").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"))
    # a number for each set: 60 bits of a hash, and its place among the sets of equal bits
    high = first.select("set_id", "first.*", F.xxhash64("set_id").bitwiseAND(F.lit(-16)).alias("high"))
    place = F.row_number().over(Window.partitionBy("high").orderBy("set_id"))
    nodes = materialize(high.select("set_id", "no_id", "id", "key", (F.col("high") + place - 1).alias("node")), "nodes")
    rep = nodes.select(F.col("set_id").alias("r_set"), F.col("id").alias("r_id"), F.col("key").alias("r_key"), "node")
    reps = materialize(full.join(rep, (F.col("set_id") == F.col("r_set")) & F.col("id").eqNullSafe(F.col("r_id"))
                                 & (F.col("key") == F.col("r_key")))
                       .select(F.col("node").alias("id"), "n", "bands", "sketch"), "reps")
    reps = _once(reps, nodes.count())

    # buckets of two representatives or more
    keys = reps.select("id", "n", F.explode("bands").alias("key"))
    hubs = (keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
            .filter("hub <> last").select("key", "hub"))
    buckets = materialize(keys.join(hubs, "key"), "buckets")
    stars = buckets.filter("id <> hub").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("bands_shared"))
    a = reps.select(F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("sketch").alias("a_sketch"))
    b = reps.select(F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("sketch").alias("b_sketch"))
    stars = (stars.select(F.col("id").alias("a"), F.col("hub").alias("b")).join(a, "a").join(b, "b")
             .withColumn("far", apart(F.col("a_sketch"), F.col("b_sketch")))
             .filter((F.col("far") <= most_apart(percent)) & alike_sizes(F.col("a_n"), F.col("b_n"), percent))
             .groupBy("a", "b").agg(F.min("far").alias("far")))
    stars = materialize(stars, "stars")
    best = stars.groupBy("a").agg(F.min(F.struct("far", "b")).alias("x")).select("a", F.col("x.b").alias("b"))

    # the sets of all that may still be compared; other texts are never moved again
    active = rep.join(buckets.select(F.col("id").alias("node")).distinct(), "node", "left_semi")
    texts = src.join(active, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")))
    sets = materialize(full_sets(texts.select(F.col("node").alias("id"), "text"), shingle), "full")
    sets = _once(sets, buckets.select("id").distinct().count())
    links = materialize(confirmed(best, sets, percent), "links")
    comps = components(links, rounds=2)

    left = _with_comp(_with_comp(stars.select("a", "b"), comps, "a", "ca"), comps, "b", "cb").filter("ca <> cb").select("a", "b")
    more = materialize(confirmed(materialize(left.join(best, ["a", "b"], "left_anti"), "pairs"), sets, percent), "links")
    links = links.unionByName(more)
    if one_per_id:
        several = (full.filter("id IS NOT NULL").groupBy("id").agg(F.min("set_id").alias("x"), F.max("set_id").alias("y"))
                   .filter("x <> y").select("id", "x"))
        same_id = (full.join(several, "id").select("set_id", "x").distinct()
                   .join(nodes.select("set_id", F.col("node").alias("a")), "set_id")
                   .join(nodes.select(F.col("set_id").alias("x"), F.col("node").alias("b")), "x").select("a", "b"))
        links = links.unionByName(materialize(same_id, "links"))
    comps = components(links, rounds=2)

    last = materialize(cross_links(buckets.select("key", "id", "n"), reps, sets, comps, percent), "links")
    comps = components(links.unionByName(last))

    joined = nodes.join(comps, "node")
    tops = joined.groupBy("comp").agg(F.min(F.struct("no_id", "id", "set_id")).alias("top"))
    tops = joined.select("node", "comp").join(tops, "comp").select("node", "top")
    own = F.struct("no_id", "id", "set_id")
    nodes = nodes.join(tops, "node", "left").withColumn("top", F.coalesce("top", own))
    return rows, nodes.select("set_id", "id", "key", F.col("top.id").alias("top_id"), F.col("top.set_id").alias("top_set"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document.

    Documents link when 100 * common shingles >= percent * all shingles of the
    two. component_id is the smallest id reachable over links, itself included;
    kept marks that document. A-Z count as a-z. A text of fewer words than a
    shingle is one shingle, a null or empty one (or of separators only) has
    none and links with nothing. Rows that repeat id and set give one row; rows
    of one id with different texts are one document for links. Rows without an
    id are a document for each set; one whose component has no id has a null
    component_id, and one of them is kept. Other columns are not read. An empty
    table gives an empty result.
    """
    rows, nodes = _linked(docs, id_col, text_col, shingle, percent, one_per_id=True)
    # an empty text of an id that has others too belongs to their component
    empty = rows.filter("n = 0 AND id IS NOT NULL").select("id").distinct()
    other = (rows.filter("n > 0").join(empty, "id", "left_semi").groupBy("id").agg(F.min("set_id").alias("other"))
             .select(F.col("id").alias("o_id"), "other"))
    each = rows.groupBy("id", "set_id", "n").agg(F.lit(1).alias("one")).drop("one")
    each = each.join(other, (F.col("n") == 0) & (F.col("id") == F.col("o_id")), "left")
    each = each.withColumn("set", F.coalesce("other", "set_id")).drop("other", "o_id")
    f = nodes.select(F.col("set_id").alias("f_set"), "top_id", "top_set")
    out = each.join(f, F.col("set") == F.col("f_set"), "left")
    component = F.when(F.col("f_set").isNull(), F.col("id")).otherwise(F.col("top_id"))
    out = out.select("id", "n", "set", "top_set", component.alias("component_id"))
    kept = F.when(F.col("component_id").isNull(), F.coalesce(F.col("set") == F.col("top_set"), F.lit(True))).otherwise(
        F.col("id").isNotNull() & (F.col("id") == F.col("component_id")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(kept, F.lit(False)).alias("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one text of each group of near copies, that of the smallest
    id (null ids last), columns as given. Texts are linked, not ids: rows that
    share an id, or have none, are documents of their own. Texts without a word
    are kept; rows that repeat id and text stay together."""
    rows, nodes = _linked(docs, "doc_id", "text", SHINGLE, PERCENT, one_per_id=False)
    keep = nodes.filter("set_id = top_set").select("id", "key").unionByName(rows.filter("n = 0").select("id", "key"))
    k_id, k_key = fresh_names(docs, "keep_id", "keep_key")
    keep = keep.select(F.col("id").alias(k_id), F.col("key").alias(k_key))
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col(k_id)) & (text_key("text") == F.col(k_key)), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents"))


# the same links without hashing: all pairs that share a shingle, then closure
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
    ELSE [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] END) AS sh FROM w),
n AS (SELECT w.doc_id, count(s.sh) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
k AS (SELECT s.doc_id, s.sh, n.n FROM s JOIN n ON s.doc_id = n.doc_id),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM k a JOIN k b ON a.sh = b.sh AND a.doc_id <> b.doc_id
    AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, link.b FROM reach r JOIN link ON r.b = link.a)
SELECT n.doc_id, n.n AS n_shingles, min(reach.b) AS component_id, min(reach.b) = n.doc_id AS kept
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n
"""
