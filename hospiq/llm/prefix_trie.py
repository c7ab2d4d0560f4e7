"""Operator 11: the prefix trie of conversations, by a splitter skeleton.

1. A turn is a token of 20 bytes (16 of the SHA-256 of role and text, 4 for the
   text's code points); a conversation is the string of its tokens, its path.
   Texts do not move further than that. Equal paths meet in one row.
2. A sample of paths, cut to ``DEPTH`` turns, gives the splitters of range
   partitions. Only prefixes of splitters can be nodes of more than one range:
   their trie, the skeleton, is sent to all tasks (at most ``SHARDS * DEPTH``
   nodes, whatever the table's size).
3. Every range is read in path order with a stack of the open nodes. A node
   that closes is finished, unless it belongs to the skeleton: then the shard
   gives a partial aggregate.
4. Partial aggregates of the skeleton are reduced, and the own terms of
   skeleton nodes are added up along the skeleton.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table

TOKEN = 20              # bytes of a turn
DEPTH = 64              # turns of a splitter
SHARDS = 2048           # ranges, at most
SHARD_PATHS = 100_000   # different paths meant for a range
OVERSAMPLE = 16         # sampled paths for each range
ID_BLOCK = 4096         # ids of one path that are digested as one row
NO_ID = 1 << 63         # stands for a null id: after all others


def turn_tokens(turns: DataFrame, id_col: str, role_col: str, text_col: str) -> DataFrame:
    """``turns`` as conv_id, turn, token."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    chars = F.lpad(F.hex(F.char_length(text)), 8, "0")
    token = F.unhex(F.concat(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * TOKEN - 8), chars))
    return turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col("turn"), token.alias("token"))


def conversation_paths(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """``conv_id, path``: one row for each conversation, its tokens in the
    order of turn (null first), equal turns in that of their tokens. Sorted
    turns stream by, so a task holds one path, 20 bytes a turn."""
    src = conversations.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                               F.col(text_col).alias("text"))
    rows = turn_tokens(src, "conv_id", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "token")
    rows = rows.select("conv_id", "token")

    def pack(ids, paths):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], names=["conv_id", "path"])

    def run(batches):
        key, held, some = None, [], False
        for b in batches:
            ids = b.column(0).to_pylist()
            raw = b"".join(b.column(1).to_pylist())
            edges = [0, *(k for k in range(1, len(ids)) if ids[k] != ids[k - 1]), len(ids)]
            done_ids, done = [], []
            for a, e in zip(edges, edges[1:], strict=False):
                if a == e:
                    continue
                if some and ids[a] != key:
                    done_ids.append(key)
                    done.append(b"".join(held))
                    held = []
                key, some = ids[a], True
                held.append(raw[TOKEN * a:TOKEN * e])
            if done:
                yield pack(done_ids, done)
        if some:
            yield pack([key], [b"".join(held)])
    return rows.mapInArrow(run, "conv_id long, path binary")


def member_paths(paths: DataFrame) -> DataFrame:
    """``path, n, conv_id, ends``: each different path, its conversations, the
    smallest of them and the digest of their ids in order. Ids of one path are
    sorted and joined in many tasks; only blocks of them meet in one."""
    none = F.col("conv_id").isNull()
    order = ["path", none, "conv_id"]
    dealt = paths.select("path", "conv_id").repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(rows):
        p, first, n, ids = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.binary()), pa.array(first, pa.int64()), pa.array(n, pa.int64()),
                                           pa.array(ids, pa.binary())], names=["path", "conv_id", "n", "ids"])

    def blocks(batches):
        path, held, out = None, [], []
        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if held and (p != path or len(held) == ID_BLOCK):
                    out.append((path, held[0], len(held), ",".join("null" if x is None else str(x) for x in held).encode()))
                    held = []
                    if len(out) == 1000:
                        yield pack(out)
                        out = []
                path = p
                held.append(c)
        if held:
            out.append((path, held[0], len(held), ",".join("null" if x is None else str(x) for x in held).encode()))
        if out:
            yield pack(out)
    found = dealt.mapInArrow(blocks, "path binary, conv_id long, n long, ids binary")
    found = found.repartition("path").sortWithinPartitions(*order)

    def finish(rows):
        p, n, first, ends = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.binary()), pa.array(n, pa.int64()), pa.array(first, pa.int64()),
                                           pa.array(ends)], names=["path", "n", "conv_id", "ends"])

    def digests(batches):
        path, n, first, sha, out = None, 0, None, None, []
        for b in batches:
            for p, c, k, ids in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if sha is not None and p == path:
                    sha.update(b"," + ids)
                    n += k
                    continue
                if sha is not None:
                    out.append((path, n, first, sha.hexdigest()))
                    if len(out) == 1000:
                        yield finish(out)
                        out = []
                path, n, first, sha = p, k, c, hashlib.sha256(ids)
        if sha is not None:
            yield finish([*out, (path, n, first, sha.hexdigest())])
    return found.mapInArrow(digests, "path binary, n long, conv_id long, ends string")


def splitters(paths: DataFrame, shards: int, depth: int = DEPTH) -> list[bytes]:
    """Borders of about ``shards`` ranges of ``paths`` (different paths), from
    a sample by hash: about ``OVERSAMPLE`` paths a range, ``depth`` turns each."""
    n = paths.count()
    share = min(1.0, OVERSAMPLE * shards / max(n, 1))
    picked = F.pmod(F.xxhash64("path", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = sorted(bytes(r[0]) for r in paths.filter(picked).select(F.substring("path", 1, TOKEN * depth)).collect())
    return sorted({sample[len(sample) * k // shards] for k in range(1, shards)} - {b""}) if sample else []


class Skeleton:
    """The trie of the splitters: node 0 is the root; ``number`` finds a child
    by its parent and token."""

    def __init__(self, borders: list[bytes]):
        self.number: dict[tuple[int, bytes], int] = {}
        self.parent, self.token = [-1], [b""]
        for s in borders:
            at = 0
            for i in range(0, len(s), TOKEN):
                key = (at, s[i:i + TOKEN])
                if key not in self.number:
                    self.number[key] = len(self.parent)
                    self.parent.append(at)
                    self.token.append(key[1])
                at = self.number[key]

    def above(self, node: int) -> list[int]:
        """The node and those above it."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out


# a finished node, or with skeleton >= 0 a shard's share of a skeleton node;
# above: the skeleton parent whose conv_id is still open, or all skeleton nodes upwards
NODES = ("skeleton int, depth long, conv_id long, parent_conv_id long, above array<int>, chars long, n_convs long, "
         "n_children long, n_leaves long, saved long, ends string")
_EMPTY = hashlib.sha256(b"").hexdigest()


class _Node:
    __slots__ = ("chars", "children", "ends", "leaves", "low", "n", "saved", "skeleton", "waiting")

    def __init__(self, skeleton: int, chars: int):
        self.skeleton, self.chars, self.low, self.ends = skeleton, chars, NO_ID + 1, None
        self.n = self.children = self.leaves = self.saved = 0
        self.waiting = []       # closed children; they wait for this node's smallest member


def _id(c: int):
    return c if c < NO_ID else None


class ShardReader:
    """Reads the sorted paths of one range; ``out`` gathers its nodes."""

    def __init__(self, skeleton: Skeleton):
        self.sk, self.out = skeleton, []
        self.path, self.open = b"", [_Node(0, 0)]

    def _close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        if node.skeleton < 0:
            if not node.children:
                node.leaves = 1
            node.saved += (node.n - 1) * node.chars
            for row in node.waiting:
                self.out.append((*row[:3], _id(node.low), *row[4:]))
        else:
            for row in node.waiting:        # its smallest member may be in another range
                self.out.append((*row[:4], [node.skeleton], *row[5:]))
            if node.n:
                self.out.append((node.skeleton, depth, _id(node.low), None, self.sk.above(node.skeleton), node.chars, node.n,
                                 node.children, node.leaves, node.saved, node.ends))
        if not self.open:
            return
        up = self.open[-1]
        up.n += node.n
        up.low = min(up.low, node.low)
        up.leaves += node.leaves
        up.saved += node.saved
        if node.skeleton < 0:
            up.children += 1
            up.waiting.append((None, depth, _id(node.low), None, None, node.chars, node.n, node.children, node.leaves, node.saved,
                               node.ends or _EMPTY))

    def add(self, path: bytes, n: int, low, ends: str) -> None:
        common, most = 0, min(len(path), len(self.path))
        while common < most and path[common:common + TOKEN] == self.path[common:common + TOKEN]:
            common += TOKEN
        while (len(self.open) - 1) * TOKEN > common:
            self._close()
        for i in range(common, len(path), TOKEN):
            token, up = path[i:i + TOKEN], self.open[-1].skeleton
            known = self.sk.number.get((up, token), -1) if up >= 0 else -1
            self.open.append(_Node(known, int.from_bytes(token[-4:], "big")))
        node = self.open[-1]
        node.n += n
        node.low = min(node.low, NO_ID if low is None else low)
        node.ends = ends
        self.path = path

    def finish(self) -> None:
        while self.open:
            self._close()


def _pack(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), *[pa.int64()] * 5, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=[x.split()[0] for x in NODES.split(", ")])


def shard_nodes(members: DataFrame, borders: list[bytes]) -> DataFrame:
    """The nodes of every range and its shares of skeleton nodes."""
    skeleton = Skeleton(borders)

    def deal(batches):
        for b in batches:
            at = [bisect_right(borders, p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *b.columns], names=["shard", *b.schema.names])

    def run(batches):
        shard, reader = None, None
        for b in batches:
            for s, p, n, c, ends in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if s != shard:
                    if reader is not None:
                        reader.finish()
                        yield _pack(reader.out)
                    shard, reader = s, ShardReader(skeleton)
                reader.add(p, n, c, ends)
                if len(reader.out) > 5000:
                    yield _pack(reader.out)
                    reader.out = []
        if reader is not None:
            reader.finish()
            yield _pack(reader.out)
    dealt = members.mapInArrow(deal, "shard int, path binary, n long, conv_id long, ends string")
    return dealt.repartition("shard").sortWithinPartitions("shard", "path").mapInArrow(run, NODES)


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, path as
    ``conversation_paths`` gives them): ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A conversation may have an empty path: it ends at the root. A null conv_id
    comes after all others: it is a node's conv_id only where no other member
    is, and counts as ``null`` among the ids of a digest. Rows that repeat an
    id and path count each. Paths of any length and groups of any size are
    read whole; an empty table gives no node. ``shards`` is the number of
    ranges, by default that of shuffle partitions, more for large tables.
    """
    spark = paths.sparkSession
    members = materialize(member_paths(paths), "members")
    if shards is None:
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-members.count() // SHARD_PATHS))
    nodes = materialize(shard_nodes(members, splitters(members, min(shards, SHARDS))), "nodes")

    part = nodes.filter("skeleton IS NOT NULL").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"), F.max("above").alias("above"),
        *(F.max(c).alias(c) for c in ("depth", "chars")), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")))
    part = materialize(part, "skeleton")
    up = F.get("above", F.lit(1))       # the skeleton node above; null for the root
    below = part.filter("depth > 0").groupBy(up.alias("k_node")).agg(F.count(F.lit(1)).alias("k_children"))
    own = part.join(F.broadcast(below), F.col("skeleton") == F.col("k_node"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("k_children", F.lit(0))).drop("k_node", "k_children")
    own = own.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("chars"))
    sums = own.select(F.explode("above").alias("s_node"), "leaf", "own").groupBy("s_node").agg(
        F.sum("leaf").alias("s_leaves"), F.sum("own").alias("s_own"))
    # the skeleton's size is bounded, so its small tables may be broadcast
    high = part.select(F.col("skeleton").alias("p_node"), F.col("conv_id").alias("p_conv"))
    top = (own.join(F.broadcast(sums), F.col("skeleton") == F.col("s_node"))
           .join(F.broadcast(high), F.get("above", F.lit(1)) == F.col("p_node"), "left")
           .select("conv_id", "depth", F.col("p_conv").alias("parent_conv_id"), "n_convs", "n_children",
                   (F.col("n_leaves") + F.col("s_leaves")).alias("n_leaves"),
                   (F.col("saved") + F.col("s_own")).alias("saved_tokens"), F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256")))
    low = (nodes.filter("skeleton IS NULL").join(F.broadcast(high), F.col("above")[0] == F.col("p_node"), "left")
           .select("conv_id", "depth", F.coalesce("p_conv", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
                   "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")))
    return low.unionByName(top)


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """The contract's conversations: the first h turns of conversation
    c - c % 100 and c's own turns after its first h, h = crc32(c) % 6. A null
    conv_id has h = 0."""
    paths = materialize(conversation_paths(conversations), "paths")
    h = F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6, F.lit(0)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = paths.filter(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("h_conv"), F.substring("path", 1, 5 * TOKEN).alias("head"))
    both = paths.withColumn("h", h).join(heads, base == F.col("h_conv"), "left")
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), F.col("h") * TOKEN)
    tail = F.substring("path", F.col("h") * TOKEN + 1, F.greatest(F.length("path"), F.lit(1)))
    return both.select("conv_id", F.concat(head, tail).alias("path"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = materialize(rebuilt_paths(read_table(spark, sf_dir, "conversations")), "rebuilt")
    return prefix_trie(rebuilt)


SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
step AS (SELECT i, c FROM bits WHERE k = 8),
crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS pos, CAST(4294967295 AS BIGINT) AS c
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT crc.conv_id, crc.s, crc.pos + 1, xor(crc.c >> 8, step.c) FROM crc JOIN step
    ON step.i = xor(crc.c, ascii(substr(crc.s, crc.pos + 1, 1))) & 255 WHERE crc.pos < length(crc.s)),
head AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h FROM crc WHERE pos = length(s)),
own AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars,
         length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS turn_text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(coalesce(role, '')) || ':'
           || coalesce(role, '') || coalesce(text, '')), 1, 32), length(coalesce(text, ''))) AS pos
  FROM conversations),
ids AS (SELECT DISTINCT c.conv_id, coalesce(h, 0) AS h FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN head USING (conv_id)),
rebuilt AS (
  SELECT i.conv_id, o.pos, o.chars, o.turn_text FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 100 AND o.pos <= i.h
  UNION ALL
  SELECT i.conv_id, o.pos, o.chars, o.turn_text FROM ids i JOIN own o ON o.conv_id IS NOT DISTINCT FROM i.conv_id AND o.pos > i.h),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, chars, sha256(string_agg(length(turn_text) || ':' || turn_text, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
longest AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT p.depth, p.node, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(p.chars) AS chars,
         sha256(coalesce(string_agg(coalesce(CAST(p.conv_id AS VARCHAR), 'null'), ',' ORDER BY p.conv_id NULLS LAST)
                         FILTER (WHERE p.depth = l.depth), '')) AS ends_sha256
  FROM prefixes p JOIN longest l ON l.conv_id IS NOT DISTINCT FROM p.conv_id GROUP BY p.depth, p.node),
parents AS (
  SELECT n.depth, n.node, q.node AS parent FROM nodes n JOIN prefixes q
    ON q.conv_id IS NOT DISTINCT FROM n.conv_id AND q.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM parents GROUP BY 1, 2),
flat AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (depth, node)),
subtree AS (
  SELECT q.depth, q.node, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved
  FROM flat f JOIN prefixes q ON q.conv_id IS NOT DISTINCT FROM f.conv_id AND q.depth <= f.depth GROUP BY q.depth, q.node)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM flat f JOIN subtree s USING (depth, node) LEFT JOIN parents p USING (depth, node)
LEFT JOIN nodes up ON up.depth = f.depth - 1 AND up.node = p.parent
"""
