"""Operator 2: benchmark decontamination.

Every item-sized window of a document (as many words as the item) is a
candidate. A window as similar as asked shares nearly all of its five-word
shingles with the item, so windows with too few shingles of any item are left
out first; that bound loses nothing. The rest get a SimHash, found from
prefix sums of the shingles' signs. Items are kept in a multi-index: the
fingerprint is cut into bytes, and each byte value leads to the items whose
byte is within a small radius, so that every item within RADIUS of a window is
found (pigeonhole). A fingerprint says little where one shingle counts many
times: windows or items with repeated shingles are candidates without it. The
candidates' exact weighted-shingle similarity decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytetext import SMALL_BLOCK, Rolling, shingles, words
from .common import bound_batches, fresh_names, materialize, read_table
from .maptext import map_text, texts_of

SHINGLE = 5             # words
SIMILARITY = 0.8        # sum of smaller over sum of larger shingle counts
RADIUS = 23             # bits of 64; a window at the similarity is 10 off on average, 3 being the deviation
HEAVY = 2               # repeated shingles of an item or a window that make its fingerprint no guide
BYTE_RADIUS = 2         # 8 bytes that all differ by 3 bits or more make 24
ITEM_CHARS = 16 << 20   # benchmark text of one block of items, at most (plus one item)

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTES_NEAR = np.array([[bin(a ^ b).count("1") <= BYTE_RADIUS for b in range(256)] for a in range(256)])


def needed(n_window: int, n_item: int, similarity: float) -> int:
    """Shingles that a window must share with an item to be that similar."""
    return int(np.ceil(similarity * (n_window + n_item) / (1 + similarity) - 1e-9))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first word of each text and the end) of lower-cased words:
    runs of letters, digits and characters beyond ASCII."""
    raw = [t.lower().encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    s, e, row = words(data, offsets, IS_WORD)
    return Rolling(data).ranges(s, e), np.searchsorted(row, np.arange(len(texts) + 1))


def sign_sums(sh: np.ndarray) -> np.ndarray:
    """Prefix sums (one more row than shingles) of the 64 signs of each hash."""
    bits = np.unpackbits(sh.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    return np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """SimHash bytes (rows of 8) of weighted sign sums."""
    return np.packbits(sums > 0, axis=1)


def _previous(sh: np.ndarray) -> np.ndarray:
    """For each shingle the place of the last equal one before it, or -1."""
    order = np.argsort(sh, kind="stable")
    out = np.full(len(sh), -1, np.int64)
    same = sh[order[1:]] == sh[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


class ItemIndex:
    """The items of one block: shingle filter, exact counts and multi-index."""

    def __init__(self, items: list[tuple[int, str]]):
        hashes, bound = word_hashes([t for _, t in items])
        self.ids = [i for i, _ in items]
        self.heavy = np.zeros(len(items), bool)
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []
        self.by_length: dict[int, dict] = {}
        self.short: dict[int, dict[int, list[int]]] = {}
        lengths: dict[int, list[int]] = {}
        for k in range(len(items)):
            h = hashes[bound[k]:bound[k + 1]]
            if len(h) >= SHINGLE:
                sh = shingles(h, SHINGLE)
                self.counts.append(np.unique(sh, return_counts=True))
                self.heavy[k] = len(sh) - len(self.counts[-1][0]) >= HEAVY
                lengths.setdefault(len(h), []).append(k)
            else:
                self.counts.append((np.zeros(0, np.uint64), np.zeros(0, int)))
                if len(h):      # fewer words than a shingle: the whole sequence
                    self.short.setdefault(len(h), {}).setdefault(int(shingles(h, len(h))[0]), []).append(k)
        self.all = np.unique(np.concatenate([c[0] for c in self.counts] or [np.zeros(0, np.uint64)]))
        self.mask = np.zeros(1 << 20, bool)
        self.mask[(self.all >> np.uint64(44)).astype(np.int64)] = True
        for n_words, ks in lengths.items():
            prints = []
            for k in ks:
                sh = shingles(hashes[bound[k]:bound[k + 1]], SHINGLE)
                prints.append(fingerprints(sign_sums(sh)[-1:])[0])
            prints = np.array(prints)
            # near[b][v]: the items whose b-th byte is within BYTE_RADIUS of v
            self.by_length[n_words] = {"items": np.array(ks), "prints": prints, "near": _BYTES_NEAR[prints].transpose(1, 2, 0)}

    def hits(self, sh: np.ndarray) -> np.ndarray:
        """Which shingles occur in an item."""
        out = np.zeros(len(sh), bool)
        maybe = np.flatnonzero(self.mask[(sh >> np.uint64(44)).astype(np.int64)])
        if len(maybe) and len(self.all):
            at = np.minimum(np.searchsorted(self.all, sh[maybe]), len(self.all) - 1)
            out[maybe] = self.all[at] == sh[maybe]
        return out

    def similarity(self, item: int, window: np.ndarray) -> float:
        h, c = self.counts[item]
        u, n = np.unique(window, return_counts=True)
        _, a, b = np.intersect1d(h, u, assume_unique=True, return_indices=True)
        both = int(np.minimum(c[a], n[b]).sum())
        return both / (int(c.sum()) + int(n.sum()) - both)

    def search(self, sh: np.ndarray, hit: np.ndarray, similarity: float) -> dict[int, float]:
        """Items found in one document (its shingles and their hits), with the
        best similarity of each."""
        found: dict[int, float] = {}
        at = np.flatnonzero(hit)
        if not len(at):
            return found
        # stretches of the document that windows with hits can touch
        longest = max(self.by_length) - SHINGLE + 1
        cut = np.flatnonzero(np.diff(at) > longest) + 1
        for part in np.split(at, cut):
            lo, hi = max(int(part[0]) - longest, 0), min(int(part[-1]) + longest + 1, len(sh))
            piece, counts = sh[lo:hi], np.concatenate([[0], np.cumsum(hit[lo:hi])])
            sums = None
            # of windows with the same shingles one is looked at: equal sums of hashes
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece, dtype=np.uint64)])
            before = _previous(piece)
            for n_words, group in self.by_length.items():
                n_item = n_words - SHINGLE + 1
                n = min(n_item, len(piece))
                if n < n_item and len(piece) < len(sh):
                    continue            # the stretch is cut by nothing but the text's own ends
                starts = np.flatnonzero(counts[n:] - counts[:-n] >= needed(n, n_item, similarity))
                if not len(starts):
                    continue
                starts = starts[np.unique(total[starts + n] - total[starts], return_index=True)[1]]
                if sums is None:
                    sums = sign_sums(piece)
                prints = fingerprints(sums[starts + n] - sums[starts])
                near = np.zeros((len(starts), len(group["items"])), bool)
                for b in range(8):
                    near |= group["near"][b][prints[:, b]]
                # one shingle with a high count may make up the whole difference of two alike
                # windows and turn their fingerprints apart: these go to the exact similarity
                repeats = np.array([int((before[s:s + n] >= s).sum()) for s in starts.tolist()])
                heavy = (repeats >= HEAVY)[:, None] | self.heavy[group["items"]][None, :]
                w, k = np.nonzero(near | heavy)
                ok = heavy[w, k] | (np.bitwise_count(prints[w] ^ group["prints"][k]).sum(axis=1) <= RADIUS)
                for x, y in zip(w[ok].tolist(), k[ok].tolist(), strict=True):
                    item = int(group["items"][y])
                    if found.get(item, 0) < 1:
                        s = self.similarity(item, piece[starts[x]:starts[x] + n])
                        if s >= similarity - 1e-12:
                            found[item] = max(s, found.get(item, 0))
        return found

    def scan(self, texts: list[str], similarity: float) -> list[dict[int, float]]:
        h, bound = word_hashes(texts)
        out: list[dict[int, float]] = [{} for _ in texts]
        if self.by_length:
            sh = shingles(h, SHINGLE)
            hit = self.hits(sh)
            total = np.concatenate([[0], np.cumsum(hit)])
            least = min(needed(1, n - SHINGLE + 1, similarity) for n in self.by_length)
            for r in range(len(texts)):
                a, b = int(bound[r]), int(bound[r + 1]) - SHINGLE + 1
                if b > a and total[b] - total[a] >= least:
                    out[r] = self.search(sh[a:b], hit[a:b], similarity)
        for n, table in self.short.items():
            runs = shingles(h, n)
            keys = np.array(list(table), np.uint64)
            for p in np.flatnonzero(np.isin(runs, keys)).tolist():
                r = int(np.searchsorted(bound, p, side="right")) - 1
                if p + n <= bound[r + 1]:
                    out[r].update({k: 1.0 for k in table[int(runs[p])]})
        return out


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"):
    """The benchmark in blocks of bounded size, each small enough for every
    task; a benchmark of any size is searched, block after block."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).alias("t")).filter("length(t) > 0")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-int(total) // ITEM_CHARS))
    for k in range(n if total else 0):
        got = rows.filter(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == k).orderBy("id", "t").collect()
        if got:
            yield ItemIndex([(r["id"], r["t"]) for r in got])


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text",
               similarity: float = SIMILARITY, names: tuple[str, str] = ("items", "similarity")) -> DataFrame:
    """``keep`` columns, ``items array<long>`` (ids of the benchmark items a
    window of the whole text matches, ascending) and ``similarity`` (the best,
    0 without an item) for every row.

    A null or empty text matches nothing, a null or empty item is matched by
    nothing. A text shorter than an item is one window. An item of fewer than
    five words is one shingle, matched by the same words in a row. Items that
    repeat an id count once; items without an id are searched like others and
    stand in ``items`` as one null, the last. Rows that repeat are judged
    alike. An empty benchmark leaves every document clean. A benchmark of more
    than one block is searched block by block: the driver holds one, and the
    rows with what was found so far are written in between.
    """
    bound_batches(docs.sparkSession)
    items, best = names
    t, new_items, new_best = fresh_names(docs.select(*keep, F.lit(0).alias(items), F.lit(0).alias(best)), "searched", "found", "found_best")
    cols = [*keep, *([] if text_col in keep else [t])]
    out = docs.select(*keep, *([] if text_col in keep else [F.col(text_col).alias(t)]),
                      F.array().cast("array<long>").alias(items), F.lit(0.0).alias(best))
    text = text_col if text_col in keep else t
    for n, index in enumerate(item_blocks(benchmark)):
        def fn(data, offsets, index=index):
            got = index.scan(texts_of(data, offsets), similarity)
            ids = [{index.ids[k] for k in g} for g in got]
            return [pa.array([sorted(x - {None}) + [None] * (None in x) for x in ids], pa.list_(pa.int64())),
                    pa.array([max(g.values(), default=0.0) for g in got], pa.float64())]
        if n:
            out = materialize(out, "leaks")
        found = map_text(out, [*cols, items, best], fn, f"{new_items} array<long>, {new_best} double", text, SMALL_BLOCK)
        both = F.array_union(items, new_items)
        ordered = F.concat(F.array_sort(F.filter(both, lambda x: x.isNotNull())), F.filter(both, lambda x: x.isNull()))
        out = found.select(*cols, ordered.alias(items), F.greatest(F.col(best), F.col(new_best)).alias(best))
    return out.select(*keep, items, best)


def drop_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item."""
    names = tuple(fresh_names(docs, "leak_items", "leak_similarity"))
    return find_leaks(docs, benchmark, docs.columns, names=names).filter(F.size(names[0]) == 0).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").alias("n_items"),
                        F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), "similarity")


# the same answer without fingerprints: windows counted shingle by shingle
SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS words FROM documents),
-- items without an id are searched too, under an id of their own that is not shown
iw AS (SELECT coalesce(item_id, -9223372036854775807) AS item_id,
              regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS words FROM benchmark WHERE length(text) > 0),
il AS (SELECT item_id, least(len(words), 5) AS k, len(words) - least(len(words), 5) + 1 AS n, words FROM iw WHERE len(words) > 0),
ish AS (SELECT item_id, sh, count(*) AS ci FROM (
          SELECT item_id, unnest([array_to_string(words[i:i + k - 1], ' ') FOR i IN range(1, n + 1)]) AS sh FROM il)
        GROUP BY item_id, sh),
dsh AS (SELECT doc_id, k, i AS p, greatest(len(words) - k + 1, 0) AS m, array_to_string(words[i:i + k - 1], ' ') AS sh
        FROM (SELECT doc_id, k, words, unnest(range(1, len(words) - k + 2)) AS i
              FROM dw, (SELECT DISTINCT k FROM il) WHERE len(words) >= k)),
hit AS (SELECT d.doc_id, i.item_id, d.p, d.m, l.n, l.k FROM dsh d JOIN ish i ON d.sh = i.sh
        JOIN il l ON l.item_id = i.item_id AND l.k = d.k),
likely AS (SELECT doc_id, item_id, m, n, k FROM hit GROUP BY ALL HAVING count(*) >= 0.8 * least(m, n)),
win AS (SELECT DISTINCT h.doc_id, h.item_id, h.k, least(h.m, h.n) AS nw, h.n,
               unnest(range(greatest(1, h.p - least(h.m, h.n) + 1), least(h.p, h.m - least(h.m, h.n) + 1) + 1)) AS p0
        FROM hit h JOIN likely USING (doc_id, item_id)),
part AS (SELECT w.doc_id, w.item_id, w.p0, w.nw, w.n, d.sh, count(*) AS cw
         FROM win w JOIN dsh d ON d.doc_id = w.doc_id AND d.k = w.k AND d.p BETWEEN w.p0 AND w.p0 + w.nw - 1 GROUP BY ALL),
sim AS (SELECT p.doc_id, p.item_id, p.p0, sum(least(p.cw, i.ci)) AS both_, any_value(p.nw + p.n) AS total
        FROM part p JOIN ish i ON i.item_id = p.item_id AND i.sh = p.sh GROUP BY ALL),
best AS (SELECT doc_id, item_id, max(both_ / (total - both_)) AS s FROM sim GROUP BY doc_id, item_id HAVING max(both_ / (total - both_)) >= 0.8)
SELECT d.doc_id, count(b.item_id) > 0 AS contaminated, CAST(count(b.item_id) AS INTEGER) AS n_items,
       coalesce(string_agg(CAST(b.item_id AS VARCHAR), ',' ORDER BY b.item_id) FILTER (WHERE b.item_id > -9223372036854775807), '') AS items,
       CAST(coalesce(max(b.s), 0) AS DOUBLE) AS similarity
FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id GROUP BY d.doc_id
"""
