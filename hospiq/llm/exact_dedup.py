"""Operator 1: exact deduplication by content-defined chunk recipes.

Every text is normalised (the separators go) and cut where a rolling hash of
the last 32 bytes says so, so equal stretches are cut alike wherever they
stand. A chunk is known by a 64-bit weak identifier, which is *verified*: where
one weak identifier stands for more than one SHA-256, the documents that
contain it are identified by SHA-256 instead. Two texts are equal when their
ordered identifier lists are equal. Only identifiers (about 1 % of the text)
are shuffled; no text leaves the task that read it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bytetext import IS_WORD, SMALL_BLOCK, Rolling, blocks, buffers
from .common import bound_batches, fresh_names, map_arrow, materialize, read_table, text_rows

WINDOW = 32
AVERAGE = 1024          # mean chunk bytes, a power of two
LONGEST = 64 * 1024     # a stretch without cuts is cut at this length

RECIPE = "id long, n_chars long, text_sha256 string, weak array<binary>, strong array<binary>"


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All chunk borders of a block of normalised texts, row borders included.
    A border depends on the row's own bytes only."""
    h = Rolling(data).grams(WINDOW)
    at = np.flatnonzero((h & np.uint64(AVERAGE - 1)) == 0) + WINDOW
    row = np.searchsorted(offsets, at, side="left") - 1     # a cut at a row's end adds nothing
    at = at[at - WINDOW >= offsets[np.maximum(row, 0)]]
    cuts = np.unique(np.concatenate([at, offsets]))
    gaps = np.diff(cuts)
    more = [np.arange(c + LONGEST, c + g, LONGEST) for c, g in
            zip(cuts[:-1][gaps > LONGEST].tolist(), gaps[gaps > LONGEST].tolist(), strict=True)]
    return np.unique(np.concatenate([cuts, *more])) if more else cuts


def _block(data: np.ndarray, offsets: np.ndarray):
    keep = IS_WORD[data]
    place = np.concatenate([[0], np.cumsum(keep)])
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    norm, new = data[keep], place[offsets]
    n_chars = np.diff(chars[offsets])
    cuts = _cuts(norm, new)
    weak = Rolling(norm).ranges(cuts[:-1], cuts[1:]).astype(">u8").tobytes()
    raw, c = memoryview(norm.tobytes()), cuts.tolist()
    strong = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(c, c[1:], strict=False)]
    first = np.searchsorted(cuts, new)
    for i in range(len(offsets) - 1):
        a, b = int(first[i]), int(first[i + 1])
        yield (int(n_chars[i]), hashlib.sha256(raw[new[i]:new[i + 1]]).hexdigest(),
               [weak[8 * j: 8 * j + 8] for j in range(a, b)], strong[a:b])


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_raw: bool = False) -> DataFrame:
    """One row per row of ``docs``: its code points, the SHA-256 of the
    normalised text and the ordered weak and strong chunk identifiers;
    ``with_raw`` adds the MD5 of the text as it is."""
    def fn(batch: pa.RecordBatch):
        data, o = buffers(batch.column(1))
        ids = batch.column(0)
        for i, j in blocks(o, SMALL_BLOCK):
            rows = list(_block(data[o[i]:o[j]], o[i:j + 1] - o[i]))
            raw = [pa.array([hashlib.md5(data[a:b].tobytes()).digest() for a, b in zip(o[i:j], o[i + 1:j + 1], strict=True)])] if with_raw else []
            yield pa.RecordBatch.from_arrays(
                [ids.slice(i, j - i), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]),
                 pa.array([r[2] for r in rows], pa.list_(pa.binary())),
                 pa.array([r[3] for r in rows], pa.list_(pa.binary())), *raw],
                names=["id", "n_chars", "text_sha256", "weak", "strong"] + ["raw"] * with_raw)
    bound_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(text_rows(src, "id"), fn, RECIPE + (", raw binary" if with_raw else ""))


def verified_recipes(recipes: DataFrame) -> DataFrame:
    """``recipes`` with ``ids``: the weak list, or the strong list for a
    document with a weak identifier that stands for several chunks."""
    chunks = recipes.select("id", "text_sha256", F.explode(F.arrays_zip("weak", "strong")).alias("c"))
    catalogue = chunks.select("c.weak", "c.strong").distinct()
    ambiguous = catalogue.groupBy("weak").count().filter("count > 1").select("weak")
    affected = (chunks.select("id", "text_sha256", F.col("c.weak").alias("weak"))
                .join(ambiguous, "weak", "left_semi").select("id", "text_sha256").distinct()
                .select(F.col("id").alias("a_id"), F.col("text_sha256").alias("a_sha"), F.lit(True).alias("amb")))
    return (recipes.join(affected, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("text_sha256") == F.col("a_sha")),
                         "left")
            .select("id", "n_chars", "text_sha256", *(["raw"] if "raw" in recipes.columns else []),
                    F.when(F.col("amb"), F.col("strong")).otherwise(F.col("weak")).alias("ids")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Decision for every document: ``doc_id, keep_id, group_size, kept,
    text_sha256, n_chunks``.

    Texts are equal when identical without separators. Of equal texts the one
    with the most code points stays, then the smallest id (a null id last). A
    null or empty text, or one of separators only, equals every other such
    text. Rows that repeat an id with an equal text are one document and give
    one row. Other columns of ``docs`` are not read, whatever their names. An
    empty table gives an empty result.
    """
    recipes = verified_recipes(materialize(chunk_recipes(docs, id_col, text_col), "recipes"))
    rows = recipes.groupBy("id", "text_sha256", "ids").agg(F.max("n_chars").alias("n_chars"))
    first = F.max(F.struct("n_chars", (-F.col("id")).alias("neg")))
    groups = rows.groupBy("ids").agg(first.alias("top"), F.count(F.lit(1)).alias("group_size"))
    keep = (-F.col("top.neg")).alias("keep_id")
    return (rows.join(groups.select("ids", keep, "group_size"), "ids")
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
                    F.size("ids").alias("n_chunks")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the copies, columns as given: of each group the row
    with the most code points, then the smallest id (null ids last), then the
    smallest digest of the text as it is; of rows that repeat id and text, one.

    Groups are found from the recipes alone. A row is known by its id and the
    digest of its text, by which the texts move once, to meet the kept keys."""
    recipes = verified_recipes(materialize(chunk_recipes(docs, with_raw=True), "recipes"))
    keys = recipes.groupBy("id", "raw", "ids").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    top = F.max(F.struct("n_chars", (-F.col("id")).alias("neg"), "raw", "copies"))
    k_id, k_raw, place = fresh_names(docs, "kept_id", "kept_raw", "kept_place")
    keep = materialize(keys.groupBy("ids").agg(top.alias("top")).select((-F.col("top.neg")).alias(k_id), F.col("top.raw").alias(k_raw),
                                                                        F.col("top.copies").alias("copies")), "kept")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    out = docs.join(keep.select(k_id, k_raw), F.col("doc_id").eqNullSafe(F.col(k_id)) & (digest == F.col(k_raw)), "left_semi")
    if keep.filter("copies > 1").limit(1).isEmpty():
        return out
    one = W.partitionBy("doc_id", digest).orderBy(F.col("text").isNull())
    return out.withColumn(place, F.row_number().over(one)).filter(F.col(place) == 1).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS t
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""
