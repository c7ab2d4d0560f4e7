"""Applying a vectorised text function to every row (operators without joins)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bytetext import blocks, buffers
from .common import fresh_names


def map_text(docs: DataFrame, keep: list[str], fn: Callable[[np.ndarray, np.ndarray], list[pa.Array]], added: str,
             text: str = "text", block: int = 2 << 20) -> DataFrame:
    """``keep`` columns of every row plus the columns that ``fn(bytes,
    offsets)`` gives for a block of whole texts (null as empty). ``added`` is
    their DDL; their names must not be among ``keep``. One scan, no shuffle;
    a task holds one Arrow batch and the work arrays of one block."""
    at = keep.index(text) if text in keep else len(keep)
    src = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias(fresh_names(docs, "map_text")[0]))
    schema = docs.select(*keep).schema
    extra = docs.sparkSession.createDataFrame([], added).schema
    for f in extra.fields:
        schema = schema.add(f)
    names = schema.fieldNames()

    def run(batches):
        for b in batches:
            data, o = buffers(b.column(at))
            for i, j in blocks(o, block):
                cols = fn(data[o[i]:o[j]], o[i:j + 1] - o[i])
                yield pa.RecordBatch.from_arrays([b.column(c).slice(i, j - i) for c in range(len(keep))] + cols, names=names)
    return src.mapInArrow(run, schema)


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw, o = data.tobytes(), offsets.tolist()
    return [raw[a:b].decode() for a, b in zip(o, o[1:], strict=False)]


def bounded_sample(rows: DataFrame, key: str, seed_column: str, per_key: int) -> DataFrame:
    """The ``per_key`` rows of each key with the smallest hash of
    ``seed_column``, all keys. One pass counts the keys; a threshold on the hash
    then lets little more than the sample through, so no task gathers more than
    about ``2 * per_key`` rows of a key, whatever the size of the table."""
    rows = rows.filter(F.col(key).isNotNull())
    share = F.when(F.col("count") > per_key, F.least(F.lit(1.0), F.lit(2.0 * per_key) / F.col("count"))).otherwise(1.0)
    counts = rows.groupBy(F.col(key).alias("sample_key")).count().select("sample_key", share.alias("sample_share"))
    u = F.pmod(F.xxhash64(seed_column), F.lit(1 << 30)) / float(1 << 30)
    # one row for each key: a small part of the sample, which its user holds whole
    picked = rows.join(F.broadcast(counts), F.col(key) == F.col("sample_key")).filter(u <= F.col("sample_share"))
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.xxhash64(seed_column), seed_column))
    return picked.withColumn("sample_rank", rank).filter(F.col("sample_rank") <= per_key).drop("sample_key", "sample_share", "sample_rank")
