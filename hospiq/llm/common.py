"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# the separators of all contracts: space and 0x09-0x0D
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, and a lost executor costs a file read, not a recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20   # of an Arrow batch that goes to a Python worker


def bound_batches(spark: SparkSession) -> None:
    """Let rows go to Python workers in Arrow batches of about BATCH_BYTES,
    however long the rows are: the executor and the worker each hold a batch
    several times over, and seldom give that memory back. Holds for plans that
    run from now on; every row is still sent."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
              schema: str) -> DataFrame:
    """mapInArrow with a function of one batch that returns or yields batches."""
    def run(batches):
        for b in batches:
            out = fn(b)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out
    return df.mapInArrow(run, schema)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: each row's place (0, 1, 2 ...) in the order.

    Rows are range-partitioned and sorted, so no task holds more than its range;
    a row's place is its place in the range plus the sizes of the ranges before
    it (one number for each partition goes over the driver). Columns of ``order`` should tell all rows
    apart that may not change places. ``df`` is read twice (the ranges are
    sampled), so give a written table."""
    spark = df.sparkSession
    at = F.monotonically_increasing_id()
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, at), name)
    part, inside = F.shiftright(F.col(name), 33), F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    base = spark.createDataFrame(rows, "range_part long, range_base long")
    return (placed.join(F.broadcast(base), part == F.col("range_part"))
            .withColumn(name, F.col("range_base") + inside).drop("range_part", "range_base"))


def segments(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut after a space or a
    line break; a stretch without any stays whole."""
    at, n = 0, len(text)
    while n - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        if cut < 0:
            ahead = [c for c in (text.find(" ", at + size), text.find("\n", at + size)) if c >= 0]
            if not ahead:
                break
            cut = min(ahead)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def text_rows(docs: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """Only the needed columns, text null as empty (the scan reads no more)."""
    return docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias(text))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per
    application, so that it need not be installed there."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "hospiq_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
