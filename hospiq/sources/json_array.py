"""Splittable reads of files that hold one JSON array.

A multi-line JSON read gives each file to one task. Here a file is read in byte
ranges. Commas are the record separator of the text reader, so it cuts the
file at any range border, and each range gets the comma-separated fragments
that start in it. Whether a range starts inside a string follows from the
number of quotes before it, its nesting depth from the brackets before it:
both are running sums over one small row for each range. With these every
range finds the commas between elements for itself; only its first and last
piece, whose element reaches over the border, are joined with the neighbours'.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# the functions below go to executors that need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

c = F.col
_TOKEN = re.compile(r'\\.|["{}\[\]]', re.S)
_STEP = {"{": 1, "[": 1, "}": -1, "]": -1}
SUMMARY = "file string, first long, quotes long, outside long, inside long, array boolean"
PIECES = "file string, first long, part int, text string"


def _ranges(batches) -> Iterator[tuple[str, int, list[str], bool]]:
    """(file, first byte, some fragments, whether the range is new) as they stream by."""
    at = None
    for b in batches:
        files, firsts, texts = (b.column(k).to_pylist() for k in range(3))
        i = 0
        while i < len(files):
            j = i
            while j < len(files) and (files[j], firsts[j]) == (files[i], firsts[i]):
                j += 1
            yield files[i], firsts[i], texts[i:j], (files[i], firsts[i]) != at
            at = (files[i], firsts[i])
            i = j


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [x.split() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)],
                                      names=[n for n, _ in fields])


def _summaries(batches):
    """Per range: its quotes, and the change of depth if it starts outside or
    inside a string; whether the file starts with an array."""
    rows = []
    for file, first, fragments, new in _ranges(batches):
        if new:
            rows.append([file, first, 0, 0, 0, None])
        r = rows[-1]
        if r[5] is None and first == 0:
            text = "".join(fragments).lstrip("\ufeff \t\r\n")
            r[5] = text[0] == "[" if text else None
        for f in fragments:
            for m in _TOKEN.finditer(f):
                t = m[0]
                if t == '"':
                    r[2] += 1
                elif t in _STEP:
                    r[3 + r[2] % 2] += _STEP[t]
    if rows:
        yield _batch(rows, SUMMARY)


def _cutter(starts: dict):
    """Cuts ranges into pieces; ``starts``: (file, first) -> (in string, depth, depth of the elements)."""
    def run(batches):
        rows, held, state = [], [], None
        key, seen = None, False

        def close():
            if key is not None:         # the last piece, or the middle of a longer element
                rows.append((*key, 2 if seen else 0, ",".join(held)))
        for file, first, fragments, new in _ranges(batches):
            if new:
                close()
                key, held, seen = (file, first), [], False
                state = list(starts[key])
            inside, depth, level = state
            for f in fragments:
                if held and not inside and depth == level:      # the comma before this fragment stands between elements
                    rows.append((*key, 1 if seen else 0, ",".join(held)))
                    seen, held = True, []
                held.append(f)
                for m in _TOKEN.finditer(f):
                    t = m[0]
                    if t == '"':
                        inside = not inside
                    elif not inside and t in _STEP:
                        depth += _STEP[t]
            state = [inside, depth, level]
            if len(rows) > 5000:
                yield _batch(rows, PIECES)
                rows = []
        close()
        if rows:
            yield _batch(rows, PIECES)
    return run


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, text``: the JSON text of each element of the arrays in the files
    under ``path`` (a file with one object gives that object). A range border
    falls on a comma; a comma that ends a range is between elements if the next
    range starts at the elements' depth."""
    raw = (spark.read.option("lineSep", ",").text(path)
           .select(c("_metadata.file_path").alias("file"), c("_metadata.file_block_start").alias("first"), "value"))
    ranges = raw.mapInArrow(_summaries, SUMMARY)
    before = W.partitionBy("file").orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    marks = ranges.withColumn("in_string", quotes % 2 == 1)
    marks = marks.withColumn("step", F.when(c("in_string"), c("inside")).otherwise(c("outside")))
    marks = marks.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    level = F.when(F.max("array").over(W.partitionBy("file")), 1).otherwise(0)
    # one small row for each byte range of the input
    starts = {(r.file, r.first): (r.in_string, r.depth, r.level)
              for r in marks.select("file", "first", "in_string", "depth", level.alias("level")).collect()}
    held = {k: v for k, v in starts.items()}
    pieces = raw.mapInArrow(_cutter(held), PIECES)
    middle = pieces.filter("part = 1").select("file", "text")
    ends = pieces.filter("part <> 1")
    # a range's first piece ends the element that an earlier range began, unless it starts between two elements
    clean = spark.createDataFrame([(f, k, not s and d == lv and lv > 0) for (f, k), (s, d, lv) in starts.items()],
                                  "file string, first long, clean boolean")
    ends = ends.join(clean, ["file", "first"])
    order = W.partitionBy("file").orderBy("first", "part")
    begins = (c("part") == 2) | (c("clean") & (c("part") == 0))
    ends = ends.withColumn("element", F.sum(begins.cast("int")).over(order))
    whole = W.partitionBy("file")
    ends = ends.withColumn("last", c("element") == F.max("element").over(whole)).withColumn(
        "head", c("element") == F.min("element").over(whole))
    joined = (ends.groupBy("file", "element", "last", "head").agg(F.sort_array(F.collect_list(F.struct("first", "part", "text"))).alias("x"))
              .withColumn("text", F.array_join(c("x.text"), ",")))
    is_array = F.broadcast(spark.createDataFrame(sorted({(f, lv == 1) for (f, _), (_, _, lv) in starts.items()}), "file string, array boolean")) \
        if starts else spark.createDataFrame([], "file string, array boolean")
    joined = joined.join(is_array, "file")
    text = F.regexp_replace("text", "^\ufeff", "")
    text = F.when(c("array") & c("head"), F.regexp_replace(text, r"^\s*\[", "")).otherwise(text)
    text = F.when(c("array") & c("last"), F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    return middle.unionByName(joined.select("file", text.alias("text"))).filter(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The elements as rows of ``schema``; one that does not parse gives NULLs."""
    parsed = array_elements(spark, path).select(F.from_json("text", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.*")


def array_lines(batches):
    """A partition's documents as the lines of one JSON array; they stream by."""
    lead = "["
    for b in batches:
        if b.num_rows:
            lines = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([lead + lines[0], *(",\n" + x for x in lines[1:])], pa.string())], names=["value"])
            lead = ",\n"
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if lead == "[" else "\n]"], pa.string())], names=["value"])
