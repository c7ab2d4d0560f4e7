"""The pipeline, stage by stage, on planted cases."""
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from hospiq.llm import bytetext, exact_dedup, near_dedup

from . import brute
from .conftest import prose


def test_stages(spark, corpus, tmp_path):
    rows, df, item = corpus
    folder = str(tmp_path)
    extra = df.select("doc_id", "text", "lang", "source", "kept")
    extra.write.parquet(f"{folder}/documents.parquet")
    items = [(1, item)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    text = {r[0]: r[1] for r in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = {r[0] for r in rows}
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = want
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        got = {r.doc_id for r in docs.collect()}
        if name == "language_id":
            letters = {i for i, t in text.items() if any(c.isalpha() for c in t or "")}
            assert got <= letters and len(letters - got) <= 2
            want = got
        elif name == "exact_dedup":
            want = {i for i, r in brute.exact([(i, text[i]) for i in before]).items() if r[2]}
        elif name == "near_dedup":
            want = {i for i, r in brute.near([(i, text[i]) for i in before]).items() if r[2]}
        elif name == "decontamination":
            want = {i for i in before if not brute.leaks(text[i], items)}
        assert got == want and docs.count() == len(got), name
        if name != "mixing":
            assert docs.columns == columns
    ids = {r.doc_id: (r["size"], r.taken) for r in docs.collect()}
    run = {r.doc_id: (r["size"], r.taken) for r in corpus_pipeline.run(spark, folder).collect()}
    assert run == ids


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES if n != "mixing"])
def test_stage_sends_long_rows_in_small_batches(spark, tmp_path, name):
    folder, limit = str(tmp_path), "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(1, "one two three", None, None), (2, "four five", None, None)],
                                 "doc_id long, text string, lang string, source string")
    spark.createDataFrame([(1, "six seven eight")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])
    before = spark.conf.get(limit)
    spark.conf.unset(limit)
    try:
        assert dict(corpus_pipeline.STAGES)[name](spark, docs, folder).count() == 2
        wide = spark.range(0, 600, 1, 1).selectExpr("repeat('x', 40000) AS text")
        got = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
    finally:
        spark.conf.set(limit, before)
    assert sum(got) == 600 and max(got) * 40000 <= 5 << 20


class _Rows:
    """Stands for a DataFrame and hands out the function that its tasks run."""

    def mapInArrow(self, run, schema):
        return run


def _peak(task, batch):
    """Rows out and bytes of work arrays of a task, in a worker without any kept."""
    bytetext._POWERS.clear()
    bytetext._POWERS["n"] = 0
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in task([batch]))
        return rows, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_task_holds_the_work_arrays_of_a_small_block():
    rng = random.Random(8)
    texts = [prose(rng, 400) for _ in range(3000)]
    n, size = len(texts), sum(len(t.encode()) for t in texts)
    assert size > 4 << 20
    ids, key, text = pa.array(range(n), pa.int64()), pa.array([b"k"] * n), pa.array(texts)
    for run, batch in ((near_dedup.set_rows(_Rows(), 2), pa.RecordBatch.from_arrays([ids, key, text], names=["id", "key", "text"])),
                       (near_dedup.full_sets(_Rows(), 2), pa.RecordBatch.from_arrays([ids, text], names=["id", "text"]))):
        rows, peak = _peak(run, batch)
        assert rows == n and peak < 48 << 20


def test_blocks_of_any_size_give_the_same_sets_and_borders(monkeypatch):
    rng = random.Random(9)
    texts = [prose(rng, rng.randint(0, 300)) for _ in range(200)]
    monkeypatch.setattr(bytetext, "_POWERS", {"n": 0})
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    o = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])

    def found(limit):
        sets, recipes = [], []
        for i, j in bytetext.blocks(o, limit):
            part = data[o[i]:o[j]], o[i:j + 1] - o[i]
            sets += [s.tobytes() for s in bytetext.shingle_sets(*part, 2)]
            recipes += list(exact_dedup._block(*part))
        return sets, recipes
    small = found(5000)
    assert len(bytetext._POWERS["v"][0]) < 50000    # not those of the largest block there may be
    assert small == found(1 << 30) == found(1)
