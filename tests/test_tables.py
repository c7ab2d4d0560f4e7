"""Versioned tables under two writers, change sets, file bounds, histories,
loads with rejects and a log, splittable arrays, counted percentiles."""
import datetime as dt
import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hospiq.operators import quantiles as Q
from hospiq.operators import state as L
from hospiq.plans.build import maintain_fact, mart_table
from hospiq.plans.models import Warehouse
from hospiq.sources import ingest as A
from hospiq.sources.json_array import array_elements, read_json_array

from .conftest import SF_SMALL, rows


def files(t):
    return {os.path.join(d, f) for d, _, n in os.walk(t.base + "/data") for f in n if f.endswith(".parquet")}


def kv(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def interleave(table, other):
    """The next publication of ``table`` lets ``other`` commit just before."""
    real, ran = table._publish, []

    def publish(*a, **kw):
        if not ran:
            ran.append(1)
            other()
        return real(*a, **kw)
    table._publish = publish


def test_interleaved_appends_and_merges_lose_no_row(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t", key=("k",), buckets=4)
    t.commit(kv(spark, [(0, "a")]))
    interleave(t, lambda: L.VersionedTable(spark, t.base, key=("k",), buckets=4).append(kv(spark, [(100, "b")])))
    assert t.append(kv(spark, [(200, "c")])) == 3
    interleave(t, lambda: L.VersionedTable(spark, t.base, key=("k",), buckets=4).append(kv(spark, [(0, "other"), (300, "d")])))
    t.merge(kv(spark, [(0, "merged")]), lambda old, new: L.replace_keys(old, new, ["k"]))
    assert rows(t.read()) == [(0, "merged"), (100, "b"), (200, "c"), (300, "d")]


def test_large_changes_are_made_in_parts_of_the_keys(spark, tmpdir_path, monkeypatch):
    rng = random.Random(3)

    def batch(n, keys, times):      # repeated keys, keys without a value
        return [(rng.randrange(keys) if rng.random() < 0.95 else None, f"v{t}", t) for t in rng.sample(times, n)]
    # the second has keys that are there, newer and older, and new ones; the third only new ones
    first, second = batch(900, 300, range(0, 2000, 2)), batch(300, 400, range(1, 2000, 2))
    third = [(1000 + k, "new", 1) for k in range(200)]
    monkeypatch.setattr(L, "PART_BYTES", 2000)
    feed = L.VersionedTable(spark, f"{tmpdir_path}/feed")
    table = L.VersionedTable(spark, f"{tmpdir_path}/table", key=("k",), buckets=4)
    writes, real = [], table._write
    table._write = lambda df: writes.append(1) or real(df)
    want = {}
    for rows_, mode in ((first, "full"), (second, "changes"), (third, "changes")):
        feed.append(spark.createDataFrame(rows_, "k long, v string, ts int").repartition(3))
        writes.clear()
        assert L.maintain_from_changes(table, feed, lambda x: x, ["k"], ["ts"], by_key=True)["mode"] == mode
        assert len(writes) > 1
        nulls = [x for x in rows_ if x[0] is None]      # no key equals a missing one: each load adds its latest
        for x in [*(x for x in rows_ if x[0] is not None), *([max(nulls, key=lambda x: x[2])] if nulls else [])]:
            at = x[0] if x[0] is not None else ("null", mode)
            if at not in want or want[at][2] < x[2]:
                want[at] = x
        assert sorted(map(tuple, table.read().collect()), key=str) == sorted(want.values(), key=str)
    assert not os.listdir(f"{table.base}/staged")


def test_written_tables_leave_no_shuffle_files(spark, tmpdir_path):
    def shuffles():
        found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {x for x in found.split("\n") if "/shuffle_" in x}
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    t = L.VersionedTable(spark, f"{tmpdir_path}/t", key=("k",), buckets=4)
    before = shuffles()
    t.commit(spark.range(2000).selectExpr("cast(id as int) k", "'a' v"))
    t.upsert(spark.range(1990, 2010).selectExpr("cast(id as int) k", "'b' v"), ["k"], ["v"])
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)     # they are deleted beside what runs
    assert not shuffles() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    assert t.read().count() == 2010


def test_billing_rows_are_not_dealt_by_payer(spark):
    plan = Warehouse(spark, SF_SMALL).revenue_cycle._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(payer_id" not in plan


def test_a_replacing_commit_fails_when_it_is_not_the_next(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t")
    t.commit(kv(spark, [(0, "a")]))
    interleave(t, lambda: L.VersionedTable(spark, t.base).append(kv(spark, [(1, "b")])))
    with pytest.raises(L.CommitConflict):
        t.commit(kv(spark, [(2, "c")]))
    assert rows(t.read()) == [(0, "a"), (1, "b")]


def test_a_manifest_is_put_once(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t")
    t.commit(kv(spark, [(0, "a")]))
    path = f"{t.base}/_manifests/{7:09d}"
    assert L._put_if_absent(spark, path, "{}\n") and not L._put_if_absent(spark, path, "[]\n")
    assert open(path).read() == "{}\n" and not [f for f in os.listdir(t.base + "/_manifests") if f.startswith(".") and "crc" not in f]


def test_changes_are_read_from_their_own_folders(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t", key=("k",), buckets=4, feed=True)
    t.commit(kv(spark, [(i, "a") for i in range(20)]))
    v1 = t.current_version()
    t.append(kv(spark, [(50, "new")]))
    t.merge(kv(spark, [(3, "b")]), lambda old, new: L.replace_keys(old, new, ["k"]))
    t.compact(1)
    assert rows(t.changes(v1)) == [(3, "b"), (50, "new")]
    assert t.changes(v1, v1).count() == 0 and t.changes(0) is None
    assert t.read().count() == 21


def test_facts_follow_late_rows_and_touch_their_buckets_only(spark, tmpdir_path):
    w = Warehouse(spark, SF_SMALL)
    feed = L.VersionedTable(spark, f"{tmpdir_path}/raw")
    table = mart_table(spark, tmpdir_path, "fct_billing_transactions", [], buckets=64)
    raw = w.raw.billing_transactions
    known = {r[0] for r in w.fct_billing_transactions.select("transaction_id").collect()}
    late = sorted(known)[:2]                                # whatever their load times
    feed.append(raw.filter(~F.col("transaction_id").isin(late)))
    assert maintain_fact(w, "fct_billing_transactions", table, feed)["mode"] == "full"
    before = files(table)
    feed.append(raw.filter(F.col("transaction_id").isin(late)))
    assert maintain_fact(w, "fct_billing_transactions", table, feed)["mode"] == "changes"
    written = {f.split("_key_bucket=")[1].split("/")[0] for f in files(table) - before}
    assert 1 <= len(written) <= 2
    assert maintain_fact(w, "fct_billing_transactions", table, feed)["mode"] == "unchanged"
    want = w.fct_billing_transactions
    assert rows(table.read().select(*want.columns)) == rows(want)


def test_capture_appends_new_and_changed_rows(spark, tmpdir_path):
    feed = L.VersionedTable(spark, f"{tmpdir_path}/feed")
    L.capture(feed, kv(spark, [(1, "a"), (2, None)]))
    v = feed.current_version()
    L.capture(feed, kv(spark, [(1, "a"), (2, None)]))
    assert feed.current_version() == v
    L.capture(feed, kv(spark, [(1, "b"), (2, None), (3, "c")]))
    assert rows(feed.changes(v)) == [(1, "b"), (3, "c")]


def test_dropping_a_tenant_rewrites_nothing(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t", partition_by=("hospital_id",))
    schema = "hospital_id string, v int"
    t.commit(spark.createDataFrame([("H1", 1), ("H2", 2), (None, 9)], schema))
    t.append(spark.createDataFrame([("H1", 3), ("H2", 4)], schema))
    before = files(t)
    log = L.offboard_tenant(spark, {"t": t}, "H1")
    assert rows(log) == [("t", "H1", 2, 0)] and files(t) == before
    assert sorted(r.v for r in t.read().collect()) == [2, 4, 9] and t.read().columns == ["hospital_id", "v"]
    assert t.read(2).count() == 5


def test_many_appends_read_as_one_relation_and_bounds_leave_files_out(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t", stats=("day", "n"))
    day = dt.date(2024, 1, 1)
    for k in range(30):
        t.append(spark.createDataFrame([(day + dt.timedelta(k), k)], "day date, n int").coalesce(1))
    plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and t.read().count() == 30
    m = t._manifest(t.current_version())
    listed = [f for e in m["entries"] for f in t._files(e, {"day": ["2024-01-05", "2024-01-07"]})]
    assert len(listed) == 3
    assert sorted(r.n for r in t.read(where={"day": ("2024-01-05", dt.date(2024, 1, 7))}).collect()) == [4, 5, 6]
    assert t.read(where={"n": (29, None)}).count() == 1 and t.read(where={"n": (100, None)}).count() == 0
    t.compact()
    assert len(t._load(t.current_version())) == 1 and t.read().count() == 30


def test_a_batch_with_a_number_counts_once(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/t")
    for batch in (0, 0, 1, 0, 1):
        t.append(kv(spark, [(batch, "x")]), ("stream:a", batch))
    t.append(kv(spark, [(9, "y")]), ("stream:b", 0))
    assert rows(t.read()) == [(0, "x"), (1, "x"), (9, "y")] and t.tag("stream:a") == 1


def test_a_replayed_stream_batch_is_skipped(spark, tmpdir_path):
    from hospiq.sources.adapters import HospitalSource
    from hospiq.sources.schemas import conform
    from hospiq.streaming import micro_batch as P
    enc = conform(HospitalSource(spark, SF_SMALL).encounters, "raw_encounters")
    enc.limit(50).write.parquet(f"{tmpdir_path}/in/1")
    target = L.VersionedTable(spark, f"{tmpdir_path}/t")
    ck = f"{tmpdir_path}/ck"

    def run():
        P.incremental_file_ingest(spark, f"{tmpdir_path}/in/*", "raw_encounters", target, ["encounter_id"], ck, mode="append").awaitTermination()
    run()
    for name in ("0", ".0.crc"):                                # the driver died before the stream's own commit
        os.rename(f"{ck}/commits/{name}", f"{tmpdir_path}/lost{name}")
    run()
    assert target.read().count() == 50


def test_history_rewrites_buckets_with_changes_only(spark, tmpdir_path):
    s = "id int, tier string"
    h = L.HistoryTable(spark, f"{tmpdir_path}/h", "id", buckets=16)
    plain = None
    states = [[(i, "A") for i in range(40)], [(i, "B" if i == 7 else "A") for i in range(40)],
              [(i, "B" if i == 7 else "A") for i in range(1, 40)], [(i, "B" if i == 7 else "A") for i in range(1, 40)]]
    for k, state in enumerate(states):
        df, before, at = spark.createDataFrame(state, s), files(h.open), f"2024-0{k + 1}-01 00:00:00"
        h.snapshot(df, at, check_cols=["tier"])
        plain = L.scd2_snapshot(plain, df, "id", at, check_cols=["tier"])
        got = h.read()
        assert rows(got.select(*plain.columns)) == rows(plain)
        buckets = {f.split("_key_bucket=")[1].split("/")[0] for f in files(h.open) - before}
        assert k == 0 or len(buckets) <= 1
    # a run that died after its closed rows were committed
    h.closed.append(h.closed.read().limit(1).withColumn("_run", F.lit(99).cast("bigint")))
    assert rows(h.read().select(*plain.columns)) == rows(plain)


def test_rejected_lines_are_kept_and_counted(spark, tmpdir_path):
    lines = ["id;amount;name", "1;10.50;a", "2;x;b", "3;1;c;extra", "4", "5;NULL;é", '6;2;"q;r"', "", "7;3;NULL"]
    os.makedirs(f"{tmpdir_path}/in")
    with open(f"{tmpdir_path}/in/f.csv", "w", encoding="latin-1") as f:
        f.write("\n".join(lines) + "\n")
    cfg = A.SourceConfig(5, "s", f"{tmpdir_path}/in", "CSV", "raw", "APPEND", csv=A.CsvOptions(
        delimiter=";", encoding="ISO-8859-1", skip_bad_rows=True), columns=[
            A.ColumnMapping("id", data_type="INTEGER"), A.ColumnMapping("amount", data_type="NUMBER", precision=10, scale=2), A.ColumnMapping("name")])
    target, bad = (L.VersionedTable(spark, f"{tmpdir_path}/{x}") for x in ("t", "bad"))
    run = A.load_raw_table(spark, cfg, target, "2024-01-01 00:00:00", bad)
    assert (run["status"], run["rows_staged"], run["rows_rejected"]) == ("SUCCESS", 4, 3)
    assert run["rows_staged"] + run["rows_rejected"] == sum(1 for x in lines[1:] if x)
    assert sorted((r.id, r.name) for r in target.read().collect()) == [(1, "a"), (5, "é"), (6, "q;r"), (7, None)]
    assert sorted((r.raw_line, r.reason, r.file_name) for r in bad.read().collect()) == [
        ("2;x;b", "type of amount", "f.csv"), ("3;1;c;extra", "number of cells", "f.csv"), ("4", "number of cells", "f.csv")]


def test_a_killed_load_is_reported(spark, tmpdir_path, monkeypatch):
    spark.range(3).selectExpr("id AS k").write.parquet(f"{tmpdir_path}/in")
    cfg = A.SourceConfig(1, "s", f"{tmpdir_path}/in", "PARQUET", "raw", "APPEND", columns=[A.ColumnMapping("k", data_type="INTEGER")])
    log, target = A.RunLog(L.VersionedTable(spark, f"{tmpdir_path}/log")), L.VersionedTable(spark, f"{tmpdir_path}/t")
    assert log.history().count() == 0

    def killed(*a):
        raise KeyboardInterrupt
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(A, "staged_frame", killed)
        A.load_raw_table(spark, cfg, target, "2024-01-01 00:00:00", log=log)
    A.load_raw_table(spark, cfg, target, "2024-01-01 00:00:00", log=log)
    assert sorted((r.status, r.rows_inserted) for r in log.history().collect()) == [("DIED", None), ("SUCCESS", 3)]


def test_array_files_are_read_in_ranges(spark, tmpdir_path):
    rng = random.Random(4)
    texts = ['pl,ain', 'q"uo\\te"', '[,]{"}', "", "line\nbreak", "é🙂,", "\\", "},{", '"],"']
    docs = [{"id": i, "s": rng.choice(texts) * rng.randint(1, 9), "sub": {"a": [rng.randint(0, 9) for _ in range(rng.randint(0, 6))],
             "t": rng.choice(texts)}} for i in range(400)]
    os.makedirs(f"{tmpdir_path}/in")
    for name, some, how in (("a", docs[:250], {"indent": 1}), ("b", docs[250:399], {}), ("c", docs[399:], {"ensure_ascii": False}), ("d", [], {})):
        with open(f"{tmpdir_path}/in/{name}.json", "w", encoding="utf-8") as f:
            json.dump(some, f, **how)
    with open(f"{tmpdir_path}/in/e.json", "w", encoding="utf-8") as f:
        f.write(' {"id": 1000, "s": "one, object", "sub": {"a": [1, 2], "t": null}}\n')
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (700, 1 << 20):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            got = sorted((json.loads(r.text) for r in array_elements(spark, f"{tmpdir_path}/in").collect()), key=lambda d: d["id"])
            assert got == [*docs, {"id": 1000, "s": "one, object", "sub": {"a": [1, 2], "t": None}}]
            if size == 700:
                raw = spark.read.option("lineSep", ",").text(f"{tmpdir_path}/in/a.json")
                assert raw.rdd.getNumPartitions() > 20
        st = spark.createDataFrame([], "id long, s string, sub struct<a: array<long>, t: string>").schema
        whole = spark.read.schema(st).option("multiLine", True).json(f"{tmpdir_path}/in")
        assert rows(read_json_array(spark, f"{tmpdir_path}/in", st).select("id", "s")) == rows(whole.select("id", "s"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("parts", [1, 7])
def test_percentiles_from_counted_values(spark, parts):
    import numpy as np
    rng = random.Random(8)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, 1.5, 2.0, 2.0, 7.25, float(rng.randint(0, 99))])) for _ in range(600)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: (r.p50, r.p95) for r in Q.grouped_percentiles(df, ["g"], {"p50": ("v", 0.5), "p95": ("v", 0.95)}, parts).collect()}
    for g in ("a", "b", None, "one"):
        v = [x for h, x in data if h == g and x is not None]
        assert np.allclose(got[g], [np.percentile(v, 50), np.percentile(v, 95)]), g
    assert "none" not in got


def test_grouped_summary_equals_plain_aggregates(spark):
    rng = random.Random(5)
    data = [(rng.choice(["x", "y", None]), rng.choice([None, *range(8)]), rng.choice([None, *"abcd"]), rng.choice([None, 1.0, 2.5, 4.0]), rng.random() < 0.3)
            for _ in range(500)]
    df = spark.createDataFrame(data, "g string, i int, j string, v double, f boolean")
    got = Q.grouped_summary(df, ["g"], {"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")},
                            {"di": ("i", None), "dif": ("i", F.col("f")), "djv": ("j", F.col("v") > 2)}, {"med": ("v", 0.5), "p9": ("v", 0.9)})
    want = df.groupBy("g").agg(F.count("v"), F.sum("v"), F.min("v"), F.max("v"), F.countDistinct("i"), F.countDistinct(F.when(F.col("f"), F.col("i"))),
                               F.countDistinct(F.when(F.col("v") > 2, F.col("j"))), F.percentile("v", 0.5), F.percentile("v", 0.9))

    def key(r):
        return tuple(str(round(x, 9) if isinstance(x, float) else x) for x in r)
    assert Counter(map(key, got.collect())) == Counter(map(key, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "percentile" not in plan


@pytest.mark.parametrize("parts", [1, 5])
def test_percent_ranks_equal_the_window_function(spark, parts):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, 0.0, 0.0, -2.5, 1e9, float(rng.randint(0, 60))]), rng.choice([None, rng.randint(1, 9)]))
            for _ in range(500)] + [("one", 1.0, 1), ("nulls", None, None), ("nulls", None, None)]
    df = spark.createDataFrame(data, "g string, v double, n int")
    by = Window.partitionBy("g")
    want = df.withColumn("rv", F.percent_rank().over(by.orderBy(F.col("v").asc_nulls_last()))).withColumn(
        "rn", F.percent_rank().over(by.orderBy(F.col("n").desc_nulls_first())))
    got = Q.percent_ranks(df, ["g"], {"rv": ("v", False), "rn": ("n", True)}, parts)
    assert got.columns == want.columns
    assert Counter(got.collect()) == Counter(want.collect())


def test_reports_on_committed_marts_compute_no_mart(spark, tmpdir_path):
    from hospiq.plans import reports as O
    from hospiq.plans.build import build_all, served
    names = ["clinical_quality_metrics", "provider_performance"]
    build_all(spark, SF_SMALL, out_base=f"{tmpdir_path}/served", marts=names, shared=["provider_summary"])
    direct = Warehouse(spark, SF_SMALL)
    on = served(direct, f"{tmpdir_path}/served", names)
    got = O.clinical_latest_day(on.clinical_quality_metrics)
    assert rows(got) == rows(O.clinical_latest_day(direct.clinical_quality_metrics))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "Join" not in plan
    assert rows(on.provider_performance.select(*direct.provider_performance.columns)) == rows(direct.provider_performance)
    empty = O.clinical_latest_day(on.clinical_quality_metrics.filter("false")).collect()
    assert len(empty) == 1 and set(empty[0]) == {None}
