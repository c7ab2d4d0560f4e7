"""Storage-level incremental operators: versioned tables, idempotence, SCD2."""
import datetime as dt

from pyspark.sql import functions as F

from hospiq.operators import state as L
from hospiq.operators.checks import validation_report

from .conftest import rows


def _table(spark, tmpdir_path, name):
    return L.VersionedTable(spark, f"{tmpdir_path}/{name}")


def test_versioned_table_commit_and_read(spark, tmpdir_path):
    t = _table(spark, tmpdir_path, "t")
    assert t.read() is None
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.commit(spark.createDataFrame([(1, "b")], "k int, v string"))
    assert t.current_version() == 2
    assert rows(t.read()) == [(1, "b")]
    assert rows(t.read(1)) == [(1, "a")]          # old versions stay readable


def test_merge_is_idempotent_and_counts(spark, tmpdir_path):
    t = _table(spark, tmpdir_path, "billing")
    base = spark.createDataFrame([("T1", "Pending", dt.datetime(2024, 1, 1)), ("T2", "Paid", dt.datetime(2024, 1, 1))],
                                 "transaction_id string, status string, loaded timestamp_ntz")
    L.incremental_merge(t, base, ["transaction_id"], order_by=["loaded"])
    upd = spark.createDataFrame([("T1", "Paid", dt.datetime(2024, 1, 2)), ("T1", "Denied", dt.datetime(2024, 1, 3)),
                                 ("T3", "Pending", dt.datetime(2024, 1, 2))],
                                "transaction_id string, status string, loaded timestamp_ntz")
    r1 = L.incremental_merge(t, upd, ["transaction_id"], order_by=["loaded"])
    assert (r1["rows_inserted"], r1["rows_updated"]) == (1, 1)
    after1 = rows(t.read())
    L.incremental_merge(t, upd, ["transaction_id"], order_by=["loaded"])   # re-delivery
    assert rows(t.read()) == after1
    assert ("T1", "Denied", dt.datetime(2024, 1, 3)) in after1            # latest re-delivered row wins


def test_delete_insert_watermark(spark, tmpdir_path):
    t = _table(spark, tmpdir_path, "enc")
    v1 = spark.createDataFrame([("E1", 1, dt.datetime(2024, 1, 1)), ("E2", 1, dt.datetime(2024, 1, 1))],
                               "encounter_id string, los int, loaded timestamp_ntz")
    L.incremental_delete_insert(t, v1, ["encounter_id"], "loaded")
    v2 = v1.unionByName(spark.createDataFrame([("E2", 5, dt.datetime(2024, 1, 5)), ("E3", 2, dt.datetime(2024, 1, 5))],
                                              "encounter_id string, los int, loaded timestamp_ntz"))
    L.incremental_delete_insert(t, v2.filter((F.col("encounter_id") != "E2") | (F.col("los") == 5)),
                                ["encounter_id"], "loaded")
    assert [r[:2] for r in rows(t.read())] == [("E1", 1), ("E2", 5), ("E3", 2)]


def test_scd2_hard_delete_and_return(spark):
    s = "hospital_id string, tier string"
    h = L.scd2_snapshot(None, spark.createDataFrame([("H1", "A"), ("H2", "B")], s), "hospital_id", "2024-01-01 00:00:00")
    h = L.scd2_snapshot(h, spark.createDataFrame([("H1", "A2")], s), "hospital_id", "2024-02-01 00:00:00",
                        check_cols=["tier"])
    h = L.scd2_snapshot(h, spark.createDataFrame([("H1", "A2"), ("H2", "B")], s), "hospital_id",
                        "2024-03-01 00:00:00", check_cols=["tier"])
    got = rows(h, "hospital_id", "tier", "dbt_valid_from", "dbt_valid_to")
    d = dt.datetime
    assert got == [("H1", "A", d(2024, 1, 1), d(2024, 2, 1)), ("H1", "A2", d(2024, 2, 1), None),
                   ("H2", "B", d(2024, 1, 1), d(2024, 2, 1)), ("H2", "B", d(2024, 3, 1), None)]
    assert rows(L.current_rows(h), "hospital_id") == [("H1",), ("H2",)]
    assert rows(L.as_of_rows(h, "2024-02-15 00:00:00"), "hospital_id", "tier") == [("H1", "A2")]


def test_offboard_tenant_evidence(spark, tmpdir_path):
    t = _table(spark, tmpdir_path, "x")
    t.commit(spark.createDataFrame([("HOSP_0001", 1), ("HOSP_0002", 2), ("HOSP_0001", 3)], "hospital_id string, v int"))
    log = L.offboard_tenant(spark, {"x": t}, "HOSP_0001")
    assert rows(log) == [("x", "HOSP_0001", 2, 0)]
    assert rows(t.read()) == [("HOSP_0002", 2)]


def test_backfill_guarded_by_validation(spark, tmpdir_path):
    t = _table(spark, tmpdir_path, "bf")
    sch = "encounter_id string, hospital_id string, patient_id string, admission_date timestamp_ntz, total_charges double"
    batch = spark.createDataFrame([("E1", "H", "P1", dt.datetime(2025, 7, 2), 10.0),
                                   ("E2", "H", "P2", dt.datetime(2025, 8, 2), 5.5)], sch)
    patients = spark.createDataFrame([("P1", "H"), ("P2", "H")], "patient_id string, hospital_id string")
    rep = validation_report(batch, patients, "2025-07-01", "2025-12-31")
    assert {r["status"] for r in rep.collect()} == {"PASS"}
    s = L.backfill(t, batch, rep).first()
    assert (s["status"], s["rows_before"], s["rows_after"], s["months_filled"]) == ("APPLIED", 0, 2, 2)
    bad = validation_report(batch, patients.limit(1), "2025-07-01", "2025-12-31")
    s2 = L.backfill(t, batch, bad).first()
    assert (s2["status"], s2["rows_after"]) == ("REJECTED", 2)


def test_append_writes_only_the_new_rows(spark, tmpdir_path):
    import os
    t = _table(spark, tmpdir_path, "ap")
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    before = {f for d, _, n in os.walk(t.base + "/data") for f in (os.path.join(d, x) for x in n)}
    t.append(spark.createDataFrame([(2, "b")], "k int, v string"))
    new = [f for d, _, n in os.walk(t.base + "/data") for f in (os.path.join(d, x) for x in n) if f not in before]
    assert rows(t.read()) == [(1, "a"), (2, "b")]
    assert sum(spark.read.parquet(f).count() for f in new if f.endswith(".parquet")) == 1
    assert rows(t.read(1)) == [(1, "a")]


def test_failed_commit_can_be_retried_and_readers_see_the_old_version(spark, tmpdir_path):
    import os

    import pytest
    t = _table(spark, tmpdir_path, "rt")
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    t.commit(good)
    bad = good.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        t.commit(bad)
    # a writer that died while it published
    with open(f"{t.base}/_manifests/{2:09d}", "w") as f:
        f.write('{"entries": [')
    assert t.current_version() == 1 and rows(t.read()) == [(1, "a")]
    assert t.commit(good.union(good)) == 3 and t.read().count() == 2
    assert t.retain(1) >= 1 and t.read().count() == 2
    assert os.path.isdir(t.base + "/data")


def test_two_writers_do_not_overwrite_each_other(spark, tmpdir_path):
    import pytest
    t = _table(spark, tmpdir_path, "two")
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(RuntimeError):
        t._publish([], 0)


def test_bucketed_merge_rewrites_touched_buckets_only(spark, tmpdir_path):
    t = L.VersionedTable(spark, f"{tmpdir_path}/b", key=("k",), buckets=8)
    t.commit(spark.range(100).selectExpr("cast(id as int) k", "'old' v", "1 ts"))
    L.incremental_merge(t, spark.createDataFrame([(5, "new", 2), (200, "ins", 2)], "k int, v string, ts int"), ["k"],
                        order_by=["ts"])
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 101 and got[5] == "new" and got[200] == "ins" and sum(v == "old" for v in got.values()) == 99
    entries = t._load(t.current_version())
    assert len(entries) == 2 and len(entries[0]["buckets"]) + len(entries[1]["buckets"]) == 8
    t.append(spark.createDataFrame([(300, "app", 3)], "k int, v string, ts int"))
    L.incremental_delete_insert(t, spark.createDataFrame([(300, "again", 4)], "k int, v string, ts int"), ["k"], "ts")
    assert {r.k: r.v for r in t.read().collect()}[300] == "again" and t.read().count() == 102


def test_merge_of_new_keys_rewrites_no_bucket(spark, tmpdir_path):
    import os
    schema = "k int, v string, ts int"
    t = L.VersionedTable(spark, f"{tmpdir_path}/added", key=("k",), buckets=8)
    t.commit(spark.createDataFrame([(k, "old", 5) for k in range(50)] + [(None, "none", 5)], schema))
    before = t._load(t.current_version())
    # new keys, a row older than the table's, a key without a value
    L.incremental_merge(t, spark.createDataFrame([(100, "a", 1), (100, "b", 2), (3, "late", 4), (None, "more", 6)], schema), ["k"],
                        order_by=["ts"])
    entries = t._load(t.current_version())
    assert entries[:1] == before and len(entries) == 2
    got = sorted(((r.k, r.v) for r in t.read().collect()), key=str)
    assert got == sorted([(k, "old") for k in range(50)] + [(None, "none"), (None, "more"), (100, "b")], key=str)
    L.incremental_merge(t, spark.createDataFrame([(3, "new", 5), (101, "c", 1), (4, "late", 1)], schema), ["k"], order_by=["ts"])
    got = {r.k: r.v for r in t.read().filter("k IS NOT NULL").collect()}
    assert (got[3], got[4], got[101], got[100], len(got)) == ("new", "old", "c", "b", 52) and t.read().count() == 54
    L.incremental_merge(t, spark.sql("SELECT 3 k, NULL v, 9 ts"), ["k"], order_by=["ts"])       # a column without a type
    assert [r.v for r in t.read().filter("k = 3").collect()] == [None]
    assert not os.listdir(f"{t.base}/staged")


def test_an_older_row_never_replaces_a_newer_one(spark):
    s = "k string, v string, ts timestamp_ntz"
    t = spark.createDataFrame([("a", "feb", dt.datetime(2024, 2, 1)), ("b", "jan", dt.datetime(2024, 1, 1))], s)
    n = spark.createDataFrame([("a", "late", dt.datetime(2024, 1, 1)), ("b", "mar", dt.datetime(2024, 3, 1)),
                               ("b", "feb", dt.datetime(2024, 2, 1)), ("c", "new", dt.datetime(2024, 1, 1))], s)
    assert rows(L.upsert(t, n, ["k"], ["ts"]), "k", "v") == [("a", "feb"), ("b", "mar"), ("c", "new")]


def test_merge_without_an_order_refuses_duplicates(spark, tmpdir_path):
    import pytest
    t = _table(spark, tmpdir_path, "dup")
    t.commit(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(ValueError, match="several rows"):
        L.incremental_merge(t, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"])
