"""Ingestion (A) and micro-batch streaming (P) operators on files derived from driver rows."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hospiq.operators.state import VersionedTable
from hospiq.sources import ingest as A
from hospiq.sources.adapters import HospitalSource
from hospiq.sources.schemas import SchemaDriftError, conform
from hospiq.streaming import micro_batch as P

from .conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def src(spark):
    return HospitalSource(spark, SF_SMALL)


def test_conform_detects_drift(spark, src):
    enc = src.encounters
    ok = conform(enc.drop("_source_updated_at"), "raw_encounters")
    assert ok.columns[-1] == "_source_updated_at"
    assert ok.filter(F.col("_source_updated_at").isNotNull()).count() == 0
    with pytest.raises(SchemaDriftError):
        conform(enc.withColumn("unexpected", F.lit(1)), "raw_encounters")
    with pytest.raises(SchemaDriftError):
        conform(enc.drop("encounter_type"), "raw_encounters")


def test_csv_roundtrip_and_options(spark, src, tmpdir_path):
    enc = conform(src.encounters, "raw_encounters")
    path = f"{tmpdir_path}/enc_csv"
    (enc.withColumn("admission_source", F.concat(F.lit("  "), F.col("admission_source"), F.lit(" ")))
     .write.option("header", True).option("sep", "|").option("nullValue", "NULL").csv(path))
    back = A.read_csv(spark, path, "raw_encounters", A.CsvOptions(delimiter="|"))
    assert back.count() == enc.count()
    assert rows(back, "encounter_id", "admission_source", "total_charges") == rows(
        enc, "encounter_id", "admission_source", "total_charges")
    out = f"{tmpdir_path}/enc_parquet"
    assert A.csv_to_parquet(spark, path, "raw_encounters", out, A.CsvOptions(delimiter="|")) == enc.count()


def test_json_outer_array(spark, tmpdir_path):
    p = f"{tmpdir_path}/payers.json"
    with open(p, "w") as f:
        f.write('[{"payer_id": "P1", "payer_name": "A", "payer_type": "Commercial", "reimbursement_rate": 0.5,'
                ' "is_active": true}, {"payer_id": "P2", "payer_name": "B"}]')
    df = A.read_json(spark, p, "raw_payers")
    assert rows(df, "payer_id", "is_active") == [("P1", True), ("P2", None)]


def test_config_driven_load_merge_and_failure_isolation(spark, src, tmpdir_path):
    landing = f"{tmpdir_path}/landing_orders"
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.filter(F.col("o_orderkey") < 100).write.parquet(f"{landing}/batch1")
    cols = [A.ColumnMapping("encounter_id", transformation_rule="concat('ENC_', cast(o_orderkey as string))",
                            is_primary_key=True),
            A.ColumnMapping("total_charges", "o_totalprice", "NUMBER", precision=12, scale=2),
            A.ColumnMapping("encounter_type", default_value="Inpatient"),
            A.ColumnMapping("row_uuid", default_value="UUID_STRING()")]
    cfg = A.SourceConfig(1, "orders", f"{landing}/batch1", "PARQUET", "raw_encounters_small", "MERGE",
                         merge_key_fields=" encounter_id ", columns=cols)
    bad = A.SourceConfig(2, "broken", f"{landing}/does_not_exist", "PARQUET", "raw_other", "APPEND", columns=cols)
    targets = {"raw_encounters_small": VersionedTable(spark, f"{tmpdir_path}/t1"),
               "raw_other": VersionedTable(spark, f"{tmpdir_path}/t2")}
    log = A.load_all_active_sources(spark, [bad, cfg], targets, "2024-01-01 00:00:00")
    status = {r["source_name"]: r["status"] for r in log.collect()}
    assert status == {"orders": "SUCCESS", "broken": "FAILED"}
    t = targets["raw_encounters_small"].read()
    assert t.count() == 100 and t.select("row_uuid").distinct().count() == 100
    # re-delivery of an overlapping batch: merge updates 50, inserts 50
    orders.filter((F.col("o_orderkey") >= 50) & (F.col("o_orderkey") < 150)).write.parquet(f"{landing}/batch2")
    cfg2 = A.SourceConfig(1, "orders", f"{landing}/batch2", "PARQUET", "raw_encounters_small", "MERGE",
                          merge_key_fields="encounter_id", columns=cols)
    run = A.load_raw_table(spark, cfg2, targets["raw_encounters_small"], "2024-01-02 00:00:00")
    assert (run["status"], run["rows_inserted"], run["rows_updated"]) == ("SUCCESS", 50, 50)
    assert targets["raw_encounters_small"].read().count() == 150


def test_idempotence_probe_seed_and_export(spark, src, tmpdir_path):
    enc = src.encounters
    assert A.window_already_loaded(enc, "encounter_id", "ENC_1")
    assert not A.window_already_loaded(enc, "encounter_id", "ENC_X")
    t = VersionedTable(spark, f"{tmpdir_path}/seed")
    r1 = A.seed_empty_targets({"enc": (enc, t)})
    r2 = A.seed_empty_targets({"enc": (enc, t)})
    assert r1[0][1] == "SEEDED" and r2[0][1] == "SKIPPED_NOT_EMPTY" and t.current_version() == 1
    out = f"{tmpdir_path}/export"
    A.export_tenant(enc, "HOSP_0001", out)
    assert spark.read.parquet(out).select("hospital_id").distinct().collect()[0][0] == "HOSP_0001"


def test_batch_window():
    s, e, tag = P.batch_window(dt.datetime(2026, 11, 27, 15, 42))
    assert (s, e, tag) == (dt.datetime(2026, 11, 27, 12), dt.datetime(2026, 11, 27, 15), "2026112715")


def test_streaming_ingest_available_now_is_idempotent(spark, src, tmpdir_path):
    landing = f"{tmpdir_path}/stream_landing"
    enc = conform(src.encounters, "raw_encounters")
    enc.filter(F.col("admission_date") < F.lit("1998-01-01").cast("timestamp_ntz")).write.parquet(f"{landing}/f1")
    target = VersionedTable(spark, f"{tmpdir_path}/stream_target")
    ck = f"{tmpdir_path}/ckpt"
    log = []
    P.incremental_file_ingest(spark, landing + "/*", "raw_encounters", target, ["encounter_id"], ck, log).awaitTermination()
    n1 = target.read().count()
    enc.filter(F.col("admission_date") >= F.lit("1998-01-01").cast("timestamp_ntz")).write.parquet(f"{landing}/f2")
    P.incremental_file_ingest(spark, landing + "/*", "raw_encounters", target, ["encounter_id"], ck, log).awaitTermination()
    P.incremental_file_ingest(spark, landing + "/*", "raw_encounters", target, ["encounter_id"], ck, log).awaitTermination()
    assert target.read().count() == enc.count() > n1
    assert sum(x["rows"] for x in log) == enc.count()        # each file processed exactly once


def test_streaming_window_counts_match_batch(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = f"{tmpdir_path}/events_landing"
    ev.write.parquet(path)
    stream = spark.readStream.schema(ev.schema).parquet(path)
    q = (P.windowed_counts(stream, "ts", 3, ("event_type",)).writeStream.outputMode("complete")
         .format("memory").queryName("wc_test").trigger(availableNow=True).start())
    q.awaitTermination()
    got = rows(spark.table("wc_test"))
    want = rows(P.windowed_counts(ev, "ts", 3, ("event_type",)))
    assert got == want


def test_json_arrays_are_written_in_several_files(spark, tmp_path, monkeypatch):
    import glob

    from hospiq import registry
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i, i * 3, f"{i % 5}-P, [{i}] \"") for i in range(40)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    monkeypatch.setattr(registry, "_ARRAY_DOCUMENTS", 15)
    monkeypatch.setattr(registry, "_scratch", lambda w, name: out)
    got = registry.QUERIES["a04_json_array"](spark, folder).collect()
    assert sorted(tuple(r) for r in got) == [(k, 'a "b", [c] {' + p, c) for k, c, p in rows]
    assert len(glob.glob(f"{out}/part-*")) == 3
