"""Production build: shared models materialized once, marts equal to the direct plans."""
from hospiq.operators.state import VersionedTable
from hospiq.plans.build import build_all
from hospiq.plans.models import Warehouse
from hospiq.session import checkpoint_dir

from .conftest import SF_SMALL, rows


def test_checkpoint_dir_reads_session_setting(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_build_all_matches_direct_marts(spark, tmpdir_path):
    log = build_all(spark, SF_SMALL, out_base=f"{tmpdir_path}/build",
                    marts=["clinical_quality_metrics", "population_health", "financial_performance"])
    got = {r["model"]: r["path"] for r in log.collect() if r["kind"] == "mart"}
    direct = Warehouse(spark, SF_SMALL)
    for name, path in got.items():
        built = VersionedTable(spark, path).read()
        want = getattr(direct, name)
        assert rows(built.select(*want.columns)) == rows(want), name


def test_incremental_facts_equal_the_full_build(spark, tmpdir_path):
    """Two loads leave the facts as one full build does, and nothing old is rewritten by an append."""
    names = ["fct_encounters", "fct_billing_transactions", "hipaa_audit_trail"]
    for _ in range(2):
        log = build_all(spark, SF_SMALL, out_base=f"{tmpdir_path}/inc", marts=names, shared=[], key_buckets=4, snapshot_at="2001-08-05 00:00:00")
    got = {r["model"]: VersionedTable(spark, r["path"]).read() for r in log.collect()}
    direct = Warehouse(spark, SF_SMALL)
    for name in names:
        want = getattr(direct, name)
        assert rows(got[name].select(*want.columns)) == rows(want), name
    assert got["snap_hospitals"].count() == direct.hospitals.count()


def test_shuffles_start_with_partitions_in_step_with_the_input(spark, tmp_path, monkeypatch):
    from hospiq import session
    folder = str(tmp_path / "tables")
    spark.range(20000).write.parquet(f"{folder}/orders.parquet")
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    names = [name, "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = {x: spark.conf.get(x, None) for x in names}
    try:
        session.size_shuffles(spark, folder)
        least = int(spark.conf.get(name))
        monkeypatch.setattr(session, "SHUFFLE_INPUT_BYTES", 2000)
        session.size_shuffles(spark, folder)
        assert least == int(spark.conf.get("spark.sql.shuffle.partitions")) < int(spark.conf.get(name))
    finally:
        for x, v in before.items():
            spark.conf.unset(x) if v is None else spark.conf.set(x, v)


def test_daily_marts_repeat_no_row_for_a_distinct_count(spark):
    from hospiq.plans.models import Warehouse

    from .conftest import SF_SMALL
    w = Warehouse(spark, SF_SMALL)
    for df in (w.clinical_quality_metrics, w.operational_metrics):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
