"""Registered queries: id -> callable(spark, sf_dir) -> DataFrame.

Ids follow the SURVEY inventory (lower case). Every query reads the driver
tables of ``sf_dir`` through the adapters, so its work grows with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from .functions import core as fn

from .plans.models import Warehouse
from .session import size_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# held with its session, so that another session never meets a stale model graph
_WAREHOUSES: dict[SparkSession, dict[str, Warehouse]] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    size_shuffles(spark, sf_dir)
    mine = _WAREHOUSES.setdefault(spark, {})
    if sf_dir not in mine:
        mine[sf_dir] = Warehouse(spark, sf_dir)
    return mine[sf_dir]


def query(qid: str):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        QUERIES[qid] = lambda spark, sf_dir: fn(warehouse(spark, sf_dir))
        return fn
    return deco


# ------------------------------------------------------------------ marts
@query("k01_clinical_quality_metrics")
def _k01(w: Warehouse) -> DataFrame:
    return w.clinical_quality_metrics


@query("k02_early_warning_surveillance")
def _k02(w: Warehouse) -> DataFrame:
    return w.early_warning_surveillance


@query("k03_laboratory_quality")
def _k03(w: Warehouse) -> DataFrame:
    return w.laboratory_quality_metrics


@query("k11_financial_performance")
def _k11(w: Warehouse) -> DataFrame:
    return w.financial_performance


@query("k04_medication_safety_metrics")
def _k04(w: Warehouse) -> DataFrame:
    return w.medication_safety_metrics


@query("k06_cms_core_measures")
def _k06(w: Warehouse) -> DataFrame:
    return w.cms_core_measures()


@query("k06_cms_core_measures_all_cohorts")
def _k06b(w: Warehouse) -> DataFrame:
    # same mart with the minimum-denominator gate lowered to 1, so every
    # tenant-quarter cohort is reported (the default gate is 25 cases)
    return w.cms_core_measures(min_denominator=1)


@query("k07_quality_measure_performance")
def _k07(w: Warehouse) -> DataFrame:
    return w.quality_measure_performance


@query("i12_comorbidity_index")
def _i12(w: Warehouse) -> DataFrame:
    return w.comorbidity_index


@query("j07_patient_profile")
def _j07(w: Warehouse) -> DataFrame:
    return w.patient_profile.select(
        *[c for c in w.patient_profile.columns if c not in ("febrile_rate", "hypotensive_rate", "hypoxic_rate", "avg_bmi")],
        *[fn.r4(c).alias(c) for c in ("febrile_rate", "hypotensive_rate", "hypoxic_rate", "avg_bmi")])


@query("k05_population_health")
def _k05(w: Warehouse) -> DataFrame:
    return w.population_health


def _provider_summary(w: Warehouse) -> DataFrame:
    """Written once, as in the build; what reads it several times reads the written rows."""
    path = _scratch(w, "provider_summary")
    w.provider_summary.write.parquet(path)
    return w.spark.read.schema(w.provider_summary.schema).parquet(path)


@query("k08_provider_performance")
def _k08(w: Warehouse) -> DataFrame:
    from .plans import marts as K
    return K.provider_performance(_provider_summary(w))


@query("k12_prior_auth_metrics")
def _k12(w: Warehouse) -> DataFrame:
    return w.prior_authorization_metrics


@query("k14_care_coordination")
def _k14(w: Warehouse) -> DataFrame:
    return w.care_coordination_metrics


@query("k13_operational_metrics")
def _k13(w: Warehouse) -> DataFrame:
    return w.operational_metrics


@query("k09_fct_encounters")
def _k09(w: Warehouse) -> DataFrame:
    return w.fct_encounters


@query("k10_fct_billing_transactions")
def _k10(w: Warehouse) -> DataFrame:
    return _rounded_billing(w.fct_billing_transactions)


def _rounded_billing(f: DataFrame) -> DataFrame:
    money = ["charge_amount", "payment_amount", "adjustment_amount", "collected_amount", "denied_amount",
             "expected_payment", "payment_variance"]
    return f.select(*[fn.r4(c).alias(c) if c in money + ["collection_rate_pct", "expected_reimbursement_rate"]
                      else F.col(c) for c in f.columns])


@query("k15_sla_monitoring")
def _k15(w: Warehouse) -> DataFrame:
    return w.sla_monitoring


@query("k16_cost_attribution")
def _k16(w: Warehouse) -> DataFrame:
    return w.cost_attribution


@query("k17_hipaa_audit_trail")
def _k17(w: Warehouse) -> DataFrame:
    return w.hipaa_audit_trail


# ------------------------------------------------------------------ checks (N)
from .operators import checks as N  # noqa: E402


@query("n01_not_null_age")
def _n01(w: Warehouse) -> DataFrame:
    return N.not_null(w.patients, "age_years").select("patient_id", "hospital_id")


@query("n02_unique_transaction_id")
def _n02(w: Warehouse) -> DataFrame:
    return N.unique(w.billing, "transaction_id")


@query("n03_accepted_values_payment_status")
def _n03(w: Warehouse) -> DataFrame:
    return N.accepted_values(w.billing, "payment_status", ["Paid", "Partial", "Denied", "Pending"]).select("transaction_id")


@query("n04_relationships_vitals_encounter")
def _n04(w: Warehouse) -> DataFrame:
    return N.relationships(w.vital_signs, "encounter_id", w.encounters, "encounter_id").select("vital_id", "encounter_id")


@query("n05_accepted_range_news")
def _n05(w: Warehouse) -> DataFrame:
    return N.accepted_range(w.vitals_enriched, "total_news_score", 0, 12).select("vital_id", "total_news_score")


@query("n06_unique_combination_orders")
def _n06(w: Warehouse) -> DataFrame:
    return N.unique_combination_of_columns(w.clinical_orders, ["encounter_id", "order_type"])


@query("n07_expression_zip3")
def _n07(w: Warehouse) -> DataFrame:
    return N.expression_is_true(w.patients, "zip_code_3digit rlike '^[0-9]{3}$'",
                                where="zip_code_3digit is not null").select("patient_id", "zip_code_3digit")


@query("n09_cross_tenant_leakage_raw_encounters")
def _n09(w: Warehouse) -> DataFrame:
    return N.no_cross_tenant_leakage(w.raw.encounters, w.patients, w.providers)


@query("n10_no_phi_in_conversations")
def _n10(w: Warehouse) -> DataFrame:
    conv = w.raw._t("conversations")
    return N.no_phi_in_column(conv, "text")


@query("n11_models_not_empty")
def _n11(w: Warehouse) -> DataFrame:
    return N.models_not_empty(w.spark, {"stg_healthcare__encounters": w.encounters,
                                        "stg_healthcare__patients": w.patients, "fct_encounters": w.fct_encounters})


@query("n12_critical_lab_response")
def _n12(w: Warehouse) -> DataFrame:
    return N.critical_lab_response(w.lab_results_enriched, w.clinical_orders, f"{w.as_of} 00:00:00")


@query("n13_los_by_encounter_type")
def _n13(w: Warehouse) -> DataFrame:
    return N.los_by_encounter_type(w.encounters)


@query("n14_los_with_issue")
def _n14(w: Warehouse) -> DataFrame:
    return N.los_with_issue(w.encounters)


@query("n15_high_risk_unverified")
def _n15(w: Warehouse) -> DataFrame:
    return N.high_risk_unverified(w.medication_administration)


@query("n16_iv_without_witness")
def _n16(w: Warehouse) -> DataFrame:
    return N.iv_without_witness(w.medication_administration)


@query("n17_cross_hospital_encounters")
def _n17(w: Warehouse) -> DataFrame:
    return N.cross_hospital_encounters(w.raw.encounters, w.patients, w.providers, w.facilities)


@query("n18_given_despite_allergy")
def _n18(w: Warehouse) -> DataFrame:
    return N.given_despite_allergy(w.medication_administration, w.patient_allergies)


@query("n19_recent_unauthorized_access")
def _n19(w: Warehouse) -> DataFrame:
    return N.recent_unauthorized_access(w.hipaa_audit_trail, f"{w.event_as_of} 00:00:00")


@query("n20_readmission_recomputation")
def _n20(w: Warehouse) -> DataFrame:
    return N.readmission_recomputation(w.encounters)


@query("n21_readmission_rate_in_range")
def _n21(w: Warehouse) -> DataFrame:
    return N.readmission_rate_in_range(w.encounters)


# every load of every tenant is a batch: its window is the quarter of the load time
def _load_batches(w: Warehouse) -> DataFrame:
    e = w.raw.encounters
    return e.withColumn("window_start", F.to_date(F.date_trunc("quarter", "_loaded_at")))


# The same checks on inputs with faults that follow from the data (ids ending
# in 7 or 77), so that each is shown to find what it looks for.
def _faulty(column: str, ending: str):
    return F.col(column).cast("string").endswith(ending)


@query("n02_unique_after_redelivery")
def _n02f(w: Warehouse) -> DataFrame:
    b = w.billing.select("transaction_id")
    return N.unique(b.unionByName(b.filter(_faulty("transaction_id", "7"))), "transaction_id")


@query("n03_accepted_values_unknown_status")
def _n03f(w: Warehouse) -> DataFrame:
    b = w.billing.withColumn("payment_status", F.when(_faulty("transaction_id", "7"), "Unknown").otherwise(F.col("payment_status")))
    return N.accepted_values(b, "payment_status", ["Paid", "Partial", "Denied", "Pending"]).select("transaction_id")


@query("n05_accepted_range_news_shifted")
def _n05f(w: Warehouse) -> DataFrame:
    v = w.vitals_enriched.withColumn("total_news_score", F.col("total_news_score") + F.when(_faulty("vital_id", "7"), 13).otherwise(0))
    return N.accepted_range(v, "total_news_score", 0, 12).select("vital_id", "total_news_score")


@query("n07_expression_zip3_unmasked")
def _n07f(w: Warehouse) -> DataFrame:
    p = w.patients.withColumn("zip_code_3digit", F.when(_faulty("patient_id", "7"), F.concat("zip_code_3digit", F.lit("01")))
                              .otherwise(F.col("zip_code_3digit")))
    return N.expression_is_true(p, "zip_code_3digit rlike '^[0-9]{3}$'",
                                where="zip_code_3digit is not null").select("patient_id", "zip_code_3digit")


@query("n10_phi_in_documents")
def _n10f(w: Warehouse) -> DataFrame:
    return N.phi_in_text(w.raw._t("documents"), "doc_id", "text")


@query("n11_models_empty_for_unknown_tenant")
def _n11f(w: Warehouse) -> DataFrame:
    ctx = M.AccessContext(role="HOSPITAL_HOSP_9999_ANALYST", user="USER_7")
    return N.models_not_empty(w.spark, {"stg_healthcare__encounters": M.secure_view("raw_encounters", w.encounters.select(*_ENC_COLS), ctx),
                                        "stg_healthcare__patients": w.patients})


def _long_stays(w: Warehouse) -> DataFrame:
    e = w.encounters
    return e.withColumn("length_of_stay", F.when(_faulty("encounter_id", "7"), F.col("length_of_stay") + 400)
                        .when(_faulty("encounter_id", "3"), -F.col("length_of_stay") - 1).otherwise(F.col("length_of_stay")))


@query("n13_los_by_encounter_type_faulty")
def _n13f(w: Warehouse) -> DataFrame:
    return N.los_by_encounter_type(_long_stays(w))


@query("n14_los_with_issue_faulty")
def _n14f(w: Warehouse) -> DataFrame:
    return N.los_with_issue(_long_stays(w))


@query("n21_readmission_rate_tight_range")
def _n21f(w: Warehouse) -> DataFrame:
    return N.readmission_rate_in_range(w.encounters, low=99, high=100, min_encounters=10)


@query("k15_sla_monitoring_late_sources")
def _k15f(w: Warehouse) -> DataFrame:
    from .plans import marts as K
    late = (F.when(_faulty("hospital_id", "3"), F.expr("INTERVAL 5 HOURS")).when(_faulty("hospital_id", "7"), F.expr("INTERVAL 10 HOURS"))
            .otherwise(F.expr("INTERVAL 0 HOURS")))
    e = w.encounters.withColumn("source_updated_at_timestamp", F.col("source_updated_at_timestamp") - late)
    return K.sla_monitoring(e, w.patients, w.billing, w.fct_encounters, f"{w.as_of} 00:00:00")


@query("n22_validation_report_all_fail")
def _n22f(w: Warehouse) -> DataFrame:
    """Every batch twice, with admissions of unknown patients a year too late."""
    b = _load_batches(w)
    stray = (b.filter(_faulty("encounter_id", "7")).withColumn("patient_id", F.concat(F.lit("X"), "patient_id"))
             .withColumn("admission_date", F.col("admission_date") + F.expr("INTERVAL 365 DAYS")))
    return N.validation_by_batch(b.unionByName(b).unionByName(stray), w.raw.patients)


@query("n22_validation_report")
def _n22(w: Warehouse) -> DataFrame:
    return N.validation_by_batch(_load_batches(w), w.raw.patients)


@query("n23_load_profile")
def _n23(w: Warehouse) -> DataFrame:
    # an earlier, partial load reached into the window
    existing = w.raw.encounters.filter(F.to_date("admission_date") < "2000-10-01")
    return N.profile_by_batch(_load_batches(w), existing, w.raw.patients, w.raw.providers, w.raw.facilities)


@query("n24_completeness_by_month")
def _n24(w: Warehouse) -> DataFrame:
    return N.completeness_by_month(w.raw.encounters)


# ------------------------------------------------------------------ security (M)
from .operators import security as M  # noqa: E402

_ENC_COLS = ["encounter_id", "hospital_id", "patient_id", "encounter_type", "admission_date"]


@query("m01_tenant_row_filter")
def _m01(w: Warehouse) -> DataFrame:
    ctx = M.AccessContext(role="HOSPITAL_HOSP_0007_ANALYST", user="USER_7")
    return M.secure_view("raw_encounters", w.encounters.select(*_ENC_COLS), ctx)


@query("m02_mapped_row_filter")
def _m02(w: Warehouse) -> DataFrame:
    ctx = M.AccessContext(role="HOSPITAL_ANALYST", user="USER_2", as_of=w.event_as_of)
    return M.secure_view("raw_encounters", w.encounters.select(*_ENC_COLS), ctx, w.raw.user_hospital_mapping)


@query("m03_phi_row_filter")
def _m03(w: Warehouse) -> DataFrame:
    ctx = M.AccessContext(role="HOSPITAL_HOSP_0005_PHI_ANALYST", user="USER_5")
    return M.secure_view("raw_patients", w.patients.select("patient_id", "hospital_id", "age_years", "zip_code_3digit"), ctx)


@query("m09_dataset_page")
def _m09(w: Warehouse) -> DataFrame:
    ctx = M.AccessContext(role="SYSADMIN")
    return M.dataset_page(w, "clinical-quality", ctx, start_date="1998-01-01", end_date="1999-12-31",
                          limit=200, offset=20)


@query("o10_visible_tenants_per_role")
def _o10(w: Warehouse) -> DataFrame:
    ctx = M.AccessContext(role="HOSPITAL_ANALYST", user="USER_8", as_of=w.event_as_of)
    return M.visible_tenants(w.encounters, ctx, w.raw.user_hospital_mapping)


# ------------------------------------------------------------------ state (L)
from .operators import state as L  # noqa: E402
from .plans import staging as B  # noqa: E402


@query("l01_delete_insert_encounters")
def _l01(w: Warehouse) -> DataFrame:
    fct = w.fct_encounters
    target = fct.filter(F.col("loaded_at_timestamp") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return L.delete_insert(target, fct, ["encounter_id"], "loaded_at_timestamp").select(
        "encounter_id", "hospital_id", "loaded_at_timestamp")


def _billing_changes(w: Warehouse) -> DataFrame:
    """Re-delivered billing rows: the second half of 1998 re-sent with every
    Pending claim now Partial, plus 1999+ rows (new)."""
    b = w.billing.filter(F.col("transaction_date") >= F.lit("1998-07-01").cast("timestamp_ntz"))
    return b.withColumn("payment_status", F.when(F.col("payment_status") == "Pending", "Partial")
                        .otherwise(F.col("payment_status")))


@query("l02_upsert_billing")
def _l02(w: Warehouse) -> DataFrame:
    target = w.billing.filter(F.col("transaction_date") < F.lit("1999-01-01").cast("timestamp_ntz"))
    out = L.upsert(target.select("transaction_id", "hospital_id", "payment_status", "loaded_at_timestamp"),
                   _billing_changes(w), ["transaction_id"], ["loaded_at_timestamp"])
    return out


@query("l02_upsert_counts")
def _l02c(w: Warehouse) -> DataFrame:
    target = w.billing.filter(F.col("transaction_date") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return L.upsert_counts(target, _billing_changes(w), ["transaction_id"])


@query("l03_append_new_audit")
def _l03(w: Warehouse) -> DataFrame:
    log = K_phi_log(w)
    target = log.filter(F.col("access_timestamp") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return L.append_new(target, log, "access_timestamp").select("query_id", "access_timestamp")


def K_phi_log(w: Warehouse) -> DataFrame:
    from .plans import marts as K
    return K.phi_access_log(w.raw.query_history, None, w.raw.CURRENT_DATABASE)


def _scratch(w: Warehouse, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    import uuid

    from .session import checkpoint_dir
    return f"{checkpoint_dir(w.spark)}/{name}/{uuid.uuid4().hex}"


def _hospital_snapshots(w: Warehouse):
    """Two snapshot runs of the tenant master: the second changes the tier of
    every 5th tenant, the bed count of every 7th, and drops the last one."""
    h1 = w.hospitals.select("hospital_id", "hospital_name", "bed_count", "contract_tier", "is_active")
    n = F.substring("hospital_id", 6, 4).cast("int")
    h2 = (h1.withColumn("contract_tier", F.when(n % 5 == 0, F.lit("Enterprise Plus")).otherwise(F.col("contract_tier")))
          .withColumn("bed_count", F.when(n % 7 == 0, F.col("bed_count") + 20).otherwise(F.col("bed_count")))
          .filter(n != 24))
    return h1, h2


@query("l04_scd2_check_strategy")
def _l04(w: Warehouse) -> DataFrame:
    h1, h2 = _hospital_snapshots(w)
    hist = L.HistoryTable(w.spark, _scratch(w, "history"), "hospital_id", buckets=8)
    for rows, at in ((h1, "2001-01-01 00:00:00"), (h2, "2001-06-01 00:00:00")):
        hist.snapshot(rows, at, check_cols=["contract_tier", "bed_count", "is_active"])
    return hist.read().drop("dbt_scd_id")


@query("l05_scd2_timestamp_strategy")
def _l05(w: Warehouse) -> DataFrame:
    p1 = w.providers.select("provider_id", "hospital_id", "specialty", "loaded_at_timestamp")
    p2 = (p1.withColumn("specialty", F.when(F.expr("cast(substring(provider_id, 5) as int) % 10 = 0"),
                                            F.lit("Hospitalist")).otherwise(F.col("specialty")))
          .withColumn("loaded_at_timestamp",
                      F.when(F.expr("cast(substring(provider_id, 5) as int) % 10 = 0"),
                             F.col("loaded_at_timestamp") + F.expr("INTERVAL 1 DAY"))
                      .otherwise(F.col("loaded_at_timestamp")))
          .filter(F.expr("cast(substring(provider_id, 5) as int) % 13 <> 0")))
    hist = L.HistoryTable(w.spark, _scratch(w, "history"), "provider_id", buckets=8)
    for rows, at in ((p1, "2001-01-01 00:00:00"), (p2, "2002-01-01 00:00:00")):
        hist.snapshot(rows, at, updated_at="loaded_at_timestamp")
    return hist.read().drop("dbt_scd_id")


@query("l06_point_in_time")
def _l06(w: Warehouse) -> DataFrame:
    h1, h2 = _hospital_snapshots(w)
    hist = L.scd2_snapshot(None, h1, "hospital_id", "2001-01-01 00:00:00")
    hist = L.scd2_snapshot(hist, h2, "hospital_id", "2001-06-01 00:00:00",
                           check_cols=["contract_tier", "bed_count", "is_active"])
    return L.as_of_rows(hist, "2001-03-01 00:00:00").select("hospital_id", "contract_tier", "bed_count")


@query("l07_insert_missing_grants")
def _l07(w: Warehouse) -> DataFrame:
    m = w.raw.user_hospital_mapping
    existing = m.filter(F.col("access_end_date") > F.lit("2024-01-01").cast("date"))
    return L.insert_missing(existing, m, ["user_name", "role_name", "hospital_id"])


@query("l08_keep_latest_lineitem")
def _l08(w: Warehouse) -> DataFrame:
    li = w.raw._t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return L.keep_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("l09_remove_tenant")
def _l09(w: Warehouse) -> DataFrame:
    return L.remove_tenant(w.encounters, "HOSP_0003").groupBy("hospital_id").agg(F.count(F.lit(1)).alias("rows_after"))


@query("l10_late_data_recompute")
def _l10(w: Warehouse) -> DataFrame:
    """Late-arriving encounters: stage the early load, then recompute only
    the patients present in the late batch and replace their rows. The result
    must equal staging everything at once."""
    raw = w.raw.encounters
    cut = F.lit("2000-06-01").cast("timestamp_ntz")
    early = B.stg_encounters(raw.filter(F.col("_loaded_at") < cut), w.patients, w.providers, w.facilities)
    late_batch = raw.filter(F.col("_loaded_at") >= cut)
    changed = L.affected_keys(late_batch, ["patient_id", "hospital_id"])
    recomputed = B.stg_encounters(L.recompute_for(raw, changed, ["patient_id", "hospital_id"]),
                                  w.patients, w.providers, w.facilities)
    out = L.replace_keys(early, recomputed, ["patient_id", "hospital_id"])
    return out.select("encounter_id", "hospital_id", "patient_id", "is_readmission", "days_since_last_inpatient_discharge")


# Facts maintained by two loads (the second with the late part) instead of one build.
def _two_loads(w: Warehouse, name: str, early) -> DataFrame:
    import uuid

    from .plans.build import maintain, mart_table
    from .session import checkpoint_dir
    base = f"{checkpoint_dir(w.spark)}/two_loads/{uuid.uuid4().hex}"
    w = Warehouse(w.spark, w.sf_dir, w.as_of)               # a graph of its own: the shared one stays as it is
    full = w.materialize(name, f"{base}/stage/{name}")     # written once, read by both loads
    table = mart_table(w.spark, base, name, full.columns, buckets=8)
    table.commit(full.filter(early))
    maintain(w, name, table)
    return table.read().select(*full.columns)


def _fed_loads(w: Warehouse, name: str, raw: DataFrame, late, shared: tuple[str, ...] = ()) -> DataFrame:
    """The raw rows arrive in two appends; the second holds ``late`` rows, among
    them some with old load times. The fact follows the change sets. ``shared``
    models do not depend on the raw rows; both loads read them as written once."""
    import uuid

    from .plans.build import maintain, mart_table
    from .session import checkpoint_dir, freed_shuffles
    base = f"{checkpoint_dir(w.spark)}/fed/{uuid.uuid4().hex}"
    if shared:
        w = Warehouse(w.spark, w.sf_dir, w.as_of)           # a graph of its own: the shared one stays as it is
        with freed_shuffles(w.spark):
            for model in shared:
                w.materialize(model, f"{base}/stage/{model}")
    feed = L.VersionedTable(w.spark, f"{base}/raw")
    table = mart_table(w.spark, base, name, [], buckets=8)
    for rows in (raw.filter(~late), raw.filter(late)):
        feed.append(rows)
        maintain(w, name, table, feed)
    return table.read()


@query("k09_incremental")
def _k09i(w: Warehouse) -> DataFrame:
    late = (F.col("_loaded_at") >= F.lit("2001-06-01").cast("timestamp_ntz")) | _faulty("encounter_id", "77")
    return _fed_loads(w, "fct_encounters", w.raw.encounters, late).select(*w.fct_encounters.columns)


@query("k10_incremental")
def _k10i(w: Warehouse) -> DataFrame:
    late = (F.col("transaction_date") >= F.lit("2001-01-01").cast("timestamp_ntz")) | _faulty("transaction_id", "77")
    return _rounded_billing(_fed_loads(w, "fct_billing_transactions", w.raw.billing_transactions, late, ("billed_encounters",))
                            .select(*w.fct_billing_transactions.columns))


@query("k17_incremental")
def _k17i(w: Warehouse) -> DataFrame:
    return _two_loads(w, "hipaa_audit_trail", F.col("access_timestamp") < F.lit("2024-01-20").cast("timestamp_ntz"))


@query("l02_upsert_late_and_repeated")
def _l02l(w: Warehouse) -> DataFrame:
    """A batch with a late, older row and a repeated newer one per key."""
    t = w.billing.select("transaction_id", "payment_status", "transaction_date")
    older = t.filter(_faulty("transaction_id", "3")).select(
        "transaction_id", F.lit("Late").alias("payment_status"), (F.col("transaction_date") - F.expr("INTERVAL 1 DAY")).alias("transaction_date"))
    newer = [t.filter(_faulty("transaction_id", "7")).select(
        "transaction_id", F.lit(v).alias("payment_status"), (F.col("transaction_date") + F.expr(f"INTERVAL {d} DAY")).alias("transaction_date"))
        for d, v in ((1, "First"), (2, "Second"))]
    return L.upsert(t, older.unionByName(newer[1]).unionByName(newer[0]), ["transaction_id"], ["transaction_date"])


# ------------------------------------------------------------------ reports (O)
from .plans import reports as O  # noqa: E402


@query("o01_sla_overview")
def _o01(w: Warehouse) -> DataFrame:
    return O.sla_overview(w.sla_monitoring)


@query("o02_cost_summary")
def _o02(w: Warehouse) -> DataFrame:
    return O.cost_summary(w.cost_attribution)


@query("o02_cost_by_tenant")
def _o02b(w: Warehouse) -> DataFrame:
    return O.cost_by_tenant(w.cost_attribution)


@query("o03_access_summary")
def _o03(w: Warehouse) -> DataFrame:
    return O.access_summary(w.hipaa_audit_trail)


@query("o03_daily_access")
def _o03b(w: Warehouse) -> DataFrame:
    return O.daily_access(w.hipaa_audit_trail)


@query("o03_top_users")
def _o03c(w: Warehouse) -> DataFrame:
    return O.top_users(w.hipaa_audit_trail)


@query("o03_access_by_status")
def _o03d(w: Warehouse) -> DataFrame:
    return O.access_by_status(w.hipaa_audit_trail)


@query("o04_comparison_by_type")
def _o04b(w: Warehouse) -> DataFrame:
    return O.comparison_by(_o04(w), "hospital_type")


@query("o04_comparison_by_emr")
def _o04c(w: Warehouse) -> DataFrame:
    return O.comparison_by(_o04(w), "emr_system")


@query("o04_tenant_comparison")
def _o04(w: Warehouse) -> DataFrame:
    return O.tenant_comparison(w.hospitals, w.clinical_quality_metrics, w.hipaa_audit_trail, w.operational_metrics,
                               w.as_of, w.event_as_of, days=60)


@query("o05_alert_list")
def _o05(w: Warehouse) -> DataFrame:
    return O.alert_list(w.sla_monitoring, w.clinical_quality_metrics, w.operational_metrics, w.as_of, days=30)


@query("o06_clinical_latest_day")
def _o06(w: Warehouse) -> DataFrame:
    return O.clinical_latest_day(w.clinical_quality_metrics)


REPORT_MARTS = ["clinical_quality_metrics", "operational_metrics", "hipaa_audit_trail", "sla_monitoring"]


def _served(w: Warehouse) -> Warehouse:
    """The model graph on committed marts. A session builds them once for all
    reports, as a scheduled build does."""
    from .plans.build import build_all, served
    if "_served" not in w.__dict__:
        base = _scratch(w, "served")
        build_all(w.spark, w.sf_dir, out_base=base, marts=REPORT_MARTS, shared=["encounters_with_attrs", "encounters_enriched"])
        w.__dict__["_served"] = served(w, base, REPORT_MARTS)
    return w.__dict__["_served"]


@query("o04_served_tenant_comparison")
def _o04_served(w: Warehouse) -> DataFrame:
    return _o04(_served(w))


@query("o05_served_alert_list")
def _o05_served(w: Warehouse) -> DataFrame:
    return _o05(_served(w))


@query("o06_served_clinical_latest_day")
def _o06_served(w: Warehouse) -> DataFrame:
    return _o06(_served(w))


@query("f04_served_top5_hospitals")
def _f04_served(w: Warehouse) -> DataFrame:
    return _f04(_served(w))


@query("o07_financial_summary")
def _o07(w: Warehouse) -> DataFrame:
    return O.financial_summary(w.financial_performance)


@query("o08_provider_analysis")
def _o08(w: Warehouse) -> DataFrame:
    return O.provider_analysis(_provider_summary(w).withColumn("readmission_rate_pct", fn.r4("readmission_rate_pct")))


@query("o09_strategy_benchmark")
def _o09(w: Warehouse) -> DataFrame:
    return O.strategy_benchmark(w.raw.query_history, w.event_as_of)


@query("o11_sla_status_distribution")
def _o11(w: Warehouse) -> DataFrame:
    return O.sla_status_distribution(w.sla_monitoring)


@query("o11_daily_volume")
def _o11b(w: Warehouse) -> DataFrame:
    return O.daily_volume(w.operational_metrics)


@query("o12_recent_window")
def _o12(w: Warehouse) -> DataFrame:
    return O.recent_window(w.clinical_quality_metrics, "metric_date", w.as_of, 90)


@query("o13_incident_scope")
def _o13(w: Warehouse) -> DataFrame:
    return O.incident_scope(w.hipaa_audit_trail, "USER_5", "HOSP_0005")


# ------------------------------------------------------------------ ingest (A) / streaming (P)
from .sources import ingest as A  # noqa: E402
from .sources.schemas import conform  # noqa: E402
from .streaming import micro_batch as P  # noqa: E402


@query("a07_conform_raw_encounters")
def _a07(w: Warehouse) -> DataFrame:
    return conform(w.raw.encounters, "raw_encounters")


# Config-driven loads of files written from the driver tables.
def _loaded(w: Warehouse, batches: list[tuple[DataFrame, dict]], columns: list, fmt: str = "parquet") -> DataFrame:
    """Lands each batch as files, loads it by its configuration, returns the target."""
    import uuid

    from .session import checkpoint_dir
    base = f"{checkpoint_dir(w.spark)}/loads/{uuid.uuid4().hex}"
    target = L.VersionedTable(w.spark, f"{base}/raw")
    for k, (df, how) in enumerate(batches):
        df.write.format(fmt).option("header", True).save(f"{base}/landing/{k}")
        cfg = A.SourceConfig(k, "customers", f"{base}/landing/{k}", fmt.upper(), "raw_customers", columns=columns, **how)
        run = A.load_raw_table(w.spark, cfg, target, f"2001-08-0{k + 1} 00:00:00")
        if run["status"] != "SUCCESS":
            raise RuntimeError(run["error_message"])
    return target.read()


@query("a08_config_load_csv")
def _a08(w: Warehouse) -> DataFrame:
    m = A.ColumnMapping
    cols = [m("customer_id", "c_custkey", "INTEGER"), m("name", "c_name"), m("balance", "c_acctbal", "NUMBER", precision=15, scale=2),
            m("segment", "c_mktsegment")]
    df = w.raw._t("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return _loaded(w, [(df, {"load_type": "FULL_REFRESH"})], cols, "csv").drop("_loaded_at", "_source_file")


@query("a09_column_rules")
def _a09(w: Warehouse) -> DataFrame:
    m = A.ColumnMapping
    cols = [m("event_id", data_type="INTEGER"), m("happened_at", "ts_micros", "TIMESTAMP"),
            m("kind", transformation_rule="upper(event_type)"), m("origin", default_value="LANDING"),
            m("tag", default_value="concat('e-', event_id)")]
    df = w.raw._t("events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"), "event_type")
    return _loaded(w, [(df, {"load_type": "FULL_REFRESH"})], cols).drop("_loaded_at", "_source_file")


@query("a12_merge_load")
def _a12(w: Warehouse) -> DataFrame:
    """Half of the customers, then all of them with a newer version, a late
    older one for every seventh; the first load's audit columns stay."""
    m = A.ColumnMapping
    cols = [m("customer_id", "c_custkey", "INTEGER"), m("balance", "bal", "NUMBER", precision=15, scale=2), m("version", "v", "INTEGER")]
    cust = w.raw._t("customer").select("c_custkey", "c_acctbal")
    first = cust.filter("c_custkey % 2 = 0").select("c_custkey", F.col("c_acctbal").alias("bal"), F.lit(5).alias("v"))
    late = cust.select("c_custkey", (F.col("c_acctbal") + 1).alias("bal"), F.when(F.expr("c_custkey % 7 = 0"), 1).otherwise(9).alias("v"))
    how = {"merge_key_fields": "customer_id", "order_fields": "version"}
    return _loaded(w, [(first, {"load_type": "MERGE", **how}), (late, {"load_type": "MERGE", **how})], cols).drop("_source_file")


@query("a05_epoch_micros_roundtrip")
def _a05(w: Warehouse) -> DataFrame:
    ev = w.raw._t("events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"))
    return ev.select("event_id", "ts_micros", A.epoch_micros_to_timestamp("ts_micros").alias("ts"),
                     F.to_date(A.epoch_micros_to_timestamp("ts_micros")).alias("event_date"))


@query("a19_source_freshness")
def _a19(w: Warehouse) -> DataFrame:
    return A.source_freshness({"raw_encounters": w.raw.encounters, "raw_billing_transactions": w.raw.billing_transactions,
                               "raw_vital_signs": w.raw.vital_signs, "raw_patients": w.raw.patients},
                              f"{w.as_of} 00:00:00", opt_out=("raw_patients",))


@query("p01_windowed_counts")
def _p01(w: Warehouse) -> DataFrame:
    return P.windowed_counts(w.raw._t("events"), "ts", 3, ("event_type",))


@query("p03_freshness_per_tenant")
def _p03(w: Warehouse) -> DataFrame:
    return P.freshness_per_tenant(w.raw.encounters)


@query("p03_streaming_freshness")
def _p03_streaming(w: Warehouse) -> DataFrame:
    """Freshness by load window over landed files, as a stream that ends: the
    first run closes the windows its watermark has passed, a second run over a
    late marker file closes the others. Only real feeds are returned."""
    base = _scratch(w, "freshness")
    enc = conform(w.raw.encounters, "raw_encounters")
    enc.write.parquet(f"{base}/landing/0")
    P.run_streaming_freshness(w.spark, f"{base}/landing/*", "raw_encounters", f"{base}/out", f"{base}/progress")
    marker = enc.agg(F.max("_loaded_at").alias("_loaded_at")).select(
        *[(F.col("_loaded_at") + F.expr("interval 30 days")).alias(x) if x == "_loaded_at" else F.lit(None).cast(enc.schema[x].dataType).alias(x)
          for x in enc.columns])
    marker.write.parquet(f"{base}/landing/1")
    P.run_streaming_freshness(w.spark, f"{base}/landing/*", "raw_encounters", f"{base}/out", f"{base}/progress")
    return w.spark.read.parquet(f"{base}/out").filter(F.col("hospital_id").isNotNull())


# ------------------------------------------------------------------ staging (B)
@query("b01_stg_billing")
def _b01(w: Warehouse) -> DataFrame:
    return w.billing.select("transaction_id", "hospital_id", "payment_status", fn.r4("collected_amount").alias("collected_amount"),
                            fn.r4("denied_amount").alias("denied_amount"), fn.r4("collection_rate_pct").alias("collection_rate_pct"),
                            "is_denied", "is_paid", "is_pending")


@query("b02_stg_care_plans")
def _b02(w: Warehouse) -> DataFrame:
    return w.care_plans.select("care_plan_id", "hospital_id", "plan_status", "is_active_plan", "is_completed_plan",
                               "is_discontinued_plan", "plan_duration_days", "days_to_target",
                               "days_since_last_evaluation", "overdue_for_evaluation", "past_target_date")


@query("b03_stg_clinical_orders")
def _b03(w: Warehouse) -> DataFrame:
    return w.clinical_orders.select("order_id", "hospital_id", "order_type", "is_completed", "is_cancelled",
                                    "is_stat_order", "completion_time_hours", "scheduled_delay_hours")


@query("b04_stg_clinical_results")
def _b04(w: Warehouse) -> DataFrame:
    return w.clinical_results.select("result_id", "hospital_id", "abnormal_flag", "is_abnormal", "is_high", "is_low",
                                     "is_final", "is_preliminary", "turnaround_time_hours",
                                     fn.r4("out_of_range_value").alias("out_of_range_value"))


@query("b05_stg_encounters")
def _b05(w: Warehouse) -> DataFrame:
    return w.encounters.select("encounter_id", "hospital_id", "patient_id", "encounter_type", "admission_day_of_week",
                               "admission_day_of_week_num", "is_readmission", "days_since_last_discharge",
                               "days_since_last_inpatient_discharge", "previous_encounter_id",
                               "previous_inpatient_encounter_id", "is_mortality", "is_emergency", "is_transfer")


@query("b06_stg_facilities")
def _b06(w: Warehouse) -> DataFrame:
    return w.facilities.select("facility_id", "hospital_id", "facility_type", "bed_capacity")


@query("b07_stg_medication_administration")
def _b07(w: Warehouse) -> DataFrame:
    return w.medication_administration.select("admin_id", "hospital_id", "is_given", "is_refused", "is_held", "is_missed",
                                              "is_verified", "is_witnessed", "administration_delay_minutes",
                                              "is_late_administration")


@query("b08_stg_patient_allergies")
def _b08(w: Warehouse) -> DataFrame:
    return w.patient_allergies.select("allergy_id", "hospital_id", "is_active", "is_life_threatening", "is_severe",
                                      "is_drug_allergy", "is_food_allergy", "is_anaphylaxis", "allergy_duration_days")


@query("b09_stg_patient_coverage")
def _b09(w: Warehouse) -> DataFrame:
    return w.patient_coverage.select("coverage_id", "hospital_id", "is_active", "is_primary", "is_secondary",
                                     "is_self_insured", fn.r4("deductible_remaining").alias("deductible_remaining"),
                                     fn.r4("out_of_pocket_remaining").alias("out_of_pocket_remaining"),
                                     fn.r4("deductible_met_pct").alias("deductible_met_pct"),
                                     fn.r4("out_of_pocket_met_pct").alias("out_of_pocket_met_pct"), "coverage_duration_days")


@query("b10_stg_patients")
def _b10(w: Warehouse) -> DataFrame:
    return w.patients.select("patient_id", "hospital_id", "birth_year", "age_years", "is_age_90_plus", "age_group",
                             "zip_code_3digit", "gender")


@query("b11_stg_prior_authorizations")
def _b11(w: Warehouse) -> DataFrame:
    return w.prior_authorizations.select("auth_id", "hospital_id", "is_approved", "is_denied", "is_pending",
                                         fn.r4("units_utilization_pct").alias("units_utilization_pct"),
                                         "is_fully_utilized", "days_to_decision", "auth_duration_days",
                                         "days_to_expiration", "is_expired", "expiring_soon")


@query("b12_stg_problem_list")
def _b12(w: Warehouse) -> DataFrame:
    return w.problem_list.select("problem_id", "hospital_id", "is_active", "is_resolved", "problem_duration_days",
                                 "days_since_last_review")


@query("b13_stg_providers")
def _b13(w: Warehouse) -> DataFrame:
    return w.providers.select("provider_id", "hospital_id", "provider_full_name", "years_of_service")


@query("b14_stg_quality_measures")
def _b14(w: Warehouse) -> DataFrame:
    return w.quality_measures.select("measure_id", "hospital_id", "is_measure_eligible", "is_numerator_met",
                                     "is_compliant", "gap_in_care", "met_antibiotic_timeliness",
                                     "met_balloon_timeliness", "met_needle_timeliness")


@query("b15_stg_referrals")
def _b15(w: Warehouse) -> DataFrame:
    return w.referrals.select("referral_id", "hospital_id", "is_completed", "is_pending", "is_cancelled", "is_urgent",
                              "days_to_appointment", "days_to_completion", "follow_up_overdue", "overdue_for_appointment")


@query("b16_stg_sdoh_screenings")
def _b16(w: Warehouse) -> DataFrame:
    return w.sdoh_screenings.select("screening_id", "hospital_id", "has_housing_risk", "has_food_insecurity",
                                    "has_transportation_barriers", "has_financial_strain", "has_high_social_isolation",
                                    "has_safety_concerns", "total_sdoh_risk_count", "sdoh_risk_category")


@query("b17_stg_vital_signs")
def _b17(w: Warehouse) -> DataFrame:
    return w.vital_signs.select("vital_id", "hospital_id", "is_febrile", "is_hypothermic", "is_tachycardic",
                                "is_bradycardic", "is_tachypneic", "is_bradypneic", "is_hypertensive", "is_hypotensive",
                                "is_hypoxic", "is_obese", "has_severe_pain", "news_respiratory_score",
                                "news_oxygen_score", "news_systolic_score", "news_heart_rate_score")


@query("b18_stg_procedures")
def _b18(w: Warehouse) -> DataFrame:
    return w.procedures.select("procedure_code", fn.r4("typical_charge_midpoint").alias("typical_charge_midpoint"),
                               fn.r4("typical_charge_range").alias("typical_charge_range"))


# ------------------------------------------------------------------ enrichment (J) and scores (I)
@query("j01_encounters_enriched")
def _j01(w: Warehouse) -> DataFrame:
    return w.encounters_enriched.select("encounter_id", "hospital_id", "hospital_name", "age_group", "provider_full_name",
                                        "specialty", "facility_type", "diagnosis_category", "severity_level", "is_chronic")


@query("j02_patient_journey")
def _j02(w: Warehouse) -> DataFrame:
    return w.patient_journey.select("encounter_id", "hospital_id", "patient_total_encounters", "patient_inpatient_count",
                                    "patient_emergency_count", "patient_chronic_conditions", "patient_risk_category",
                                    "days_since_last_discharge", "is_30day_return", "is_7day_return")


@query("j03_vitals_enriched")
def _j03(w: Warehouse) -> DataFrame:
    return w.vitals_enriched.select("vital_id", "hospital_id", "measurement_sequence", "total_news_score",
                                    "news_risk_category", "news2_partial_score", "qsofa_partial_score",
                                    "minutes_since_last_vitals", "heart_rate_change", "rapid_deterioration_flag",
                                    "encounter_day_of_measurement", "encounter_hour_of_measurement", "sepsis_alert",
                                    "hypertensive_crisis_alert", "respiratory_distress_alert")


@query("j04_orders_enriched")
def _j04(w: Warehouse) -> DataFrame:
    return w.orders_enriched.select("order_id", "hospital_id", "ordering_provider_specialty", "result_is_final",
                                    "result_turnaround_hours", "order_to_result_hours", "encounter_day_of_order",
                                    "stat_order_delayed", "lab_turnaround_delayed", "radiology_delayed")


@query("j05_lab_results_enriched")
def _j05(w: Warehouse) -> DataFrame:
    return w.lab_results_enriched.select("result_id", "hospital_id", "result_sequence", "trend_direction",
                                         "is_critical_value", "lab_panel_category", "days_since_previous_result",
                                         fn.r4("result_change").alias("result_change"),
                                         fn.r4("result_change_pct").alias("result_change_pct"),
                                         fn.r4("percent_above_range").alias("percent_above_range"),
                                         "encounter_day_of_result", "order_completion_hours")


@query("j06_medication_safety")
def _j06(w: Warehouse) -> DataFrame:
    return w.medication_safety.select("admin_id", "hospital_id", "potential_allergy_conflict", "conflicting_allergen",
                                      "conflicting_allergy_severity", "given_despite_allergy",
                                      "given_without_verification", "late_administration", "is_high_risk_medication",
                                      "iv_given_without_witness", "encounter_day_of_admin", "hours_from_order_to_admin")


@query("j08_revenue_cycle")
def _j08(w: Warehouse) -> DataFrame:
    return w.revenue_cycle.select("transaction_id", "hospital_id", "payer_type", "days_in_ar",
                                  fn.r4("expected_payment").alias("expected_payment"),
                                  fn.r4("payment_variance").alias("payment_variance"), "is_over_30_days",
                                  "is_over_60_days", "is_over_90_days", "ar_aging_bucket")


@query("j09_prior_auth_enriched")
def _j09(w: Warehouse) -> DataFrame:
    return w.prior_auth_enriched.select("auth_id", "hospital_id", "payer_type", "request_month",
                                        "decision_turnaround_bucket", fn.r4("encounter_charges").alias("encounter_charges"),
                                        "has_claim_denial", "has_prior_auth_denial",
                                        fn.r4("charges_at_risk").alias("charges_at_risk"))


@query("j10_measure_results")
def _j10(w: Warehouse) -> DataFrame:
    return w.measure_results.select("measure_id", "hospital_id", "measure_code", "time_to_treatment_minutes",
                                    "target_minutes", "is_timed_measure", "met_time_target", "is_performance_met")


@query("j11_referrals_enriched")
def _j11(w: Warehouse) -> DataFrame:
    return w.referrals_enriched.select("referral_id", "hospital_id", "referral_month", "source_encounter_type",
                                       "scheduling_sla_days", "scheduled_within_sla", "is_closed_loop")


@query("i06_vital_scores")
def _i06(w: Warehouse) -> DataFrame:
    """Bedside scores per vital-sign row: NEWS2 (+level), MEWS (+category),
    qSOFA, APACHE II physiology + age (+mortality band), SOFA cardiovascular."""
    from .functions import scores as S
    v = w.vitals_enriched
    t_c = S.f_to_c("temperature_f")
    apache = S.apache_ii(age="age_years", temperature_c=t_c, map_mmhg="map_mmhg", heart_rate="heart_rate_bpm",
                         respiratory_rate="respiratory_rate")
    return (v.select("vital_id", "hospital_id",
                     S.news2(respiratory_rate="respiratory_rate", spo2="oxygen_saturation_pct", temperature_c=t_c,
                             systolic_bp="systolic_bp", heart_rate="heart_rate_bpm",
                             consciousness_alert=F.col("pain_score") < 9).alias("news2_score"),
                     S.mews(systolic_bp="systolic_bp", heart_rate="heart_rate_bpm", respiratory_rate="respiratory_rate",
                            temperature_c=t_c).alias("mews_score"),
                     S.qsofa("respiratory_rate", "systolic_bp", F.col("pain_score") >= 9).alias("qsofa_score"),
                     apache.alias("apache_ii_partial"),
                     S.sofa(map_mmhg="map_mmhg").alias("sofa_cardiovascular"))
            .withColumn("news2_level", S.news2_level("news2_score"))
            .withColumn("mews_category", S.mews_category("mews_score"))
            .withColumn("apache_ii_mortality_pct", S.apache_ii_mortality("apache_ii_partial")))


@query("i08_patient_risk_scores")
def _i08(w: Warehouse) -> DataFrame:
    """Stroke and bleeding risk per patient from the comorbidity flags."""
    from .functions import scores as S
    ci = w.comorbidity_index.join(w.patients.select("patient_id", "hospital_id", "gender"), ["patient_id", "hospital_id"])
    age = F.col("age_years")
    cha = S.cha2ds2_vasc(age="age_years", gender="gender", has_chf="has_congestive_heart_failure",
                         has_stroke_tia="has_cerebrovascular_disease",
                         has_vascular_disease=F.col("has_myocardial_infarction") | F.col("has_peripheral_vascular_disease"),
                         has_diabetes=F.col("has_diabetes_without_complications") | F.col("has_diabetes_with_complications"))
    hb = S.hasbled(F.lit(False), "has_renal_disease",
                   F.col("has_mild_liver_disease") | F.col("has_moderate_severe_liver_disease"),
                   "has_cerebrovascular_disease", F.lit(False), F.lit(False), F.coalesce(age > 65, F.lit(False)),
                   F.lit(False), F.lit(False))
    return (ci.select("patient_id", "hospital_id", cha.alias("cha2ds2_vasc_score"), hb.alias("hasbled_score"),
                      "charlson_index")
            .withColumn("cha2ds2_vasc_category", S.cha2ds2_vasc_category("cha2ds2_vasc_score"))
            .withColumn("annual_stroke_risk_pct", S.cha2ds2_vasc_annual_stroke_risk("cha2ds2_vasc_score"))
            .withColumn("hasbled_category", S.hasbled_category("hasbled_score"))
            .withColumn("annual_bleeding_risk_pct", S.hasbled_annual_bleeding_risk("hasbled_score")))


@query("i01_encounter_severity")
def _i01(w: Warehouse) -> DataFrame:
    return w.encounter_severity


@query("i09_stroke_and_bleeding_risk")
def _i09(w: Warehouse) -> DataFrame:
    return w.stroke_and_bleeding_risk


@query("i10_charlson_conditions")
def _i10(w: Warehouse) -> DataFrame:
    from .functions import scores as S
    p = w.problem_list.select("problem_id", "hospital_id", "diagnosis_code")
    return (p.withColumn("charlson_condition", S.charlson_condition("diagnosis_code"))
            .withColumn("charlson_weight", S.charlson_weight("charlson_condition")))


@query("i13_readmission_rate")
def _i13(w: Warehouse) -> DataFrame:
    return (w.encounters.groupBy("hospital_id")
            .agg(fn.r4(fn.readmission_rate("is_readmission", "encounter_type")).alias("readmission_rate_pct")))


# ------------------------------------------------------------------ remaining primitives (B19, D18, F04, G02, H)
@query("g02_union_distinct_diagnoses")
def _g02(w: Warehouse) -> DataFrame:
    prob = w.problem_list.filter(F.col("is_active")).select("hospital_id", "patient_id", "diagnosis_code")
    enc = w.encounters.select("hospital_id", "patient_id", F.col("primary_diagnosis_code").alias("diagnosis_code"))
    return prob.union(enc).distinct()


@query("h15_json_field_access")
def _h15(w: Warehouse) -> DataFrame:
    ev = w.raw._t("events")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                     F.from_json("props", "k int").getField("k").alias("k_struct"))


@query("h_scalar_helpers")
def _h(w: Warehouse) -> DataFrame:
    """H08 age buckets / flags, H11 length of stay, H12 A/R ageing bucket,
    H13 tenant surrogate key, H14 severity rank, H09 strict least, H16 split."""
    e = w.encounters_enriched.join(w.raw.patients.select("patient_id", "date_of_birth"), "patient_id")
    return e.select(
        "encounter_id", "hospital_id",
        fn.age_bucket("age_years").alias("age_bucket"), fn.is_pediatric("age_years").alias("is_pediatric"),
        fn.is_geriatric("age_years").alias("is_geriatric"),
        fn.los_midnights("admission_date", "discharge_date").alias("los_midnights"),
        fn.ar_aging_bucket(fn.boundary_diff("day", "admission_date", F.lit(w.as_of).cast("date"))).alias("ar_bucket"),
        fn.tenant_surrogate_key("encounter_id").alias("encounter_key"),
        fn.severity_rank(F.upper("severity_level")).alias("severity_rank"),
        fn.least_strict(fn.age_years("date_of_birth", F.lit(w.as_of).cast("date")), F.lit(90)).alias("age_capped"),
        F.size(fn.split_list(F.lit("a, b ,c"))).alias("n_parts"))


@query("f04_top5_hospitals_by_occupancy")
def _f04(w: Warehouse) -> DataFrame:
    from .plans import reports as O
    comp = O.tenant_comparison(w.hospitals, w.clinical_quality_metrics, w.hipaa_audit_trail, w.operational_metrics,
                               w.as_of, w.event_as_of, days=60)
    return O.top_hospitals(comp, "bed_occupancy_rate_pct", 5)


@query("d18_latest_vital_per_patient")
def _d18(w: Warehouse) -> DataFrame:
    from pyspark.sql import Window
    v = w.vitals_enriched.select("patient_id", "hospital_id", "vital_id", "measurement_datetime", "total_news_score")
    win = Window.partitionBy("patient_id", "hospital_id").orderBy(F.col("measurement_datetime").desc(),
                                                                  F.col("vital_id").desc())
    return v.withColumn("_rn", F.row_number().over(win)).filter(F.col("_rn") == 1).drop("_rn")


# ------------------------------------------------------------------ loads through tables (A, L, P)
_CUSTOMER_COLUMNS = [A.ColumnMapping("customer_id", "c_custkey", "INTEGER"),
                     A.ColumnMapping("balance", "c_acctbal", "NUMBER", precision=15, scale=2),
                     A.ColumnMapping("segment", "c_mktsegment")]


def _customers(w: Warehouse) -> DataFrame:
    return w.raw._t("customer").select("c_custkey", "c_acctbal", "c_mktsegment")


@query("a01_typed_parquet")
def _a01(w: Warehouse) -> DataFrame:
    """Files that lack the load-time columns, read by the table's DDL."""
    base = _scratch(w, "typed")
    conform(w.raw.encounters, "raw_encounters").drop("_source_updated_at").write.parquet(base)
    return A.read_typed_parquet(w.spark, base, "raw_encounters").select(
        "encounter_id", "hospital_id", "admission_date", "total_charges", "_loaded_at", "_source_updated_at")


@query("a02_csv_to_parquet")
def _a02(w: Warehouse) -> DataFrame:
    base = _scratch(w, "csv")
    enc = conform(w.raw.encounters, "raw_encounters")
    enc.write.option("header", True).option("sep", "|").option("nullValue", "NULL").csv(f"{base}/in")
    A.csv_to_parquet(w.spark, f"{base}/in", "raw_encounters", f"{base}/out", A.CsvOptions(delimiter="|"))
    return w.spark.read.parquet(f"{base}/out").select("encounter_id", "discharge_date", "length_of_stay", "total_charges")


@query("a03_quarantine")
def _a03(w: Warehouse) -> DataFrame:
    """Latin-1 lines, some with a cell too many or a number that is none: all
    lines are loaded or rejected with a reason."""
    base = _scratch(w, "rejects")
    key = F.col("c_custkey")
    line = F.concat_ws(";", F.when(key % 7 == 0, F.concat(F.lit("n"), key)).otherwise(key.cast("string")),
                       F.col("c_acctbal").cast("string"), F.concat(F.lit("\u00e9 "), F.col("c_mktsegment")),
                       F.when(key % 11 == 0, F.lit("more")))
    lines = w.raw._t("customer").select(line.alias("value"))
    (lines.write.option("sep", "\u0001").option("quote", "").option("escape", "").option("encoding", "ISO-8859-1")
     .csv(f"{base}/in"))
    columns = [A.ColumnMapping("customer_id", "_c0", "INTEGER"), A.ColumnMapping("balance", "_c1", "NUMBER", precision=15, scale=2),
               A.ColumnMapping("segment", "_c2")]
    cfg = A.SourceConfig(1, "customers", f"{base}/in", "CSV", "raw_customers", "APPEND", columns=columns,
                         csv=A.CsvOptions(delimiter=";", header=False, encoding="ISO-8859-1", skip_bad_rows=True))
    target, rejects = (L.VersionedTable(w.spark, f"{base}/{x}") for x in ("raw", "rejects"))
    run = A.load_raw_table(w.spark, cfg, target, "2001-08-05 00:00:00", rejects)
    if run["status"] != "SUCCESS":
        raise RuntimeError(run["error_message"])
    good = target.read().select(F.lit("loaded").alias("outcome"), F.col("customer_id").cast("string").alias("record"),
                                "segment", F.lit(None).cast("string").alias("reason"))
    return good.unionByName(rejects.read().select(F.lit("rejected").alias("outcome"), F.col("raw_line").alias("record"),
                                                  F.lit(None).cast("string").alias("segment"), "reason"))


_ARRAY_DOCUMENTS = 1_000_000    # of an array file: several byte ranges, and no task holds or sorts more


@query("a04_json_array")
def _a04(w: Warehouse) -> DataFrame:
    """The orders' texts with quotes, brackets and commas in them, written as
    array files of nested documents and read back in byte ranges."""
    base = _scratch(w, "array")
    o = w.raw._t("orders").select("o_orderkey", F.struct(F.concat(F.lit('a "b", [c] {'), F.col("o_orderpriority")).alias("note"),
                                                         F.array("o_orderkey", "o_custkey").alias("ids")).alias("doc"))
    from .sources.json_array import array_lines, read_json_array
    # array files of about _ARRAY_DOCUMENTS documents each, one document a line
    files = max(1, -(-o.count() // _ARRAY_DOCUMENTS))
    docs = o.select("o_orderkey", F.to_json(F.struct("o_orderkey", "doc")).alias("value")).repartitionByRange(files, "o_orderkey")
    docs.select("value").mapInArrow(array_lines, "value string").write.option("lineSep", " ").text(base)
    st = "o_orderkey long, doc struct<note: string, ids: array<long>>"
    back = read_json_array(w.spark, base, w.spark.createDataFrame([], st).schema)
    return back.select("o_orderkey", F.col("doc.note").alias("note"), F.col("doc.ids")[1].alias("second_id"))


@query("a06_load_columns")
def _a06(w: Warehouse) -> DataFrame:
    base = _scratch(w, "stamped")
    _customers(w).write.parquet(base)
    return A.with_load_columns(w.spark.read.parquet(base), "2001-08-05 12:00:00").select(
        "c_custkey", "_loaded_at", F.col("_source_file").endswith(".parquet").alias("has_file"))


def _two_batches(w: Warehouse, load_type: str) -> DataFrame:
    c1 = _customers(w).filter("c_custkey % 3 = 0")
    c2 = _customers(w).filter("c_custkey % 3 = 1")
    return _loaded(w, [(c1, {"load_type": load_type}), (c2, {"load_type": load_type})], _CUSTOMER_COLUMNS).select(
        "customer_id", "balance", "segment", "_loaded_at")


@query("a10_full_refresh_load")
def _a10(w: Warehouse) -> DataFrame:
    return _two_batches(w, "FULL_REFRESH")


@query("a11_append_load")
def _a11(w: Warehouse) -> DataFrame:
    return _two_batches(w, "APPEND")


@query("a13_load_active_sources")
def _a13(w: Warehouse) -> DataFrame:
    """Sources, formats and columns come from the three configuration tables;
    one source is switched off, one has no files."""
    base = _scratch(w, "sources")
    _customers(w).write.parquet(f"{base}/customers")
    w.raw._t("orders").select("o_orderkey", "o_totalprice").write.option("header", True).csv(f"{base}/orders")
    spark = w.spark
    formats = spark.createDataFrame([(1, "PARQUET", *[None] * 7), (2, "CSV", ",", True, '"', True, ",NULL", "UTF-8", False)], A.FORMAT_TABLE)
    sources = spark.createDataFrame([
        (1, "customers", f"{base}/customers", 1, "raw_customers", "FULL_REFRESH", None, None, True),
        (2, "orders", f"{base}/orders", 2, "raw_orders", "MERGE", "order_id", None, True),
        (3, "idle", f"{base}/customers", 1, "raw_idle", "APPEND", None, None, False),
        (4, "missing", f"{base}/nothing", 1, "raw_missing", "APPEND", None, None, True)], A.SOURCE_TABLE)
    columns = spark.createDataFrame([
        (1, 1, "customer_id", "c_custkey", "INTEGER", None, None, None, None, None, True),
        (1, 2, "segment", None, "VARCHAR", None, None, None, "lower(c_mktsegment)", None, False),
        (2, 1, "order_id", "o_orderkey", "INTEGER", None, None, None, None, None, True),
        (2, 2, "price", "o_totalprice", "NUMBER", None, 12, 2, None, None, False),
        (4, 1, "x", None, "VARCHAR", None, None, None, None, None, False)], A.COLUMN_TABLE)
    targets = {n: L.VersionedTable(spark, f"{base}/{n}") for n in ("raw_customers", "raw_orders", "raw_idle", "raw_missing")}
    runs = A.load_all_active_sources(spark, A.configs_from_tables(sources, formats, columns), targets, "2001-08-05 00:00:00")
    return runs.select("source_name", "load_type", "status", "rows_staged", "rows_inserted", "rows_updated")


@query("a14_run_log")
def _a14(w: Warehouse) -> DataFrame:
    """A run that ends, one that fails and one that died after its start."""
    base = _scratch(w, "runs")
    _customers(w).write.parquet(f"{base}/customers")
    log = A.RunLog(L.VersionedTable(w.spark, f"{base}/log"))
    target = L.VersionedTable(w.spark, f"{base}/raw")
    good = A.SourceConfig(1, "customers", f"{base}/customers", "PARQUET", "raw_customers", "APPEND", columns=_CUSTOMER_COLUMNS)
    lost = A.SourceConfig(2, "lost", f"{base}/nothing", "PARQUET", "raw_lost", "APPEND", columns=_CUSTOMER_COLUMNS)
    for cfg in (good, lost):
        A.load_raw_table(w.spark, cfg, target, "2001-08-05 00:00:00", log=log)
    log.write({"batch_id": "killed", "source_id": 3, "source_name": "killed", "load_type": "APPEND", "status": "STARTED",
               "rows_staged": 0, "rows_inserted": 0, "rows_updated": 0, "start_time": A._now()})
    return log.history().select("source_id", "source_name", "status", "rows_inserted", F.col("error_message").isNotNull().alias("has_error"))


@query("a15_windows_already_loaded")
def _a15(w: Warehouse) -> DataFrame:
    e = w.raw.encounters
    found = [(p, A.window_already_loaded(e, "encounter_id", p)) for p in ("ENC_1", "ENC_99", "BATCH_2001080500", "ENC_X")]
    return w.spark.createDataFrame(found, "prefix string, already_loaded boolean")


@query("a16_seed_empty_targets")
def _a16(w: Warehouse) -> DataFrame:
    base = _scratch(w, "seed")
    tables = {n: L.VersionedTable(w.spark, f"{base}/{n}") for n in ("customers", "nations")}
    tables["nations"].commit(w.raw._t("nation").limit(3))
    rows = A.seed_empty_targets({"customers": (_customers(w), tables["customers"]), "nations": (w.raw._t("nation"), tables["nations"])})
    return w.spark.createDataFrame(rows, "target string, outcome string, row_count long")


@query("a17_export_tenant")
def _a17(w: Warehouse) -> DataFrame:
    base = _scratch(w, "export")
    A.export_tenant(w.raw.encounters, "HOSP_0004", base)
    return w.spark.read.parquet(base).groupBy("hospital_id").agg(F.count(F.lit(1)).alias("encounters"), F.sum("total_charges").alias("charges"))


@query("l09_offboard_tenant_log")
def _l09t(w: Warehouse) -> DataFrame:
    """Two tables in tenant folders: the tenant's folders are unlisted."""
    base = _scratch(w, "offboard")
    e = conform(w.raw.encounters, "raw_encounters").select("encounter_id", "hospital_id", "patient_id")
    tables = {n: L.VersionedTable(w.spark, f"{base}/{n}", partition_by=("hospital_id",)) for n in ("encounters", "patients")}
    tables["encounters"].commit(e)
    tables["patients"].append(w.raw.patients.select("patient_id", "hospital_id"))
    log = L.offboard_tenant(w.spark, tables, "HOSP_0003")
    left = [tables[n].read().groupBy().agg(F.count(F.lit(1)).alias("rows_left")).select(F.lit(n).alias("table_name"), "rows_left") for n in tables]
    return log.join(left[0].unionByName(left[1]), "table_name")


@query("l11_backfill_quarter")
def _l11(w: Warehouse) -> DataFrame:
    """Two batches into one table: a clean one, and one with rows of a later
    quarter, which is refused."""
    target = L.VersionedTable(w.spark, _scratch(w, "backfill"))
    e = w.raw.encounters
    out = []
    for name, start, end, until in (("clean", "2000-01-01", "2000-03-31", "2000-03-31"), ("stray", "2000-04-01", "2000-06-30", "2000-07-15")):
        batch = e.filter(F.to_date("admission_date").between(start, until))
        s = L.backfill(target, batch, N.validation_report(batch, w.raw.patients, start, end))
        out.append(s.select(F.lit(name).alias("batch"), "*"))
    return out[0].unionByName(out[1])


@query("l12_compacted_appends")
def _l12(w: Warehouse) -> DataFrame:
    """Twelve appends by month, compacted, then two months read by file bounds."""
    t = L.VersionedTable(w.spark, _scratch(w, "compact"), stats=("transaction_date",))
    b = conform(w.raw.billing_transactions, "raw_billing_transactions").select("transaction_id", "transaction_date", "charge_amount")
    for month in range(1, 13):
        t.append(b.filter(F.month("transaction_date") == month))
        if month == 9:
            t.compact()
    rows = t.read(where={"transaction_date": ("2000-02-01", "2000-03-31")})
    return rows.groupBy(F.to_date(F.date_trunc("month", "transaction_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("charge_amount").alias("charges"))


@query("l13_change_sets")
def _l13(w: Warehouse) -> DataFrame:
    """What changed between versions: an append, a merge and a compaction."""
    t = L.VersionedTable(w.spark, _scratch(w, "changes"), key=("customer_id",), buckets=8, feed=True)
    rows = _customers(w).select(F.col("c_custkey").cast("long").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.lit(1).alias("v"))
    t.commit(rows.filter("customer_id % 2 = 0"))
    first = t.current_version()
    t.append(rows.filter("customer_id % 2 = 1 AND customer_id % 3 = 0"))
    changed = rows.filter("customer_id % 10 = 0").withColumn("v", F.lit(2))
    t.merge(changed, lambda old, new: L.replace_keys(old, new, ["customer_id"]))
    t.compact(1)
    return t.changes(first).select("customer_id", "segment", "v")


@query("p02_file_ingest_replayed")
def _p02(w: Warehouse) -> DataFrame:
    """New files in two drops, each batch added once though the first is
    delivered again."""
    base = _scratch(w, "ingest")
    enc = conform(w.raw.encounters, "raw_encounters")
    target = L.VersionedTable(w.spark, f"{base}/target")
    early = F.col("admission_date") < F.lit("2000-01-01").cast("timestamp_ntz")
    for k, rows in enumerate((enc.filter(early), enc.filter(~early))):
        rows.write.parquet(f"{base}/landing/{k}")
        for _ in range(2):
            P.incremental_file_ingest(w.spark, f"{base}/landing/*", "raw_encounters", target, ["encounter_id"], f"{base}/progress",
                                      mode="append").awaitTermination()
    target.append(enc.filter(early), (f"stream:{base}/progress", 0))       # the first batch once more
    return target.read().groupBy("hospital_id").agg(F.count(F.lit(1)).alias("encounters"), F.sum("total_charges").alias("charges"))
