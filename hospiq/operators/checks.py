"""Data-quality checks (N-family). Every check returns the violating rows:
an empty result means the check passes. ``run_checks`` evaluates a list of
checks and writes the failures to a ``test_failures`` table (store failures).

Scale notes: uniqueness checks are ``groupBy().count()`` (partial
aggregation), relationship checks are anti joins, and the two checks that
the warehouse expresses as self / range joins over all pairs within a group
(readmission recomputation, critical-lab follow-up) are written with windows
over one sorted pass per patient / encounter instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import core as fn
from .quantiles import grouped_percentiles

c = F.col


# --------------------------------------------------------------------------- generic (schema tests)
def not_null(df: DataFrame, column: str) -> DataFrame:                       # N01
    return df.filter(c(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:                          # N02
    return (df.filter(c(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(c("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:   # N03
    return df.filter(c(column).isNotNull() & ~c(column).isin(values))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:  # N04
    child = df.filter(c(column).isNotNull())
    return child.join(parent.select(c(parent_column).alias(column)).distinct(), column, "left_anti")


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True,
                   where: str | None = None) -> DataFrame:                    # N05
    d = df.filter(F.expr(where)) if where else df
    conds = []
    if min_value is not None:
        conds.append(c(column) < min_value if inclusive else c(column) <= min_value)
    if max_value is not None:
        conds.append(c(column) > max_value if inclusive else c(column) >= max_value)
    return d.filter(reduce(lambda a, b: a | b, conds)) if conds else d.limit(0)


def unique_combination_of_columns(df: DataFrame, columns: list[str]) -> DataFrame:   # N06
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter(c("n_records") > 1)


def expression_is_true(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:  # N07
    d = df.filter(F.expr(where)) if where else df
    return d.filter(~F.coalesce(F.expr(expression), F.lit(False)))


def has_tenant_column(spark: SparkSession, name: str, df: DataFrame, tenant_column: str = "hospital_id") -> DataFrame:  # N08
    """One row per model lacking the tenant column (schema check, no scan)."""
    missing = tenant_column not in df.columns
    rows = [(name, tenant_column, f"Model {name} is missing required {tenant_column} column for RLS")] if missing else []
    return spark.createDataFrame(rows, "model_name string, missing_column string, error_message string")


def no_cross_tenant_leakage(model: DataFrame, patients: DataFrame, providers: DataFrame, is_fact: bool = True,
                            name: str = "model", tenant_column: str = "hospital_id") -> DataFrame:   # N09
    if not is_fact:
        return (model.filter(c(tenant_column).isNull()).groupBy(tenant_column)
                .agg(F.count(F.lit(1)).alias("null_tenant_count")).withColumn("model_name", F.lit(name)))
    pm = (model.join(patients.select("patient_id", c("hospital_id").alias("related_hospital")), "patient_id")
          .filter(c(tenant_column) != c("related_hospital"))
          .groupBy(c(tenant_column).alias("model_hospital"), "related_hospital").agg(F.count(F.lit(1)).alias("violation_count"))
          .withColumn("leak_type", F.lit("patient_mismatch")))
    vm = (model.join(providers.select("provider_id", c("hospital_id").alias("related_hospital")), "provider_id")
          .filter(c(tenant_column) != c("related_hospital"))
          .groupBy(c(tenant_column).alias("model_hospital"), "related_hospital").agg(F.count(F.lit(1)).alias("violation_count"))
          .withColumn("leak_type", F.lit("provider_mismatch")))
    return (pm.unionByName(vm).filter(c("violation_count") > 0)
            .select("leak_type", "model_hospital", "related_hospital", "violation_count",
                    F.lit("rows of one tenant refer to another tenant").alias("error_message")))


# PHI patterns (SSN, US phone, e-mail).
PHI_PATTERNS = [r"\d{3}-\d{2}-\d{4}", r"\(\d{3}\) \d{3}-\d{4}", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"]


PHI_KINDS = ["ssn", "phone", "email"]


def phi_in_text(df: DataFrame, key: str, column: str) -> DataFrame:          # N10
    """Keys of texts that contain personal data, and its kinds."""
    kinds = F.array_compact(F.array(*[F.when(c(column).rlike(p), F.lit(k)) for k, p in zip(PHI_KINDS, PHI_PATTERNS, strict=True)]))
    return df.select(key, F.array_join(kinds, ",").alias("kinds")).filter(c("kinds") != "")


def no_phi_in_column(df: DataFrame, column: str) -> DataFrame:               # N10
    """Values that contain an SSN / phone / e-mail (correction: the warehouse's
    regexp_like matches whole values only and is blind to text)."""
    cond = reduce(lambda a, b: a | b, [c(column).rlike(p) for p in PHI_PATTERNS])
    return df.filter(cond).groupBy(column).agg(F.count(F.lit(1)).alias("violation_count"))


def models_not_empty(spark: SparkSession, models: dict[str, DataFrame]) -> DataFrame:   # N11
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("model_name"), "row_count")
             for n, df in models.items()]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.filter(c("row_count") == 0).withColumn("error_message", F.lit("no rows are visible"))


# --------------------------------------------------------------------------- singular (business rules)
CRITICAL_TYPES = [("%glucose%", "<", 40, "Severe Hypoglycemia"), ("%glucose%", ">", 500, "Severe Hyperglycemia"),
                  ("%potassium%", "<", 2.5, "Severe Hypokalemia"), ("%potassium%", ">", 6.5, "Severe Hyperkalemia"),
                  ("%sodium%", "<", 120, "Severe Hyponatremia"), ("%sodium%", ">", 160, "Severe Hypernatremia"),
                  ("%hemoglobin%", "<", 6, "Severe Anemia"), ("%creatinine%", ">", 10, "Severe Renal Failure"),
                  ("%troponin%", ">", 0.5, "Positive Troponin (AMI)"), ("%inr%", ">", 5, "Critical INR")]


def critical_lab_response(labs: DataFrame, orders: DataFrame, as_of_ts: str, lookback_days: int = 30,
                          recent_hours: int = 48) -> DataFrame:              # N12
    """Critical final labs without a follow-up order in time.

    The warehouse joins each critical result with all orders of the encounter
    in (result, result + 24 h]. Here results and orders of the same encounter
    are one stream sorted by time; RANGE frames over the microsecond clock
    give the first order within 24 h and the order counts within 1 h / 2 h -
    one sort per encounter, no pair expansion."""
    now = F.lit(as_of_ts).cast("timestamp_ntz")
    t = F.lower(c("test_name"))
    v = c("result_value_numeric")
    ctype = None
    for pat, op, thr, name in CRITICAL_TYPES:
        cond = t.like(pat) & ((v < thr) if op == "<" else (v > thr))
        ctype = F.when(cond, name) if ctype is None else ctype.when(cond, name)
    ctype = ctype.otherwise("Other Critical Value")
    crit = (labs.filter(c("is_critical_value") & c("is_final")
                        & (c("result_datetime") >= F.date_sub(F.to_date(now), lookback_days)))
            .select("result_id", "hospital_id", "encounter_id", "patient_id", "test_name", "result_value",
                    c("result_datetime").alias("t"), ctype.alias("critical_value_type"),
                    F.when(t.like("%glucose%") | t.like("%potassium%") | t.like("%troponin%"), 1).otherwise(2)
                    .alias("expected_response_hours"), F.lit("L").alias("kind")))
    o = (orders.join(crit.select("encounter_id", "hospital_id").distinct(), ["encounter_id", "hospital_id"], "left_semi")
         .select("encounter_id", "hospital_id", c("order_datetime").alias("t"), F.lit("O").alias("kind")))
    stream = crit.unionByName(o, allowMissingColumns=True).withColumn(
        "us", F.unix_micros(c("t").cast("timestamp")))
    hour = 3_600_000_000
    w = Window.partitionBy("encounter_id", "hospital_id").orderBy("us")
    is_o = c("kind") == "O"
    s = (stream.withColumn("first_order_after_result", F.min(F.when(is_o, c("t"))).over(w.rangeBetween(1, 24 * hour)))
         .withColumn("n1", F.count(F.when(is_o, F.lit(1))).over(w.rangeBetween(1, hour)))
         .withColumn("n2", F.count(F.when(is_o, F.lit(1))).over(w.rangeBetween(1, 2 * hour)))
         .filter(c("kind") == "L"))
    rt = fn.boundary_diff("minute", "t", "first_order_after_result") / 60.0
    s = (s.withColumn("response_time_hours", rt)
         .withColumn("orders_within_timeframe", F.when(c("expected_response_hours") == 1, c("n1")).otherwise(c("n2"))))
    late = c("response_time_hours") > c("expected_response_hours")
    viol = s.filter(c("first_order_after_result").isNull() | late).withColumn(
        "violation_type", F.when(c("first_order_after_result").isNull(), "NO FOLLOW-UP ORDERS").otherwise("DELAYED RESPONSE"))
    since_h = fn.boundary_diff("hour", "t", now)
    return (viol.filter((since_h <= recent_hours) | (c("violation_type") == "NO FOLLOW-UP ORDERS"))
            .select("result_id", "hospital_id", "encounter_id", "patient_id", "test_name", "result_value",
                    "critical_value_type", c("t").alias("result_datetime"), "expected_response_hours",
                    "first_order_after_result", fn.r4("response_time_hours").alias("response_time_hours"),
                    "orders_within_timeframe", "violation_type",
                    F.when(c("violation_type") == "NO FOLLOW-UP ORDERS",
                           "no order in 24 hours: ask for an acknowledgement and see the patient")
                    .when(c("response_time_hours") > c("expected_response_hours") * 2,
                          "more than twice the allowed time: find out how the result was passed on")
                    .otherwise("late order: see how results are passed on")
                    .alias("action_required"),
                    since_h.alias("hours_since_critical_value")))


def los_by_encounter_type(encounters: DataFrame) -> DataFrame:               # N13
    los, et = c("length_of_stay"), c("encounter_type")
    bad = (((et == "Inpatient") & ((los < 1) | (los > 365))) | ((et == "Outpatient") & (los >= 1))
           | ((et == "Emergency") & (los >= 3)) | ((et == "Observation") & (los > 3)) | (los < 0))
    return (encounters.filter(los.isNotNull() & bad)
            .select("encounter_id", "hospital_id", "encounter_type", "length_of_stay", "admission_date", "discharge_date"))


def los_with_issue(encounters: DataFrame) -> DataFrame:                      # N14
    los, et = c("length_of_stay"), c("encounter_type")
    issue = (F.when((et == "Inpatient") & (los > 365), "inpatient stay of over a year")
             .when((et == "Inpatient") & (los == 0) & c("discharge_date").isNotNull(), "inpatient stay of no day")
             .when((et == "Outpatient") & (los > 1), "outpatient stay of over a day")
             .when((et == "Emergency") & (los > 2), "emergency stay of over two days")
             .when((et == "Observation") & (los > 3), "observation stay of over three days")
             .when(los < 0, "negative stay"))
    return (encounters.withColumn("issue_type", issue).filter(c("issue_type").isNotNull())
            .select("encounter_id", "hospital_id", "encounter_type", "length_of_stay", "admission_date",
                    "discharge_date", "issue_type"))


# High-risk medication classes (patterns, class), first match wins.
HIGH_RISK_CLASSES = [
    (["%warfarin%", "%coumadin%"], "Anticoagulant - Warfarin", None),
    (["%heparin%", "%enoxaparin%", "%lovenox%"], "Anticoagulant - Heparin", None),
    (["%insulin%", "%novolog%", "%humalog%", "%lantus%"], "Insulin", None),
    (["%morphine%", "%dilaudid%", "%hydromorphone%"], "Opioid", None),
    (["%fentanyl%", "%oxycodone%", "%hydrocodone%"], "Opioid", None),
    (["%potassium chloride%", "%kcl%"], "Concentrated Electrolyte", "IV"),
    (["%magnesium sulfate%"], "Concentrated Electrolyte", "IV"),
    (["%chemotherapy%", "%methotrexate%", "%cisplatin%"], "Chemotherapy", None),
]
HIGH_RISK_ANY = ["%warfarin%", "%coumadin%", "%heparin%", "%enoxaparin%", "%lovenox%", "%insulin%", "%novolog%",
                 "%humalog%", "%lantus%", "%morphine%", "%dilaudid%", "%hydromorphone%", "%fentanyl%", "%oxycodone%",
                 "%hydrocodone%", "%potassium chloride%", "%kcl%", "%magnesium sulfate%", "%methotrexate%", "%cisplatin%"]


def _like_any(col_, pats):
    return reduce(lambda a, b: a | b, [col_.like(p) for p in pats])


def high_risk_unverified(med_admin: DataFrame) -> DataFrame:                 # N15
    m = F.lower(c("medication_name"))
    klass = None
    for pats, name, route in HIGH_RISK_CLASSES:
        cond = _like_any(m, pats) & ((c("route") == route) if route else F.lit(True))
        klass = F.when(cond, name) if klass is None else klass.when(cond, name)
    klass = klass.otherwise("Other High-Risk")
    risk = (F.when((c("route") == "IV") & _like_any(m, ["%potassium%", "%insulin%"]), "CRITICAL")
            .when(_like_any(m, ["%warfarin%", "%heparin%", "%chemotherapy%"]), "HIGH").otherwise("MODERATE"))
    return (med_admin.filter(c("is_given") & _like_any(m, HIGH_RISK_ANY)
                             & ((c("barcode_scanned") == False) | c("barcode_scanned").isNull()))  # noqa: E712
            .select("admin_id", "hospital_id", "encounter_id", "patient_id", "medication_name", "dose", "route",
                    klass.alias("high_risk_class"), risk.alias("risk_level"), "administered_datetime",
                    "administered_by_provider_id", "barcode_scanned")
            .withColumn("action_required",
                        F.when(c("risk_level") == "CRITICAL", "tell the supervisor now and file a report")
                        .when(c("risk_level") == "HIGH", "file a report, train the staff")
                        .otherwise("go over the rules for high-risk medication")))


def iv_without_witness(med_admin: DataFrame) -> DataFrame:                   # N16
    m = F.lower(c("medication_name"))
    return (med_admin.filter((c("route") == "IV") & c("is_given") & c("witnessed_by_provider_id").isNull()
                             & _like_any(m, ["%insulin%", "%heparin%", "%potassium%", "%chemotherapy%"]))
            .select("admin_id", "hospital_id", "encounter_id", "patient_id", "medication_name", "dose",
                    "administered_datetime", "administered_by_provider_id"))


def cross_hospital_encounters(raw_encounters: DataFrame, patients: DataFrame, providers: DataFrame,
                              facilities: DataFrame) -> DataFrame:           # N17
    """Encounter rows whose patient, provider or facility belongs to another
    tenant, with one message per kind of mismatch (run on the raw feed: the
    staged model has already dropped them)."""
    e = (raw_encounters.select("encounter_id", c("hospital_id").alias("encounter_hospital_id"), "patient_id",
                               "provider_id", "facility_id")
         .join(patients.select("patient_id", c("hospital_id").alias("ph")), "patient_id")
         .join(providers.select("provider_id", c("hospital_id").alias("vh")), "provider_id")
         .join(facilities.select("facility_id", c("hospital_id").alias("fh")), "facility_id"))
    h = c("encounter_hospital_id")
    return (e.filter((h != c("ph")) | (h != c("vh")) | (h != c("fh")))
            .select("encounter_id", "encounter_hospital_id", "patient_id", "provider_id", "facility_id",
                    F.when(h != c("ph"), F.concat(F.lit("patient belongs to "), c("ph"))).alias("patient_violation"),
                    F.when(h != c("vh"), F.concat(F.lit("provider belongs to "), c("vh"))).alias("provider_violation"),
                    F.when(h != c("fh"), F.concat(F.lit("facility belongs to "), c("fh"))).alias("facility_violation")))


def given_despite_allergy(med_admin: DataFrame, allergies: DataFrame) -> DataFrame:   # N18
    ma = med_admin.filter(c("is_given")).alias("m")
    aa = allergies.filter(c("is_active") & (c("allergen_type") == "DRUG")).alias("a")
    med, agn = F.lower(c("m.medication_name")), F.lower(c("a.allergen_name"))
    j = ma.join(aa, (c("m.patient_id") == c("a.patient_id")) & (c("m.hospital_id") == c("a.hospital_id"))
                & (med.contains(agn) | agn.contains(med)))
    return j.select(
        c("m.admin_id").alias("admin_id"), c("m.hospital_id").alias("hospital_id"), c("m.encounter_id").alias("encounter_id"),
        c("m.patient_id").alias("patient_id"), c("m.medication_name").alias("administered_medication"),
        c("a.allergen_name").alias("known_allergy"), c("a.severity").alias("allergy_severity"),
        c("a.reaction_type").alias("expected_reaction"), c("a.allergy_id").alias("allergy_id"),
        F.when(med == agn, "same name").when(med.contains(agn), "allergen within medication")
        .when(agn.contains(med), "medication within allergen").otherwise("no match").alias("match_type"),
        c("m.administered_datetime").alias("administered_datetime"), c("m.barcode_scanned").alias("barcode_scanned"),
        F.coalesce(c("a.severity").isin("SEVERE", "LIFE_THREATENING"), F.lit(False)).alias("is_critical_severity"))


def recent_unauthorized_access(audit: DataFrame, as_of_ts: str, days: int = 1) -> DataFrame:   # N19
    since = F.lit(as_of_ts).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
    return (audit.filter(c("is_unauthorized") & (c("access_timestamp") >= since))
            .select("audit_id", "access_timestamp", "user_name", "role_name", "hospital_id", "phi_tables_accessed",
                    "records_accessed", "compliance_note"))


def readmission_recomputation(encounters: DataFrame) -> DataFrame:           # N20
    """Independent recomputation of the inpatient readmission flag.

    The prior inpatient stay (as-of backward) is found with a lag over the
    inpatient rows of each patient, ordered by (admission, encounter_id) - the
    same answer as the self join + top-1 of the warehouse test, without
    emitting every earlier stay of the patient."""
    inp = encounters.filter(c("encounter_type") == "Inpatient")
    w = Window.partitionBy("patient_id", "hospital_id").orderBy("admission_date", "encounter_id")
    prior = (inp.select("encounter_id", F.lag("encounter_id").over(w).alias("prior_encounter_id"),
                        F.lag("discharge_date").over(w).alias("prior_discharge_date")))
    e = encounters.select("encounter_id", "hospital_id", "patient_id", "encounter_type", "admission_date", "is_readmission")
    j = e.join(prior, "encounter_id", "left").withColumn(
        "days_since_prior_inpatient", fn.boundary_diff("day", "prior_discharge_date", "admission_date"))
    exp = F.coalesce((c("encounter_type") == "Inpatient") & c("days_since_prior_inpatient").between(1, 30), F.lit(False))
    return (j.withColumn("expected_flag", exp).filter(c("is_readmission") != c("expected_flag"))
            .select("encounter_id", "hospital_id", "patient_id", "encounter_type", "admission_date",
                    c("is_readmission").alias("actual_flag"), "expected_flag", "prior_encounter_id",
                    "prior_discharge_date", "days_since_prior_inpatient",
                    F.when(c("is_readmission") & ~c("expected_flag"),
                           "flag set without an inpatient discharge 1 to 30 days before")
                    .otherwise("inpatient discharge 1 to 30 days before, flag not set").alias("validation_error")))


def readmission_rate_in_range(encounters: DataFrame, low: float = 1, high: float = 15,
                              min_encounters: int = 1000) -> DataFrame:      # N21
    s = encounters.filter(c("encounter_type") == "Inpatient").agg(
        F.count(F.lit(1)).alias("total_encounters"),
        F.sum(F.when(c("is_readmission"), 1).otherwise(0)).cast("bigint").alias("readmissions"))
    s = s.withColumn("readmission_rate", F.when(c("total_encounters") == 0, F.lit(None))
                     .otherwise(fn.r4(c("readmissions") * 100.0 / c("total_encounters"))))
    r = c("readmission_rate")
    # too few stays to judge is reported, not passed over
    return (s.withColumn("finding", F.when(c("total_encounters") < min_encounters, "TOO FEW STAYS TO JUDGE")
                         .when(r.isNull() | (r < low) | (r > high), "RATE OUT OF RANGE"))
            .filter(c("finding").isNotNull()))


def validation_report(staging: DataFrame, patients: DataFrame, start: str, end: str) -> DataFrame:   # N22
    """Stacked PASS/FAIL rows for a backfill batch: one left join for orphan
    detection and a single aggregation pass, then unpivoted with stack()."""
    p = patients.select("patient_id", "hospital_id", F.lit(True).alias("_known")).distinct()
    a = (staging.join(p, ["patient_id", "hospital_id"], "left").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("encounter_id").alias("nd"),
        F.count(F.when(F.to_date("admission_date").between(start, end), 1)).alias("in_range"),
        F.countDistinct(F.when(c("_known").isNull(), c("patient_id"))).alias("orphans")))
    return a.select(F.expr(
        "stack(4, 'Total Rows', cast(n as string), if(n > 0, 'PASS', 'FAIL'), "
        "'Date Range Valid', cast(in_range as string), if(in_range = n, 'PASS', 'FAIL'), "
        "'No Duplicates', cast(nd as string), if(n = nd, 'PASS', 'FAIL'), "
        "'No Orphaned Patients', cast(orphans as string), if(orphans = 0, 'PASS', 'FAIL')) as (check_name, result, status)"))


def load_profile(staging: DataFrame, existing: DataFrame, patients: DataFrame, providers: DataFrame,
                 facilities: DataFrame, start: str, end: str) -> DataFrame:   # N23
    """Date / LOS sanity, charge profile, orphan counts and overlap with the
    existing table in one row: flags come from left joins (one per
    reference), then a single aggregation."""
    def known(df, key, flag):
        return df.select(key, "hospital_id", F.lit(True).alias(flag)).distinct()
    j = (staging.join(known(patients, "patient_id", "_p"), ["patient_id", "hospital_id"], "left")
         .join(known(providers, "provider_id", "_v"), ["provider_id", "hospital_id"], "left")
         .join(known(facilities, "facility_id", "_f"), ["facility_id", "hospital_id"], "left")
         .join(known(existing, "encounter_id", "_e"), ["encounter_id", "hospital_id"], "left"))
    return j.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(F.to_date("admission_date") < start, 1)).alias("before_window"),
        F.count(F.when(F.to_date("admission_date") > end, 1)).alias("after_window"),
        F.count(F.when(c("discharge_date") < c("admission_date"), 1)).alias("invalid_dates"),
        F.count(F.when(c("length_of_stay") < 0, 1)).alias("negative_los"),
        F.count(F.when(c("total_charges") < 0, 1)).alias("negative_charges"),
        F.count(F.when(c("total_charges").isNull(), 1)).alias("null_charges"),
        fn.r2(fn.mean("total_charges")).alias("avg_charges"),
        fn.r2(F.percentile("total_charges", 0.5)).alias("median_charges"),
        F.countDistinct(F.when(c("_p").isNull(), c("patient_id"))).alias("orphaned_patients"),
        F.countDistinct(F.when(c("_v").isNull(), c("provider_id"))).alias("orphaned_providers"),
        F.countDistinct(F.when(c("_f").isNull(), c("facility_id"))).alias("orphaned_facilities"),
        F.count(F.when(c("_e"), 1)).alias("overlap_count"))


BATCH = ["hospital_id", "window_start"]


def _in_window():
    """Admitted in the window's quarter, or up to 31 days before it: loads come later."""
    day = F.to_date("admission_date")
    return day.between(F.date_sub("window_start", 31), F.date_sub(F.add_months("window_start", 3), 1))


def _reference(df: DataFrame, key: str, flag: str) -> DataFrame:
    return df.select(key, "hospital_id", F.lit(True).alias(flag)).distinct()


def _distinct_keys(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct keys of each batch, by two plain aggregations."""
    return rows.groupBy(*BATCH, key).agg(F.lit(1).alias("_one")).groupBy(*BATCH).agg(F.count(key).alias(out))


def validation_by_batch(staging: DataFrame, patients: DataFrame) -> DataFrame:   # N22
    """The validation rows of every batch (tenant and load window) of a staging
    table: ``hospital_id, window_start, check_name, result, status``. One pre-
    aggregate by encounter and patient holds all that the checks count, so a
    batch of any size is reduced before it meets in one row."""
    p = _reference(patients, "patient_id", "_known")
    per = (staging.join(p, ["patient_id", "hospital_id"], "left")
           .groupBy(*BATCH, "encounter_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(_in_window(), 1)).alias("ok")))
    strangers = _distinct_keys(staging.join(p, ["patient_id", "hospital_id"], "left_anti"), "patient_id", "orphans")
    a = (per.groupBy(*BATCH).agg(F.sum("n").alias("n"), F.count("encounter_id").alias("nd"), F.sum("ok").alias("in_range"))
         .join(strangers, BATCH, "left").withColumn("orphans", F.coalesce("orphans", F.lit(0))))
    return a.select(*BATCH, F.expr(
        "stack(4, 'Total Rows', cast(n as string), if(n > 0, 'PASS', 'FAIL'), "
        "'Date Range Valid', cast(in_range as string), if(in_range = n, 'PASS', 'FAIL'), "
        "'No Duplicates', cast(nd as string), if(n = nd, 'PASS', 'FAIL'), "
        "'No Orphaned Patients', cast(orphans as string), if(orphans = 0, 'PASS', 'FAIL')) as (check_name, result, status)"))


def profile_by_batch(staging: DataFrame, existing: DataFrame, patients: DataFrame, providers: DataFrame,
                     facilities: DataFrame) -> DataFrame:   # N23
    """The load profile of every batch: date and stay sanity, charges, orphans
    and overlap with the existing table. Sums are plain aggregates; the median
    comes from counted values (``quantiles``), orphans from anti joins."""
    known = _reference(existing, "encounter_id", "_e")
    day = F.to_date("admission_date")
    sums = staging.join(known, ["encounter_id", "hospital_id"], "left").groupBy(*BATCH).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(day < F.date_sub("window_start", 31), 1)).alias("before_window"),
        F.count(F.when(day >= F.add_months("window_start", 3), 1)).alias("after_window"),
        F.count(F.when(c("discharge_date") < c("admission_date"), 1)).alias("invalid_dates"),
        F.count(F.when(c("length_of_stay") < 0, 1)).alias("negative_los"),
        F.count(F.when(c("total_charges") < 0, 1)).alias("negative_charges"),
        F.count(F.when(c("total_charges").isNull(), 1)).alias("null_charges"),
        fn.r2(fn.mean("total_charges")).alias("avg_charges"), F.count(F.when(c("_e"), 1)).alias("overlap_count"))
    out = sums.join(grouped_percentiles(staging, BATCH, {"median_charges": ("total_charges", 0.5)}, parts=64), BATCH, "left")
    out = out.withColumn("median_charges", fn.r2(fn.r4("median_charges")))
    for df, key, name in ((patients, "patient_id", "orphaned_patients"), (providers, "provider_id", "orphaned_providers"),
                          (facilities, "facility_id", "orphaned_facilities")):
        lost = staging.filter(c(key).isNotNull()).join(df.select(key, "hospital_id"), [key, "hospital_id"], "left_anti")
        out = out.join(_distinct_keys(lost, key, name), BATCH, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def completeness_by_month(encounters: DataFrame, hospital_id: str | None = None, since: str | None = None) -> DataFrame:  # N24
    e = encounters
    if hospital_id:
        e = e.filter(c("hospital_id") == hospital_id)
    if since:
        e = e.filter(c("admission_date") >= F.lit(since).cast("timestamp_ntz"))
    return (e.groupBy("hospital_id", F.to_date(F.date_trunc("month", "admission_date")).alias("month"))
            .agg(F.countDistinct("encounter_id").alias("encounter_count"),
                 F.countDistinct("patient_id").alias("patient_count"),
                 F.min("admission_date").alias("earliest_admission"), F.max("admission_date").alias("latest_admission")))


# --------------------------------------------------------------------------- runner (store failures)
@dataclass
class CheckResult:
    name: str
    severity: str
    failures: int


def run_checks(spark: SparkSession, checks: dict[str, tuple[str, DataFrame]], store_path: str | None = None):
    """Evaluate checks; optionally write the failing rows of each check (as
    JSON text, so different schemas share one table) to ``store_path``."""
    results = []
    for name, (severity, df) in checks.items():
        n = df.count()
        results.append(CheckResult(name, severity, n))
        if store_path and n:
            (df.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
                       F.to_json(F.struct(*df.columns)).alias("failure_row"))
             .write.mode("append").parquet(store_path))
    return results
