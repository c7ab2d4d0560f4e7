"""Enrichment layer (J-family, I12). Each function takes staged DataFrames
and returns an enriched DataFrame; nothing is materialised."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import core as fn


# J01 ----------------------------------------------------------------------
def encounters_enriched(enc_attrs: DataFrame, hospitals: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Encounter + tenant + patient/provider/facility attributes + diagnosis.

    ``enc_attrs`` is B05 computed with the validation joins' attributes kept,
    so patients/providers/facilities are not joined a second time. Tenants and
    diagnosis codes are small dimensions; the optimizer chooses their join."""
    h = hospitals.select("hospital_id", "hospital_name", "hospital_type", "region", "teaching_hospital")
    d = diagnoses.select(F.col("diagnosis_code").alias("primary_diagnosis_code"), "diagnosis_description",
                         F.col("category").alias("diagnosis_category"), "severity_level", "is_chronic")
    return (enc_attrs.join(h, "hospital_id")
            .join(d, "primary_diagnosis_code", "left")
            .select(
                "encounter_id", "hospital_id", "patient_id", "provider_id", "facility_id",
                "hospital_name", "hospital_type", "region", "teaching_hospital",
                "age_years", "age_group", "gender", "race", "ethnicity",
                "provider_full_name", "specialty", "department", "provider_type",
                "facility_name", "facility_type",
                "primary_diagnosis_code", "diagnosis_description", "diagnosis_category", "severity_level",
                "is_chronic", "encounter_type", "admission_source", "discharge_disposition",
                "admission_date", "discharge_date", "length_of_stay", "admission_date_day",
                "admission_date_month", "admission_date_quarter", "admission_date_year",
                "admission_day_of_week", "total_charges", "is_readmission", "is_mortality",
                "is_emergency", "is_transfer", "loaded_at_timestamp"))


# J02 ----------------------------------------------------------------------
def patient_journey(enriched: DataFrame) -> DataFrame:
    """Per-patient history columns and any-type 30/7-day return flags.

    The per-patient history is a window aggregate over the same partition as
    the lag (patient, tenant), so one sort serves both and no join back is
    needed; encounter_id is unique per row, so counts replace count-distinct."""
    p = Window.partitionBy("patient_id", "hospital_id")
    o = p.orderBy("admission_date", "encounter_id")
    chronic = F.sum(F.when(F.col("is_chronic"), 1).otherwise(0)).over(p)
    out = (enriched
           .withColumn("patient_total_encounters", F.count("encounter_id").over(p))
           .withColumn("patient_inpatient_count",
                       F.count(F.when(F.col("encounter_type") == "Inpatient", F.col("encounter_id"))).over(p))
           .withColumn("patient_emergency_count",
                       F.count(F.when(F.col("encounter_type") == "Emergency", F.col("encounter_id"))).over(p))
           .withColumn("patient_chronic_conditions", chronic)
           .withColumn("patient_risk_category",
                       F.when(F.col("patient_chronic_conditions") >= 3, "High Risk")
                       .when(F.col("patient_chronic_conditions") >= 1, "Medium Risk").otherwise("Low Risk"))
           .withColumn("previous_discharge_date", F.lag("discharge_date").over(o))
           .withColumn("days_since_last_discharge",
                       fn.boundary_diff("day", "previous_discharge_date", "admission_date")))
    d = F.col("days_since_last_discharge")
    return (out.withColumn("is_30day_return", F.coalesce(d.between(1, 30), F.lit(False)))
            .withColumn("is_7day_return", F.coalesce(d.between(1, 7), F.lit(False))))


def _hosp(hospitals: DataFrame) -> DataFrame:
    return hospitals.select("hospital_id", "hospital_name", "hospital_type", "region")


# J03 ----------------------------------------------------------------------
def vitals_enriched(vitals: DataFrame, encounters: DataFrame, patients: DataFrame,
                    hospitals: DataFrame) -> DataFrame:
    """Per-encounter vital trends (one window spec, every lag from one sort),
    NEWS / NEWS2 / qSOFA partial scores and composite alerts."""
    from ..functions import scores as S
    c = F.col
    w = Window.partitionBy("patient_id", "encounter_id").orderBy("measurement_datetime", "vital_id")
    enc = encounters.select("encounter_id", "encounter_type", "admission_date", "primary_diagnosis_code")
    pat = patients.select("patient_id", "age_years", "age_group", "gender")
    # Trends are computed over all vitals of the encounter (before the
    # validity joins). Hash-partitioning on encounter_id once serves both the
    # window (partition keys contain encounter_id) and the encounter join.
    v = vitals.repartition("encounter_id")
    for src, dst in [("temperature_f", "previous_temperature_f"), ("heart_rate_bpm", "previous_heart_rate_bpm"),
                     ("systolic_bp", "previous_systolic_bp"),
                     ("oxygen_saturation_pct", "previous_oxygen_saturation_pct"),
                     ("measurement_datetime", "previous_measurement_datetime")]:
        v = v.withColumn(dst, F.lag(src).over(w))
    v = v.withColumn("measurement_sequence", F.row_number().over(w))
    total_news = c("news_respiratory_score") + c("news_oxygen_score") + c("news_systolic_score") + c("news_heart_rate_score")
    temp_c = S.f_to_c("temperature_f")
    d_temp = c("temperature_f") - c("previous_temperature_f")
    d_hr = c("heart_rate_bpm") - c("previous_heart_rate_bpm")
    d_sbp = c("systolic_bp") - c("previous_systolic_bp")
    d_o2 = c("oxygen_saturation_pct") - c("previous_oxygen_saturation_pct")
    return (v.join(enc, "encounter_id").join(_hosp(hospitals), "hospital_id").join(pat, "patient_id")
            .select(
                "vital_id", "hospital_id", "encounter_id", "patient_id", "hospital_name", "hospital_type", "region",
                "age_years", "age_group", "gender", "encounter_type", "admission_date", "primary_diagnosis_code",
                "measurement_datetime", "position", "measured_by_role", "measurement_sequence",
                "temperature_f", "heart_rate_bpm", "respiratory_rate", "systolic_bp", "diastolic_bp",
                "oxygen_saturation_pct", "weight_kg", "height_cm", "bmi", "pain_score", "map_mmhg",
                "is_febrile", "is_hypothermic", "is_tachycardic", "is_bradycardic", "is_tachypneic", "is_bradypneic",
                "is_hypertensive", "is_hypotensive", "is_hypoxic", "is_obese", "has_severe_pain",
                "news_respiratory_score", "news_oxygen_score", "news_systolic_score", "news_heart_rate_score",
                total_news.alias("total_news_score"),
                S.news_category(total_news).alias("news_risk_category"),
                S.news2(respiratory_rate="respiratory_rate", spo2="oxygen_saturation_pct", temperature_c=temp_c,
                        systolic_bp="systolic_bp", heart_rate="heart_rate_bpm").alias("news2_partial_score"),
                S.qsofa("respiratory_rate", "systolic_bp").alias("qsofa_partial_score"),
                "previous_temperature_f", "previous_heart_rate_bpm", "previous_systolic_bp",
                "previous_oxygen_saturation_pct", "previous_measurement_datetime",
                fn.boundary_diff("minute", "previous_measurement_datetime", "measurement_datetime")
                .alias("minutes_since_last_vitals"),
                d_temp.alias("temperature_change"), d_hr.alias("heart_rate_change"),
                d_sbp.alias("systolic_bp_change"), d_o2.alias("oxygen_sat_change"),
                F.coalesce((d_temp > 2.0) | (d_hr > 30) | (d_sbp < -30) | (d_o2 < -5), F.lit(False))
                .alias("rapid_deterioration_flag"),
                fn.boundary_diff("day", "admission_date", "measurement_datetime").alias("encounter_day_of_measurement"),
                fn.boundary_diff("hour", "admission_date", "measurement_datetime").alias("encounter_hour_of_measurement"),
                (c("is_hypotensive") & c("is_tachycardic") & c("is_hypoxic")).alias("sepsis_alert"),
                (c("is_hypertensive") & c("has_severe_pain")).alias("hypertensive_crisis_alert"),
                (c("is_hypoxic") & c("is_tachypneic")).alias("respiratory_distress_alert"),
                "loaded_at_timestamp"))


# J05 ----------------------------------------------------------------------
def _like_any(c, patterns):
    from functools import reduce
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def lab_panel_category(test_name) -> F.Column:
    # Panel name patterns, first match wins.
    t = F.lower(F.col(test_name) if isinstance(test_name, str) else test_name)
    return (F.when(_like_any(t, ["%cbc%", "%hemoglobin%", "%hematocrit%", "%platelet%", "%wbc%"]), "Complete Blood Count")
            .when(_like_any(t, ["%sodium%", "%potassium%", "%chloride%", "%bicarb%", "%glucose%"]), "Basic Metabolic Panel")
            .when(_like_any(t, ["%cmp%", "%albumin%", "%calcium%", "%protein%"]), "Comprehensive Metabolic Panel")
            .when(_like_any(t, ["%ast%", "%alt%", "%bilirubin%", "%alkaline%"]), "Liver Function Panel")
            .when(_like_any(t, ["%lipid%", "%cholesterol%", "%triglyceride%", "%hdl%", "%ldl%"]), "Lipid Panel")
            .when(t.like("%troponin%"), "Cardiac Marker")
            .when(_like_any(t, ["%pt%", "%inr%", "%ptt%", "%aptt%"]), "Coagulation Panel")
            .otherwise("Other"))


# Critical-value rule (analyte pattern, below, above).
CRITICAL_LAB_RULES = [("%glucose%", 40, 500), ("%potassium%", 2.5, 6.5), ("%sodium%", 120, 160),
                      ("%hemoglobin%", 6, None), ("%creatinine%", None, 10), ("%troponin%", None, 0.5)]


def is_critical_lab(test_name, value) -> F.Column:
    t = F.lower(F.col(test_name))
    v = F.col(value)
    out = None
    for pat, lo, hi in CRITICAL_LAB_RULES:
        for cond in ([t.like(pat) & (v < lo)] if lo is not None else []) + ([t.like(pat) & (v > hi)] if hi is not None else []):
            out = F.when(cond, F.lit(True)) if out is None else out.when(cond, F.lit(True))
    return out.otherwise(F.lit(False))


def _valid_only(df: DataFrame, dims: list[tuple[DataFrame, str]], absent: dict[str, str]) -> DataFrame:
    """For an aggregate that reads no attribute of its dimensions: the rows
    that the inner joins keep (semi joins on unique keys), the attributes and
    the optional joins' columns left NULL."""
    for dim, key in dims:
        df = df.join(dim.select(key), key, "left_semi")
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in absent.items()})


def lab_results_enriched(results: DataFrame, orders: DataFrame, encounters: DataFrame, patients: DataFrame,
                         providers: DataFrame, hospitals: DataFrame, narrow: bool = False) -> DataFrame:
    """``narrow``: without the attributes of tenant, stay, patient and providers."""
    c = F.col
    w = Window.partitionBy("patient_id", "test_code").orderBy("result_datetime", "result_id")
    lr = (results.filter(c("result_type") == "LAB")
          .withColumn("previous_result_value", F.lag("result_value_numeric").over(w))
          .withColumn("previous_result_datetime", F.lag("result_datetime").over(w))
          .withColumn("result_sequence", F.row_number().over(w)))
    enc = encounters.select("encounter_id", "encounter_type", "admission_date", "primary_diagnosis_code")
    pat = patients.select("patient_id", "age_years", "age_group", "gender")
    lo = orders.filter(c("order_type") == "LAB").select("order_id", c("provider_id").alias("lo_provider_id"),
                                                         c("completion_time_hours").alias("order_completion_hours"))
    ord_prov = providers.select(c("provider_id").alias("lo_provider_id"),
                                c("provider_full_name").alias("ordering_provider_name"),
                                c("specialty").alias("ordering_provider_specialty"))
    int_prov = providers.select(c("provider_id").alias("interpreting_provider_id"),
                                c("provider_full_name").alias("interpreting_provider_name"))
    v, prev = c("result_value_numeric"), c("previous_result_value")
    if narrow:
        names = ["hospital_name", "hospital_type", "region", "age_group", "gender", "encounter_type", "primary_diagnosis_code",
                 "ordering_provider_name", "ordering_provider_specialty", "interpreting_provider_name"]
        j = _valid_only(lr, [(hospitals, "hospital_id"), (encounters, "encounter_id"), (patients, "patient_id")],
                        {**dict.fromkeys(names, "string"), "age_years": "int", "admission_date": "timestamp_ntz"})
        j = j.join(lo, "order_id", "left")
    else:
        j = (lr.join(_hosp(hospitals), "hospital_id").join(enc, "encounter_id").join(pat, "patient_id")
             .join(lo, "order_id", "left"))
        j = left_join_sparse(j, int_prov, ["interpreting_provider_id"], "result_id")
        j = left_join_sparse(j, ord_prov, ["lo_provider_id"], "result_id")
    return j.select(
        "result_id", "hospital_id", "order_id", "patient_id", "encounter_id", "hospital_name", "hospital_type",
        "region", "age_years", "age_group", "gender", "encounter_type", "admission_date", "primary_diagnosis_code",
        "ordering_provider_name", "ordering_provider_specialty", "interpreting_provider_name",
        "test_code", "test_name", "component_code", "component_name", "result_value", "result_value_numeric",
        "result_units", "reference_range_low", "reference_range_high", "abnormal_flag", "result_datetime",
        "collected_datetime", "resulted_datetime", "result_status", "performing_lab", "is_abnormal", "is_high",
        "is_low", "is_final", "is_preliminary", "turnaround_time_hours", "order_completion_hours",
        "out_of_range_value",
        F.when(c("out_of_range_value") > 0, c("out_of_range_value").cast("double") * 100.0
               / F.nullif(c("reference_range_high"), F.lit(0)).cast("double")).otherwise(F.lit(0.0))
        .alias("percent_above_range"),
        "previous_result_value", "previous_result_datetime", "result_sequence",
        (v - prev).alias("result_change"),
        F.when(prev.isNotNull() & (prev != 0), (v - prev).cast("double") * 100.0 / prev.cast("double"))
        .alias("result_change_pct"),
        fn.boundary_diff("day", "previous_result_datetime", "result_datetime").alias("days_since_previous_result"),
        F.when(v > prev, "Increasing").when(v < prev, "Decreasing").when(v == prev, "Stable")
        .otherwise("First Result").alias("trend_direction"),
        is_critical_lab("test_name", "result_value_numeric").alias("is_critical_value"),
        lab_panel_category("test_name").alias("lab_panel_category"),
        fn.boundary_diff("day", "admission_date", "result_datetime").alias("encounter_day_of_result"),
        "loaded_at_timestamp")


# J08 ----------------------------------------------------------------------
def revenue_cycle(billing: DataFrame, payers: DataFrame, encounters: DataFrame) -> DataFrame:
    c = F.col
    # a code list: of a list of unknown size Spark would deal all billing rows by its few keys
    p = F.broadcast(payers.select("payer_id", "payer_name", "payer_type", c("reimbursement_rate").alias("expected_reimbursement_rate")))
    e = encounters.select("encounter_id", "encounter_type", "discharge_date")
    j = (billing.join(p, "payer_id").join(e, "encounter_id")
         .withColumn("days_in_ar", fn.boundary_diff("day", "discharge_date", "transaction_date")))
    d = c("days_in_ar")
    expected = c("charge_amount") * c("expected_reimbursement_rate")
    return j.select(
        "transaction_id", "hospital_id", "encounter_id", "patient_id", "payer_id", "payer_name", "payer_type",
        "expected_reimbursement_rate", "encounter_type", "discharge_date", "transaction_date", "days_in_ar",
        "charge_amount", "payment_amount", "adjustment_amount", "collected_amount", "denied_amount",
        "collection_rate_pct", expected.alias("expected_payment"),
        (c("payment_amount") - expected).alias("payment_variance"),
        "payment_status", "denial_reason", "is_denied", "is_paid", "is_pending",
        F.coalesce(d > 90, F.lit(False)).alias("is_over_90_days"),
        F.coalesce(d > 60, F.lit(False)).alias("is_over_60_days"),
        F.coalesce(d > 30, F.lit(False)).alias("is_over_30_days"),
        F.when(d <= 30, "0-30 days").when(d <= 60, "31-60 days").when(d <= 90, "61-90 days")
        .when(d <= 120, "91-120 days").otherwise("120+ days").alias("ar_aging_bucket"))


def left_join_sparse(left: DataFrame, right: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """Left join on a key that is NULL in many left rows. These match nothing;
    in place of the NULL they get one of 4096 keys that no right row has, so
    they are dealt over all tasks instead of piling up in one."""
    first, rest = keys[0], keys[1:]
    stand_in = F.concat(F.lit("\u0000null "), F.pmod(F.xxhash64(spread_by), F.lit(4096)).cast("string"))
    return (left.withColumn("_sparse", F.coalesce(F.col(first), stand_in))
            .join(right.withColumnRenamed(first, "_sparse"), ["_sparse", *rest], "left").drop("_sparse"))


# J04 ----------------------------------------------------------------------
def orders_enriched(orders: DataFrame, results: DataFrame, encounters: DataFrame, patients: DataFrame,
                    providers: DataFrame, hospitals: DataFrame, procedures: DataFrame) -> DataFrame:
    c = F.col
    enc = encounters.select("encounter_id", "encounter_type", "admission_date", "primary_diagnosis_code")
    pat = patients.select("patient_id", "age_years", "age_group", "gender")
    prov = providers.select("provider_id", c("provider_full_name").alias("ordering_provider_name"),
                            c("specialty").alias("ordering_provider_specialty"),
                            c("department").alias("ordering_provider_department"))
    res = results.select("result_id", c("is_final").alias("result_is_final"),
                         c("turnaround_time_hours").alias("result_turnaround_hours"), "result_datetime",
                         "abnormal_flag")
    proc = procedures.select(c("procedure_code").alias("order_code"), "typical_charge_midpoint")
    j = (orders.join(_hosp(hospitals), "hospital_id").join(enc, "encounter_id").join(pat, "patient_id")
         .join(prov, "provider_id").join(proc, "order_code", "left"))
    j = left_join_sparse(j, res, ["result_id"], "order_id")      # most orders have no result
    return j.select(
        "order_id", "hospital_id", "encounter_id", "patient_id", "provider_id", "hospital_name", "hospital_type",
        "region", "age_years", "age_group", "gender", "encounter_type", "admission_date", "primary_diagnosis_code",
        "ordering_provider_name", "ordering_provider_specialty", "ordering_provider_department",
        "order_type", "order_code", "order_description", "order_status", "priority", "order_datetime",
        "scheduled_datetime", "completed_datetime", "medication_name", "dose", "route", "frequency",
        "duration_days", "specimen_type", "collection_datetime", "is_completed", "is_cancelled", "is_stat_order",
        "completion_time_hours", "scheduled_delay_hours", "result_id", "result_is_final", "result_turnaround_hours",
        "abnormal_flag", "typical_charge_midpoint",
        fn.boundary_diff("hour", "order_datetime", "result_datetime").alias("order_to_result_hours"),
        fn.boundary_diff("day", "admission_date", "order_datetime").alias("encounter_day_of_order"),
        F.coalesce(c("is_stat_order") & (c("completion_time_hours") > 1), F.lit(False)).alias("stat_order_delayed"),
        F.coalesce((c("order_type") == "LAB") & (c("result_turnaround_hours") > 24), F.lit(False))
        .alias("lab_turnaround_delayed"),
        F.coalesce((c("order_type") == "RADIOLOGY") & (c("completion_time_hours") > 48), F.lit(False))
        .alias("radiology_delayed"),
        "loaded_at_timestamp")


def orders_for_measures(orders: DataFrame, encounters: DataFrame, patients: DataFrame, providers: DataFrame,
                        hospitals: DataFrame) -> DataFrame:
    """The rows of J04 with only what the quality measures look at: the valid
    orders and their day in the stay, without descriptions to join."""
    c = F.col
    return (orders.join(encounters.select("encounter_id", "admission_date"), "encounter_id")
            .join(hospitals.select("hospital_id"), "hospital_id", "left_semi")
            .join(patients.select("patient_id"), "patient_id", "left_semi")
            .join(providers.select("provider_id"), "provider_id", "left_semi")
            .select("encounter_id", "order_type", "medication_name", "order_description", "completion_time_hours",
                    fn.boundary_diff("day", c("admission_date"), c("order_datetime")).alias("encounter_day_of_order")))


# J06 ----------------------------------------------------------------------
# High-risk medication name patterns.
HIGH_RISK_MEDICATIONS = ["%warfarin%", "%heparin%", "%insulin%", "%morphine%", "%fentanyl%"]


def medication_safety(med_admin: DataFrame, orders: DataFrame, allergies: DataFrame, encounters: DataFrame,
                      patients: DataFrame, providers: DataFrame, hospitals: DataFrame, narrow: bool = False) -> DataFrame:
    """C10 substring theta join (drug contains allergen or the reverse) kept
    on the equi keys (patient, tenant) so it never becomes a cross product,
    then E07 most-severe match per administration via row_number.

    The top-1 window is partitioned by (patient_id, hospital_id, admin_id):
    admin_id determines the patient, so the result equals a partition by
    admin_id alone, and the join's hash partitioning on (patient_id,
    hospital_id) already satisfies it - no extra shuffle."""
    c = F.col
    alg = (allergies.filter(c("is_active") & (c("allergen_type") == "DRUG"))
           .select("patient_id", "hospital_id", "allergy_id", "allergen_name",
                   c("severity").alias("allergy_severity"), "reaction_type"))
    m = med_admin.alias("m")
    a = alg.alias("a")
    med, agn = F.lower(c("m.medication_name")), F.lower(c("a.allergen_name"))
    cond = ((c("m.patient_id") == c("a.patient_id")) & (c("m.hospital_id") == c("a.hospital_id"))
            & (med.contains(agn) | agn.contains(med)))
    top = Window.partitionBy("m.patient_id", "m.hospital_id", "m.admin_id").orderBy(
        fn.severity_rank("a.allergy_severity").asc(), c("a.allergy_id").asc_nulls_last())
    checked = (m.join(a, cond, "left")
               .withColumn("_rn", F.row_number().over(top)).filter(c("_rn") == 1)
               .select("m.*", "a.allergen_name", "a.allergy_severity", "a.reaction_type",
                       c("a.allergy_id").isNotNull().alias("potential_allergy_conflict")))
    enc = encounters.select("encounter_id", "encounter_type", "admission_date", "length_of_stay")
    pat = patients.select("patient_id", "age_years", "age_group", "gender")
    adm_prov = providers.select(c("provider_id").alias("administered_by_provider_id"),
                                c("provider_full_name").alias("administering_provider_name"),
                                c("specialty").alias("administering_provider_specialty"),
                                c("provider_type").alias("administering_provider_type"))
    wit_prov = providers.select(c("provider_id").alias("witnessed_by_provider_id"),
                                c("provider_full_name").alias("witnessing_provider_name"))
    mo = (orders.filter(c("order_type") == "MEDICATION")
          .select("order_id", "order_datetime", "frequency", "duration_days"))
    if narrow:
        names = ["hospital_name", "hospital_type", "region", "age_group", "gender", "encounter_type", "frequency",
                 "administering_provider_name", "administering_provider_specialty", "administering_provider_type",
                 "witnessing_provider_name"]
        j = _valid_only(checked, [(hospitals, "hospital_id"), (encounters, "encounter_id"), (patients, "patient_id")],
                        {**dict.fromkeys(names, "string"), "age_years": "int", "length_of_stay": "int", "duration_days": "int",
                         "admission_date": "timestamp_ntz", "order_datetime": "timestamp_ntz"})
    else:
        j = (checked.join(_hosp(hospitals), "hospital_id").join(enc, "encounter_id").join(pat, "patient_id")
             .join(mo, "order_id", "left"))
        j = left_join_sparse(j, adm_prov, ["administered_by_provider_id"], "admin_id")
        j = left_join_sparse(j, wit_prov, ["witnessed_by_provider_id"], "admin_id")
    given = c("is_given")
    return j.select(
        "admin_id", "hospital_id", "encounter_id", "patient_id", "order_id", "hospital_name", "hospital_type",
        "region", "age_years", "age_group", "gender", "encounter_type", "admission_date", "length_of_stay",
        "administering_provider_name", "administering_provider_specialty", "administering_provider_type",
        "witnessing_provider_name", "medication_name", "dose", "route", "scheduled_datetime",
        "administered_datetime", "administration_status", "order_datetime", "frequency", "duration_days",
        "refusal_reason", "hold_reason", "barcode_scanned", "is_verified", "is_witnessed", "adverse_reaction_flag",
        "reaction_description", "potential_allergy_conflict",
        c("allergen_name").alias("conflicting_allergen"),
        c("allergy_severity").alias("conflicting_allergy_severity"),
        c("reaction_type").alias("expected_reaction_type"),
        "is_given", "is_refused", "is_held", "is_missed", "is_late_administration", "administration_delay_minutes",
        F.coalesce(c("potential_allergy_conflict") & given, F.lit(False)).alias("given_despite_allergy"),
        F.coalesce(~c("is_verified") & given, F.lit(False)).alias("given_without_verification"),
        F.coalesce(c("is_late_administration") & given, F.lit(False)).alias("late_administration"),
        F.coalesce(c("adverse_reaction_flag"), F.lit(False)).alias("has_adverse_reaction"),
        F.coalesce(_like_any(F.lower(c("medication_name")), HIGH_RISK_MEDICATIONS), F.lit(False))
        .alias("is_high_risk_medication"),
        F.coalesce((c("route") == "IV") & ~c("is_witnessed"), F.lit(False)).alias("iv_given_without_witness"),
        fn.boundary_diff("day", "admission_date", "administered_datetime").alias("encounter_day_of_admin"),
        fn.boundary_diff("hour", "order_datetime", "administered_datetime").alias("hours_from_order_to_admin"),
        "loaded_at_timestamp")


# J10 ----------------------------------------------------------------------
# Door-to-treatment targets (minutes) per timed measure.
MEASURE_TARGET_MINUTES = {"SEP-1": 60, "AMI-8a": 90, "STK-4": 60}


def measure_results(measures: DataFrame, encounters: DataFrame) -> DataFrame:
    from ..functions.scores import lookup
    c = F.col
    e = encounters.select("encounter_id", "hospital_id", "provider_id", "facility_id", "encounter_type",
                          "admission_date", "is_mortality")
    j = (measures.join(e, ["encounter_id", "hospital_id"])
         .withColumn("time_to_treatment_minutes", F.coalesce("door_to_antibiotic_minutes", "door_to_balloon_minutes",
                                                             "door_to_needle_minutes"))
         .withColumn("target_minutes", lookup("measure_code", MEASURE_TARGET_MINUTES, None)))
    return j.select(
        "measure_id", "hospital_id", "encounter_id", "patient_id", "provider_id", "facility_id", "encounter_type",
        "admission_date", "is_mortality", "measure_code", "measure_name", "measure_category", "reporting_year",
        "reporting_quarter", "denominator_eligible", "exclusion_applied", "exclusion_reason", "is_measure_eligible",
        "is_numerator_met", "gap_in_care", "time_to_treatment_minutes", "target_minutes", "compliance_flag",
        c("target_minutes").isNotNull().alias("is_timed_measure"),
        F.when(c("target_minutes").isNull() | c("time_to_treatment_minutes").isNull(), F.lit(None))
        .otherwise(c("time_to_treatment_minutes") <= c("target_minutes")).alias("met_time_target"),
        (c("is_measure_eligible") & F.coalesce(c("compliance_flag"), F.lit(False))).alias("is_performance_met"))


# I12 ----------------------------------------------------------------------
def comorbidity_index(patients: DataFrame, problems: DataFrame, encounters: DataFrame) -> DataFrame:
    """G02 union distinct of active problems and encounter diagnoses -> I10
    condition per code -> D08 pivoted bool_or flags per patient -> weighted
    sum with severe-supersedes-mild -> age points and severity band."""
    from ..functions import scores as S
    c = F.col
    # union (no distinct needed: the per-patient reduction is an idempotent bit_or)
    dx = (problems.filter(c("is_active")).select("hospital_id", "patient_id", "diagnosis_code")
          .unionByName(encounters.filter(c("primary_diagnosis_code").isNotNull())
                       .select("hospital_id", "patient_id", c("primary_diagnosis_code").alias("diagnosis_code"))))
    names = [n for n, *_ in S.CHARLSON]
    # I10 as a lookup: a ~250-row prefix table generated from the rule lists
    # (fixed size, broadcast); each code probes its 3- and 4-character
    # prefix and keeps the earliest rule it matches.
    spark = dx.sparkSession
    px = spark.createDataFrame(S.charlson_prefix_rows(), "plen int, prefix string, rule int")
    p3 = F.broadcast(px.filter(c("plen") == 3).select(c("prefix").alias("_p3"), c("rule").alias("_r3")))
    p4 = F.broadcast(px.filter(c("plen") == 4).select(c("prefix").alias("_p4"), c("rule").alias("_r4")))
    code = S.normalize_icd10("diagnosis_code")
    probed = (dx.select("hospital_id", "patient_id", F.substring(code, 1, 3).alias("_p3"),
                        F.substring(code, 1, 4).alias("_p4"))
              .join(p3, "_p3", "left").join(p4, "_p4", "left")
              .select("hospital_id", "patient_id", F.least("_r3", "_r4").alias("_rule"))
              .filter(c("_rule").isNotNull()))
    masks = (probed.groupBy("hospital_id", "patient_id")
             .agg(F.bit_or(F.expr("shiftleft(1, _rule)")).alias("_mask")))
    flags = masks.select("hospital_id", "patient_id",
                         *[((c("_mask").bitwiseAND(F.lit(1 << i))) != 0).alias(f"has_{n}") for i, n in enumerate(names)])
    superseded = {mild: severe for severe, mild in S.CHARLSON_SUPERSEDES}
    p = patients.select("hospital_id", "patient_id", "age_years").join(flags, ["patient_id", "hospital_id"], "left")
    for n in names:
        p = p.withColumn(f"has_{n}", F.coalesce(c(f"has_{n}"), F.lit(False)))
    index = None
    for n in names:
        cond = c(f"has_{n}")
        if n in superseded:
            cond = cond & ~c(f"has_{superseded[n]}")
        term = F.when(cond, F.lit(S.CHARLSON_WEIGHT[n])).otherwise(F.lit(0))
        index = term if index is None else index + term
    count = None
    for n in names:
        term = F.when(c(f"has_{n}"), 1).otherwise(0)
        count = term if count is None else count + term
    ci = c("charlson_index")
    return (p.withColumn("charlson_index", index)
            .withColumn("charlson_condition_count", count)
            .withColumn("charlson_age_points", S.charlson_age_points("age_years"))
            .withColumn("charlson_age_adjusted_index", ci + c("charlson_age_points"))
            .withColumn("charlson_severity", F.when(ci == 0, "None").when(ci <= 2, "Mild")
                        .when(ci <= 4, "Moderate").otherwise("Severe")))


# J07 ----------------------------------------------------------------------
def _ordered_listagg(value: str, order_cols: list[str], sep: str = "; ") -> F.Column:
    """listagg(value, sep) within group (order by order_cols desc), ties
    broken by the remaining struct fields (deterministic)."""
    s = F.sort_array(F.collect_list(F.struct(*order_cols, value)), asc=False)
    return F.when(F.size(s) > 0, F.array_join(F.transform(s, lambda x: x[value]), sep))


def patient_profile(patients: DataFrame, hospitals: DataFrame, problems: DataFrame, allergies: DataFrame,
                    coverage: DataFrame, vitals: DataFrame, sdoh: DataFrame, encounters: DataFrame,
                    med_admin: DataFrame, as_of: str) -> DataFrame:
    """Patient 360 (C03): seven per-patient pre-aggregations, each grouped by
    (patient_id, hospital_id), left-joined to the patient spine. The
    aggregates share one hash partitioning on the join keys, so the join
    chain needs no exchange beyond the aggregations' own."""
    c = F.col
    keys = ["patient_id", "hospital_id"]
    today = F.lit(as_of).cast("date")
    ap = (problems.filter(c("is_active")).groupBy(*keys).agg(
        F.count("problem_id").alias("active_problem_count"),
        F.count(F.when(c("is_chronic"), c("problem_id"))).alias("chronic_condition_count"),
        _ordered_listagg("diagnosis_description", ["onset_date", "problem_id"]).alias("active_diagnoses_list")))
    aa = (allergies.filter(c("is_active")).groupBy(*keys).agg(
        F.count("allergy_id").alias("active_allergy_count"),
        F.count(F.when(c("is_life_threatening"), c("allergy_id"))).alias("life_threatening_allergy_count"),
        F.count(F.when(c("is_drug_allergy"), c("allergy_id"))).alias("drug_allergy_count"),
        _ordered_listagg("allergen_name", ["documentation_date", "allergy_id"]).alias("active_allergies_list")))
    cc = (coverage.filter(c("is_active")).groupBy(*keys).agg(
        F.count("coverage_id").alias("active_coverage_count"),
        F.max(F.when(c("is_primary"), c("payer_id"))).alias("primary_payer_id"),
        F.max(F.when(c("is_primary"), c("plan_type"))).alias("primary_plan_type"),
        F.max(F.when(c("is_primary"), c("deductible_remaining"))).alias("primary_deductible_remaining"),
        F.max(F.when(c("is_primary"), c("out_of_pocket_remaining"))).alias("primary_oop_remaining")))
    rv = (vitals.filter(c("measurement_datetime") >= F.date_sub(today, 7)).groupBy(*keys).agg(
        F.count("vital_id").alias("vital_measurements_last_7days"),
        F.max("measurement_datetime").alias("last_vital_datetime"),
        fn.mean(F.when(c("is_febrile"), 1).otherwise(0)).alias("febrile_rate"),
        fn.mean(F.when(c("is_hypotensive"), 1).otherwise(0)).alias("hypotensive_rate"),
        fn.mean(F.when(c("is_hypoxic"), 1).otherwise(0)).alias("hypoxic_rate"),
        fn.mean("bmi").alias("avg_bmi"),
        F.max_by("total_news_score", F.struct("measurement_datetime", "vital_id")).alias("latest_news_score")))
    latest = F.struct("screening_date", "screening_id")
    sd = sdoh.groupBy(*keys).agg(
        F.max("screening_date").alias("last_sdoh_screening_date"),
        *[F.max_by(x, latest).alias(a) for x, a in [
            ("sdoh_risk_category", "current_sdoh_risk_category"), ("total_sdoh_risk_count", "current_sdoh_risk_count"),
            ("has_housing_risk", "has_housing_risk"), ("has_food_insecurity", "has_food_insecurity"),
            ("has_transportation_barriers", "has_transportation_barriers")]])
    eh = encounters.groupBy(*keys).agg(
        F.count("encounter_id").alias("total_encounters"),
        F.count(F.when(c("encounter_type") == "Emergency", c("encounter_id"))).alias("ed_visits"),
        F.count(F.when(c("encounter_type") == "Inpatient", c("encounter_id"))).alias("inpatient_admits"),
        F.count(F.when(c("is_readmission"), c("encounter_id"))).alias("readmissions"),
        F.sum("total_charges").alias("lifetime_charges"),
        F.max("admission_date").alias("last_encounter_date"))
    rm = (med_admin.filter(c("administered_datetime") >= F.date_sub(today, 30)).groupBy(*keys).agg(
        F.count("admin_id").alias("medication_administrations_30days"),
        F.count(F.when(c("is_refused"), c("admin_id"))).alias("medication_refusals_30days"),
        F.count(F.when(c("adverse_reaction_flag"), c("admin_id"))).alias("adverse_reactions_30days"),
        F.countDistinct("medication_name").alias("unique_medications_30days")))
    h = hospitals.select("hospital_id", "hospital_name", "hospital_type", "region")
    p = patients.select("patient_id", "hospital_id", "age_years", "age_group", "gender", "race", "ethnicity",
                        "zip_code_3digit", "primary_language", "marital_status", "first_encounter_date")
    j = p.join(h, "hospital_id")
    for df in (ap, aa, cc, rv, sd, eh, rm):
        j = j.join(df, keys, "left")
    z = lambda x: F.coalesce(c(x), F.lit(0))
    j = (j.withColumn("active_problem_count", z("active_problem_count"))
         .withColumn("chronic_condition_count", z("chronic_condition_count"))
         .withColumn("active_allergy_count", z("active_allergy_count"))
         .withColumn("life_threatening_allergy_count", z("life_threatening_allergy_count"))
         .withColumn("drug_allergy_count", z("drug_allergy_count"))
         .withColumn("active_coverage_count", z("active_coverage_count"))
         .withColumn("total_encounters", z("total_encounters"))
         .withColumn("ed_visits", z("ed_visits"))
         .withColumn("inpatient_admits", z("inpatient_admits"))
         .withColumn("readmissions", z("readmissions"))
         .withColumn("lifetime_charges", F.coalesce(c("lifetime_charges"), F.lit(0).cast("decimal(22,2)"))))
    chronic, ed, inp, tot = c("chronic_condition_count"), c("ed_visits"), c("inpatient_admits"), c("total_encounters")
    refusals = c("medication_refusals_30days")
    return (j.withColumn("clinical_risk_category",
                         F.when((chronic >= 3) & (ed >= 2), "Very High Risk")
                         .when((chronic >= 2) | (c("readmissions") >= 1), "High Risk")
                         .when(chronic >= 1, "Medium Risk").otherwise("Low Risk"))
            .withColumn("utilization_category",
                        F.when(ed >= 4, "Frequent ED User").when(inp >= 3, "Frequent Admits")
                        .when(tot >= 10, "High Utilizer").when(tot >= 5, "Moderate Utilizer").otherwise("Low Utilizer"))
            .withColumn("days_since_last_encounter", fn.boundary_diff("day", "last_encounter_date", today))
            .withColumn("patient_engagement_score",
                        F.when(refusals > 0, F.greatest(F.lit(0), 100 - refusals * 10)).otherwise(F.lit(100))))


# J09 ----------------------------------------------------------------------
def prior_auth_enriched(auths: DataFrame, payers: DataFrame, billing: DataFrame) -> DataFrame:
    c = F.col
    p = payers.select("payer_id", "payer_name", "payer_type")
    claims = billing.groupBy("hospital_id", "encounter_id").agg(
        F.sum("charge_amount").alias("encounter_charges"), F.sum("payment_amount").alias("encounter_payments"),
        F.bool_or("is_denied").alias("has_claim_denial"),
        F.bool_or(F.lower(c("denial_reason")).like("%prior authorization%")).alias("has_prior_auth_denial"))
    d = c("days_to_decision")
    j = auths.join(p, "payer_id", "left").join(claims, ["encounter_id", "hospital_id"], "left")
    return j.select(
        "auth_id", "hospital_id", "patient_id", "encounter_id", "payer_id", "payer_name", "payer_type", "auth_type",
        "service_code", "service_description", "auth_status", "is_approved", "is_denied", "is_pending", "is_expired",
        "expiring_soon", "denial_reason", "request_date",
        F.to_date(F.date_trunc("month", "request_date")).alias("request_month"), "decision_date", "days_to_decision",
        F.when(d.isNull(), "Pending").when(d <= 2, "0-2 days").when(d <= 7, "3-7 days").when(d <= 14, "8-14 days")
        .otherwise("15+ days").alias("decision_turnaround_bucket"),
        "units_authorized", "units_used", "units_remaining", "units_utilization_pct", "encounter_charges",
        "encounter_payments", F.coalesce(c("has_claim_denial"), F.lit(False)).alias("has_claim_denial"),
        F.coalesce(c("has_prior_auth_denial"), F.lit(False)).alias("has_prior_auth_denial"),
        F.when(c("is_denied") | c("is_pending"), F.coalesce(c("encounter_charges"), F.lit(0))).otherwise(F.lit(0))
        .alias("charges_at_risk"))


# J11 ----------------------------------------------------------------------
# Scheduling SLA days by urgency (others: 30).
REFERRAL_SLA_DAYS = {"EMERGENT": 2, "URGENT": 7}


def referrals_enriched(referrals: DataFrame, encounters: DataFrame, providers: DataFrame) -> DataFrame:
    from ..functions.scores import lookup
    c = F.col
    e = encounters.select("encounter_id", "hospital_id", c("encounter_type").alias("source_encounter_type"),
                          "discharge_disposition", "primary_diagnosis_code",
                          c("is_readmission").alias("source_encounter_is_readmission"))
    p = providers.select(c("provider_id").alias("referring_provider_id"), "hospital_id",
                         c("specialty").alias("referring_provider_specialty"))
    j = left_join_sparse(referrals, e, ["encounter_id", "hospital_id"], "referral_id")
    j = (left_join_sparse(j, p, ["referring_provider_id", "hospital_id"], "referral_id")
         .withColumn("scheduling_sla_days", lookup(F.upper(c("urgency")), REFERRAL_SLA_DAYS, 30)))
    return j.select(
        "referral_id", "hospital_id", "patient_id", "encounter_id", "referring_provider_id",
        "referring_provider_specialty", "referred_to_provider_id", "referred_to_facility", "referral_type",
        c("specialty").alias("referred_specialty"), "urgency", "referral_status", "is_completed", "is_pending",
        "is_cancelled", "referral_date", F.to_date(F.date_trunc("month", "referral_date")).alias("referral_month"),
        "appointment_date", "completion_date", "days_to_appointment", "days_to_completion", "follow_up_required",
        "follow_up_completed", "follow_up_overdue", "overdue_for_appointment", "source_encounter_type",
        "discharge_disposition", "primary_diagnosis_code", "source_encounter_is_readmission", "scheduling_sla_days",
        F.when(c("days_to_appointment").isNull(), F.lit(None))
        .otherwise(c("days_to_appointment") <= c("scheduling_sla_days")).alias("scheduled_within_sla"),
        F.coalesce(c("is_completed") & (~F.coalesce(c("follow_up_required"), F.lit(False))
                                        | F.coalesce(c("follow_up_completed"), F.lit(False))), F.lit(False))
        .alias("is_closed_loop"))
