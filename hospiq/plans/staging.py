"""Staging layer (B-family): one function per raw table, raw DataFrame in,
cleaned / flagged DataFrame out. Pure projections and filters except the
encounter model, which validates tenant ownership through joins (M08) and
derives readmission windows (E01/E02)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import core as fn
from ..sources.adapters import STAR_AS_OF


def _as_of(as_of: str | None) -> F.Column:
    return F.lit(as_of or STAR_AS_OF).cast("date")


# B06 ----------------------------------------------------------------------
def stg_hospitals(raw: DataFrame) -> DataFrame:
    return (raw.filter(F.col("is_active") == True)  # noqa: E712
            .select("hospital_id", "hospital_name", "hospital_type", "bed_count", "city", "state",
                    "region", "emr_system", "contract_tier", "contract_start_date", "is_active",
                    "teaching_hospital", F.col("_loaded_at").alias("loaded_at_timestamp")))


def stg_facilities(raw: DataFrame) -> DataFrame:
    return (raw.filter(F.col("is_active") == True)  # noqa: E712
            .select("facility_id", "hospital_id", "facility_name", "facility_type", "bed_capacity",
                    "is_active", "opened_date", F.col("_loaded_at").alias("loaded_at_timestamp")))


# B10 + M05/M06/M07 ----------------------------------------------------------
def stg_patients(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    exact = fn.age_years("date_of_birth", _as_of(as_of))
    return (raw.withColumn("exact_age_years", exact)
            .select(
                "patient_id", "hospital_id",
                F.when(F.col("exact_age_years") > 89, F.lit(None))
                .otherwise(F.year("date_of_birth")).alias("birth_year"),
                fn.least_strict("exact_age_years", F.lit(90)).alias("age_years"),
                (F.col("exact_age_years") > 89).alias("is_age_90_plus"),
                fn.age_group("exact_age_years").alias("age_group"),
                "gender", "race", "ethnicity",
                fn.deidentify_zip("zip_code").alias("zip_code_3digit"),
                "primary_language", "marital_status", "first_encounter_date",
                F.col("_loaded_at").alias("loaded_at_timestamp")))


# B13 ----------------------------------------------------------------------
def stg_providers(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    return raw.select(
        "provider_id", "hospital_id", "npi", "provider_first_name", "provider_last_name",
        F.concat(F.col("provider_first_name"), F.lit(" "), F.col("provider_last_name")).alias("provider_full_name"),
        "specialty", "department", "provider_type", "is_active", "accepts_new_patients", "hire_date",
        fn.boundary_diff("year", "hire_date", _as_of(as_of)).alias("years_of_service"),
        F.col("_loaded_at").alias("loaded_at_timestamp"))


# B18 / B19 ------------------------------------------------------------------
def stg_diagnoses(raw: DataFrame) -> DataFrame:
    return raw.select("diagnosis_code", "diagnosis_description", "category", "severity_level", "is_chronic",
                      F.col("_loaded_at").alias("loaded_at_timestamp"))


def stg_payers(raw: DataFrame) -> DataFrame:
    return raw.select("payer_id", "payer_name", "payer_type", "reimbursement_rate", "is_active",
                      F.col("_loaded_at").alias("loaded_at_timestamp"))


def stg_procedures(raw: DataFrame) -> DataFrame:
    return raw.select(
        "procedure_code", "procedure_description", "category", "typical_charge_min", "typical_charge_max",
        ((F.col("typical_charge_min") + F.col("typical_charge_max")) / 2).alias("typical_charge_midpoint"),
        (F.col("typical_charge_max") - F.col("typical_charge_min")).alias("typical_charge_range"),
        F.col("_loaded_at").alias("loaded_at_timestamp"))


# B05 ----------------------------------------------------------------------
ENCOUNTER_COLUMNS = [
    "encounter_id", "hospital_id", "patient_id", "provider_id", "facility_id", "primary_diagnosis_code",
    "encounter_type", "admission_source", "discharge_disposition", "admission_date", "discharge_date",
    "length_of_stay", "admission_date_day", "admission_date_month", "admission_date_year",
    "admission_date_quarter", "admission_day_of_week", "admission_day_of_week_num", "total_charges",
    "is_readmission", "days_since_last_discharge", "days_since_last_inpatient_discharge",
    "previous_encounter_id", "previous_discharge_date", "previous_encounter_type",
    "previous_inpatient_encounter_id", "previous_inpatient_discharge_date", "is_mortality",
    "is_emergency", "is_transfer", "loaded_at_timestamp", "source_updated_at_timestamp",
]


def encounters_validated(raw_enc: DataFrame, patients: DataFrame, providers: DataFrame,
                         facilities: DataFrame, attrs: bool = False) -> DataFrame:
    """B05 with the validation join columns kept (``attrs=True``) so that the
    enrichment layer can reuse them instead of joining the dimensions again.

    Join order is chosen for the shuffle plan: provider (shuffle on
    provider_id), facility, patient
    last, so the encounter rows end hash-partitioned on patient_id - which
    already satisfies the per-patient windows below and J02's per-patient
    aggregates (no further exchange)."""
    prov = providers.select("provider_id", F.col("hospital_id").alias("provider_hospital_id"),
                            *(["provider_full_name", "specialty", "department", "provider_type"] if attrs else []))
    fac = facilities.select("facility_id", F.col("hospital_id").alias("facility_hospital_id"),
                            *(["facility_name", "facility_type"] if attrs else []))
    pat = patients.select("patient_id", F.col("hospital_id").alias("patient_hospital_id"),
                          *(["age_years", "age_group", "gender", "race", "ethnicity"] if attrs else []))
    joined = (raw_enc.join(prov, "provider_id").join(fac, "facility_id").join(pat, "patient_id")
              .filter((F.col("hospital_id") == F.col("patient_hospital_id"))
                      & (F.col("hospital_id") == F.col("provider_hospital_id"))
                      & (F.col("hospital_id") == F.col("facility_hospital_id"))))
    any_w = Window.partitionBy("patient_id", "hospital_id").orderBy("admission_date", "encounter_id")
    # The lag inside the (encounter_type = 'Inpatient') partition equals,
    # for inpatient rows, the last earlier inpatient row of the same patient.
    # Written as a framed last(ignore nulls) over the *same* window partition
    # as E01, so one exchange + one sort serve every per-patient window.
    before = any_w.rowsBetween(Window.unboundedPreceding, -1)
    is_inp = F.col("encounter_type") == "Inpatient"
    prev_inp = F.last(F.when(is_inp, F.struct(F.col("discharge_date").alias("d"), F.col("encounter_id").alias("i"))),
                      ignorenulls=True).over(before)
    d = (joined
         .withColumn("previous_discharge_date", F.lag("discharge_date").over(any_w))
         .withColumn("previous_encounter_type", F.lag("encounter_type").over(any_w))
         .withColumn("previous_encounter_id", F.lag("encounter_id").over(any_w))
         .withColumn("_prev_inp", prev_inp)
         .withColumn("lag_inp_discharge", F.col("_prev_inp.d"))
         .withColumn("lag_inp_id", F.col("_prev_inp.i"))
         .withColumn("days_inp", fn.boundary_diff("day", "lag_inp_discharge", "admission_date")))
    out = d.select(
        "*",
        F.date_trunc("day", "admission_date").alias("admission_date_day"),
        F.date_trunc("month", "admission_date").alias("admission_date_month"),
        F.date_trunc("year", "admission_date").alias("admission_date_year"),
        F.date_trunc("quarter", "admission_date").alias("admission_date_quarter"),
        fn.day_name("admission_date").alias("admission_day_of_week"),
        (F.dayofweek("admission_date") - 1).alias("admission_day_of_week_num"),
        F.coalesce(is_inp & F.col("lag_inp_discharge").isNotNull() & F.col("days_inp").between(1, 30),
                   F.lit(False)).alias("is_readmission_calc"),
        F.when(F.col("previous_discharge_date").isNotNull(),
               fn.boundary_diff("day", "previous_discharge_date", "admission_date")).alias("days_since_last_discharge"),
        F.when(is_inp & F.col("lag_inp_discharge").isNotNull(), F.col("days_inp"))
        .alias("days_since_last_inpatient_discharge"),
        F.when(is_inp, F.col("lag_inp_id")).alias("previous_inpatient_encounter_id"),
        F.when(is_inp, F.col("lag_inp_discharge")).alias("previous_inpatient_discharge_date"),
        F.coalesce(F.col("discharge_disposition") == "Deceased", F.lit(False)).alias("is_mortality"),
        F.coalesce(F.col("encounter_type") == "Emergency", F.lit(False)).alias("is_emergency"),
        F.coalesce(F.col("admission_source") == "Transfer", F.lit(False)).alias("is_transfer"),
        F.col("_loaded_at").alias("loaded_at_timestamp"),
        F.col("_source_updated_at").alias("source_updated_at_timestamp"),
    ).drop("is_readmission").withColumnRenamed("is_readmission_calc", "is_readmission")
    valid = out.filter((F.col("discharge_date").isNull() | (F.col("discharge_date") >= F.col("admission_date")))
                       & (F.col("total_charges") >= 0) & (F.col("length_of_stay") >= 0)
                       & F.col("hospital_id").isNotNull())
    extra = (["provider_full_name", "specialty", "department", "provider_type", "facility_name",
              "facility_type", "age_years", "age_group", "gender", "race", "ethnicity"] if attrs else [])
    return valid.select(*ENCOUNTER_COLUMNS, *extra)


def stg_encounters(raw_enc: DataFrame, patients: DataFrame, providers: DataFrame,
                   facilities: DataFrame) -> DataFrame:
    return encounters_validated(raw_enc, patients, providers, facilities, attrs=False)


# B01 ----------------------------------------------------------------------
def stg_billing(raw: DataFrame) -> DataFrame:
    s = F.col("payment_status")
    return raw.select(
        "transaction_id", "hospital_id", "encounter_id", "patient_id", "payer_id", "transaction_date",
        "charge_amount", "payment_amount", "adjustment_amount", "denial_reason", "payment_status",
        F.when(s == "Paid", F.col("payment_amount")).otherwise(F.lit(0)).alias("collected_amount"),
        F.when(s == "Denied", F.col("charge_amount")).otherwise(F.lit(0)).alias("denied_amount"),
        F.when(s.isin("Paid", "Partial"),
               (F.col("payment_amount") + F.col("adjustment_amount")).cast("double") * 100.0
               / F.nullif(F.col("charge_amount"), F.lit(0)).cast("double"))
        .otherwise(F.lit(0.0)).alias("collection_rate_pct"),
        F.coalesce(s == "Denied", F.lit(False)).alias("is_denied"),
        F.coalesce(s == "Paid", F.lit(False)).alias("is_paid"),
        F.coalesce(s == "Pending", F.lit(False)).alias("is_pending"),
        F.col("_loaded_at").alias("loaded_at_timestamp"))


# B03 ----------------------------------------------------------------------
def stg_clinical_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id", "hospital_id", "encounter_id", "patient_id", "provider_id", "ordering_provider_id",
        "result_id", "order_type", "order_code", "order_description", "order_status", "priority",
        "performing_location", "order_datetime", "scheduled_datetime", "completed_datetime",
        "medication_name", "dose", "route", "frequency", "duration_days", "specimen_type", "collection_datetime",
        F.coalesce(F.col("order_status") == "COMPLETED", F.lit(False)).alias("is_completed"),
        F.coalesce(F.col("order_status") == "CANCELLED", F.lit(False)).alias("is_cancelled"),
        F.coalesce(F.col("priority") == "STAT", F.lit(False)).alias("is_stat_order"),
        fn.boundary_diff("hour", "order_datetime", "completed_datetime").alias("completion_time_hours"),
        fn.boundary_diff("hour", "order_datetime", "scheduled_datetime").alias("scheduled_delay_hours"),
        F.col("_loaded_at").alias("loaded_at_timestamp"), "_source_file")


# B04 ----------------------------------------------------------------------
def stg_clinical_results(raw: DataFrame) -> DataFrame:
    v, lo, hi = F.col("result_value_numeric"), F.col("reference_range_low"), F.col("reference_range_high")
    flag = F.col("abnormal_flag")
    return raw.select(
        "result_id", "hospital_id", "order_id", "patient_id", "encounter_id", "interpreting_provider_id",
        "result_type", "test_code", "test_name", "component_code", "component_name", "result_value",
        "result_value_numeric", "result_units", "reference_range_low", "reference_range_high", "abnormal_flag",
        "result_datetime", "collected_datetime", "resulted_datetime", "result_status", "performing_lab",
        "imaging_modality", "impression", "report_text",
        F.coalesce(flag.isin("H", "L", "A"), F.lit(False)).alias("is_abnormal"),
        F.coalesce(flag == "H", F.lit(False)).alias("is_high"),
        F.coalesce(flag == "L", F.lit(False)).alias("is_low"),
        F.coalesce(F.col("result_status") == "FINAL", F.lit(False)).alias("is_final"),
        F.coalesce(F.col("result_status") == "PRELIMINARY", F.lit(False)).alias("is_preliminary"),
        fn.boundary_diff("hour", "collected_datetime", "resulted_datetime").alias("turnaround_time_hours"),
        F.when(v.isNotNull() & hi.isNotNull() & (v > hi), v - hi)
        .when(v.isNotNull() & lo.isNotNull() & (v < lo), lo - v).otherwise(F.lit(0)).alias("out_of_range_value"),
        F.col("_loaded_at").alias("loaded_at_timestamp"))


# B07 ----------------------------------------------------------------------
def stg_medication_administration(raw: DataFrame) -> DataFrame:
    st = F.col("administration_status")
    delay = fn.boundary_diff("minute", "scheduled_datetime", "administered_datetime")
    return raw.select(
        "admin_id", "hospital_id", "encounter_id", "patient_id", "order_id", "administered_by_provider_id",
        "witnessed_by_provider_id", "medication_name", "dose", "route", "scheduled_datetime",
        "administered_datetime", "administration_status", "refusal_reason", "hold_reason", "barcode_scanned",
        "adverse_reaction_flag", "reaction_description",
        F.coalesce(st == "GIVEN", F.lit(False)).alias("is_given"),
        F.coalesce(st == "REFUSED", F.lit(False)).alias("is_refused"),
        F.coalesce(st == "HELD", F.lit(False)).alias("is_held"),
        F.coalesce(st == "MISSED", F.lit(False)).alias("is_missed"),
        F.coalesce(F.col("barcode_scanned") == True, F.lit(False)).alias("is_verified"),  # noqa: E712
        F.col("witnessed_by_provider_id").isNotNull().alias("is_witnessed"),
        F.when(F.col("administered_datetime").isNotNull() & F.col("scheduled_datetime").isNotNull(), delay)
        .alias("administration_delay_minutes"),
        F.coalesce(delay > 60, F.lit(False)).alias("is_late_administration"),
        F.col("_loaded_at").alias("loaded_at_timestamp"))


# B17 ----------------------------------------------------------------------
def stg_vital_signs(raw: DataFrame) -> DataFrame:
    from ..functions import scores as S
    c = F.col

    def flag(cond):
        return F.coalesce(cond, F.lit(False))

    return raw.select(
        "vital_id", "hospital_id", "encounter_id", "patient_id", "measurement_datetime", "position",
        "measured_by_role", "temperature_f", "heart_rate_bpm", "respiratory_rate", "systolic_bp", "diastolic_bp",
        "oxygen_saturation_pct", "weight_kg", "height_cm", "bmi", "pain_score", "map_mmhg",
        flag(c("temperature_f") > 100.4).alias("is_febrile"),
        flag(c("temperature_f") < 95.0).alias("is_hypothermic"),
        flag(c("heart_rate_bpm") > 100).alias("is_tachycardic"),
        flag(c("heart_rate_bpm") < 60).alias("is_bradycardic"),
        flag(c("respiratory_rate") > 20).alias("is_tachypneic"),
        flag(c("respiratory_rate") < 12).alias("is_bradypneic"),
        flag((c("systolic_bp") > 140) | (c("diastolic_bp") > 90)).alias("is_hypertensive"),
        flag((c("systolic_bp") < 90) | (c("diastolic_bp") < 60)).alias("is_hypotensive"),
        flag(c("oxygen_saturation_pct") < 90).alias("is_hypoxic"),
        flag(c("bmi") >= 30).alias("is_obese"),
        flag(c("pain_score") >= 7).alias("has_severe_pain"),
        S.ranged_points("respiratory_rate", S.NEWS_RR_COMPONENT).alias("news_respiratory_score"),
        S.ranged_points("oxygen_saturation_pct", S.NEWS_SPO2_COMPONENT).alias("news_oxygen_score"),
        S.ranged_points("systolic_bp", S.NEWS_SBP_COMPONENT).alias("news_systolic_score"),
        S.ranged_points("heart_rate_bpm", S.NEWS_HR_COMPONENT).alias("news_heart_rate_score"),
        F.col("_loaded_at").alias("loaded_at_timestamp"))


def _flag(cond) -> F.Column:
    return F.coalesce(cond, F.lit(False))


def _days(a, b) -> F.Column:
    return fn.boundary_diff("day", a, b)


# B02 ----------------------------------------------------------------------
def stg_care_plans(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    c, today = F.col, _as_of(as_of)
    st = c("plan_status")
    return raw.select(
        "care_plan_id", "hospital_id", "encounter_id", "patient_id", "problem_description", "goal_description",
        "intervention_description", "plan_status", "start_date", "target_date", "completion_date",
        "created_by_provider_id", "assigned_to_provider_ids", "progress_notes", "last_evaluated_date",
        _flag(st == "ACTIVE").alias("is_active_plan"),
        _flag(st == "COMPLETED").alias("is_completed_plan"),
        _flag(st == "DISCONTINUED").alias("is_discontinued_plan"),
        F.when((st == "COMPLETED") & c("completion_date").isNotNull(), _days("start_date", "completion_date"))
        .when((st == "ACTIVE") & c("start_date").isNotNull(), _days("start_date", today)).alias("plan_duration_days"),
        F.when(c("target_date").isNotNull(), _days(today, "target_date")).alias("days_to_target"),
        F.when(c("last_evaluated_date").isNotNull(), _days("last_evaluated_date", today))
        .alias("days_since_last_evaluation"),
        _flag((st == "ACTIVE") & c("last_evaluated_date").isNotNull() & (_days("last_evaluated_date", today) > 90))
        .alias("overdue_for_evaluation"),
        _flag((st == "ACTIVE") & c("target_date").isNotNull() & (today > c("target_date"))).alias("past_target_date"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B08 ----------------------------------------------------------------------
def stg_patient_allergies(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    c, today = F.col, _as_of(as_of)
    st = c("allergy_status")
    return raw.select(
        "allergy_id", "hospital_id", "patient_id", "allergen_type", "allergen_code", "allergen_name",
        "reaction_type", "severity", "allergy_status", "onset_date", "resolution_date",
        "documented_by_provider_id", "documentation_date", "clinical_notes",
        _flag(st == "ACTIVE").alias("is_active"),
        _flag(c("severity") == "LIFE_THREATENING").alias("is_life_threatening"),
        _flag(c("severity").isin("SEVERE", "LIFE_THREATENING")).alias("is_severe"),
        _flag(c("allergen_type") == "DRUG").alias("is_drug_allergy"),
        _flag(c("allergen_type") == "FOOD").alias("is_food_allergy"),
        _flag(c("reaction_type") == "ANAPHYLAXIS").alias("is_anaphylaxis"),
        F.when((st == "RESOLVED") & c("resolution_date").isNotNull(), _days("onset_date", "resolution_date"))
        .when(st == "ACTIVE", _days("onset_date", today)).alias("allergy_duration_days"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B09 ----------------------------------------------------------------------
def stg_patient_coverage(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    c, today = F.col, _as_of(as_of)
    return raw.select(
        "coverage_id", "hospital_id", "patient_id", "payer_id", "policy_number", "group_number", "subscriber_id",
        "subscriber_relationship", "effective_date", "termination_date", "coverage_status", "plan_type",
        "coverage_level", "deductible_amount", "deductible_met_amount", "out_of_pocket_max", "out_of_pocket_met",
        "copay_amount", "coinsurance_pct", "coverage_priority",
        _flag(c("coverage_status") == "ACTIVE").alias("is_active"),
        _flag(c("coverage_priority") == 1).alias("is_primary"),
        _flag(c("coverage_priority") == 2).alias("is_secondary"),
        _flag(c("subscriber_relationship") == "SELF").alias("is_self_insured"),
        (c("deductible_amount") - c("deductible_met_amount")).alias("deductible_remaining"),
        (c("out_of_pocket_max") - c("out_of_pocket_met")).alias("out_of_pocket_remaining"),
        F.when(c("deductible_amount") > 0, c("deductible_met_amount").cast("double") * 100.0
               / c("deductible_amount").cast("double")).otherwise(0.0).alias("deductible_met_pct"),
        F.when(c("out_of_pocket_max") > 0, c("out_of_pocket_met").cast("double") * 100.0
               / c("out_of_pocket_max").cast("double")).otherwise(0.0).alias("out_of_pocket_met_pct"),
        F.when(c("coverage_status") == "ACTIVE", _days("effective_date", today))
        .when(c("termination_date").isNotNull(), _days("effective_date", "termination_date"))
        .alias("coverage_duration_days"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B11 ----------------------------------------------------------------------
def stg_prior_authorizations(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    c, today = F.col, _as_of(as_of)
    st = c("auth_status")
    to_exp = _days(today, "expiration_date")
    return raw.select(
        "auth_id", "hospital_id", "patient_id", "payer_id", "encounter_id", "auth_number", "auth_type",
        "service_code", "service_description", "auth_status", "request_date", "decision_date", "effective_date",
        "expiration_date", "units_authorized", "units_used", "units_remaining", "diagnosis_codes", "denial_reason",
        _flag(st == "APPROVED").alias("is_approved"), _flag(st == "DENIED").alias("is_denied"),
        _flag(st == "PENDING").alias("is_pending"),
        F.when(c("units_authorized").isNotNull() & (c("units_authorized") > 0),
               c("units_used").cast("double") * 100.0 / c("units_authorized").cast("double"))
        .alias("units_utilization_pct"),
        _flag((c("units_remaining") == 0) & c("units_authorized").isNotNull()).alias("is_fully_utilized"),
        F.when(c("decision_date").isNotNull(), _days("request_date", "decision_date")).alias("days_to_decision"),
        F.when(c("effective_date").isNotNull() & c("expiration_date").isNotNull(),
               _days("effective_date", "expiration_date")).alias("auth_duration_days"),
        F.when(c("expiration_date").isNotNull(), to_exp).alias("days_to_expiration"),
        _flag(c("expiration_date").isNotNull() & (today > c("expiration_date"))).alias("is_expired"),
        _flag(c("expiration_date").isNotNull() & to_exp.between(0, 30)).alias("expiring_soon"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B12 ----------------------------------------------------------------------
def stg_problem_list(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    c, today = F.col, _as_of(as_of)
    st = c("problem_status")
    return raw.select(
        "problem_id", "hospital_id", "patient_id", "diagnosis_code", "diagnosis_description", "problem_status",
        "onset_date", "resolution_date", "last_reviewed_date", "severity", "is_chronic", "is_primary_diagnosis",
        "documented_by_provider_id", "documentation_date",
        _flag(st == "ACTIVE").alias("is_active"), _flag(st == "RESOLVED").alias("is_resolved"),
        F.when((st == "RESOLVED") & c("resolution_date").isNotNull(), _days("onset_date", "resolution_date"))
        .when(st == "ACTIVE", _days("onset_date", today)).alias("problem_duration_days"),
        F.when(c("last_reviewed_date").isNotNull(), _days("last_reviewed_date", today)).alias("days_since_last_review"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B14 ----------------------------------------------------------------------
def stg_quality_measures(raw: DataFrame) -> DataFrame:
    c = F.col
    den, num, exc = c("denominator_eligible"), c("numerator_eligible"), c("exclusion_applied")
    return raw.select(
        "measure_id", "hospital_id", "encounter_id", "patient_id", "measure_code", "measure_name",
        "measure_category", "numerator_eligible", "denominator_eligible", "exclusion_applied", "exclusion_reason",
        "door_to_antibiotic_minutes", "door_to_balloon_minutes", "door_to_needle_minutes", "metric_component",
        "component_value", "component_timestamp", "compliance_flag", "reporting_quarter", "reporting_year",
        _flag(den & ~exc).alias("is_measure_eligible"),
        _flag(num & den & ~exc).alias("is_numerator_met"),
        _flag(c("compliance_flag") == True).alias("is_compliant"),  # noqa: E712
        _flag(den & ~exc & ~num).alias("gap_in_care"),
        _flag(c("door_to_antibiotic_minutes") <= 60).alias("met_antibiotic_timeliness"),
        _flag(c("door_to_balloon_minutes") <= 90).alias("met_balloon_timeliness"),
        _flag(c("door_to_needle_minutes") <= 30).alias("met_needle_timeliness"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B15 ----------------------------------------------------------------------
def stg_referrals(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    c, today = F.col, _as_of(as_of)
    st = c("referral_status")
    return raw.select(
        "referral_id", "hospital_id", "patient_id", "encounter_id", "referral_type", "referring_provider_id",
        "referred_to_provider_id", "referred_to_facility", "specialty", "referral_status", "referral_date",
        "appointment_date", "completion_date", "reason_for_referral", "diagnosis_codes", "urgency",
        "follow_up_required", "follow_up_completed",
        _flag(st == "COMPLETED").alias("is_completed"), _flag(st == "PENDING").alias("is_pending"),
        _flag(st == "CANCELLED").alias("is_cancelled"), _flag(c("urgency") == "URGENT").alias("is_urgent"),
        F.when(c("appointment_date").isNotNull(), _days("referral_date", "appointment_date")).alias("days_to_appointment"),
        F.when(c("completion_date").isNotNull(), _days("referral_date", "completion_date")).alias("days_to_completion"),
        _flag(c("follow_up_required") & ~c("follow_up_completed")).alias("follow_up_overdue"),
        _flag((st == "PENDING") & c("appointment_date").isNull() & (_days("referral_date", today) > 14))
        .alias("overdue_for_appointment"),
        c("_loaded_at").alias("loaded_at_timestamp"))


# B16 ----------------------------------------------------------------------
def stg_sdoh_screenings(raw: DataFrame) -> DataFrame:
    c = F.col

    def t(x):
        return _flag(c(x) == True)  # noqa: E712

    risk_count = (F.when(t("housing_concerns"), 1).otherwise(0) + F.when(t("food_insecurity_flag"), 1).otherwise(0)
                           + F.when(t("transportation_barriers"), 1).otherwise(0)
                           + F.when(t("difficulty_paying_utilities"), 1).otherwise(0)
                           + F.when(t("difficulty_affording_medications"), 1).otherwise(0)
                           + F.when(c("social_isolation_score") >= 6, 1).otherwise(0)
                           + F.when(t("safety_concerns"), 1).otherwise(0))
    return (raw.select(
        "screening_id", "hospital_id", "patient_id", "encounter_id", "screening_date", "housing_status",
        "social_isolation_score", "employment_status", "highest_education_level", "health_literacy_score",
        "screening_tool_name",
        t("housing_concerns").alias("has_housing_risk"),
        (t("food_insecurity_flag") | t("difficulty_affording_food")).alias("has_food_insecurity"),
        t("transportation_barriers").alias("has_transportation_barriers"),
        (t("difficulty_paying_utilities") | t("difficulty_affording_medications")).alias("has_financial_strain"),
        _flag(c("social_isolation_score") >= 6).alias("has_high_social_isolation"),
        (t("safety_concerns") | t("intimate_partner_violence_screen")).alias("has_safety_concerns"),
        risk_count.alias("total_sdoh_risk_count"),
        c("_loaded_at").alias("loaded_at_timestamp"))
        .withColumn("sdoh_risk_category",
                    F.when(c("total_sdoh_risk_count") >= 4, "High Risk").when(c("total_sdoh_risk_count") >= 2, "Medium Risk")
                    .when(c("total_sdoh_risk_count") >= 1, "Low Risk").otherwise("No Risk")))
