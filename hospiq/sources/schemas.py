"""Raw table schemas (DDL of the 21 source tables) and the conform step.

The DDL strings are the single source of truth for typed reads, CSV/JSON
loads and the conform projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Column lists and types of the raw tables.
RAW_DDL: dict[str, str] = {
    "raw_hospitals": (
        "hospital_id string, hospital_name string, hospital_type string, bed_count bigint, city string, "
        "state string, region string, emr_system string, contract_tier string, "
        "contract_start_date timestamp_ntz, is_active boolean, teaching_hospital boolean, "
        "_loaded_at timestamp_ntz, _source_file string"
    ),
    "raw_patients": (
        "patient_id string, hospital_id string, mrn string, ssn_hash string, first_name string, "
        "last_name string, date_of_birth date, gender string, race string, ethnicity string, "
        "zip_code string, phone_number_hash string, email_hash string, primary_language string, "
        "marital_status string, first_encounter_date timestamp_ntz, _loaded_at timestamp_ntz, "
        "_source_file string"
    ),
    "raw_providers": (
        "provider_id string, hospital_id string, npi string, provider_first_name string, "
        "provider_last_name string, specialty string, department string, provider_type string, "
        "hire_date date, is_active boolean, accepts_new_patients boolean, _loaded_at timestamp_ntz, "
        "_source_file string"
    ),
    "raw_facilities": (
        "facility_id string, hospital_id string, facility_name string, facility_type string, "
        "bed_capacity bigint, is_active boolean, opened_date timestamp_ntz, _loaded_at timestamp_ntz, "
        "_source_file string"
    ),
    "raw_diagnoses": (
        "diagnosis_code string, diagnosis_description string, category string, severity_level string, "
        "is_chronic boolean, _source_file string, _loaded_at timestamp_ntz"
    ),
    "raw_procedures": (
        "procedure_code string, procedure_description string, category string, "
        "typical_charge_min decimal(10, 2) , typical_charge_max decimal(10, 2) , _source_file string, "
        "_loaded_at timestamp_ntz"
    ),
    "raw_payers": (
        "payer_id string, payer_name string, payer_type string, reimbursement_rate decimal(5, 4) , "
        "is_active boolean, _source_file string, _loaded_at timestamp_ntz"
    ),
    "raw_encounters": (
        "encounter_id string, hospital_id string, patient_id string, provider_id string, "
        "facility_id string, admission_date timestamp_ntz, discharge_date timestamp_ntz, "
        "length_of_stay decimal(10, 2) , encounter_type string, admission_source string, "
        "discharge_disposition string, primary_diagnosis_code string, total_charges decimal(12, 2) , "
        "is_readmission boolean, _loaded_at timestamp_ntz, _source_file string, "
        "_source_updated_at timestamp_ntz"
    ),
    "raw_billing_transactions": (
        "transaction_id string, hospital_id string, encounter_id string, patient_id string, "
        "payer_id string, transaction_date timestamp_ntz, charge_amount decimal(12, 2) , "
        "payment_amount decimal(12, 2) , adjustment_amount decimal(12, 2) , denial_reason string, "
        "payment_status string, _loaded_at timestamp_ntz, _source_file string"
    ),
    "raw_clinical_orders": (
        "order_id string, hospital_id string, encounter_id string, patient_id string, provider_id string, "
        "order_type string, order_code string, order_description string, order_status string, "
        "order_datetime timestamp_ntz, scheduled_datetime timestamp_ntz, "
        "completed_datetime timestamp_ntz, priority string, ordering_provider_id string, "
        "performing_location string, medication_name string, dose string, route string, frequency string, "
        "duration_days bigint, specimen_type string, collection_datetime timestamp_ntz, result_id string, "
        "_loaded_at timestamp_ntz, _source_file string"
    ),
    "raw_clinical_results": (
        "result_id string, hospital_id string, order_id string, patient_id string, encounter_id string, "
        "result_type string, test_code string, test_name string, component_code string, "
        "component_name string, result_value string, result_value_numeric decimal(18, 4) , "
        "result_units string, reference_range_low decimal(18, 4) , reference_range_high decimal(18, 4) , "
        "abnormal_flag string, result_datetime timestamp_ntz, collected_datetime timestamp_ntz, "
        "resulted_datetime timestamp_ntz, result_status string, performing_lab string, "
        "interpreting_provider_id string, imaging_modality string, impression string, report_text string, "
        "_loaded_at timestamp_ntz"
    ),
    "raw_vital_signs": (
        "vital_id string, hospital_id string, encounter_id string, patient_id string, "
        "measurement_datetime timestamp_ntz, temperature_f decimal(5, 2) , heart_rate_bpm bigint, "
        "respiratory_rate bigint, systolic_bp bigint, diastolic_bp bigint, oxygen_saturation_pct bigint, "
        "weight_kg decimal(6, 2) , height_cm decimal(5, 1) , bmi decimal(4, 1) , pain_score bigint, "
        "map_mmhg bigint, position string, measured_by_role string, _loaded_at timestamp_ntz"
    ),
    "raw_problem_list": (
        "problem_id string, hospital_id string, patient_id string, diagnosis_code string, "
        "diagnosis_description string, problem_status string, onset_date date, resolution_date date, "
        "last_reviewed_date date, severity string, is_chronic boolean, is_primary_diagnosis boolean, "
        "documented_by_provider_id string, documentation_date date, clinical_notes string, "
        "_loaded_at timestamp_ntz"
    ),
    "raw_medication_administration": (
        "admin_id string, hospital_id string, encounter_id string, patient_id string, order_id string, "
        "medication_name string, dose string, route string, scheduled_datetime timestamp_ntz, "
        "administered_datetime timestamp_ntz, administered_by_provider_id string, "
        "administration_status string, refusal_reason string, hold_reason string, "
        "barcode_scanned boolean, witnessed_by_provider_id string, adverse_reaction_flag boolean, "
        "reaction_description string, _loaded_at timestamp_ntz"
    ),
    "raw_patient_allergies": (
        "allergy_id string, hospital_id string, patient_id string, allergen_type string, "
        "allergen_code string, allergen_name string, reaction_type string, severity string, "
        "allergy_status string, onset_date date, resolution_date date, documented_by_provider_id string, "
        "documentation_date date, clinical_notes string, _loaded_at timestamp_ntz"
    ),
    "raw_care_plans": (
        "care_plan_id string, hospital_id string, encounter_id string, patient_id string, "
        "problem_description string, goal_description string, intervention_description string, "
        "plan_status string, start_date date, target_date date, completion_date date, "
        "created_by_provider_id string, assigned_to_provider_ids string, progress_notes string, "
        "last_evaluated_date date, _loaded_at timestamp_ntz"
    ),
    "raw_patient_coverage": (
        "coverage_id string, hospital_id string, patient_id string, payer_id string, "
        "policy_number string, group_number string, subscriber_id string, subscriber_name string, "
        "subscriber_relationship string, effective_date date, termination_date date, "
        "coverage_status string, plan_type string, coverage_level string, deductible_amount decimal(10, "
        "2) , deductible_met_amount decimal(10, 2) , out_of_pocket_max decimal(10, 2) , "
        "out_of_pocket_met decimal(10, 2) , copay_amount decimal(10, 2) , coinsurance_pct decimal(5, 2) , "
        "coverage_priority bigint, _loaded_at timestamp_ntz"
    ),
    "raw_prior_authorizations": (
        "auth_id string, hospital_id string, patient_id string, payer_id string, encounter_id string, "
        "auth_number string, auth_type string, service_code string, service_description string, "
        "auth_status string, request_date date, decision_date date, effective_date date, "
        "expiration_date date, units_authorized bigint, units_used bigint, units_remaining bigint, "
        "diagnosis_codes string, clinical_notes string, denial_reason string, _loaded_at timestamp_ntz"
    ),
    "raw_sdoh_screenings": (
        "screening_id string, hospital_id string, patient_id string, encounter_id string, "
        "screening_date date, housing_status string, housing_concerns boolean, "
        "food_insecurity_flag boolean, difficulty_affording_food boolean, "
        "transportation_barriers boolean, difficulty_paying_utilities boolean, "
        "difficulty_affording_medications boolean, social_isolation_score bigint, "
        "safety_concerns boolean, intimate_partner_violence_screen boolean, employment_status string, "
        "highest_education_level string, health_literacy_score bigint, screening_tool_name string, "
        "referrals_text string, _loaded_at timestamp_ntz"
    ),
    "raw_quality_measures": (
        "measure_id string, hospital_id string, encounter_id string, patient_id string, "
        "measure_code string, measure_name string, measure_category string, numerator_eligible boolean, "
        "denominator_eligible boolean, exclusion_applied boolean, exclusion_reason string, "
        "door_to_antibiotic_minutes bigint, door_to_balloon_minutes bigint, "
        "door_to_needle_minutes bigint, metric_component string, component_value string, "
        "component_timestamp timestamp_ntz, compliance_flag boolean, reporting_quarter string, "
        "reporting_year bigint, _loaded_at timestamp_ntz"
    ),
    "raw_referrals": (
        "referral_id string, hospital_id string, patient_id string, encounter_id string, "
        "referral_type string, referring_provider_id string, referred_to_provider_id string, "
        "referred_to_facility string, specialty string, referral_status string, referral_date date, "
        "appointment_date date, completion_date date, reason_for_referral string, diagnosis_codes string, "
        "urgency string, follow_up_required boolean, follow_up_completed boolean, "
        "_loaded_at timestamp_ntz"
    ),
}


LOAD_TIME_COLUMNS = ("_loaded_at", "_source_file", "_source_updated_at")


def schema(table: str) -> StructType:
    return StructType.fromDDL(RAW_DDL[table])


class SchemaDriftError(ValueError):
    pass


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project ``df`` onto the table DDL: DDL column order and types, NULL for
    missing load-time columns, error for missing business columns or for
    columns the DDL does not know (schema drift fails the load)."""
    st = schema(table)
    names = [f.name for f in st.fields]
    have = set(df.columns)
    extra = sorted(have - set(names))
    if extra:
        raise SchemaDriftError(f"{table}: unexpected columns {extra}")
    missing = [n for n in names if n not in have and n not in LOAD_TIME_COLUMNS]
    if missing:
        raise SchemaDriftError(f"{table}: missing columns {missing}")
    return df.select(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in st.fields])
