"""DuckDB re-statement of the adapter tables and staging models.

Written independently of the Spark code (plain SQL over the driver views)
so that the oracle checks the Spark plans end to end. ``sql(names, body)``
prefixes the CTEs a query needs (dependencies resolved)."""

from __future__ import annotations

ICD = "['A41.9','I21.9','I50.9','E11.9','J44.9','N18.6','C78.0','K70.3']"
DRUGS = "['Aspirin','Insulin','Heparin','Vancomycin','Metoprolol','Morphine','Penicillin','Warfarin']"
TESTS = "['Glucose','Potassium','Sodium','Hemoglobin','Creatinine','Troponin','Lactate','Lipid Panel']"
AS_OF = "DATE '2001-08-05'"
LOADED = "TIMESTAMP '2001-12-30 00:00:00'"


def T(expr: str) -> str:
    return f"('HOSP_' || lpad(CAST({expr} AS VARCHAR), 4, '0'))"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------- raw tables
cte("r_hospitals", [], f"""
SELECT {T('n_nationkey')} AS hospital_id, n_name || ' MEDICAL CENTER' AS hospital_name,
  ['Academic Medical Center','Community Hospital','Critical Access Hospital'][n_nationkey % 3 + 1] AS hospital_type,
  CAST(n_nationkey * 10 + 50 AS BIGINT) AS bed_count, n_name AS city, n_name AS state, r_name AS region,
  ['Epic','Cerner','Meditech'][n_nationkey % 3 + 1] AS emr_system,
  ['Enterprise','Professional','Standard','Basic'][n_nationkey % 4 + 1] AS contract_tier,
  TIMESTAMP '2019-01-01 00:00:00' + to_days(CAST(n_nationkey * 30 AS INTEGER)) AS contract_start_date,
  TRUE AS is_active, n_nationkey % 2 = 0 AS teaching_hospital, {LOADED} AS _loaded_at
FROM nation JOIN region ON n_regionkey = r_regionkey""")

cte("r_patients", [], f"""
SELECT 'PAT_' || CAST(c_custkey AS VARCHAR) AS patient_id, {T('c_nationkey')} AS hospital_id,
  CASE WHEN c_custkey % 97 = 0 THEN NULL
       ELSE DATE '1900-01-01' + CAST(c_custkey * 37 % 36500 AS INTEGER) END AS date_of_birth,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  ['White','Black','Asian','Hispanic','Other'][c_custkey % 5 + 1] AS race,
  CASE WHEN c_custkey % 4 = 0 THEN 'Hispanic' ELSE 'Non-Hispanic' END AS ethnicity,
  lpad(CAST(c_custkey * 61 % 100000 AS VARCHAR), 5, '0') AS zip_code,
  CASE WHEN c_custkey % 10 = 0 THEN 'Spanish' ELSE 'English' END AS primary_language,
  ['Married','Single','Widowed'][c_custkey % 3 + 1] AS marital_status,
  c_custkey, c_nationkey, c_acctbal, {LOADED} AS _loaded_at
FROM customer""")

cte("r_providers", [], f"""
SELECT 'PRV_' || CAST(s_suppkey AS VARCHAR) AS provider_id, {T('s_suppkey % 25')} AS hospital_id,
  'Pat' AS provider_first_name, s_name AS provider_last_name,
  ['Cardiology','Internal Medicine','Emergency Medicine','General Surgery'][(s_suppkey // 25) % 4 + 1] AS specialty,
  ['Cardiology','Medicine','Emergency','Surgery'][(s_suppkey // 25) % 4 + 1] AS department,
  CASE WHEN s_suppkey % 3 = 0 THEN 'NP' ELSE 'MD' END AS provider_type,
  DATE '1990-01-01' + CAST(s_suppkey * 53 % 4000 AS INTEGER) AS hire_date,
  TRUE AS is_active, s_suppkey % 5 <> 0 AS accepts_new_patients, {LOADED} AS _loaded_at
FROM supplier""")

cte("r_facilities", [], f"""
SELECT 'FAC_' || CAST(n_nationkey AS VARCHAR) || '_' || CAST(k AS VARCHAR) AS facility_id,
  {T('n_nationkey')} AS hospital_id,
  n_name || ' ' || ['Emergency Department','Medical-Surgical Unit','Intensive Care Unit','Operating Room',
                    'Outpatient Clinic'][k + 1] AS facility_name,
  ['Emergency Department','Medical-Surgical Unit','Intensive Care Unit','Operating Room','Outpatient Clinic'][k + 1]
    AS facility_type,
  CAST(n_nationkey + k * 5 + 10 AS BIGINT) AS bed_capacity,
  (n_nationkey * 5 + k) % 25 <> 24 AS is_active, {LOADED} AS _loaded_at
FROM nation CROSS JOIN (SELECT range AS k FROM range(5)) ks""")

cte("r_diagnoses", [], """
SELECT * FROM (VALUES
  ('A41.9','Sepsis, unspecified organism','Infectious','Severe',FALSE),
  ('I21.9','Acute myocardial infarction, unspecified','Cardiovascular','Severe',FALSE),
  ('I50.9','Heart failure, unspecified','Cardiovascular','Moderate',TRUE),
  ('E11.9','Type 2 diabetes mellitus without complications','Endocrine','Moderate',TRUE),
  ('J44.9','Chronic obstructive pulmonary disease, unspecified','Respiratory','Moderate',TRUE),
  ('N18.6','End stage renal disease','Renal','Severe',TRUE),
  ('C78.0','Secondary malignant neoplasm of lung','Oncology','Severe',TRUE),
  ('K70.3','Alcoholic cirrhosis of liver','Gastrointestinal','Severe',TRUE))
  AS t(diagnosis_code, diagnosis_description, category, severity_level, is_chronic)""")

cte("r_payers", [], """
SELECT 'PAY_' || CAST(i AS VARCHAR) AS payer_id, 'Payer ' || CAST(i AS VARCHAR) AS payer_name,
  ['Government','Commercial','Self-Pay'][i % 3 + 1] AS payer_type,
  CAST(round(0.50 + 0.04 * i, 4) AS DECIMAL(5,4)) AS reimbursement_rate, TRUE AS is_active
FROM (SELECT range AS i FROM range(10)) p""")

cte("order_base", [], """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice, o_orderstatus, c_nationkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'Inpatient'
    WHEN '3-MEDIUM' THEN 'Inpatient' WHEN '4-NOT SPECIFIED' THEN 'Outpatient' ELSE 'Observation' END
    AS encounter_type,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS admission_date
FROM orders JOIN customer ON o_custkey = c_custkey""")

cte("r_encounters", ["order_base"], f"""
SELECT 'ENC_' || CAST(o_orderkey AS VARCHAR) AS encounter_id, {T('c_nationkey')} AS hospital_id,
  'PAT_' || CAST(o_custkey AS VARCHAR) AS patient_id,
  CASE WHEN pc > 0 THEN 'PRV_' || CAST(pn + 25 * (o_orderkey % pc) AS VARCHAR) END AS provider_id,
  'FAC_' || CAST(c_nationkey AS VARCHAR) || '_' || CAST(CASE encounter_type WHEN 'Emergency' THEN 0
     WHEN 'Inpatient' THEN (CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END)
     WHEN 'Observation' THEN 1 ELSE 4 END AS VARCHAR) AS facility_id,
  admission_date,
  CASE WHEN encounter_type = 'Inpatient' AND o_orderkey % 101 = 0 THEN NULL
       WHEN o_orderkey % 211 = 0 THEN admission_date - INTERVAL 1 HOUR
       ELSE admission_date + to_days(CAST(los_days AS INTEGER))
            + to_hours(CAST(CASE WHEN encounter_type IN ('Emergency','Outpatient') THEN 2 + o_orderkey % 5
                                 ELSE o_orderkey % 7 END AS INTEGER)) END AS discharge_date,
  CAST(los_days AS DECIMAL(10,2)) AS length_of_stay, encounter_type,
  ['Emergency','Elective','Transfer'][o_orderkey % 3 + 1] AS admission_source,
  CASE WHEN o_orderkey % 20 = 0 THEN 'Deceased' WHEN o_orderkey % 4 = 1 THEN 'SNF'
       WHEN o_orderkey % 4 = 2 THEN 'Rehab' ELSE 'Home' END AS discharge_disposition,
  {ICD}[o_orderkey % 8 + 1] AS primary_diagnosis_code,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_charges,
  admission_date + INTERVAL 1 DAY AS _loaded_at,
  admission_date + INTERVAL 23 HOUR AS _source_updated_at,
  o_orderkey, o_custkey, c_nationkey, o_totalprice, o_orderstatus
FROM (
  SELECT b.*, CASE WHEN n_sup > pn THEN (n_sup - 1 - pn) // 25 + 1 ELSE 0 END AS pc,
    CASE encounter_type WHEN 'Inpatient' THEN 1 + o_orderkey % 9 WHEN 'Observation' THEN o_orderkey % 3
      ELSE 0 END AS los_days
  FROM (SELECT ob.*, CASE WHEN o_orderkey % 50 = 7 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS pn,
               (SELECT count(*) FROM supplier) AS n_sup FROM order_base ob) b)""")

# ---------------------------------------------------------------- staging
cte("stg_hospitals", ["r_hospitals"], "SELECT * FROM r_hospitals WHERE is_active")
cte("stg_facilities", ["r_facilities"], "SELECT * FROM r_facilities WHERE is_active")
cte("stg_providers", ["r_providers"], f"""
SELECT *, provider_first_name || ' ' || provider_last_name AS provider_full_name,
  year({AS_OF}) - year(hire_date) AS years_of_service FROM r_providers""")
cte("stg_patients", ["r_patients"], f"""
SELECT patient_id, hospital_id,
  CASE WHEN age > 89 THEN NULL ELSE year(date_of_birth) END AS birth_year,
  CASE WHEN age IS NULL THEN NULL ELSE least(age, 90) END AS age_years,
  age > 89 AS is_age_90_plus,
  CASE WHEN age < 18 THEN 'Pediatric' WHEN age BETWEEN 18 AND 64 THEN 'Adult' WHEN age >= 65 THEN 'Geriatric'
       ELSE 'Unknown' END AS age_group,
  gender, race, ethnicity,
  CASE WHEN zip_code IS NULL THEN NULL
       WHEN NOT regexp_matches(left(trim(zip_code), 3), '^[0-9]{{3}}') THEN '000'
       WHEN left(trim(zip_code), 3) IN ('036','059','063','102','203','556','692','790','821','823','830','831',
                                        '878','879','884','890','893') THEN '000'
       ELSE left(trim(zip_code), 3) END AS zip_code_3digit,
  primary_language, marital_status, date_of_birth, c_acctbal
FROM (SELECT *, CAST(date_sub('year', date_of_birth, {AS_OF}) AS INTEGER) AS age FROM r_patients)""")

cte("stg_encounters", ["r_encounters", "stg_patients", "stg_providers", "stg_facilities"], """
SELECT * FROM (
  SELECT *,
    CAST(date_trunc('day', admission_date) AS DATE) AS admission_date_day,
    CAST(date_trunc('month', admission_date) AS DATE) AS admission_date_month,
    CAST(date_trunc('quarter', admission_date) AS DATE) AS admission_date_quarter,
    CAST(date_trunc('year', admission_date) AS DATE) AS admission_date_year,
    dayname(admission_date) AS admission_day_of_week,
    coalesce(encounter_type = 'Inpatient' AND lag_inp_discharge IS NOT NULL
             AND date_diff('day', lag_inp_discharge, admission_date) BETWEEN 1 AND 30, FALSE) AS is_readmission,
    CASE WHEN previous_discharge_date IS NOT NULL
         THEN date_diff('day', previous_discharge_date, admission_date) END AS days_since_last_discharge,
    CASE WHEN encounter_type = 'Inpatient' AND lag_inp_discharge IS NOT NULL
         THEN date_diff('day', lag_inp_discharge, admission_date) END AS days_since_last_inpatient_discharge,
    CASE WHEN encounter_type = 'Inpatient' THEN lag_inp_id END AS previous_inpatient_encounter_id,
    CASE WHEN encounter_type = 'Inpatient' THEN lag_inp_discharge END AS previous_inpatient_discharge_date,
    coalesce(discharge_disposition = 'Deceased', FALSE) AS is_mortality,
    coalesce(encounter_type = 'Emergency', FALSE) AS is_emergency,
    coalesce(admission_source = 'Transfer', FALSE) AS is_transfer,
    _loaded_at AS loaded_at_timestamp
  FROM (
    SELECT e.*, p.age_years, p.age_group, p.gender, p.race, p.ethnicity,
      v.provider_full_name, v.specialty, v.department, v.provider_type, f.facility_name, f.facility_type,
      lag(e.discharge_date) OVER w AS previous_discharge_date,
      lag(e.encounter_type) OVER w AS previous_encounter_type,
      lag(e.encounter_id) OVER w AS previous_encounter_id,
      lag(e.discharge_date) OVER wi AS lag_inp_discharge,
      lag(e.encounter_id) OVER wi AS lag_inp_id
    FROM r_encounters e
    JOIN stg_patients p ON e.patient_id = p.patient_id
    JOIN stg_providers v ON e.provider_id = v.provider_id
    JOIN stg_facilities f ON e.facility_id = f.facility_id
    WHERE e.hospital_id = p.hospital_id AND e.hospital_id = v.hospital_id AND e.hospital_id = f.hospital_id
    WINDOW w AS (PARTITION BY e.patient_id, e.hospital_id ORDER BY e.admission_date, e.encounter_id),
           wi AS (PARTITION BY e.patient_id, e.hospital_id, (e.encounter_type = 'Inpatient')
                  ORDER BY e.admission_date, e.encounter_id)))
WHERE (discharge_date IS NULL OR discharge_date >= admission_date) AND total_charges >= 0
  AND length_of_stay >= 0 AND hospital_id IS NOT NULL""")

cte("int_encounters_enriched", ["stg_encounters", "stg_hospitals", "r_diagnoses"], """
SELECT e.*, h.hospital_name, h.hospital_type, h.region, h.teaching_hospital,
  d.diagnosis_description, d.category AS diagnosis_category, d.severity_level, d.is_chronic
FROM stg_encounters e JOIN stg_hospitals h ON e.hospital_id = h.hospital_id
LEFT JOIN r_diagnoses d ON e.primary_diagnosis_code = d.diagnosis_code""")

cte("int_patient_journey", ["int_encounters_enriched"], """
SELECT *, coalesce(dsl BETWEEN 1 AND 30, FALSE) AS is_30day_return, coalesce(dsl BETWEEN 1 AND 7, FALSE) AS is_7day_return,
  CASE WHEN patient_chronic_conditions >= 3 THEN 'High Risk' WHEN patient_chronic_conditions >= 1 THEN 'Medium Risk'
       ELSE 'Low Risk' END AS patient_risk_category
FROM (
  SELECT e.*, ph.total_encounters AS patient_total_encounters, ph.inpatient_count AS patient_inpatient_count,
    ph.emergency_count AS patient_emergency_count, ph.chronic_condition_count AS patient_chronic_conditions,
    date_diff('day', lag(e.discharge_date) OVER (PARTITION BY e.patient_id, e.hospital_id
                                                ORDER BY e.admission_date, e.encounter_id), e.admission_date) AS dsl
  FROM int_encounters_enriched e
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT encounter_id) AS total_encounters,
               count(DISTINCT CASE WHEN encounter_type = 'Inpatient' THEN encounter_id END) AS inpatient_count,
               count(DISTINCT CASE WHEN encounter_type = 'Emergency' THEN encounter_id END) AS emergency_count,
               sum(CASE WHEN is_chronic THEN 1 ELSE 0 END) AS chronic_condition_count
             FROM int_encounters_enriched GROUP BY patient_id, hospital_id) ph
    ON e.patient_id = ph.patient_id AND e.hospital_id = ph.hospital_id)""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(names: list[str], body: str) -> str:
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in _order(names)]
    body = body.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":  # a body with its own CTEs continues the list
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------- lineitem facts
cte("line_base", ["order_base"], """
SELECT l.*, ob.o_custkey, ob.c_nationkey, ob.admission_date, CAST(l_quantity AS INTEGER) AS q,
  CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) || '_' || CAST(l_partkey AS VARCHAR) || '_'
    || CAST(l_suppkey AS VARCHAR) AS line_key,
  ['LAB','MEDICATION','RADIOLOGY','PROCEDURE'][l_linenumber % 4 + 1] AS order_type,
  ob.admission_date + to_hours(CAST(3 * l_linenumber AS INTEGER)) AS order_datetime
FROM lineitem l JOIN order_base ob ON l.l_orderkey = ob.o_orderkey""")

cte("r_billing", ["line_base"], f"""
SELECT 'TXN_' || line_key AS transaction_id, {T('c_nationkey')} AS hospital_id,
  'ENC_' || CAST(l_orderkey AS VARCHAR) AS encounter_id, 'PAT_' || CAST(o_custkey AS VARCHAR) AS patient_id,
  'PAY_' || CAST(l_partkey % 10 AS VARCHAR) AS payer_id, l_shipdate AS transaction_date,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS charge_amount,
  CAST(CASE payment_status WHEN 'Paid' THEN (ext_c * (100 - disc_c) + 50) // 100
       WHEN 'Partial' THEN (ext_c * (100 - disc_c) + 100) // 200 ELSE 0 END / 100.0 AS DECIMAL(12,2)) AS payment_amount,
  CAST(CASE WHEN payment_status IN ('Paid','Partial') THEN (ext_c * disc_c + 50) // 100 ELSE 0 END / 100.0
       AS DECIMAL(12,2)) AS adjustment_amount,
  CASE WHEN payment_status = 'Denied' THEN ['Prior authorization not obtained','Medical necessity not established',
       'Duplicate claim'][l_orderkey % 3 + 1] END AS denial_reason,
  payment_status, l_shipdate + INTERVAL 1 DAY AS _loaded_at
FROM (SELECT *, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Paid' WHEN l_returnflag = 'A' THEN 'Partial'
                     WHEN l_returnflag = 'R' THEN 'Denied' ELSE 'Pending' END AS payment_status,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS ext_c, CAST(round(l_discount * 100) AS BIGINT) AS disc_c
      FROM line_base)""")

cte("r_orders", ["line_base"], f"""
SELECT 'ORD_' || line_key AS order_id, {T('c_nationkey')} AS hospital_id,
  'ENC_' || CAST(l_orderkey AS VARCHAR) AS encounter_id, 'PAT_' || CAST(o_custkey AS VARCHAR) AS patient_id,
  'PRV_' || CAST(l_suppkey AS VARCHAR) AS provider_id, order_type, order_status, order_datetime,
  order_datetime + to_hours(CAST(l_partkey % 3 AS INTEGER)) AS scheduled_datetime,
  CASE WHEN order_status = 'COMPLETED'
       THEN order_datetime + to_hours(CAST(q % 6 + 12 * (l_partkey % 5) AS INTEGER)) END AS completed_datetime,
  CASE WHEN l_suppkey % 5 = 0 THEN 'STAT' WHEN l_suppkey % 5 = 1 THEN 'URGENT' ELSE 'ROUTINE' END AS priority,
  'PRV_' || CAST(l_suppkey AS VARCHAR) AS ordering_provider_id,
  CASE WHEN order_type = 'MEDICATION' THEN {DRUGS}[l_partkey % 8 + 1] END AS medication_name,
  CASE WHEN order_type = 'LAB' THEN {TESTS}[l_partkey % 8 + 1]
                                   || CASE WHEN l_partkey % 3 = 0 THEN ' + Blood Culture' ELSE '' END
       WHEN order_type = 'MEDICATION' THEN {DRUGS}[l_partkey % 8 + 1]
       ELSE 'Order ' || CAST(l_partkey AS VARCHAR) END AS order_description,
  'OC' || CAST(l_partkey AS VARCHAR) AS order_code,
  CASE WHEN order_type = 'MEDICATION' THEN 'Q8H' END AS frequency,
  CASE WHEN order_type = 'MEDICATION' THEN CAST(q % 14 AS BIGINT) END AS duration_days,
  CASE WHEN order_type = 'LAB' THEN 'RES_' || line_key END AS result_id,
  order_datetime + INTERVAL 1 DAY AS _loaded_at
FROM (SELECT *, CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN 'CANCELLED' WHEN l_linestatus = 'F' THEN 'COMPLETED'
                     WHEN l_returnflag = 'N' THEN 'ORDERED' ELSE 'IN_PROGRESS' END AS order_status FROM line_base)""")

cte("r_results", ["line_base"], f"""
SELECT 'RES_' || line_key AS result_id, {T('c_nationkey')} AS hospital_id, 'ORD_' || line_key AS order_id,
  'PAT_' || CAST(o_custkey AS VARCHAR) AS patient_id, 'ENC_' || CAST(l_orderkey AS VARCHAR) AS encounter_id,
  'LAB' AS result_type, 'T' || CAST(ti - 1 AS VARCHAR) AS test_code, {TESTS}[ti] AS test_name,
  CAST(val AS DECIMAL(18,4)) AS result_value_numeric,
  CAST(lo AS DECIMAL(18,4)) AS reference_range_low, CAST(hi AS DECIMAL(18,4)) AS reference_range_high,
  CASE WHEN val > hi THEN 'H' WHEN val < lo THEN 'L' ELSE 'N' END AS abnormal_flag,
  resulted AS result_datetime, collected AS collected_datetime, resulted AS resulted_datetime,
  CASE WHEN l_returnflag = 'N' THEN 'PRELIMINARY' WHEN l_orderkey % 29 = 0 THEN 'CORRECTED' ELSE 'FINAL' END
    AS result_status,
  CAST(NULL AS VARCHAR) AS interpreting_provider_id, resulted + INTERVAL 2 HOUR AS _loaded_at
FROM (SELECT *, round(lo + (hi - lo) * (q - 15) / 10.0, 4) AS val,
             order_datetime + INTERVAL 1 HOUR + to_hours(CAST((q * 7) % 30 + 1 AS INTEGER)) AS resulted,
             order_datetime + INTERVAL 1 HOUR AS collected
      FROM (SELECT *, CAST(l_partkey % 8 + 1 AS INTEGER) AS ti,
                   [70.0, 3.5, 135.0, 12.0, 0.6, 0.0, 0.5, 0.0][l_partkey % 8 + 1] AS lo,
                   [100.0, 5.0, 145.0, 17.5, 1.3, 0.04, 2.2, 200.0][l_partkey % 8 + 1] AS hi
            FROM line_base WHERE order_type = 'LAB'))""")

cte("r_med_admin", ["line_base"], f"""
SELECT 'ADM_' || line_key AS admin_id, {T('c_nationkey')} AS hospital_id,
  'ENC_' || CAST(l_orderkey AS VARCHAR) AS encounter_id, 'PAT_' || CAST(o_custkey AS VARCHAR) AS patient_id,
  'ORD_' || line_key AS order_id, {DRUGS}[l_partkey % 8 + 1] AS medication_name,
  ['PO','IV','IM','SC'][l_partkey % 4 + 1] AS route, scheduled AS scheduled_datetime,
  CASE WHEN status = 'GIVEN' THEN scheduled + to_minutes(CAST(q * 3 AS INTEGER)) END AS administered_datetime,
  'PRV_' || CAST(l_suppkey AS VARCHAR) AS administered_by_provider_id, status AS administration_status,
  l_partkey % 10 <> 0 AS barcode_scanned,
  CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'PRV_' || CAST(l_suppkey + 25 AS VARCHAR) END AS witnessed_by_provider_id,
  l_orderkey % 37 = 0 AS adverse_reaction_flag,
  CASE WHEN l_orderkey % 37 = 0 THEN 'Rash' END AS reaction_description,
  scheduled + INTERVAL 4 HOUR AS _loaded_at
FROM (SELECT *, CASE l_suppkey % 20 WHEN 0 THEN 'REFUSED' WHEN 1 THEN 'HELD' WHEN 2 THEN 'MISSED' ELSE 'GIVEN' END
                  AS status, order_datetime + INTERVAL 2 HOUR AS scheduled
      FROM line_base WHERE order_type = 'MEDICATION')""")

cte("latest_order", ["order_base"], """
SELECT o_custkey AS user_id, max(o_orderkey) AS last_orderkey, arg_max(admission_date, o_orderkey) AS last_admission,
  arg_max(c_nationkey, o_orderkey) AS nation
FROM order_base GROUP BY o_custkey""")

cte("r_vitals", ["latest_order"], f"""
SELECT 'VIT_' || CAST(event_id AS VARCHAR) AS vital_id, {T('nation')} AS hospital_id,
  'ENC_' || CAST(last_orderkey AS VARCHAR) AS encounter_id, 'PAT_' || CAST(e.user_id AS VARCHAR) AS patient_id,
  last_admission + to_hours(CAST(event_id % 72 AS INTEGER)) + to_minutes(CAST(event_id % 60 AS INTEGER))
    AS measurement_datetime,
  CAST(94.0 + (event_id % 80) / 10.0 AS DECIMAL(5,2)) AS temperature_f,
  CAST(35 + event_id * 7 % 110 AS BIGINT) AS heart_rate_bpm,
  CAST(6 + event_id * 3 % 24 AS BIGINT) AS respiratory_rate,
  CAST(80 + event_id * 11 % 150 AS BIGINT) AS systolic_bp,
  CAST(50 + event_id * 5 % 50 AS BIGINT) AS diastolic_bp,
  CAST(85 + event_id * 13 % 16 AS BIGINT) AS oxygen_saturation_pct,
  CAST(event_id % 11 AS BIGINT) AS pain_score,
  CAST(round((50 + e.user_id % 50) / (((150 + e.user_id % 40) / 100.0) * ((150 + e.user_id % 40) / 100.0)), 1)
       AS DECIMAL(4,1)) AS bmi,
  e.ts
FROM events e JOIN latest_order lo ON e.user_id = lo.user_id""")

# ---------------------------------------------------------------- staging facts
cte("stg_billing", ["r_billing"], """
SELECT *, CASE WHEN payment_status = 'Paid' THEN payment_amount ELSE 0 END AS collected_amount,
  CASE WHEN payment_status = 'Denied' THEN charge_amount ELSE 0 END AS denied_amount,
  coalesce(payment_status = 'Denied', FALSE) AS is_denied, coalesce(payment_status = 'Paid', FALSE) AS is_paid,
  coalesce(payment_status = 'Pending', FALSE) AS is_pending
FROM r_billing""")

cte("stg_orders", ["r_orders"], """
SELECT *, coalesce(order_status = 'COMPLETED', FALSE) AS is_completed,
  coalesce(priority = 'STAT', FALSE) AS is_stat_order,
  date_diff('hour', order_datetime, completed_datetime) AS completion_time_hours
FROM r_orders""")

cte("stg_results", ["r_results"], """
SELECT *, coalesce(abnormal_flag IN ('H','L','A'), FALSE) AS is_abnormal, coalesce(abnormal_flag = 'H', FALSE) AS is_high,
  coalesce(abnormal_flag = 'L', FALSE) AS is_low, coalesce(result_status = 'FINAL', FALSE) AS is_final,
  coalesce(result_status = 'PRELIMINARY', FALSE) AS is_preliminary,
  date_diff('hour', collected_datetime, resulted_datetime) AS turnaround_time_hours,
  CASE WHEN result_value_numeric > reference_range_high THEN result_value_numeric - reference_range_high
       WHEN result_value_numeric < reference_range_low THEN reference_range_low - result_value_numeric
       ELSE 0 END AS out_of_range_value
FROM r_results""")

cte("stg_med_admin", ["r_med_admin"], """
SELECT *, administration_status = 'GIVEN' AS is_given, administration_status = 'REFUSED' AS is_refused,
  administration_status = 'HELD' AS is_held, administration_status = 'MISSED' AS is_missed,
  coalesce(barcode_scanned, FALSE) AS is_verified, witnessed_by_provider_id IS NOT NULL AS is_witnessed,
  CASE WHEN administered_datetime IS NOT NULL AND scheduled_datetime IS NOT NULL
       THEN date_diff('minute', scheduled_datetime, administered_datetime) END AS administration_delay_minutes,
  coalesce(date_diff('minute', scheduled_datetime, administered_datetime) > 60, FALSE) AS is_late_administration
FROM r_med_admin""")

cte("stg_vitals", ["r_vitals"], """
SELECT *, coalesce(temperature_f > 100.4, FALSE) AS is_febrile, coalesce(temperature_f < 95.0, FALSE) AS is_hypothermic,
  coalesce(heart_rate_bpm > 100, FALSE) AS is_tachycardic, coalesce(heart_rate_bpm < 60, FALSE) AS is_bradycardic,
  coalesce(respiratory_rate > 20, FALSE) AS is_tachypneic,
  coalesce(systolic_bp > 140 OR diastolic_bp > 90, FALSE) AS is_hypertensive,
  coalesce(systolic_bp < 90 OR diastolic_bp < 60, FALSE) AS is_hypotensive,
  coalesce(oxygen_saturation_pct < 90, FALSE) AS is_hypoxic, coalesce(pain_score >= 7, FALSE) AS has_severe_pain,
  CASE WHEN respiratory_rate <= 8 THEN 3 WHEN respiratory_rate BETWEEN 9 AND 11 THEN 1
       WHEN respiratory_rate BETWEEN 21 AND 24 THEN 2 WHEN respiratory_rate >= 25 THEN 3 ELSE 0 END AS news_rr,
  CASE WHEN oxygen_saturation_pct <= 91 THEN 3 WHEN oxygen_saturation_pct BETWEEN 92 AND 93 THEN 2
       WHEN oxygen_saturation_pct BETWEEN 94 AND 95 THEN 1 ELSE 0 END AS news_o2,
  CASE WHEN systolic_bp <= 90 THEN 3 WHEN systolic_bp BETWEEN 91 AND 100 THEN 2 WHEN systolic_bp BETWEEN 101 AND 110 THEN 1
       WHEN systolic_bp >= 220 THEN 3 ELSE 0 END AS news_sbp,
  CASE WHEN heart_rate_bpm <= 40 THEN 3 WHEN heart_rate_bpm BETWEEN 41 AND 50 THEN 1
       WHEN heart_rate_bpm BETWEEN 91 AND 110 THEN 1 WHEN heart_rate_bpm BETWEEN 111 AND 130 THEN 2
       WHEN heart_rate_bpm >= 131 THEN 3 ELSE 0 END AS news_hr
FROM r_vitals""")

# ---------------------------------------------------------------- intermediate facts
cte("int_vitals", ["stg_vitals", "stg_encounters", "stg_patients", "stg_hospitals"], """
SELECT v.*, news_rr + news_o2 + news_sbp + news_hr AS total_news_score,
  CASE WHEN news_rr + news_o2 + news_sbp + news_hr >= 7 THEN 'High Risk'
       WHEN news_rr + news_o2 + news_sbp + news_hr >= 5 THEN 'Medium Risk'
       WHEN news_rr + news_o2 + news_sbp + news_hr >= 3 THEN 'Low Risk' ELSE 'Normal' END AS news_risk_category,
  is_hypotensive AND is_tachycardic AND is_hypoxic AS sepsis_alert,
  is_hypertensive AND has_severe_pain AS hypertensive_crisis_alert,
  is_hypoxic AND is_tachypneic AS respiratory_distress_alert
FROM (SELECT *,
        coalesce(temperature_f - lag(temperature_f) OVER w > 2.0 OR heart_rate_bpm - lag(heart_rate_bpm) OVER w > 30
                 OR systolic_bp - lag(systolic_bp) OVER w < -30
                 OR oxygen_saturation_pct - lag(oxygen_saturation_pct) OVER w < -5, FALSE) AS rapid_deterioration_flag
      FROM stg_vitals
      WINDOW w AS (PARTITION BY patient_id, encounter_id ORDER BY measurement_datetime, vital_id)) v
JOIN stg_hospitals h ON v.hospital_id = h.hospital_id
JOIN stg_encounters e ON v.encounter_id = e.encounter_id
JOIN stg_patients p ON v.patient_id = p.patient_id""")

cte("int_labs", ["stg_results", "stg_orders", "stg_encounters", "stg_patients", "stg_hospitals"], """
SELECT *, CASE WHEN result_value_numeric > prev THEN 'Increasing' WHEN result_value_numeric < prev THEN 'Decreasing'
               WHEN result_value_numeric = prev THEN 'Stable' ELSE 'First Result' END AS trend_direction,
  CASE WHEN lower(test_name) LIKE '%glucose%' AND (result_value_numeric < 40 OR result_value_numeric > 500) THEN TRUE
       WHEN lower(test_name) LIKE '%potassium%' AND (result_value_numeric < 2.5 OR result_value_numeric > 6.5) THEN TRUE
       WHEN lower(test_name) LIKE '%sodium%' AND (result_value_numeric < 120 OR result_value_numeric > 160) THEN TRUE
       WHEN lower(test_name) LIKE '%hemoglobin%' AND result_value_numeric < 6 THEN TRUE
       WHEN lower(test_name) LIKE '%creatinine%' AND result_value_numeric > 10 THEN TRUE
       WHEN lower(test_name) LIKE '%troponin%' AND result_value_numeric > 0.5 THEN TRUE ELSE FALSE END
    AS is_critical_value,
  CASE WHEN lower(test_name) SIMILAR TO '.*(cbc|hemoglobin|hematocrit|platelet|wbc).*' THEN 'Complete Blood Count'
       WHEN lower(test_name) SIMILAR TO '.*(sodium|potassium|chloride|bicarb|glucose).*' THEN 'Basic Metabolic Panel'
       WHEN lower(test_name) SIMILAR TO '.*(cmp|albumin|calcium|protein).*' THEN 'Comprehensive Metabolic Panel'
       WHEN lower(test_name) SIMILAR TO '.*(ast|alt|bilirubin|alkaline).*' THEN 'Liver Function Panel'
       WHEN lower(test_name) SIMILAR TO '.*(lipid|cholesterol|triglyceride|hdl|ldl).*' THEN 'Lipid Panel'
       WHEN lower(test_name) LIKE '%troponin%' THEN 'Cardiac Marker'
       WHEN lower(test_name) SIMILAR TO '.*(pt|inr|ptt|aptt).*' THEN 'Coagulation Panel' ELSE 'Other' END
    AS lab_panel_category
FROM (
  SELECT r.*, lo.completion_time_hours AS order_completion_hours
  FROM (SELECT *, lag(result_value_numeric) OVER w AS prev, row_number() OVER w AS result_sequence,
               lag(result_datetime) OVER w AS prev_t
        FROM stg_results WHERE result_type = 'LAB'
        WINDOW w AS (PARTITION BY patient_id, test_code ORDER BY result_datetime, result_id)) r
  JOIN stg_hospitals h ON r.hospital_id = h.hospital_id
  JOIN stg_encounters e ON r.encounter_id = e.encounter_id
  JOIN stg_patients p ON r.patient_id = p.patient_id
  LEFT JOIN (SELECT * FROM stg_orders WHERE order_type = 'LAB') lo ON r.order_id = lo.order_id)""")

cte("int_revenue_cycle", ["stg_billing", "r_payers", "stg_encounters"], """
SELECT b.*, p.payer_name, p.payer_type, p.reimbursement_rate, e.encounter_type, e.discharge_date,
  date_diff('day', e.discharge_date, b.transaction_date) AS days_in_ar,
  b.payment_amount - b.charge_amount * p.reimbursement_rate AS payment_variance
FROM stg_billing b JOIN r_payers p ON b.payer_id = p.payer_id JOIN stg_encounters e ON b.encounter_id = e.encounter_id""")


# ---------------------------------------------------------------- customer history
def per_customer(n: int, keep: str) -> str:
    return (f"(SELECT c.*, k, CAST(c_custkey AS VARCHAR) || '_' || CAST(k AS VARCHAR) AS ck FROM customer c "
            f"CROSS JOIN (SELECT range AS k FROM range({n})) ks WHERE {keep})")


cte("r_problems", [], f"""
SELECT 'PRB_' || ck AS problem_id, {T('c_nationkey')} AS hospital_id, 'PAT_' || CAST(c_custkey AS VARCHAR) AS patient_id,
  {ICD}[(c_custkey + 3 * k) % 8 + 1] AS diagnosis_code, status AS problem_status, onset AS onset_date,
  CASE WHEN status = 'RESOLVED' THEN onset + 90 END AS resolution_date,
  DATE '2001-01-01' + CAST((c_custkey + k) % 300 AS INTEGER) AS last_reviewed_date,
  [FALSE, FALSE, TRUE, TRUE, TRUE, TRUE, TRUE, TRUE][(c_custkey + 3 * k) % 8 + 1] AS is_chronic
FROM (SELECT *, CASE (c_custkey + k) % 5 WHEN 0 THEN 'RESOLVED' WHEN 1 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
             DATE '1990-01-01' + CAST((c_custkey * 7 + k * 131) % 4000 AS INTEGER) AS onset
      FROM {per_customer(3, 'k <= c_custkey % 3')})""")

cte("r_allergies", [], f"""
SELECT 'ALG_' || ck AS allergy_id, {T('c_nationkey')} AS hospital_id, 'PAT_' || CAST(c_custkey AS VARCHAR) AS patient_id,
  ['DRUG','DRUG','DRUG','FOOD','ENVIRONMENTAL','DRUG','DRUG','FOOD'][ai] AS allergen_type,
  ['Penicillin','Aspirin','Sulfa','Peanuts','Latex','Heparin Sodium','Morphine','Shellfish'][ai] AS allergen_name,
  ['RASH','ANAPHYLAXIS','GI_UPSET'][(c_custkey + k) % 3 + 1] AS reaction_type,
  ['MILD','MODERATE','SEVERE','LIFE_THREATENING'][(c_custkey * 3 + k) % 4 + 1] AS severity,
  status AS allergy_status, onset AS onset_date,
  CASE WHEN status = 'RESOLVED' THEN onset + 365 END AS resolution_date
FROM (SELECT *, CAST(CASE WHEN k = 1 AND c_custkey % 11 = 0 THEN c_custkey % 8 ELSE (c_custkey + 5 * k) % 8 END + 1
                     AS INTEGER) AS ai,
             CASE WHEN (c_custkey + k) % 7 = 0 THEN 'RESOLVED' ELSE 'ACTIVE' END AS status,
             DATE '1985-01-01' + CAST((c_custkey * 11 + k * 97) % 5000 AS INTEGER) AS onset
      FROM {per_customer(2, 'k < c_custkey % 3')})""")

cte("r_coverage", [], f"""
SELECT 'COV_' || ck AS coverage_id, {T('c_nationkey')} AS hospital_id, 'PAT_' || CAST(c_custkey AS VARCHAR) AS patient_id,
  'PAY_' || CAST((c_custkey + 3 * k) % 10 AS VARCHAR) AS payer_id,
  ['SELF','SPOUSE','CHILD','OTHER'][(c_custkey + k) % 4 + 1] AS subscriber_relationship,
  eff AS effective_date, CASE WHEN (c_custkey + k) % 6 = 0 THEN eff + 700 END AS termination_date,
  CASE WHEN (c_custkey + k) % 6 = 0 THEN 'TERMINATED' WHEN (c_custkey + k) % 13 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END
    AS coverage_status,
  ['HMO','PPO','EPO','POS'][c_custkey % 4 + 1] AS plan_type,
  CAST(ded AS DECIMAL(10,2)) AS deductible_amount,
  CAST(least(ded, ((c_custkey * 37) % 21) * 50) AS DECIMAL(10,2)) AS deductible_met_amount,
  CAST(oop AS DECIMAL(10,2)) AS out_of_pocket_max,
  CAST(least(oop, ((c_custkey * 17) % 31) * 100) AS DECIMAL(10,2)) AS out_of_pocket_met,
  CAST(k + 1 AS BIGINT) AS coverage_priority
FROM (SELECT *, 500 + (c_custkey % 5) * 500 AS ded, 3000 + (c_custkey % 4) * 1000 AS oop,
             DATE '1995-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS eff
      FROM {per_customer(2, 'k = 0 OR c_custkey % 4 = 0')})""")

cte("r_sdoh", [], f"""
SELECT 'SDH_' || CAST(c_custkey AS VARCHAR) AS screening_id, {T('c_nationkey')} AS hospital_id,
  'PAT_' || CAST(c_custkey AS VARCHAR) AS patient_id,
  DATE '2001-01-01' + CAST(c_custkey % 300 AS INTEGER) AS screening_date,
  housing AS housing_status, housing <> 'STABLE' AS housing_concerns, c_custkey % 7 = 0 AS food_insecurity_flag,
  c_custkey % 11 = 0 AS difficulty_affording_food, c_custkey % 5 = 1 AS transportation_barriers,
  c_custkey % 9 = 0 AS difficulty_paying_utilities, c_custkey % 8 = 3 AS difficulty_affording_medications,
  CAST(c_custkey % 10 AS BIGINT) AS social_isolation_score, c_custkey % 23 = 0 AS safety_concerns,
  c_custkey % 29 = 0 AS intimate_partner_violence_screen
FROM (SELECT *, ['STABLE','STABLE','UNSTABLE','HOMELESS','TRANSITIONAL'][c_custkey % 5 + 1] AS housing
      FROM customer WHERE c_custkey % 3 <> 2)""")

# ---------------------------------------------------------------- encounter programmes
cte("enc_src", ["order_base"], f"""
SELECT *, {T('c_nationkey')} AS hid, 'ENC_' || CAST(o_orderkey AS VARCHAR) AS eid,
  'PAT_' || CAST(o_custkey AS VARCHAR) AS pid, CAST(admission_date AS DATE) AS adm_date FROM order_base""")

cte("r_measures", ["enc_src"], """
SELECT 'QM_' || CAST(o_orderkey AS VARCHAR) AS measure_id, hid AS hospital_id, eid AS encounter_id, pid AS patient_id,
  ['SEP-1','AMI-8a','HF-2','STK-4','PN-6'][mi] AS measure_code,
  ['Severe Sepsis and Septic Shock','Primary PCI Within 90 Minutes','Heart Failure LVS Assessment',
   'Thrombolytic Therapy','Pneumonia Antibiotic Selection'][mi] AS measure_name,
  ['SEPSIS','AMI','HF','STROKE','PNEUMONIA'][mi] AS measure_category,
  o_orderkey % 5 <> 0 AS numerator_eligible, o_orderkey % 13 <> 0 AS denominator_eligible,
  o_orderkey % 17 = 0 AS exclusion_applied,
  CAST(CASE WHEN mi = 1 THEN 20 + o_orderkey % 90 END AS BIGINT) AS door_to_antibiotic_minutes,
  CAST(CASE WHEN mi = 2 THEN 40 + o_orderkey % 100 END AS BIGINT) AS door_to_balloon_minutes,
  CAST(CASE WHEN mi = 4 THEN 10 + o_orderkey % 50 END AS BIGINT) AS door_to_needle_minutes,
  o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS compliance_flag,
  'Q' || CAST(quarter(admission_date) AS VARCHAR) AS reporting_quarter, CAST(year(admission_date) AS BIGINT) AS reporting_year
FROM (SELECT *, CAST(o_orderkey % 8 + 1 AS INTEGER) AS mi FROM enc_src WHERE o_orderkey % 8 < 5)""")

cte("r_care_plans", ["enc_src"], """
SELECT 'CP_' || CAST(o_orderkey AS VARCHAR) AS care_plan_id, hid AS hospital_id, eid AS encounter_id, pid AS patient_id,
  status AS plan_status, adm_date AS start_date, adm_date + CAST(30 + o_orderkey % 60 AS INTEGER) AS target_date,
  CASE WHEN status = 'COMPLETED' THEN adm_date + CAST(o_orderkey % 90 AS INTEGER) END AS completion_date,
  adm_date + CAST(o_orderkey % 120 AS INTEGER) AS last_evaluated_date
FROM (SELECT *, CASE o_orderkey % 5 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'ACTIVE' WHEN 4 THEN 'DISCONTINUED'
                  ELSE 'COMPLETED' END AS status
      FROM enc_src WHERE encounter_type = 'Inpatient' AND o_orderkey % 10 < 7)""")

cte("r_referrals", ["enc_src"], """
SELECT 'REF_' || CAST(o_orderkey AS VARCHAR) AS referral_id, hid AS hospital_id, pid AS patient_id, eid AS encounter_id,
  ['SPECIALIST','DME','HOME_HEALTH','SNF'][(o_orderkey // 4) % 4 + 1] AS referral_type,
  ['Cardiology','Nephrology','Pulmonology','Oncology'][(o_orderkey // 8) % 4 + 1] AS specialty,
  status AS referral_status, ref_date AS referral_date, appt AS appointment_date,
  CASE WHEN status = 'COMPLETED' THEN appt + 2 END AS completion_date,
  ['ROUTINE','URGENT','EMERGENT'][(o_orderkey // 3) % 3 + 1] AS urgency,
  o_orderkey % 2 = 0 AS follow_up_required, o_orderkey % 6 = 0 AS follow_up_completed
FROM (SELECT *, CASE WHEN status IN ('SCHEDULED','COMPLETED') THEN ref_date + CAST(o_orderkey % 40 AS INTEGER)
                     WHEN status = 'PENDING' AND o_orderkey % 3 = 0 THEN ref_date + 5 END AS appt
      FROM (SELECT *, CASE o_orderkey % 7 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'SCHEDULED'
                        WHEN 6 THEN 'CANCELLED' ELSE 'COMPLETED' END AS status, adm_date + 1 AS ref_date
            FROM enc_src WHERE o_orderkey % 4 = 0))""")

cte("r_prior_auth", ["enc_src"], """
SELECT 'PA_' || CAST(o_orderkey AS VARCHAR) AS auth_id, hid AS hospital_id, pid AS patient_id,
  'PAY_' || CAST(o_orderkey % 10 AS VARCHAR) AS payer_id, eid AS encounter_id,
  ['SERVICE','MEDICATION','DME'][o_orderkey % 3 + 1] AS auth_type, status AS auth_status,
  req AS request_date, dec AS decision_date, dec AS effective_date,
  CASE WHEN dec IS NOT NULL THEN dec + 90 END AS expiration_date,
  CAST(ua AS BIGINT) AS units_authorized, CAST(uu AS BIGINT) AS units_used, CAST(ua - uu AS BIGINT) AS units_remaining,
  CASE WHEN status = 'DENIED' THEN 'Not medically necessary' END AS denial_reason
FROM (SELECT *, (o_orderkey * 7) % (ua + 1) AS uu,
             CASE WHEN status <> 'PENDING' THEN req + CAST(o_orderkey % 10 AS INTEGER) END AS dec
      FROM (SELECT *, ['PENDING','APPROVED','APPROVED','DENIED','EXPIRED'][(o_orderkey // 5) % 5 + 1] AS status,
                   adm_date - 3 AS req, 10 + o_orderkey % 20 AS ua
            FROM enc_src WHERE o_orderkey % 5 = 1))""")

# ---------------------------------------------------------------- staging (history / programmes)
cte("stg_problems", ["r_problems"], f"""
SELECT *, problem_status = 'ACTIVE' AS is_active, problem_status = 'RESOLVED' AS is_resolved FROM r_problems""")
cte("stg_allergies", ["r_allergies"], """
SELECT *, allergy_status = 'ACTIVE' AS is_active, severity IN ('SEVERE','LIFE_THREATENING') AS is_severe,
  allergen_type = 'DRUG' AS is_drug_allergy, reaction_type = 'ANAPHYLAXIS' AS is_anaphylaxis FROM r_allergies""")
cte("stg_coverage", ["r_coverage"], """
SELECT *, coverage_status = 'ACTIVE' AS is_active, coverage_priority = 1 AS is_primary FROM r_coverage""")
cte("stg_sdoh", ["r_sdoh"], """
SELECT *, CASE WHEN total >= 4 THEN 'High Risk' WHEN total >= 2 THEN 'Medium Risk' WHEN total >= 1 THEN 'Low Risk'
               ELSE 'No Risk' END AS sdoh_risk_category
FROM (SELECT *, housing_concerns AS has_housing_risk, food_insecurity_flag OR difficulty_affording_food AS has_food_insecurity,
        transportation_barriers AS has_transportation_barriers,
        difficulty_paying_utilities OR difficulty_affording_medications AS has_financial_strain,
        social_isolation_score >= 6 AS has_high_social_isolation,
        safety_concerns OR intimate_partner_violence_screen AS has_safety_concerns,
        CAST(housing_concerns AS INTEGER) + CAST(food_insecurity_flag AS INTEGER) + CAST(transportation_barriers AS INTEGER)
        + CAST(difficulty_paying_utilities AS INTEGER) + CAST(difficulty_affording_medications AS INTEGER)
        + CAST(social_isolation_score >= 6 AS INTEGER) + CAST(safety_concerns AS INTEGER) AS total
      FROM r_sdoh)""")
cte("stg_measures", ["r_measures"], """
SELECT *, coalesce(denominator_eligible AND NOT exclusion_applied, FALSE) AS is_measure_eligible,
  coalesce(denominator_eligible AND NOT exclusion_applied AND NOT numerator_eligible, FALSE) AS gap_in_care
FROM r_measures""")
cte("stg_care_plans", ["r_care_plans"], f"""
SELECT *, plan_status = 'ACTIVE' AS is_active_plan, plan_status = 'COMPLETED' AS is_completed_plan,
  CASE WHEN plan_status = 'COMPLETED' AND completion_date IS NOT NULL THEN date_diff('day', start_date, completion_date)
       WHEN plan_status = 'ACTIVE' AND start_date IS NOT NULL THEN date_diff('day', start_date, {AS_OF}) END
    AS plan_duration_days,
  coalesce(plan_status = 'ACTIVE' AND last_evaluated_date IS NOT NULL
           AND date_diff('day', last_evaluated_date, {AS_OF}) > 90, FALSE) AS overdue_for_evaluation,
  coalesce(plan_status = 'ACTIVE' AND target_date IS NOT NULL AND {AS_OF} > target_date, FALSE) AS past_target_date
FROM r_care_plans""")
cte("stg_referrals", ["r_referrals"], f"""
SELECT *, referral_status = 'COMPLETED' AS is_completed, referral_status = 'PENDING' AS is_pending,
  referral_status = 'CANCELLED' AS is_cancelled, urgency = 'URGENT' AS is_urgent,
  CASE WHEN appointment_date IS NOT NULL THEN date_diff('day', referral_date, appointment_date) END AS days_to_appointment,
  CASE WHEN completion_date IS NOT NULL THEN date_diff('day', referral_date, completion_date) END AS days_to_completion,
  coalesce(follow_up_required AND NOT follow_up_completed, FALSE) AS follow_up_overdue,
  coalesce(referral_status = 'PENDING' AND appointment_date IS NULL
           AND date_diff('day', referral_date, {AS_OF}) > 14, FALSE) AS overdue_for_appointment
FROM r_referrals""")
cte("stg_prior_auth", ["r_prior_auth"], f"""
SELECT *, auth_status = 'APPROVED' AS is_approved, auth_status = 'DENIED' AS is_denied,
  auth_status = 'PENDING' AS is_pending,
  CASE WHEN units_authorized IS NOT NULL AND units_authorized > 0 THEN units_used * 100.0 / units_authorized END
    AS units_utilization_pct,
  CASE WHEN decision_date IS NOT NULL THEN date_diff('day', request_date, decision_date) END AS days_to_decision,
  coalesce(expiration_date IS NOT NULL AND {AS_OF} > expiration_date, FALSE) AS is_expired
FROM r_prior_auth""")

# ---------------------------------------------------------------- intermediate (programmes)
cte("int_orders", ["stg_orders", "stg_hospitals", "stg_encounters", "stg_patients", "stg_providers"], """
SELECT o.*, date_diff('day', e.admission_date, o.order_datetime) AS encounter_day_of_order
FROM stg_orders o JOIN stg_hospitals h ON o.hospital_id = h.hospital_id
JOIN stg_encounters e ON o.encounter_id = e.encounter_id JOIN stg_patients p ON o.patient_id = p.patient_id
JOIN stg_providers v ON o.provider_id = v.provider_id""")

cte("int_med_safety", ["stg_med_admin", "stg_allergies", "stg_hospitals", "stg_encounters", "stg_patients"], """
SELECT m.*, coalesce(mac.potential_allergy_conflict AND m.is_given, FALSE) AS given_despite_allergy,
  coalesce(NOT m.is_verified AND m.is_given, FALSE) AS given_without_verification,
  coalesce(m.adverse_reaction_flag, FALSE) AS has_adverse_reaction,
  coalesce(lower(m.medication_name) SIMILAR TO '.*(warfarin|heparin|insulin|morphine|fentanyl).*', FALSE)
    AS is_high_risk_medication,
  coalesce(m.route = 'IV' AND NOT m.is_witnessed, FALSE) AS iv_given_without_witness
FROM stg_med_admin m
JOIN stg_hospitals h ON m.hospital_id = h.hospital_id
JOIN stg_encounters e ON m.encounter_id = e.encounter_id
JOIN stg_patients p ON m.patient_id = p.patient_id
LEFT JOIN (
  SELECT ma.admin_id, ma.hospital_id, a.allergy_id IS NOT NULL AS potential_allergy_conflict, a.allergen_name,
         a.severity AS allergy_severity
  FROM stg_med_admin ma
  LEFT JOIN (SELECT * FROM stg_allergies WHERE is_active AND allergen_type = 'DRUG') a
    ON ma.patient_id = a.patient_id AND ma.hospital_id = a.hospital_id
   AND (lower(ma.medication_name) LIKE '%' || lower(a.allergen_name) || '%'
        OR lower(a.allergen_name) LIKE '%' || lower(ma.medication_name) || '%')
  QUALIFY row_number() OVER (PARTITION BY ma.admin_id, ma.hospital_id
                             ORDER BY CASE a.severity WHEN 'LIFE_THREATENING' THEN 1 WHEN 'SEVERE' THEN 2
                                      WHEN 'MODERATE' THEN 3 WHEN 'MILD' THEN 4 ELSE 5 END, a.allergy_id) = 1) mac
  ON m.admin_id = mac.admin_id AND m.hospital_id = mac.hospital_id""")

cte("int_measure_results", ["stg_measures", "stg_encounters"], """
SELECT *, target_minutes IS NOT NULL AS is_timed_measure,
  CASE WHEN target_minutes IS NULL OR time_to_treatment_minutes IS NULL THEN NULL
       ELSE time_to_treatment_minutes <= target_minutes END AS met_time_target,
  is_measure_eligible AND coalesce(compliance_flag, FALSE) AS is_performance_met
FROM (SELECT m.*, e.provider_id, e.is_mortality,
        coalesce(m.door_to_antibiotic_minutes, m.door_to_balloon_minutes, m.door_to_needle_minutes)
          AS time_to_treatment_minutes,
        CASE m.measure_code WHEN 'SEP-1' THEN 60 WHEN 'AMI-8a' THEN 90 WHEN 'STK-4' THEN 60 END AS target_minutes
      FROM stg_measures m JOIN stg_encounters e ON m.encounter_id = e.encounter_id AND m.hospital_id = e.hospital_id)""")


def _charlson_case(code: str) -> str:
    from ..functions.scores import CHARLSON
    c = f"upper(replace({code}, '.', ''))"
    parts = []
    for name, _w, three, four, ranges in CHARLSON:
        conds = []
        if three:
            conds.append(f"left({c}, 3) IN ({', '.join(repr(x) for x in three)})")
        if four:
            conds.append(f"left({c}, 4) IN ({', '.join(repr(x) for x in four)})")
        conds += [f"left({c}, 3) BETWEEN '{lo}' AND '{hi}'" for lo, hi in ranges]
        if name == "myocardial_infarction":
            conds.append(f"{c} LIKE 'I252%'")
        parts.append(f"WHEN {' OR '.join(conds)} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


def _charlson_index_sql() -> str:
    from ..functions.scores import CHARLSON, CHARLSON_SUPERSEDES
    names = [n for n, *_ in CHARLSON]
    weight = {n: w for n, w, *_ in CHARLSON}
    sup = {mild: severe for severe, mild in CHARLSON_SUPERSEDES}
    flags = ", ".join(f"bool_or(cond = '{n}') AS has_{n}" for n in names)
    cols = ", ".join(f"coalesce(f.has_{n}, FALSE) AS has_{n}" for n in names)
    idx = " + ".join(
        f"CASE WHEN has_{n}{(' AND NOT has_' + sup[n]) if n in sup else ''} THEN {weight[n]} ELSE 0 END" for n in names)
    cnt = " + ".join(f"CAST(has_{n} AS INTEGER)" for n in names)
    return f"""
SELECT *, charlson_index + charlson_age_points AS charlson_age_adjusted_index,
  CASE WHEN charlson_index = 0 THEN 'None' WHEN charlson_index <= 2 THEN 'Mild' WHEN charlson_index <= 4 THEN 'Moderate'
       ELSE 'Severe' END AS charlson_severity
FROM (SELECT *, {idx} AS charlson_index, {cnt} AS charlson_condition_count,
        CASE WHEN age_years >= 80 THEN 4 WHEN age_years >= 70 THEN 3 WHEN age_years >= 60 THEN 2
             WHEN age_years >= 50 THEN 1 ELSE 0 END AS charlson_age_points
      FROM (SELECT p.hospital_id, p.patient_id, p.age_years, {cols}
            FROM stg_patients p LEFT JOIN (
              SELECT hospital_id, patient_id, {flags}
              FROM (SELECT hospital_id, patient_id, {_charlson_case('diagnosis_code')} AS cond
                    FROM (SELECT hospital_id, patient_id, diagnosis_code FROM stg_problems WHERE is_active
                          UNION
                          SELECT hospital_id, patient_id, primary_diagnosis_code FROM stg_encounters
                          WHERE primary_diagnosis_code IS NOT NULL))
              WHERE cond IS NOT NULL GROUP BY hospital_id, patient_id) f
            ON p.patient_id = f.patient_id AND p.hospital_id = f.hospital_id))"""


cte("int_comorbidity", ["stg_patients", "stg_problems", "stg_encounters"], _charlson_index_sql())

cte("int_patient_profile", ["stg_patients", "stg_hospitals", "stg_problems", "stg_allergies", "stg_coverage",
                            "int_vitals", "stg_sdoh", "stg_encounters", "stg_med_admin", "r_diagnoses"], f"""
SELECT *,
  CASE WHEN chronic_condition_count >= 3 AND ed_visits >= 2 THEN 'Very High Risk'
       WHEN chronic_condition_count >= 2 OR readmissions >= 1 THEN 'High Risk'
       WHEN chronic_condition_count >= 1 THEN 'Medium Risk' ELSE 'Low Risk' END AS clinical_risk_category,
  CASE WHEN ed_visits >= 4 THEN 'Frequent ED User' WHEN inpatient_admits >= 3 THEN 'Frequent Admits'
       WHEN total_encounters >= 10 THEN 'High Utilizer' WHEN total_encounters >= 5 THEN 'Moderate Utilizer'
       ELSE 'Low Utilizer' END AS utilization_category,
  date_diff('day', last_encounter_date, {AS_OF}) AS days_since_last_encounter,
  CASE WHEN medication_refusals_30days > 0 THEN greatest(0, 100 - medication_refusals_30days * 10) ELSE 100 END
    AS patient_engagement_score
FROM (
  SELECT p.patient_id, p.hospital_id, h.hospital_name, h.hospital_type, h.region, p.age_years, p.age_group, p.gender,
    p.race, p.ethnicity, p.zip_code_3digit, p.primary_language, p.marital_status,
    CAST(NULL AS TIMESTAMP) AS first_encounter_date,
    coalesce(ap.active_problem_count, 0) AS active_problem_count,
    coalesce(ap.chronic_condition_count, 0) AS chronic_condition_count, ap.active_diagnoses_list,
    coalesce(aa.active_allergy_count, 0) AS active_allergy_count,
    coalesce(aa.life_threatening_allergy_count, 0) AS life_threatening_allergy_count,
    coalesce(aa.drug_allergy_count, 0) AS drug_allergy_count, aa.active_allergies_list,
    coalesce(cc.active_coverage_count, 0) AS active_coverage_count, cc.primary_payer_id, cc.primary_plan_type,
    cc.primary_deductible_remaining, cc.primary_oop_remaining,
    rv.vital_measurements_last_7days, rv.last_vital_datetime, rv.febrile_rate, rv.hypotensive_rate, rv.hypoxic_rate,
    rv.avg_bmi, rv.latest_news_score,
    sd.last_sdoh_screening_date, sd.current_sdoh_risk_category, sd.current_sdoh_risk_count, sd.has_housing_risk,
    sd.has_food_insecurity, sd.has_transportation_barriers,
    coalesce(eh.total_encounters, 0) AS total_encounters, coalesce(eh.ed_visits, 0) AS ed_visits,
    coalesce(eh.inpatient_admits, 0) AS inpatient_admits, coalesce(eh.readmissions, 0) AS readmissions,
    coalesce(eh.lifetime_charges, 0) AS lifetime_charges, eh.last_encounter_date,
    rm.medication_administrations_30days, rm.medication_refusals_30days, rm.adverse_reactions_30days,
    rm.unique_medications_30days
  FROM stg_patients p JOIN stg_hospitals h ON p.hospital_id = h.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT problem_id) AS active_problem_count,
               count(DISTINCT CASE WHEN is_chronic THEN problem_id END) AS chronic_condition_count,
               string_agg(diagnosis_description, '; ' ORDER BY onset_date DESC, problem_id DESC) AS active_diagnoses_list
             FROM (SELECT pr.*, d.diagnosis_description FROM stg_problems pr
                   JOIN r_diagnoses d ON pr.diagnosis_code = d.diagnosis_code)
             WHERE is_active GROUP BY patient_id, hospital_id) ap
    ON p.patient_id = ap.patient_id AND p.hospital_id = ap.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT allergy_id) AS active_allergy_count,
               count(DISTINCT CASE WHEN severity = 'LIFE_THREATENING' THEN allergy_id END) AS life_threatening_allergy_count,
               count(DISTINCT CASE WHEN is_drug_allergy THEN allergy_id END) AS drug_allergy_count,
               string_agg(allergen_name, '; ' ORDER BY onset_date DESC, allergy_id DESC) AS active_allergies_list
             FROM stg_allergies WHERE is_active GROUP BY patient_id, hospital_id) aa
    ON p.patient_id = aa.patient_id AND p.hospital_id = aa.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT coverage_id) AS active_coverage_count,
               max(CASE WHEN is_primary THEN payer_id END) AS primary_payer_id,
               max(CASE WHEN is_primary THEN plan_type END) AS primary_plan_type,
               max(CASE WHEN is_primary THEN deductible_amount - deductible_met_amount END) AS primary_deductible_remaining,
               max(CASE WHEN is_primary THEN out_of_pocket_max - out_of_pocket_met END) AS primary_oop_remaining
             FROM stg_coverage WHERE is_active GROUP BY patient_id, hospital_id) cc
    ON p.patient_id = cc.patient_id AND p.hospital_id = cc.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT vital_id) AS vital_measurements_last_7days,
               max(measurement_datetime) AS last_vital_datetime,
               (floor(avg(CASE WHEN is_febrile THEN 1 ELSE 0 END) * 10000 + 0.5) / 10000) AS febrile_rate,
               (floor(avg(CASE WHEN is_hypotensive THEN 1 ELSE 0 END) * 10000 + 0.5) / 10000) AS hypotensive_rate,
               (floor(avg(CASE WHEN is_hypoxic THEN 1 ELSE 0 END) * 10000 + 0.5) / 10000) AS hypoxic_rate,
               (floor(CAST(sum(bmi) AS DOUBLE) / count(bmi) * 10000 + 0.5) / 10000) AS avg_bmi,
               arg_max(total_news_score, (measurement_datetime, vital_id)) AS latest_news_score
             FROM int_vitals WHERE measurement_datetime >= {AS_OF} - INTERVAL 7 DAY
             GROUP BY patient_id, hospital_id) rv
    ON p.patient_id = rv.patient_id AND p.hospital_id = rv.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, max(screening_date) AS last_sdoh_screening_date,
               arg_max(sdoh_risk_category, (screening_date, screening_id)) AS current_sdoh_risk_category,
               arg_max(total, (screening_date, screening_id)) AS current_sdoh_risk_count,
               arg_max(has_housing_risk, (screening_date, screening_id)) AS has_housing_risk,
               arg_max(has_food_insecurity, (screening_date, screening_id)) AS has_food_insecurity,
               arg_max(has_transportation_barriers, (screening_date, screening_id)) AS has_transportation_barriers
             FROM stg_sdoh GROUP BY patient_id, hospital_id) sd
    ON p.patient_id = sd.patient_id AND p.hospital_id = sd.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT encounter_id) AS total_encounters,
               count(DISTINCT CASE WHEN encounter_type = 'Emergency' THEN encounter_id END) AS ed_visits,
               count(DISTINCT CASE WHEN encounter_type = 'Inpatient' THEN encounter_id END) AS inpatient_admits,
               count(DISTINCT CASE WHEN is_readmission THEN encounter_id END) AS readmissions,
               sum(total_charges) AS lifetime_charges, max(admission_date) AS last_encounter_date
             FROM stg_encounters GROUP BY patient_id, hospital_id) eh
    ON p.patient_id = eh.patient_id AND p.hospital_id = eh.hospital_id
  LEFT JOIN (SELECT patient_id, hospital_id, count(DISTINCT admin_id) AS medication_administrations_30days,
               count(DISTINCT CASE WHEN is_refused THEN admin_id END) AS medication_refusals_30days,
               count(DISTINCT CASE WHEN adverse_reaction_flag THEN admin_id END) AS adverse_reactions_30days,
               count(DISTINCT medication_name) AS unique_medications_30days
             FROM stg_med_admin WHERE administered_datetime >= {AS_OF} - INTERVAL 30 DAY
             GROUP BY patient_id, hospital_id) rm
    ON p.patient_id = rm.patient_id AND p.hospital_id = rm.hospital_id)""")

cte("int_prior_auth", ["stg_prior_auth", "r_payers", "stg_billing"], """
SELECT a.*, p.payer_name, p.payer_type, CAST(date_trunc('month', a.request_date) AS DATE) AS request_month,
  c.encounter_charges, coalesce(c.has_prior_auth_denial, FALSE) AS has_prior_auth_denial,
  coalesce(c.has_claim_denial, FALSE) AS has_claim_denial,
  CASE WHEN a.is_denied OR a.is_pending THEN coalesce(c.encounter_charges, 0) ELSE 0 END AS charges_at_risk,
  {exp}
FROM stg_prior_auth a LEFT JOIN r_payers p ON a.payer_id = p.payer_id
LEFT JOIN (SELECT hospital_id, encounter_id, sum(charge_amount) AS encounter_charges,
             bool_or(lower(denial_reason) LIKE '%prior authorization%') AS has_prior_auth_denial,
             bool_or(is_denied) AS has_claim_denial
           FROM stg_billing GROUP BY hospital_id, encounter_id) c
  ON a.encounter_id = c.encounter_id AND a.hospital_id = c.hospital_id""".replace(
    "{exp}", f"coalesce(a.expiration_date IS NOT NULL AND date_diff('day', {AS_OF}, a.expiration_date) BETWEEN 0 AND 30, FALSE) AS expiring_soon"))

cte("int_referrals", ["stg_referrals", "stg_encounters"], """
SELECT *, CASE WHEN days_to_appointment IS NULL THEN NULL ELSE days_to_appointment <= sla END AS scheduled_within_sla,
  coalesce(is_completed AND (NOT coalesce(follow_up_required, FALSE) OR coalesce(follow_up_completed, FALSE)), FALSE)
    AS is_closed_loop
FROM (SELECT r.*, e.encounter_type AS source_encounter_type, CAST(date_trunc('month', r.referral_date) AS DATE) AS referral_month,
        CASE upper(r.urgency) WHEN 'EMERGENT' THEN 2 WHEN 'URGENT' THEN 7 ELSE 30 END AS sla
      FROM stg_referrals r LEFT JOIN stg_encounters e ON r.encounter_id = e.encounter_id AND r.hospital_id = e.hospital_id)""")


# ---------------------------------------------------------------- platform logs
_LOG_TABLES = ("['RAW_PHI.RAW_PATIENTS','RAW_PHI.RAW_ENCOUNTERS','RAW_PHI.RAW_BILLING_TRANSACTIONS',"
               "'RAW_PHI.RAW_CLINICAL_ORDERS','RAW_PHI.RAW_CLINICAL_RESULTS','RAW_PHI.RAW_VITAL_SIGNS',"
               "'RAW_PHI.RAW_MEDICATION_ADMINISTRATION','RAW_PHI.RAW_PATIENT_ALLERGIES',"
               "'STAGING.STG_HEALTHCARE__PATIENTS','STAGING.STG_HEALTHCARE__ENCOUNTERS','RAW_PHI.RAW_PAYERS',"
               "'MARTS.FCT_FINANCIAL_PERFORMANCE','RAW_PHI.RAW_SDOH_SCREENINGS']")

cte("r_query_history", [], f"""
SELECT 'Q' || CAST(event_id AS VARCHAR) AS query_id,
  CASE WHEN user_id % 6 = 3 AND event_type = 'purchase'
         THEN 'create or replace table MARTS.FCT_ENCOUNTERS as select * from INT_ENCOUNTERS_ENRICHED'
       WHEN user_id % 6 = 3 AND event_type = 'signup'
         THEN 'merge into MARTS.FCT_ENCOUNTERS using INT_ENCOUNTERS_ENRICHED on encounter_id'
       WHEN user_id % 6 = 3 AND event_type = 'click'
         THEN 'delete from MARTS.FCT_ENCOUNTERS where loaded_at_timestamp > current_date - 1'
       ELSE CASE qtype WHEN 'SELECT' THEN sel || tbl || join_txt || filter_txt
             WHEN 'INSERT' THEN 'INSERT INTO ' || tbl || ' SELECT * FROM staging_batch' || filter_txt
             WHEN 'MERGE' THEN 'MERGE INTO ' || tbl || ' USING updates' || filter_txt
             ELSE 'DELETE FROM ' || tbl || filter_txt END END AS query_text,
  CASE WHEN event_id % 10 = 0 THEN 'HEALTHCARE_DEV' ELSE 'HEALTHCARE_PROD' END AS database_name,
  split_part(tbl, '.', 1) AS schema_name, 'USER_' || CAST(user_id AS VARCHAR) AS user_name,
  CASE user_id % 6 WHEN 0 THEN 'SYSADMIN' WHEN 1 THEN 'HOSPITAL_' || hosp || '_PHI_ANALYST'
       WHEN 2 THEN 'HOSPITAL_' || hosp || '_ANALYST' WHEN 3 THEN 'DBT_PROD_ROLE' WHEN 4 THEN 'HIPAA_AUDITOR'
       ELSE 'MARKETING_ROLE' END AS role_name,
  CAST(user_id * 1000 + dayofmonth(ts) AS BIGINT) AS session_id,
  CASE WHEN user_id % 2 = 0 THEN 'TRANSFORM_WH' ELSE 'ANALYTICS_WH' END AS warehouse_name,
  ts AS start_time, ts + to_milliseconds(elapsed) AS end_time,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
  CASE WHEN qtype = 'SELECT' THEN nrows ELSE 0 END AS rows_produced,
  CASE WHEN qtype = 'INSERT' THEN nrows ELSE 0 END AS rows_inserted,
  CASE WHEN qtype = 'MERGE' THEN nrows ELSE 0 END AS rows_updated,
  CASE WHEN qtype = 'DELETE' THEN nrows ELSE 0 END AS rows_deleted,
  nrows * 512 AS bytes_scanned, (elapsed * 4) // 5 AS execution_time, elapsed AS total_elapsed_time,
  CAST(value / 100.0 AS DECIMAL(18,6)) AS credits_used_cloud_services, qtype AS query_type
FROM (SELECT *,
        CASE WHEN event_id % 4 = 0 THEN ' WHERE hospital_id = ''' || hosp || ''''
             WHEN event_id % 4 = 1 THEN ' WHERE hospital_id IN (''' || hosp || ''', ''HOSP_9999'')'
             WHEN event_id % 4 = 2 THEN ' where HOSPITAL_ID=''' || lower(hosp) || ''''
             ELSE '' END AS filter_txt,
        CASE WHEN event_id % 3 = 0 THEN 'select * from ' ELSE 'SELECT count(*) FROM ' END AS sel,
        CASE WHEN event_id % 5 = 0 THEN ' JOIN ' || {_LOG_TABLES}[(event_id * 7 + 3) % 13 + 1] ELSE '' END AS join_txt
      FROM (SELECT *, CAST(round(value * 1000) AS BIGINT) AS elapsed, CAST(round(value * 100) AS BIGINT) AS nrows,
              {_LOG_TABLES}[event_id % 13 + 1] AS tbl, {T('user_id % 25')} AS hosp,
              CASE event_type WHEN 'purchase' THEN 'INSERT' WHEN 'signup' THEN 'MERGE' WHEN 'error' THEN 'DELETE'
                   ELSE 'SELECT' END AS qtype
            FROM events))""")

cte("r_metering", [], """
SELECT date_trunc('hour', ts) AS start_time,
  CASE WHEN user_id % 2 = 0 THEN 'TRANSFORM_WH' ELSE 'ANALYTICS_WH' END AS warehouse_name,
  CAST(count(*) / 10.0 AS DECIMAL(18,6)) AS credits_used
FROM events GROUP BY ALL""")

cte("r_line_dose", ["line_base"], """
SELECT 'ADM_' || line_key AS admin_id, CAST(q % 10 + 1 AS VARCHAR) || ' mg' AS dose FROM line_base
WHERE order_type = 'MEDICATION'""")

cte("r_user_mapping", [], f"""
SELECT 'USER_' || CAST(user_id AS VARCHAR) AS user_name, 'HOSPITAL_ANALYST' AS role_name, h AS hospital_id,
  DATE '2020-01-01' AS access_start_date, e AS access_end_date
FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 6 = 2) u,
     (SELECT 0 AS k UNION ALL SELECT 1) ks,
     LATERAL (SELECT CASE WHEN k = 0 THEN {T('user_id % 25')} ELSE {T('(user_id + 1) % 25')} END AS h,
                     CASE WHEN k = 0 THEN DATE '2099-12-31' ELSE DATE '2023-12-31' END AS e)""")

cte("r_vitals_extra", ["r_vitals"], "SELECT vital_id, bmi FROM r_vitals")

cte("r_vitals_map", ["r_vitals"], """
SELECT vital_id, CAST((systolic_bp + 2 * diastolic_bp) // 3 AS BIGINT) AS map_mmhg FROM r_vitals""")
