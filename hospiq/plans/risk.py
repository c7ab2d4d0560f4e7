"""Scores over whole stays and whole patients (I01-I09) with every input the
tables carry. Each clinical table is reduced to one row per stay or patient
(on the map side first) before it meets the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S

c = F.col

# S/F = 64 + 0.84 * P/F (published regression of SpO2/FiO2 on PaO2/FiO2)
SF_INTERCEPT, SF_SLOPE = 64.0, 0.84
ROOM_AIR = 0.21
ANTICOAGULANTS = ["WARFARIN", "HEPARIN"]
ANTIPLATELETS = ["ASPIRIN", "CLOPIDOGREL"]


def worst_vitals(vitals: DataFrame) -> DataFrame:
    """The worst of each vital sign of a stay.

    The feeds hold neither blood gases nor a coma scale. Oxygen given stands in
    as FiO2 0.4 under a saturation of 92 % and 0.6 under 88 %, the arterial
    pressure of oxygen follows from the saturation, and consciousness falls with
    pain reports over 6 (of 10)."""
    v = vitals.groupBy("hospital_id", "encounter_id").agg(
        F.max("temperature_f").alias("_temp_f"), F.min("map_mmhg").alias("map"), F.max("heart_rate_bpm").alias("hr"),
        F.max("respiratory_rate").alias("rr"), F.min("systolic_bp").alias("sbp"), F.min("oxygen_saturation_pct").alias("spo2"),
        F.max("pain_score").alias("pain"))
    fio2 = F.when(c("spo2") < 88, 0.6).when(c("spo2") < 92, 0.4).when(c("spo2").isNotNull(), ROOM_AIR)
    return (v.withColumn("temp_c", S.f_to_c("_temp_f")).withColumn("fio2", fio2)
            .withColumn("pf", (c("spo2").cast("double") / c("fio2") - SF_INTERCEPT) / SF_SLOPE)
            .withColumn("pao2", c("pf") * c("fio2"))
            .withColumn("gcs", F.lit(15) - F.greatest(c("pain") - 6, F.lit(0)) * 2)
            .withColumn("avpu", F.when(c("pain") >= 10, "U").when(c("pain") == 9, "P").when(c("pain") == 8, "V").otherwise("A"))
            .drop("_temp_f"))


def worst_labs(results: DataFrame) -> DataFrame:
    """The worst released value of each scored test of a stay; a haematocrit is
    three times the haemoglobin."""
    def of(test):
        return F.when(F.upper("test_name") == test, c("result_value_numeric").cast("double"))
    r = results.filter((c("result_type") == "LAB") & ~c("is_preliminary")).groupBy("hospital_id", "encounter_id").agg(
        F.max(of("SODIUM")).alias("sodium"), F.max(of("POTASSIUM")).alias("potassium"), F.max(of("CREATININE")).alias("creatinine"),
        F.min(of("HEMOGLOBIN")).alias("_hb"), F.max(of("WBC")).alias("wbc"), F.min(of("PLATELETS")).alias("platelets"),
        F.max(of("BILIRUBIN")).alias("bilirubin"), F.min(of("ARTERIAL PH")).alias("ph"))
    return r.withColumn("hematocrit", c("_hb") * 3).drop("_hb")


def encounter_severity(encounters: DataFrame, patients: DataFrame, vitals: DataFrame, results: DataFrame,
                       comorbidity: DataFrame) -> DataFrame:
    """APACHE II, SOFA, MEWS and NEWS2 of each stay from its worst values; a
    value never measured adds nothing."""
    chronic = (c("has_congestive_heart_failure") | c("has_chronic_pulmonary_disease") | c("has_renal_disease")
               | c("has_moderate_severe_liver_disease"))
    per_patient = (patients.select("hospital_id", "patient_id", "age_years")
                   .join(comorbidity.select("hospital_id", "patient_id", chronic.alias("chronic")), ["hospital_id", "patient_id"], "left"))
    stay = ["hospital_id", "encounter_id"]
    e = (encounters.select(*stay, "patient_id", "encounter_type").join(worst_vitals(vitals), stay, "left")
         .join(worst_labs(results), stay, "left").join(per_patient, ["hospital_id", "patient_id"], "left"))
    apache = S.apache_ii(age="age_years", temperature_c="temp_c", map_mmhg="map", heart_rate="hr", respiratory_rate="rr",
                         pao2="pao2", fio2="fio2", arterial_ph="ph", serum_sodium="sodium", serum_potassium="potassium",
                         serum_creatinine="creatinine", hematocrit="hematocrit", wbc_count="wbc", gcs_score="gcs",
                         has_chronic_disease="chronic", admission_type="encounter_type")
    sofa = S.sofa(pao2_fio2_ratio="pf", platelets="platelets", bilirubin="bilirubin", map_mmhg="map", gcs_score="gcs",
                  creatinine="creatinine")
    alert = F.when(c("avpu").isNotNull(), c("avpu") == "A")
    return (e.select(*stay, apache.alias("apache_ii_score"), sofa.alias("sofa_score"),
                     S.mews("sbp", "hr", "rr", "temp_c", "avpu").alias("mews_score"),
                     S.news2("rr", "spo2", c("fio2") > ROOM_AIR, "temp_c", "sbp", "hr", alert).alias("news2_score"))
            .withColumn("apache_ii_mortality_pct", S.apache_ii_mortality("apache_ii_score"))
            .withColumn("mews_category", S.mews_category("mews_score"))
            .withColumn("news2_level", S.news2_level("news2_score")))


def stroke_and_bleeding_risk(patients: DataFrame, comorbidity: DataFrame, vitals: DataFrame, medication: DataFrame,
                             problems: DataFrame, encounters: DataFrame) -> DataFrame:
    """CHA2DS2-VASc and HAS-BLED with all their inputs.

    Hypertension: a code I10-I15 or two hypertensive readings; uncontrolled: a
    systolic pressure over 160. Antiplatelet: one was given. Bleeding: an adverse
    reaction to an anticoagulant or antiplatelet. Labile INR (no feed has the
    test): warfarin was given and a dose of it was missed, held or refused.
    Alcohol: a code F10 or K70."""
    who = ["hospital_id", "patient_id"]
    code = S.normalize_icd10("diagnosis_code")
    dx = (problems.filter("is_active").select(*who, "diagnosis_code")
          .unionByName(encounters.select(*who, c("primary_diagnosis_code").alias("diagnosis_code"))))
    dx = dx.groupBy(*who).agg(F.bool_or(F.substring(code, 1, 3).between("I10", "I15")).alias("_htn_code"),
                              F.bool_or(F.substring(code, 1, 3).isin("F10", "K70")).alias("alcohol"))
    v = vitals.groupBy(*who).agg((F.count_if("is_hypertensive") >= 2).alias("_htn_read"), (F.max("systolic_bp") > 160).alias("uncontrolled"))
    drug = F.upper("medication_name")
    skipped = c("is_missed") | c("is_held") | c("is_refused")
    m = medication.groupBy(*who).agg(
        F.bool_or(drug.isin(*ANTIPLATELETS) & c("is_given")).alias("antiplatelet"),
        F.bool_or(drug.isin(*ANTIPLATELETS, *ANTICOAGULANTS) & c("adverse_reaction_flag")).alias("bleeding"),
        (F.bool_or((drug == "WARFARIN") & c("is_given")) & F.bool_or((drug == "WARFARIN") & skipped)).alias("labile_inr"))
    p = comorbidity.join(patients.select(*who, "gender"), who)
    for side in (dx, v, m):
        p = p.join(side, who, "left")
    no = F.lit(False)
    htn = F.coalesce(c("_htn_code"), no) | F.coalesce(c("_htn_read"), no)
    cha = S.cha2ds2_vasc(age="age_years", gender="gender", has_chf="has_congestive_heart_failure", has_hypertension=htn,
                         has_stroke_tia="has_cerebrovascular_disease",
                         has_vascular_disease=c("has_myocardial_infarction") | c("has_peripheral_vascular_disease"),
                         has_diabetes=c("has_diabetes_without_complications") | c("has_diabetes_with_complications"))
    liver = c("has_mild_liver_disease") | c("has_moderate_severe_liver_disease")
    bled = S.hasbled("uncontrolled", "has_renal_disease", liver, "has_cerebrovascular_disease", "bleeding", "labile_inr",
                     c("age_years") > 65, "antiplatelet", "alcohol")
    return (p.select(*who, htn.alias("has_hypertension"), cha.alias("cha2ds2_vasc_score"), bled.alias("hasbled_score"))
            .withColumn("cha2ds2_vasc_category", S.cha2ds2_vasc_category("cha2ds2_vasc_score"))
            .withColumn("annual_stroke_risk_pct", S.cha2ds2_vasc_annual_stroke_risk("cha2ds2_vasc_score"))
            .withColumn("hasbled_category", S.hasbled_category("hasbled_score"))
            .withColumn("annual_bleeding_risk_pct", S.hasbled_annual_bleeding_risk("hasbled_score")))
