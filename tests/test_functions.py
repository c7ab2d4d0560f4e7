"""Band edges of the scalar helpers and clinical scores (I/H families)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from hospiq.functions import core as fn
from hospiq.functions import scores as S


def one(spark, expr, **cols):
    if not cols:
        df = spark.range(1)
    else:
        import datetime as _dt
        def typ(v):
            if isinstance(v, bool):
                return "boolean"
            if isinstance(v, int):
                return "bigint"
            if isinstance(v, float):
                return "double"
            if isinstance(v, _dt.datetime):
                return "timestamp_ntz"
            if isinstance(v, _dt.date):
                return "date"
            return "string"
        schema = ", ".join(f"{k} {typ(v)}" for k, v in cols.items())
        df = spark.createDataFrame([tuple(cols.values())], schema)
    return df.select(expr.alias("x")).first()["x"]


def test_boundary_diff_counts_boundaries(spark):
    a, b = dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1)
    assert one(spark, fn.boundary_diff("hour", "a", "b"), a=a, b=b) == 1
    assert one(spark, fn.boundary_diff("minute", "a", "b"), a=a, b=b) == 2
    assert one(spark, fn.boundary_diff("day", "a", "b"), a=dt.datetime(2024, 1, 1, 23, 59),
               b=dt.datetime(2024, 1, 2, 0, 1)) == 1
    assert one(spark, fn.boundary_diff("year", "a", "b"), a=dt.datetime(2023, 12, 31), b=dt.datetime(2024, 1, 1)) == 1


def test_safe_divide_and_pct(spark):
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(None).cast("int"))) is None
    assert one(spark, fn.pct(F.lit(1), F.lit(3), 2)) == pytest.approx(33.33)
    assert one(spark, fn.round_half_up(F.lit(0.125), 2)) == 0.13


def test_least_strict_keeps_null(spark):
    assert one(spark, fn.least_strict(F.lit(None).cast("int"), F.lit(90))) is None
    assert one(spark, fn.least_strict(F.lit(95), F.lit(90))) == 90


@pytest.mark.parametrize("zip_code,expected", [("02139", "021"), ("03601", "000"), ("ab123", "000"), (None, None),
                                                (" 89012", "000"), ("10001", "100")])
def test_zip_safe_harbor(spark, zip_code, expected):
    assert one(spark, fn.deidentify_zip("z"), z=zip_code) == expected


def test_age_and_groups(spark):
    age = one(spark, fn.age_years("d", F.lit("2001-08-05").cast("date")), d=dt.date(1950, 8, 6))
    assert age == 50
    assert one(spark, fn.age_years("d", F.lit("2001-08-05").cast("date")), d=dt.date(1950, 8, 5)) == 51
    assert one(spark, fn.age_group(F.lit(17))) == "Pediatric"
    assert one(spark, fn.age_group(F.lit(18))) == "Adult"
    assert one(spark, fn.age_group(F.lit(65))) == "Geriatric"
    assert one(spark, fn.age_group(F.lit(None).cast("int"))) == "Unknown"
    assert one(spark, fn.age_bucket(F.lit(90))) == "90+"
    assert one(spark, fn.age_bucket(F.lit(45))) == "40-49"


def test_los_and_ar_bucket(spark):
    a = dt.datetime(2024, 1, 1, 23, 0)
    assert one(spark, fn.los_midnights("a", "b"), a=a, b=dt.datetime(2024, 1, 2, 1, 0)) == 1
    assert one(spark, fn.los_midnights("a", "b"), a=a, b=dt.datetime(2023, 12, 31)) is None
    for days, bucket in [(30, "0-30"), (31, "31-60"), (90, "61-90"), (121, "120+"), (None, "Unknown")]:
        assert one(spark, fn.ar_aging_bucket(F.lit(days).cast("int"))) == bucket


def test_surrogate_key_matches_md5_convention(spark):
    import hashlib
    expected = hashlib.md5(b"HOSP_0001-_dbt_utils_surrogate_key_null_").hexdigest()
    assert one(spark, fn.surrogate_key(F.lit("HOSP_0001"), F.lit(None).cast("string"))) == expected


@pytest.mark.parametrize("rr,spo2,temp_c,sbp,hr,expected", [
    (8, 91, 35.0, 90, 40, 15),       # every parameter at its worst low edge
    (12, 96, 37.0, 120, 60, 0),      # normal
    (21, 94, 38.5, 101, 91, 2 + 1 + 1 + 1 + 1),
    (25, 92, 39.1, 220, 131, 3 + 2 + 2 + 3 + 3),
    (None, None, None, None, None, 0),
])
def test_news2_band_edges(spark, rr, spo2, temp_c, sbp, hr, expected):
    df = spark.createDataFrame([(rr, spo2, temp_c, sbp, hr)],
                               "rr int, spo2 int, t double, sbp int, hr int")
    got = df.select(S.news2(respiratory_rate="rr", spo2="spo2", temperature_c="t", systolic_bp="sbp",
                            heart_rate="hr").alias("s")).first()["s"]
    assert got == expected


def test_news2_oxygen_and_consciousness(spark):
    df = spark.createDataFrame([(True, False)], "o2 boolean, alert boolean")
    assert df.select(S.news2(on_supplemental_oxygen="o2", consciousness_alert="alert").alias("s")).first()["s"] == 5


@pytest.mark.parametrize("rr,sbp,am,expected", [(22, 100, True, 3), (21, 101, False, 0), (None, None, None, 0)])
def test_qsofa(spark, rr, sbp, am, expected):
    df = spark.createDataFrame([(rr, sbp, am)], "rr int, sbp int, am boolean")
    assert df.select(S.qsofa("rr", "sbp", "am").alias("s")).first()["s"] == expected


def test_apache_ii_edges(spark):
    df = spark.createDataFrame([(41.0, 49, 39, 5, 80.0, 0.6, 7.7, 180.0, 7.0, 0.5, 19.0, 0.9, 3, 75, True, "Emergency")],
                               "t double, map int, hr int, rr int, pao2 double, fio2 double, ph double, na double, "
                               "k double, cr double, hct double, wbc double, gcs int, age int, chronic boolean, adm string")
    s = df.select(S.apache_ii(age="age", temperature_c="t", map_mmhg="map", heart_rate="hr", respiratory_rate="rr",
                              pao2="pao2", fio2="fio2", arterial_ph="ph", serum_sodium="na", serum_potassium="k",
                              serum_creatinine="cr", hematocrit="hct", wbc_count="wbc", gcs_score="gcs",
                              has_chronic_disease="chronic", admission_type="adm").alias("s")).first()["s"]
    # temp 4, map 4, hr 4, rr 4, A-a (713*.6-80=347.8 -> 2), ph 4, na 4, k 4, cr 2, hct 4, wbc 4, gcs 12, age 6, chronic 5
    assert s == 4 + 4 + 4 + 4 + 2 + 4 + 4 + 4 + 2 + 4 + 4 + 12 + 6 + 5
    assert spark.range(1).select(S.apache_ii_mortality(F.lit(35)).alias("m")).first()["m"] == 85
    assert spark.range(1).select(S.apache_ii_mortality(F.lit(4)).alias("m")).first()["m"] == 4


def test_sofa_edges(spark):
    df = spark.createDataFrame([(99.0, 19.0, 12.0, 69, 5, None, 199.0)],
                               "pf double, plt double, bili double, map int, gcs int, cr double, uo double")
    s = df.select(S.sofa("pf", "plt", "bili", "map", "gcs", None, "uo").alias("s")).first()["s"]
    assert s == 4 + 4 + 4 + 1 + 4 + 4


def test_mews_and_category(spark):
    df = spark.createDataFrame([(70, 130, 30, 38.5, "u")], "sbp int, hr int, rr int, t double, avpu string")
    s = df.select(S.mews("sbp", "hr", "rr", "t", "avpu").alias("s")).first()["s"]
    assert s == 3 + 2 + 3 + 2 + 3
    assert spark.range(1).select(S.mews_category(F.lit(0)).alias("c")).first()["c"].startswith("Low")


def test_cha2ds2_vasc_and_hasbled(spark):
    df = spark.createDataFrame([(75, "f", True, True, True, True, True)],
                               "age int, g string, chf boolean, htn boolean, stroke boolean, vasc boolean, dm boolean")
    s = df.select(S.cha2ds2_vasc("age", "g", "chf", "htn", "stroke", "vasc", "dm").alias("s")).first()["s"]
    assert s == 9
    assert spark.range(1).select(S.cha2ds2_vasc_annual_stroke_risk(F.lit(9)).alias("r")).first()["r"] == 15.2
    df2 = spark.createDataFrame([(True,) * 9], ",".join(f"f{i} boolean" for i in range(9)))
    hb = df2.select(S.hasbled(*[f"f{i}" for i in range(9)]).alias("s")).first()["s"]
    assert hb == 9
    assert spark.range(1).select(S.hasbled_annual_bleeding_risk(F.lit(7)).alias("r")).first()["r"] == 12.5


@pytest.mark.parametrize("code,cond", [("I21.9", "myocardial_infarction"), ("I25.2", "myocardial_infarction"),
                                       ("I50.9", "congestive_heart_failure"), ("J44.9", "chronic_pulmonary_disease"),
                                       ("E11.9", "diabetes_without_complications"),
                                       ("E11.2", "diabetes_with_complications"), ("K70.3", "mild_liver_disease"),
                                       ("K70.4", "moderate_severe_liver_disease"), ("C78.0", "metastatic_solid_tumor"),
                                       ("C34.1", "malignancy"), ("A41.9", None), ("b20", "hiv_aids")])
def test_charlson_condition(spark, code, cond):
    assert one(spark, S.charlson_condition("c"), c=code) == cond


def test_sla_status(spark):
    assert one(spark, S.sla_status(F.lit(240), 240, 360)) == "COMPLIANT"
    assert one(spark, S.sla_status(F.lit(361), 240, 360)) == "BREACH"
    assert one(spark, S.sla_status(F.lit(96.0), 99, 95, higher_is_better=True)) == "WARNING"


def test_every_organ_and_flag_reaches_the_scores(spark):
    """Stays and patients made so that each input alone changes its score."""
    from pyspark.sql import functions as F

    from hospiq.plans import risk as R
    who = "hospital_id string, encounter_id string"
    enc = spark.createDataFrame([("H", "E1", "P1", "Emergency", None), ("H", "E2", "P2", "Inpatient", "I10")],
                                f"{who}, patient_id string, encounter_type string, primary_diagnosis_code string")
    pat = spark.createDataFrame([("H", "P1", 80, "F"), ("H", "P2", None, None)], "hospital_id string, patient_id string, age_years int, gender string")
    vit = spark.createDataFrame([("H", "E1", "P1", 104.0, 60, 150, 40, 70, 80, 10, True), ("H", "E1", "P1", None, None, None, None, 170, None, None, True)],
                                f"{who}, patient_id string, temperature_f double, map_mmhg int, heart_rate_bpm int, respiratory_rate int, "
                                "systolic_bp int, oxygen_saturation_pct int, pain_score int, is_hypertensive boolean")
    labs = {"Sodium": 185.0, "Potassium": 7.5, "Creatinine": 6.0, "Hemoglobin": 5.0, "Platelets": 10.0, "Bilirubin": 13.0, "WBC": 45.0, "Arterial pH": 7.8}
    res = spark.createDataFrame([("H", "E1", t, v, "LAB", False) for t, v in labs.items()] + [("H", "E2", "Creatinine", 9.0, "LAB", True)],
                                f"{who}, test_name string, result_value_numeric double, result_type string, is_preliminary boolean")
    flags = [f"has_{n}" for n, *_ in S.CHARLSON]
    com = spark.createDataFrame([("H", "P1", 80), ("H", "P2", None)], "hospital_id string, patient_id string, age_years int")
    for f in flags:
        com = com.withColumn(f, F.lit(f in ("has_renal_disease",)) & (F.col("patient_id") == "P1"))
    got = {r.encounter_id: r for r in R.encounter_severity(enc, pat, vit, res, com).collect()}
    pf = (80 / 0.6 - 64) / 0.84                                   # saturation 80 %: FiO2 0.6
    assert 0 <= pf < 100 and got["E1"].sofa_score == 4 + 4 + 4 + 1 + 3 + 4      # gcs 15 - 2 * 4 = 7
    oxygen = 3                                                    # 713 * 0.6 - pf * 0.6 is 378
    assert got["E1"].apache_ii_score == 3 + 2 + 3 + 3 + oxygen + 4 + 4 + 4 + 4 + 4 + 4 + 8 + 6 + 5
    assert got["E1"].news2_score == 3 + 3 + 2 + 2 + 3 + 3 + 3 and got["E1"].mews_score == 3 + 2 + 3 + 2 + 3
    assert (got["E2"].apache_ii_score, got["E2"].sofa_score, got["E2"].news2_score) == (0, 0, 0)   # nothing released, nothing scored
    med = spark.createDataFrame([("H", "P1", "Aspirin", True, False, False, False, True), ("H", "P1", "warfarin", True, False, False, False, False),
                                 ("H", "P1", "Warfarin", False, True, False, False, False)],
                                "hospital_id string, patient_id string, medication_name string, is_given boolean, is_missed boolean, "
                                "is_held boolean, is_refused boolean, adverse_reaction_flag boolean")
    prob = spark.createDataFrame([("H", "P1", "F10.2", True), ("H", "P2", "K70.3", False)],
                                 "hospital_id string, patient_id string, diagnosis_code string, is_active boolean")
    risk = {r.patient_id: r for r in R.stroke_and_bleeding_risk(pat, com, vit, med, prob, enc).collect()}
    assert risk["P1"].has_hypertension and risk["P1"].cha2ds2_vasc_score == 1 + 2 + 1
    assert risk["P1"].hasbled_score == 7                          # all but liver and stroke
    assert risk["P2"].has_hypertension and (risk["P2"].cha2ds2_vasc_score, risk["P2"].hasbled_score) == (1, 0)
