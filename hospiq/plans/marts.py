"""Marts (K-family): aggregate DataFrames at tenant x period grain.

Aggregations are plain ``groupBy().agg()`` (partial aggregation before the
shuffle, so a hot tenant is pre-reduced on every map task). Count-distinct
is used only for ids that repeat within a group (patients, providers);
ids unique per row are counted with ``count``/``count_if``. Marts with several
distinct counts or percentiles use ``grouped_summary``: no Expand, no buffer."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core as fn
from ..operators.quantiles import grouped_summary, percent_ranks


def _cnt_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _sum_if(cond, value=None) -> F.Column:
    v = F.lit(1) if value is None else value
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))


# K01 ----------------------------------------------------------------------
def clinical_quality_metrics(journey: DataFrame) -> DataFrame:
    c = F.col
    back, risk = c("is_30day_return"), c("patient_risk_category")
    zero = lambda cond, value=1: F.when(cond, value).otherwise(0)
    base = grouped_summary(
        journey.withColumn("metric_date", c("admission_date_day").cast("date")), ["hospital_id", "metric_date"],
        {"total_encounters": ("count", "encounter_id"),
         "inpatient_encounters": ("count", F.when(c("encounter_type") == "Inpatient", 1)),
         "emergency_encounters": ("count", F.when(c("encounter_type") == "Emergency", 1)),
         "readmissions_30day": ("sum", zero(back)),
         # corrected: a 30-day return that is not an inpatient readmission
         "returns_30day_non_readmit": ("sum", zero(back & ~c("is_readmission"))),
         "mortality_count": ("sum", zero(c("is_mortality"))),
         "_los": ("sum", "length_of_stay"), "_los_n": ("count", "length_of_stay"), "max_los": ("max", "length_of_stay"),
         "readmission_charges": ("sum", zero(back, c("total_charges"))),
         "ed_7day_returns": ("count", F.when(c("is_emergency") & c("is_7day_return"), 1))},
        {"unique_patients": ("patient_id", None), "high_risk_patients": ("patient_id", risk == "High Risk"),
         "medium_risk_patients": ("patient_id", risk == "Medium Risk"), "low_risk_patients": ("patient_id", risk == "Low Risk")},
        {"median_los": ("length_of_stay", 0.5)})
    base = base.withColumn("avg_los", c("_los").cast("double") / c("_los_n"))
    return base.select(
        "hospital_id", "metric_date", "total_encounters", "inpatient_encounters", "emergency_encounters",
        "unique_patients", "readmissions_30day", "returns_30day_non_readmit",
        c("inpatient_encounters").alias("inpatient_denominator"), "mortality_count",
        fn.r4("avg_los").alias("avg_length_of_stay"), fn.r4("median_los").alias("median_length_of_stay"),
        fn.r4("max_los").alias("max_length_of_stay"),
        "high_risk_patients", "medium_risk_patients", "low_risk_patients",
        fn.r2("readmission_charges").alias("readmission_charges"), "ed_7day_returns",
        fn.r4(fn.rate_or_zero("readmissions_30day", "inpatient_encounters")).alias("readmission_rate_30day_pct"),
        fn.r4(fn.rate_or_zero("mortality_count", "total_encounters")).alias("mortality_rate_pct"))


def _rate(num, den) -> F.Column:
    return fn.r4(fn.rate_or_zero(num, den))


def _band(x, bands, otherwise) -> F.Column:
    """Label from descending (min, label) bands."""
    c = F.col(x) if isinstance(x, str) else x
    out = None
    for t, lab in bands:
        out = F.when(c >= t, lab) if out is None else out.when(c >= t, lab)
    return out.otherwise(otherwise)


# K02 ----------------------------------------------------------------------
def early_warning_surveillance(vitals: DataFrame) -> DataFrame:
    c = F.col
    cat = c("news_risk_category")
    rows = vitals.filter(c("measurement_datetime").isNotNull()).withColumn(
        "metric_date", F.to_date(F.date_trunc("day", "measurement_datetime")))
    flags = {"febrile_measurements": "is_febrile", "hypothermic_measurements": "is_hypothermic",
             "tachycardic_measurements": "is_tachycardic", "bradycardic_measurements": "is_bradycardic",
             "tachypneic_measurements": "is_tachypneic", "hypotensive_measurements": "is_hypotensive",
             "hypertensive_measurements": "is_hypertensive", "hypoxic_measurements": "is_hypoxic", "sepsis_alerts": "sepsis_alert",
             "respiratory_alerts": "respiratory_distress_alert", "hypertensive_crisis_alerts": "hypertensive_crisis_alert",
             "rapid_deterioration_events": "rapid_deterioration_flag", "severe_pain_measurements": "has_severe_pain"}
    levels = {"high_risk_measurements": "High Risk", "medium_risk_measurements": "Medium Risk", "low_risk_measurements": "Low Risk",
              "normal_measurements": "Normal"}
    agg = grouped_summary(
        rows, ["hospital_id", "metric_date"],
        {"total_vital_measurements": ("count", "vital_id"),
         **{a: ("count", F.when(cat == k, 1)) for a, k in levels.items()}, **{a: ("count", F.when(c(f), 1)) for a, f in flags.items()},
         "_news": ("sum", "total_news_score"), "_news_n": ("count", "total_news_score"), "max_news_score": ("max", "total_news_score"),
         "_pain": ("sum", "pain_score"), "_pain_n": ("count", "pain_score")},
        {"unique_patients_monitored": ("patient_id", None), "encounters_monitored": ("encounter_id", None),
         "high_risk_patients": ("patient_id", cat == "High Risk"), "medium_risk_patients": ("patient_id", cat == "Medium Risk"),
         "patients_with_sepsis_alert": ("patient_id", c("sepsis_alert")),
         "patients_with_respiratory_alert": ("patient_id", c("respiratory_distress_alert")),
         "patients_with_rapid_deterioration": ("patient_id", c("rapid_deterioration_flag"))},
        {"median_news": ("total_news_score", 0.5), "p95_news": ("total_news_score", 0.95)})
    agg = (agg.withColumn("avg_news", c("_news").cast("double") / c("_news_n")).withColumn("avg_pain", c("_pain").cast("double") / c("_pain_n"))
           .drop("_news", "_news_n", "_pain", "_pain_n"))
    tot = "total_vital_measurements"
    r = (agg.withColumn("avg_measurements_per_encounter", c(tot) * 1.0 / c("encounters_monitored"))
         .withColumn("high_risk_rate_pct", _rate("high_risk_measurements", tot))
         .withColumn("elevated_risk_rate_pct", _rate(c("high_risk_measurements") + c("medium_risk_measurements"), tot))
         .withColumn("sepsis_alert_rate_pct", _rate("sepsis_alerts", tot))
         .withColumn("respiratory_alert_rate_pct", _rate("respiratory_alerts", tot))
         .withColumn("rapid_deterioration_rate_pct", _rate("rapid_deterioration_events", tot))
         .withColumn("hypotension_rate_pct", _rate("hypotensive_measurements", tot))
         .withColumn("hypoxia_rate_pct", _rate("hypoxic_measurements", tot))
         .withColumn("tachycardia_rate_pct", _rate("tachycardic_measurements", tot)))
    raw_rate = lambda n: fn.rate_or_zero(n, tot)
    score = F.greatest(F.lit(0.0), 100 - raw_rate("high_risk_measurements") * 5 - raw_rate("sepsis_alerts") * 10
                       - raw_rate("rapid_deterioration_events") * 8)
    return (r.withColumn("alert_volume_status", _band("high_risk_patients", [(5, "High Alert Volume"),
                                                                              (2, "Moderate Alert Volume")],
                                                      "Normal Alert Volume"))
            .withColumn("population_risk_status", _band("avg_news", [(5, "High Average Risk"),
                                                                      (3, "Moderate Average Risk")], "Low Average Risk"))
            .withColumn("sepsis_surveillance_status", _band("sepsis_alerts", [(3, "High Sepsis Alert Day"),
                                                                               (1, "Sepsis Alerts Present")],
                                                            "No Sepsis Alerts"))
            .withColumn("monitoring_frequency_status", _band("avg_measurements_per_encounter",
                                                             [(3, "Adequate Monitoring"), (2, "Marginal Monitoring")],
                                                             "Insufficient Monitoring"))
            .withColumn("surveillance_quality_score", fn.r4(score))
            .withColumn("avg_news_score", fn.r4("avg_news"))
            .withColumn("median_news_score", fn.r4("median_news"))
            .withColumn("p95_news_score", fn.r4("p95_news"))
            .withColumn("avg_pain_score", fn.r4("avg_pain"))
            .withColumn("avg_measurements_per_encounter", fn.r4("avg_measurements_per_encounter"))
            .drop("avg_news", "median_news", "p95_news", "avg_pain"))


# K03 ----------------------------------------------------------------------
def laboratory_quality_metrics(labs: DataFrame) -> DataFrame:
    c = F.col
    panel = c("lab_panel_category")
    tat = c("turnaround_time_hours")
    stat_tat = F.when(c("order_completion_hours") <= 1, tat)
    rows = labs.filter(c("result_datetime").isNotNull()).withColumn("metric_date", F.to_date(F.date_trunc("day", "result_datetime")))
    oor = F.when(c("is_abnormal"), c("out_of_range_value"))
    counts = {
        "cbc_count": panel == "Complete Blood Count", "bmp_count": panel == "Basic Metabolic Panel",
        "cmp_count": panel == "Comprehensive Metabolic Panel", "lft_count": panel == "Liver Function Panel",
        "lipid_count": panel == "Lipid Panel", "cardiac_marker_count": panel == "Cardiac Marker", "coag_count": panel == "Coagulation Panel",
        "final_results": c("is_final"), "preliminary_results": c("is_preliminary"), "abnormal_results": c("is_abnormal"),
        "high_results": c("is_high"), "low_results": c("is_low"), "critical_values": c("is_critical_value"),
        "results_within_2hrs": tat <= 2, "results_within_4hrs": tat <= 4, "results_within_24hrs": tat <= 24,
        "repeat_tests": c("result_sequence") > 1, "increasing_trends": c("trend_direction") == "Increasing",
        "decreasing_trends": c("trend_direction") == "Decreasing"}
    agg = grouped_summary(
        rows, ["hospital_id", "metric_date"],
        {"total_lab_results": ("count", "result_id"), **{a: ("count", F.when(x, 1)) for a, x in counts.items()},
         "_tat": ("sum", tat), "_tat_n": ("count", tat), "max_turnaround_hours": ("max", tat),
         "_stat": ("sum", stat_tat), "_stat_n": ("count", stat_tat), "_oor": ("sum", oor), "_oor_n": ("count", oor), "max_oor": ("max", oor)},
        {"unique_patients_tested": ("patient_id", None), "encounters_with_labs": ("encounter_id", None),
         "unique_tests_performed": ("test_code", None), "patients_with_critical_values": ("patient_id", c("is_critical_value"))},
        {"median_tat": ("turnaround_time_hours", 0.5), "p95_tat": ("turnaround_time_hours", 0.95),
         "median_stat_turnaround_hours": (stat_tat, 0.5)})
    for name, part in (("avg_tat", "_tat"), ("avg_stat_tat", "_stat"), ("avg_oor", "_oor")):
        agg = agg.withColumn(name, c(part).cast("double") / c(f"{part}_n")).drop(part, f"{part}_n")
    tot = "total_lab_results"
    w4 = fn.rate_or_zero("results_within_4hrs", tot)
    med_stat = c("median_stat_turnaround_hours")
    final_pct = c("final_results") * 100.0 / F.nullif(c(tot), F.lit(0))
    rep = fn.rate_or_zero("repeat_tests", tot)
    score = (F.when(w4 >= 90, 40).when(w4 >= 75, 30).when(w4 >= 50, 20).otherwise(w4 * 0.4)
             + F.when(med_stat <= 1, 30).when(med_stat <= 2, 20).otherwise(10)
             + F.when(final_pct >= 95, 20).when(final_pct >= 85, 15).otherwise(10)
             + F.when(rep <= 10, 10).when(rep <= 20, 7).otherwise(5))
    med = c("median_tat")
    return (agg.select(
        "*",
        _rate("abnormal_results", tot).alias("abnormal_rate_pct"),
        _rate("critical_values", tot).alias("critical_value_rate_pct"),
        _rate("results_within_2hrs", tot).alias("within_2hr_rate_pct"),
        _rate("results_within_4hrs", tot).alias("within_4hr_rate_pct"),
        _rate("results_within_24hrs", tot).alias("within_24hr_rate_pct"),
        _rate("cbc_count", tot).alias("cbc_pct"),
        _rate("cardiac_marker_count", tot).alias("cardiac_marker_pct"),
        _rate("repeat_tests", tot).alias("repeat_test_rate_pct"),
        F.when(med <= 4, "Excellent").when(med <= 8, "Good").when(med <= 12, "Fair")
        .otherwise("Needs Improvement").alias("turnaround_performance"),
        F.when(med_stat <= 1, "Meets STAT Target").when(med_stat <= 2, "Marginal STAT Performance")
        .otherwise("Below STAT Target").alias("stat_performance_status"),
        _band("critical_values", [(5, "High Critical Volume"), (2, "Moderate Critical Volume"),
                                  (1, "Low Critical Volume")], "No Critical Values").alias("critical_value_status"),
        fn.r4(score).alias("lab_quality_score"),
        fn.r4("avg_tat").alias("avg_turnaround_hours"), fn.r4("median_tat").alias("median_turnaround_hours"),
        fn.r4("p95_tat").alias("p95_turnaround_hours"), fn.r4("avg_stat_tat").alias("avg_stat_turnaround_hours"),
        fn.r4("avg_oor").alias("avg_out_of_range_value"), fn.r4("max_oor").alias("max_out_of_range_value"))
        .drop("avg_tat", "median_tat", "p95_tat", "avg_stat_tat", "avg_oor", "max_oor")
        .withColumn("median_stat_turnaround_hours", fn.r4("median_stat_turnaround_hours")))


# K11 ----------------------------------------------------------------------
def financial_performance(rc: DataFrame) -> DataFrame:
    c = F.col
    pt = c("payer_type")
    def late(flag):
        return F.when(c(flag), c("charge_amount")).otherwise(0)
    sums = {"tc": "charge_amount", "tp": "payment_amount", "ta": "adjustment_amount", "tcol": "collected_amount", "td": "denied_amount",
            "a30": late("is_over_30_days"), "a60": late("is_over_60_days"), "a90": late("is_over_90_days"), "tpv": "payment_variance",
            "_dar": "days_in_ar"}
    counts = {"denial_count": F.when(c("is_denied"), 1), "n": F.lit(1), "government_payer_count": F.when(pt == "Government", 1),
              "commercial_payer_count": F.when(pt == "Commercial", 1), "self_pay_count": F.when(pt == "Self-Pay", 1),
              "paid_count": F.when(c("is_paid"), 1), "pending_count": F.when(c("is_pending"), 1),
              "total_transactions": "transaction_id", "_nc": "charge_amount", "_np": "payment_amount", "_ndar": "days_in_ar",
              "_npv": "payment_variance"}
    rows = rc.withColumn("metric_date", F.to_date(F.date_trunc("day", "transaction_date")))
    agg = grouped_summary(rows, ["hospital_id", "metric_date"],
                          {**{k: ("sum", v) for k, v in sums.items()}, **{k: ("count", v) for k, v in counts.items()}},
                          {"encounters_billed": ("encounter_id", None)}, {"mdar": ("days_in_ar", 0.5)})
    for name, total, n in (("ac", "tc", "_nc"), ("ap", "tp", "_np"), ("adar", "_dar", "_ndar"), ("apv", "tpv", "_npv")):
        agg = agg.withColumn(name, c(total).cast("double") / c(n))
    return agg.select(
        "hospital_id", "metric_date", "total_transactions", "encounters_billed",
        fn.r2("tc").alias("total_charges"), fn.r2("tp").alias("total_payments"),
        fn.r2("ta").alias("total_adjustments"), fn.r2("tcol").alias("total_collections"),
        fn.r2("td").alias("total_denials"), fn.r4("ac").alias("avg_charge_per_transaction"),
        fn.r4("ap").alias("avg_payment_per_transaction"),
        fn.r4(F.when(c("tc") > 0, c("tcol").cast("double") * 100.0 / c("tc").cast("double")).otherwise(0.0))
        .alias("net_collection_rate_pct"),
        "denial_count", _rate("denial_count", "n").alias("denial_rate_pct"),
        fn.r4("adar").alias("avg_days_in_ar"), fn.r4("mdar").alias("median_days_in_ar"),
        fn.r2("a30").alias("ar_over_30_days"), fn.r2("a60").alias("ar_over_60_days"),
        fn.r2("a90").alias("ar_over_90_days"),
        "government_payer_count", "commercial_payer_count", "self_pay_count", "paid_count", "pending_count",
        fn.r2("tpv").alias("total_payment_variance"), fn.r4("apv").alias("avg_payment_variance"))


# K04 ----------------------------------------------------------------------
def medication_safety_metrics(ms: DataFrame) -> DataFrame:
    c = F.col
    given = c("is_given")
    agg = (ms.filter(c("administered_datetime").isNotNull())
           .groupBy("hospital_id", F.to_date(F.date_trunc("day", "administered_datetime")).alias("metric_date"))
           .agg(F.count("admin_id").alias("total_administrations"),
                F.countDistinct("patient_id").alias("unique_patients_medicated"),
                F.countDistinct("medication_name").alias("unique_medications_used"),
                F.countDistinct("encounter_id").alias("encounters_with_medications"),
                *[_cnt_if(c(f)).alias(a) for f, a in [
                    ("is_given", "medications_given"), ("is_refused", "medications_refused"),
                    ("is_held", "medications_held"), ("is_missed", "medications_missed"),
                    ("is_verified", "verified_administrations"), ("is_witnessed", "witnessed_administrations")]],
                _cnt_if(given & c("barcode_scanned")).alias("barcode_scanned_administrations"),
                _cnt_if(c("is_late_administration")).alias("late_administrations"),
                fn.mean(F.when(given, c("administration_delay_minutes"))).alias("avg_delay"),
                F.max(F.when(given, c("administration_delay_minutes"))).alias("max_delay_minutes"),
                _cnt_if(c("is_high_risk_medication")).alias("high_risk_medication_count"),
                _cnt_if(c("is_high_risk_medication") & c("is_verified")).alias("high_risk_verified_count"),
                _cnt_if(c("given_despite_allergy")).alias("allergy_violations"),
                _cnt_if(c("given_without_verification")).alias("verification_violations"),
                _cnt_if(c("iv_given_without_witness")).alias("iv_witness_violations"),
                _cnt_if(c("has_adverse_reaction")).alias("adverse_reactions"),
                F.countDistinct(F.when(c("has_adverse_reaction"), c("patient_id"))).alias("patients_with_adverse_reactions"),
                _cnt_if(c("route") == "IV").alias("iv_administrations"),
                _cnt_if(c("route") == "PO").alias("po_administrations"),
                _cnt_if(c("route") == "IM").alias("im_administrations")))
    tot, gv = "total_administrations", "medications_given"
    ver = fn.rate_or_zero("verified_administrations", tot)
    wit = fn.rate_or_zero("witnessed_administrations", "iv_administrations")
    bar = fn.rate_or_zero("barcode_scanned_administrations", gv)
    late = fn.rate_or_zero("late_administrations", gv)
    score = (F.when(ver >= 95, 25).otherwise(ver * 0.25) + F.when(wit >= 98, 25).otherwise(wit * 0.25)
             + F.when(bar >= 90, 25).otherwise(bar * 0.25)
             + F.when(late <= 5, 25).otherwise(F.greatest(F.lit(0.0), 25 - late * 2)))
    return agg.select(
        *[x for x in agg.columns if x != "avg_delay"],
        fn.r4("avg_delay").alias("avg_delay_minutes"),
        fn.r4(ver).alias("verification_rate_pct"), fn.r4(wit).alias("iv_witness_rate_pct"),
        fn.r4(bar).alias("barcode_scan_rate_pct"), fn.r4(late).alias("late_administration_rate_pct"),
        _rate(c("allergy_violations") + c("verification_violations") + c("iv_witness_violations"), tot)
        .alias("total_violation_rate_pct"),
        _rate("adverse_reactions", gv).alias("adverse_reaction_rate_pct"),
        _rate("medications_refused", tot).alias("refusal_rate_pct"),
        _rate("medications_held", tot).alias("hold_rate_pct"),
        _rate("high_risk_verified_count", "high_risk_medication_count").alias("high_risk_verification_rate_pct"),
        F.when(ver >= 95, "Meets Target").otherwise("Below Target").alias("verification_compliance_status"),
        F.when(wit >= 98, "Meets Target").otherwise("Below Target").alias("witness_compliance_status"),
        F.when(bar >= 90, "Meets Target").otherwise("Below Target").alias("barcode_compliance_status"),
        F.when(late <= 5, "Meets Target").otherwise("Above Target").alias("timing_compliance_status"),
        F.when(c("allergy_violations") == 0, "No Violations").otherwise("Has Violations").alias("allergy_safety_status"),
        fn.r4(score).alias("medication_safety_score"))


# K06 ----------------------------------------------------------------------
# Fixed values: (measure code, name, target %) and the minimum denominator.
CMS_MEASURES = {"SEP-1": ("Sepsis Bundle", 50.0), "AMI-2": ("AMI: Aspirin at Arrival", 95.0),
                "READM-30": ("30-Day All-Cause Readmission", 15.0)}
CMS_MIN_DENOMINATOR = 25
ANTIBIOTIC_PATTERNS = ["%antibiotic%", "%ceftriaxone%", "%vancomycin%"]


def cms_core_measures(enc: DataFrame, vitals: DataFrame, orders: DataFrame,
                      min_denominator: int = CMS_MIN_DENOMINATOR) -> DataFrame:
    """Correlated EXISTS x5 rewritten as one per-encounter pre-aggregation of
    orders (bool_or flags) and one of vitals, each left-joined once. A cohort
    under ``min_denominator`` keeps its row with a status of its own."""
    from .intermediate import _like_any
    c = F.col
    med, lab = c("order_type") == "MEDICATION", c("order_type") == "LAB"
    day = c("encounter_day_of_order")
    o = (orders.groupBy("encounter_id").agg(
        F.bool_or(med & _like_any(F.lower(c("medication_name")), ANTIBIOTIC_PATTERNS) & (day == 0)
                  & (c("completion_time_hours") <= 3)).alias("early_antibiotics_met"),
        F.bool_or(lab & F.lower(c("order_description")).like("%lactate%") & (day == 0)).alias("lactate_measured"),
        F.bool_or(lab & F.lower(c("order_description")).like("%blood culture%") & (day == 0))
        .alias("blood_cultures_obtained"),
        F.bool_or(med & F.lower(c("medication_name")).like("%aspirin%") & (day <= 1)).alias("aspirin_received")))
    v = vitals.groupBy("encounter_id").agg(F.bool_or(c("sepsis_alert")).alias("any_sepsis_alert"))
    e = (enc.select("hospital_id", "encounter_id", "admission_date", "encounter_type", "primary_diagnosis_code",
                    "is_readmission")
         .withColumn("reporting_quarter", F.to_date(F.date_trunc("quarter", "admission_date"))))
    acute = c("encounter_type").isin("Emergency", "Inpatient")
    sepsis = acute & ((c("any_sepsis_alert") == True) | c("primary_diagnosis_code").like("A41%"))  # noqa: E712
    ami = acute & c("primary_diagnosis_code").like("I21%")
    bundle = c("early_antibiotics_met") & c("lactate_measured") & c("blood_cultures_obtained")
    # one aggregate for all measures, then a row for each of them
    agg = (e.join(o, "encounter_id", "left").join(v, "encounter_id", "left")
           .groupBy("hospital_id", "reporting_quarter").agg(
               F.count_if(acute).alias("acute"),
               _cnt_if(sepsis).alias("sep_den"), _cnt_if(sepsis & bundle).alias("sep_num"),
               _cnt_if(ami).alias("ami_den"), _cnt_if(ami & c("aspirin_received")).alias("ami_num"),
               _cnt_if(c("encounter_type") == "Inpatient").alias("inp_den"), _cnt_if(c("is_readmission")).alias("inp_num"),
               fn.readmission_rate("is_readmission", "encounter_type").alias("inp_rate")))

    def measure(code, den, num, rate, reported):
        name, target = CMS_MEASURES[code]
        return F.struct(F.lit(code).alias("measure_code"), F.lit(name).alias("measure_name"), c(den).alias("denominator"),
                        c(num).alias("numerator"), rate.cast("double").alias("performance_rate_pct"),
                        F.lit(target).alias("cms_target_pct"), reported.alias("reported"))
    allm = agg.select("hospital_id", "reporting_quarter", F.inline(F.array(
        measure("SEP-1", "sep_den", "sep_num", fn.rate_or_zero("sep_num", "sep_den"), c("acute") > 0),
        measure("AMI-2", "ami_den", "ami_num", fn.rate_or_zero("ami_num", "ami_den"), c("acute") > 0),
        measure("READM-30", "inp_den", "inp_num", c("inp_rate"), F.lit(True))))).filter((c("denominator") > 0) & c("reported"))
    p, t = c("performance_rate_pct"), c("cms_target_pct")
    is_readm = c("measure_code") == "READM-30"
    return (allm
            .select("hospital_id", "reporting_quarter", "measure_code", "measure_name", "denominator", "numerator",
                    fn.r4(p).alias("performance_rate_pct"), "cms_target_pct",
                    F.when(c("denominator") < min_denominator, "Below Minimum Denominator")
                    .when(is_readm, F.when(p <= t, "Meets Target").when(p <= t * 1.1, "Near Target")
                          .otherwise("Below Target"))
                    .otherwise(F.when(p >= t, "Meets Target").when(p >= t * 0.9, "Near Target")
                               .otherwise("Below Target")).alias("performance_status"),
                    fn.r4(F.when(is_readm, t - p).otherwise(p - t)).alias("gap_to_target_pct")))


# K07 ----------------------------------------------------------------------
def quality_measure_performance(results: DataFrame, comorbidity: DataFrame) -> DataFrame:
    c = F.col
    cm = comorbidity.select("hospital_id", "patient_id", "charlson_index")
    j = results.join(cm, ["patient_id", "hospital_id"], "left")
    elig, perf = c("is_measure_eligible"), c("is_performance_met")
    agg = (j.groupBy("hospital_id", "measure_code", "reporting_year", "reporting_quarter")
           .agg(F.min("measure_name").alias("measure_name"), F.min("measure_category").alias("measure_category"),
                F.count(F.lit(1)).alias("total_cases"),
                _cnt_if(c("denominator_eligible")).alias("denominator_cases"),
                _cnt_if(c("exclusion_applied")).alias("excluded_cases"),
                _cnt_if(elig).alias("eligible_cases"),
                _cnt_if(perf).alias("numerator_cases"),
                _cnt_if(elig & ~perf).alias("care_gap_cases"),
                F.percentile("time_to_treatment_minutes", 0.5).alias("med_ttt"),
                F.percentile("time_to_treatment_minutes", 0.9).alias("p90_ttt"),
                F.min("target_minutes").alias("target_minutes"),
                _cnt_if(c("met_time_target")).alias("_met"),
                _cnt_if(c("met_time_target").isNotNull()).alias("_timed"),
                _cnt_if(c("is_mortality")).alias("_dead"),
                fn.mean("charlson_index").alias("_charlson")))
    perf_pct = fn.round_half_up(fn.safe_divide(c("numerator_cases") * 100.0, c("eligible_cases")), 2)
    return agg.select(
        fn.tenant_surrogate_key("measure_code", "reporting_quarter").alias("quality_measure_performance_key"),
        "hospital_id", "measure_code", "measure_name", "measure_category", "reporting_year", "reporting_quarter",
        "total_cases", "denominator_cases", "excluded_cases", "eligible_cases", "numerator_cases", "care_gap_cases",
        perf_pct.alias("performance_rate_pct"),
        fn.r4("med_ttt").alias("median_time_to_treatment_minutes"),
        fn.r4("p90_ttt").alias("p90_time_to_treatment_minutes"), "target_minutes",
        fn.round_half_up(fn.safe_divide(c("_met") * 100.0, c("_timed")), 2).alias("met_time_target_pct"),
        fn.round_half_up(fn.safe_divide(c("_dead") * 100.0, c("total_cases")), 2).alias("cohort_mortality_rate_pct"),
        fn.round_half_up("_charlson", 2).alias("avg_charlson_index"),
        F.when(perf_pct.isNull(), "No eligible cases").when(perf_pct >= 90, "Meets target")
        .when(perf_pct >= 75, "Needs improvement").otherwise("Below target").alias("performance_status"))


# K05 ----------------------------------------------------------------------
def population_health(profiles: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Tenant snapshot over J07 (one row per patient, so patient counts are
    plain conditional counts)."""
    c = F.col
    h = hospitals.select("hospital_id", "hospital_name", "hospital_type", "region", "contract_tier")
    risk, util = c("clinical_risk_category"), c("utilization_category")
    agg = (profiles.drop("hospital_name", "hospital_type", "region").join(h, "hospital_id")
           .groupBy("hospital_id", "hospital_name", "hospital_type", "region", "contract_tier")
           .agg(F.count("patient_id").alias("total_population"),
                _cnt_if(c("age_group") == "Pediatric").alias("pediatric_patients"),
                _cnt_if(c("age_group") == "Adult").alias("adult_patients"),
                _cnt_if(c("age_group") == "Geriatric").alias("geriatric_patients"),
                fn.mean("age_years").alias("_age"),
                F.sum("chronic_condition_count").alias("total_chronic_conditions"),
                fn.mean("chronic_condition_count").alias("_chronic"),
                _cnt_if(c("chronic_condition_count") >= 3).alias("high_complexity_patients"),
                _cnt_if(c("chronic_condition_count") >= 1).alias("patients_with_chronic_disease"),
                _cnt_if(risk == "Very High Risk").alias("very_high_risk_patients"),
                _cnt_if(risk == "High Risk").alias("high_risk_patients"),
                _cnt_if(risk == "Medium Risk").alias("medium_risk_patients"),
                _cnt_if(risk == "Low Risk").alias("low_risk_patients"),
                _cnt_if(util == "Frequent ED User").alias("frequent_ed_users"),
                _cnt_if(util == "Frequent Admits").alias("frequent_admits"),
                _cnt_if(util == "High Utilizer").alias("high_utilizers"),
                F.sum("ed_visits").alias("total_ed_visits"),
                F.sum("readmissions").alias("total_readmissions"),
                _cnt_if(c("life_threatening_allergy_count") > 0).alias("patients_with_life_threatening_allergies"),
                _cnt_if(c("drug_allergy_count") > 0).alias("patients_with_drug_allergies"),
                F.sum("active_allergy_count").alias("total_active_allergies"),
                _cnt_if(c("active_coverage_count") == 0).alias("uninsured_patients"),
                _cnt_if(c("primary_plan_type") == "HMO").alias("hmo_patients"),
                _cnt_if(c("primary_plan_type") == "PPO").alias("ppo_patients"),
                fn.mean("primary_deductible_remaining").alias("_ded"),
                _cnt_if(c("latest_news_score") >= 7).alias("high_news_score_patients"),
                _cnt_if(c("febrile_rate") > 0.5).alias("frequently_febrile_patients"),
                fn.mean("avg_bmi").alias("_bmi"),
                _cnt_if(c("current_sdoh_risk_category").isin("High Risk", "Medium Risk")).alias("elevated_sdoh_risk"),
                _cnt_if(c("has_housing_risk")).alias("housing_insecurity"),
                _cnt_if(c("has_food_insecurity")).alias("food_insecurity"),
                _cnt_if(c("has_transportation_barriers")).alias("transportation_barriers"),
                fn.mean("current_sdoh_risk_count").alias("_sdoh"),
                fn.mean("patient_engagement_score").alias("_eng"),
                _cnt_if(c("medication_refusals_30days") > 0).alias("patients_with_med_refusals"),
                F.sum("adverse_reactions_30days").alias("total_adverse_reactions"),
                F.sum("lifetime_charges").alias("_charges"),
                fn.mean("lifetime_charges").alias("_avg_charges")))
    pop = "total_population"
    chronic_p = fn.rate_or_zero("patients_with_chronic_disease", pop)
    risk_p = fn.rate_or_zero(c("very_high_risk_patients") + c("high_risk_patients"), pop)
    ed_1000 = F.when(c(pop) > 0, c("total_ed_visits") * 1000.0 / c(pop)).otherwise(0.0)
    nonadh = fn.rate_or_zero("patients_with_med_refusals", pop)
    sdoh_p = fn.rate_or_zero("elevated_sdoh_risk", pop)
    score = (F.when(chronic_p <= 20, 25).when(chronic_p <= 30, 20).when(chronic_p <= 40, 15).otherwise(10)
             + F.when(risk_p <= 10, 25).when(risk_p <= 20, 20).when(risk_p <= 30, 15).otherwise(10)
             + F.when(ed_1000 <= 100, 20).when(ed_1000 <= 200, 15).when(ed_1000 <= 300, 10).otherwise(5)
             + F.when(nonadh <= 5, 15).when(nonadh <= 10, 10).otherwise(5)
             + F.when(sdoh_p <= 10, 15).when(sdoh_p <= 20, 10).otherwise(5))
    return agg.select(
        *[x for x in agg.columns if not x.startswith("_")],
        fn.r4("_age").alias("avg_patient_age"), fn.r4("_chronic").alias("avg_chronic_conditions_per_patient"),
        fn.r4("_ded").alias("avg_deductible_remaining"), fn.r4("_bmi").alias("population_avg_bmi"),
        fn.r4("_sdoh").alias("avg_sdoh_risk_factors"), fn.r4("_eng").alias("avg_engagement_score"),
        fn.r2("_charges").alias("total_lifetime_charges"), fn.r4("_avg_charges").alias("avg_lifetime_charges_per_patient"),
        fn.r4(chronic_p).alias("chronic_disease_prevalence_pct"), fn.r4(risk_p).alias("high_risk_prevalence_pct"),
        _rate("frequent_ed_users", pop).alias("frequent_ed_user_rate_pct"),
        _rate("uninsured_patients", pop).alias("uninsured_rate_pct"),
        fn.r4(sdoh_p).alias("sdoh_risk_prevalence_pct"), fn.r4(nonadh).alias("medication_non_adherence_rate_pct"),
        fn.r4(ed_1000).alias("ed_visits_per_1000"),
        fn.r4(F.when(c(pop) > 0, c("total_readmissions") * 1000.0 / c(pop)).otherwise(0.0)).alias("readmissions_per_1000"),
        (c("very_high_risk_patients") + c("high_risk_patients")).alias("care_management_candidates"),
        (c("frequent_ed_users") + c("frequent_admits")).alias("utilization_management_candidates"),
        c("elevated_sdoh_risk").alias("social_services_candidates"),
        c("patients_with_med_refusals").alias("adherence_support_candidates"),
        score.alias("population_health_score"),
        F.when((c("very_high_risk_patients") > 10) | (c("frequent_ed_users") > 5), "Critical Priority")
        .when((c("high_risk_patients") > 20) | (c("elevated_sdoh_risk") > 10), "High Priority")
        .when(c("medium_risk_patients") > 50, "Medium Priority").otherwise("Monitoring").alias("intervention_priority"))


# K08 ----------------------------------------------------------------------
PROVIDER_KEYS = ["hospital_id", "provider_id", "provider_full_name", "specialty", "department", "provider_type"]


def provider_summary(journey: DataFrame) -> DataFrame:
    """Volumes and rates, one row a provider: all of K08 but its ranks."""
    c = F.col
    keys = PROVIDER_KEYS
    inpatient, risky = c("encounter_type") == "Inpatient", c("patient_risk_category") == "High Risk"
    agg = grouped_summary(
        journey, keys,
        {"first_encounter_date": ("min", "admission_date"), "last_encounter_date": ("max", "admission_date"),
         "total_encounters": ("count", "encounter_id"), "inpatient_encounters": ("count", F.when(inpatient, 1)),
         "emergency_encounters": ("count", F.when(c("encounter_type") == "Emergency", 1)),
         "readmissions_30day": ("count", F.when(c("is_30day_return"), 1)), "mortality_count": ("count", F.when(c("is_mortality"), 1)),
         "_los": ("sum", "length_of_stay"), "_los_n": ("count", "length_of_stay"), "_charges": ("sum", "total_charges"),
         "_charges_n": ("count", "total_charges"), "critical_cases": ("count", F.when(c("severity_level") == "Critical", 1)),
         "high_severity_cases": ("count", F.when(c("severity_level") == "High", 1))},
        {"unique_patients": ("patient_id", None), "high_risk_patients": ("patient_id", risky)}, {"_mlos": ("length_of_stay", 0.5)})
    agg = (agg.withColumn("_alos", c("_los").cast("double") / c("_los_n"))
           .withColumn("_avg_charge", c("_charges").cast("double") / c("_charges_n")))
    days = fn.boundary_diff("day", "first_encounter_date", "last_encounter_date")
    return (agg.withColumn("days_active", days)
            .withColumn("readmission_rate_pct", fn.rate_or_zero("readmissions_30day", "inpatient_encounters"))
            .withColumn("mortality_rate_pct", fn.rate_or_zero("mortality_count", "total_encounters"))
            .withColumn("complex_case_rate_pct", fn.rate_or_zero(c("critical_cases") + c("high_severity_cases"),
                                                                 "total_encounters"))
            .withColumn("encounters_per_day", F.when(c("days_active") > 0, c("total_encounters") * 1.0 / c("days_active"))
                        .otherwise(F.lit(0.0))))


def provider_performance(summary: DataFrame) -> DataFrame:
    """K08 from the provider summary: percent ranks (E08) within tenant and
    specialty from counted values, so no task holds a group. The summary is
    read four times; the build writes it first."""
    c = F.col
    m = percent_ranks(summary, ["hospital_id", "specialty"],
                      {"_rr_rank": ("readmission_rate_pct", False), "_los_rank": ("_alos", False),
                       "_volume_rank": ("total_encounters", True)})
    rr, epd = c("readmission_rate_pct"), c("encounters_per_day")
    return m.select(
        *PROVIDER_KEYS, "first_encounter_date", "last_encounter_date", "days_active", "total_encounters", "unique_patients",
        "inpatient_encounters", "emergency_encounters", "readmissions_30day", "mortality_count",
        fn.r4("_alos").alias("avg_length_of_stay"), fn.r4("_mlos").alias("median_length_of_stay"),
        fn.r2("_charges").alias("total_charges"), fn.r4("_avg_charge").alias("avg_charge_per_encounter"),
        "critical_cases", "high_severity_cases", "high_risk_patients",
        fn.r4(rr).alias("readmission_rate_pct"), fn.r4("mortality_rate_pct").alias("mortality_rate_pct"),
        fn.r4("complex_case_rate_pct").alias("complex_case_rate_pct"), fn.r4(epd).alias("encounters_per_day"),
        fn.r4("_rr_rank").alias("readmission_rate_percentile"),
        fn.r4("_los_rank").alias("los_percentile"),
        fn.r4("_volume_rank").alias("volume_percentile"),
        F.when(rr < 5, "Excellent").when(rr < 10, "Good").when(rr < 15, "Needs Improvement").otherwise("Critical")
        .alias("readmission_performance"),
        F.when(epd >= 15, "High Volume").when(epd >= 10, "Medium Volume").otherwise("Low Volume")
        .alias("productivity_category"))


# K12 ----------------------------------------------------------------------
def prior_authorization_metrics(auths: DataFrame) -> DataFrame:
    c = F.col
    decided = ~c("is_pending")
    agg = auths.groupBy("hospital_id", "payer_id", "request_month").agg(
        F.min("payer_name").alias("payer_name"), F.min("payer_type").alias("payer_type"),
        F.count(F.lit(1)).alias("auth_requests"), _cnt_if(c("is_approved")).alias("auths_approved"),
        _cnt_if(c("is_denied")).alias("auths_denied"), _cnt_if(c("is_pending")).alias("auths_pending"),
        _cnt_if((c("auth_status") == "EXPIRED") | c("is_expired")).alias("auths_expired"),
        _cnt_if(c("expiring_soon") & ~c("is_expired")).alias("auths_expiring_within_30_days"),
        _cnt_if(decided).alias("_decided"),
        fn.mean("days_to_decision").alias("_avg_dec"), F.percentile("days_to_decision", 0.5).alias("_med_dec"),
        _cnt_if(c("days_to_decision") > 14).alias("decisions_over_14_days"),
        fn.mean("units_utilization_pct").alias("_util"),
        F.sum("charges_at_risk").alias("_risk"),
        _cnt_if(c("has_prior_auth_denial")).alias("encounters_with_prior_auth_claim_denial"),
        _sum_if(c("has_prior_auth_denial"), c("encounter_charges")).alias("_pa_charges"))
    return agg.select(
        fn.tenant_surrogate_key("payer_id", "request_month").alias("prior_auth_metric_key"),
        "hospital_id", "payer_id", "payer_name", "payer_type", "request_month", "auth_requests", "auths_approved",
        "auths_denied", "auths_pending", "auths_expired", "auths_expiring_within_30_days",
        fn.round_half_up(fn.safe_divide(c("auths_approved") * 100.0, c("_decided")), 2).alias("approval_rate_pct"),
        fn.round_half_up(fn.safe_divide(c("auths_denied") * 100.0, c("_decided")), 2).alias("denial_rate_pct"),
        fn.round_half_up("_avg_dec", 1).alias("avg_days_to_decision"),
        fn.round_half_up("_med_dec", 1).alias("median_days_to_decision"), "decisions_over_14_days",
        fn.round_half_up("_util", 1).alias("avg_units_utilization_pct"), fn.r2("_risk").alias("charges_at_risk"),
        "encounters_with_prior_auth_claim_denial", fn.r2("_pa_charges").alias("charges_on_prior_auth_claim_denials"))


# K14 ----------------------------------------------------------------------
def care_coordination_metrics(referrals: DataFrame, care_plans: DataFrame, comorbidity: DataFrame) -> DataFrame:
    """Referral months full-outer-joined with care-plan months on
    (tenant, month), keys coalesced."""
    c = F.col
    cm = comorbidity.select("hospital_id", "patient_id", "charlson_index")
    r = (referrals.join(cm, ["patient_id", "hospital_id"], "left")
         .groupBy("hospital_id", c("referral_month").alias("metric_month")).agg(
        F.count(F.lit(1)).alias("referrals_created"),
        _cnt_if(F.upper(c("urgency")).isin("URGENT", "EMERGENT")).alias("urgent_referrals"),
        _cnt_if(c("referral_type") == "SPECIALIST").alias("specialist_referrals"),
        _cnt_if(c("referral_type").isin("HOME_HEALTH", "SNF", "DME")).alias("post_acute_referrals"),
        _cnt_if(c("is_completed")).alias("referrals_completed"), _cnt_if(c("is_cancelled")).alias("referrals_cancelled"),
        _cnt_if(c("overdue_for_appointment")).alias("referrals_overdue_for_scheduling"),
        _cnt_if(c("follow_up_overdue")).alias("referrals_follow_up_overdue"),
        _cnt_if(c("is_closed_loop")).alias("_closed"), _cnt_if(c("scheduled_within_sla")).alias("_sla"),
        _cnt_if(c("scheduled_within_sla").isNotNull()).alias("_sla_den"),
        F.percentile("days_to_appointment", 0.5).alias("_med_appt"), fn.mean("charlson_index").alias("_ch")))
    r = r.select(
        "*",
        fn.round_half_up(fn.safe_divide(c("referrals_completed") * 100.0,
                                        c("referrals_created") - c("referrals_cancelled")), 2)
        .alias("referral_completion_rate_pct"),
        fn.round_half_up(fn.safe_divide(c("_closed") * 100.0, c("referrals_completed")), 2)
        .alias("referral_closed_loop_rate_pct"),
        fn.round_half_up(fn.safe_divide(c("_sla") * 100.0, c("_sla_den")), 2).alias("scheduled_within_sla_pct"),
        fn.round_half_up("_med_appt", 1).alias("median_days_to_appointment"),
        fn.round_half_up("_ch", 2).alias("avg_charlson_index_referred")).drop("_closed", "_sla", "_sla_den",
                                                                           "_med_appt", "_ch")
    cp = (care_plans.groupBy("hospital_id", F.to_date(F.date_trunc("month", "start_date")).alias("metric_month")).agg(
        F.count(F.lit(1)).alias("care_plans_started"), _cnt_if(c("is_active_plan")).alias("care_plans_active"),
        _cnt_if(c("is_completed_plan")).alias("care_plans_completed"),
        _cnt_if(c("is_discontinued_plan")).alias("care_plans_discontinued"),
        _cnt_if(c("overdue_for_evaluation")).alias("care_plans_overdue_for_evaluation"),
        _cnt_if(c("past_target_date")).alias("care_plans_past_target_date"),
        _cnt_if(c("is_completed_plan") | c("is_discontinued_plan")).alias("_closed_plans"),
        fn.mean(F.when(c("is_completed_plan"), c("plan_duration_days"))).alias("_dur"))
        .select("*", fn.round_half_up(fn.safe_divide(c("care_plans_completed") * 100.0, c("_closed_plans")), 2)
                .alias("care_plan_goal_completion_rate_pct"),
                fn.round_half_up("_dur", 1).alias("avg_completed_plan_duration_days"))
        .drop("_closed_plans", "_dur"))
    j = r.alias("r").join(cp.alias("cp"), ["hospital_id", "metric_month"], "full")
    z = lambda x: F.coalesce(c(x), F.lit(0))
    zero_cols = ["referrals_created", "urgent_referrals", "specialist_referrals", "post_acute_referrals",
                 "referrals_completed", "referrals_cancelled", "referrals_overdue_for_scheduling",
                 "referrals_follow_up_overdue", "care_plans_started", "care_plans_active", "care_plans_completed",
                 "care_plans_discontinued", "care_plans_overdue_for_evaluation", "care_plans_past_target_date"]
    out = j.select(
        fn.tenant_surrogate_key("metric_month").alias("care_coordination_key"), "hospital_id", "metric_month",
        *[z(x).alias(x) for x in zero_cols],
        "referral_completion_rate_pct", "referral_closed_loop_rate_pct", "scheduled_within_sla_pct",
        "median_days_to_appointment", "avg_charlson_index_referred", "care_plan_goal_completion_rate_pct",
        "avg_completed_plan_duration_days")
    return out


# K13 ----------------------------------------------------------------------
def census(enc: DataFrame, as_of: str, days: DataFrame) -> DataFrame:
    """C08 interval join without a date spine or patient-days: a stay adds one
    bed on its first day and gives it back after its last ([admission day,
    discharge), an open stay runs to as_of). The beds of a tenant on a day are
    the running sum of these changes; ``days`` (hospital_id, metric_date) are
    the days to report. Two rows a stay, and per tenant one row a day."""
    c = F.col
    d = c("discharge_date")
    last_day = (F.when(d.isNull(), F.lit(as_of).cast("date"))
                .when(d == F.date_trunc("day", d), F.date_sub(F.to_date(d), 1))
                .otherwise(F.to_date(d)))
    stays = (enc.filter(c("encounter_type") == "Inpatient")
             .select("hospital_id", "encounter_id", F.to_date("admission_date_day").alias("first_day"),
                     last_day.alias("last_day"))
             .filter(c("last_day") >= c("first_day")))
    from pyspark.sql import Window
    changes = stays.select("hospital_id", F.inline(F.array(
        F.struct(c("first_day").alias("metric_date"), F.lit(1).alias("change"), F.lit(False).alias("asked")),
        F.struct(F.date_add("last_day", 1).alias("metric_date"), F.lit(-1).alias("change"), F.lit(False).alias("asked")))))
    asked = days.select("hospital_id", "metric_date", F.lit(0).alias("change"), F.lit(True).alias("asked"))
    per_day = changes.unionByName(asked).groupBy("hospital_id", "metric_date").agg(
        F.sum("change").alias("change"), F.max("asked").alias("asked"))
    running = Window.partitionBy("hospital_id").orderBy("metric_date").rowsBetween(Window.unboundedPreceding, 0)
    return (per_day.withColumn("occupied_beds", F.sum("change").over(running)).filter("asked")
            .select("hospital_id", "metric_date", "occupied_beds"))


def operational_metrics(enc: DataFrame, facilities: DataFrame, as_of: str) -> DataFrame:
    c = F.col
    et, src, disp, dow = c("encounter_type"), c("admission_source"), c("discharge_disposition"), c("admission_day_of_week")
    counts = {
        "inpatient_admissions": et == "Inpatient", "emergency_visits": et == "Emergency", "outpatient_visits": et == "Outpatient",
        "observation_visits": et == "Observation", "admits_from_ed": src == "Emergency", "transfer_admissions": src == "Transfer",
        "elective_admissions": src == "Elective", "discharges_to_home": disp == "Home", "discharges_to_snf": disp == "SNF",
        "discharges_to_rehab": disp == "Rehab",
        # corrected: full day names (the warehouse's short names never matched)
        "monday_admissions": dow == "Monday", "friday_admissions": dow == "Friday",
        "weekend_admissions": dow.isin("Saturday", "Sunday"), "critical_cases": c("severity_level") == "Critical",
        "high_severity_cases": c("severity_level") == "High", "chronic_condition_encounters": c("is_chronic")}
    stay = F.when((et == "Inpatient") & (c("length_of_stay") > 0), c("length_of_stay")).otherwise(F.lit(0))
    m = grouped_summary(
        enc.withColumn("metric_date", F.to_date("admission_date_day")), ["hospital_id", "metric_date"],
        {**{a: ("count", F.when(x, 1)) for a, x in counts.items()}, "_pd": ("sum", stay)},
        {"active_facilities": ("facility_id", None),
         "ed_facilities_used": ("facility_id", c("facility_type") == "Emergency Department"),
         "icu_facilities_used": ("facility_id", c("facility_type") == "Intensive Care Unit"),
         "active_providers": ("provider_id", None), "ed_providers": ("provider_id", c("specialty") == "Emergency Medicine"),
         "medicine_providers": ("provider_id", c("specialty") == "Internal Medicine")})
    order = ["inpatient_admissions", "emergency_visits", "outpatient_visits", "observation_visits", "_pd", "active_facilities",
             "ed_facilities_used", "icu_facilities_used", "active_providers", "ed_providers", "medicine_providers"]
    m = m.select("hospital_id", "metric_date", *order, *[x for x in counts if x not in order])
    ft = c("facility_type")
    cap = facilities.groupBy("hospital_id").agg(
        _sum_if(ft.isin("Medical-Surgical Unit", "Intensive Care Unit"), c("bed_capacity")).alias("total_bed_capacity"),
        _sum_if(ft == "Intensive Care Unit", c("bed_capacity")).alias("icu_bed_capacity"),
        _sum_if(ft == "Medical-Surgical Unit", c("bed_capacity")).alias("medsurg_bed_capacity"))
    j = m.join(cap, "hospital_id", "left").join(census(enc, as_of, m), ["hospital_id", "metric_date"], "left")
    tot, occ = F.coalesce(c("total_bed_capacity"), F.lit(0)), F.coalesce(c("occupied_beds"), F.lit(0))
    return j.select(
        *[x for x in m.columns if x != "_pd"], fn.r2("_pd").alias("total_patient_days"),
        tot.cast("bigint").alias("total_bed_capacity"),
        F.coalesce(c("icu_bed_capacity"), F.lit(0)).cast("bigint").alias("icu_bed_capacity"),
        F.coalesce(c("medsurg_bed_capacity"), F.lit(0)).cast("bigint").alias("medsurg_bed_capacity"),
        occ.alias("occupied_beds"),
        fn.r4(F.when(tot > 0, occ * 100.0 / tot).otherwise(F.lit(0.0))).alias("bed_occupancy_rate_pct"))


# K09 / K10 (full builds; incremental maintenance lives in operators.state) --
FCT_ENCOUNTER_COLUMNS = [
    "encounter_id", "hospital_id", "patient_id", "provider_id", "facility_id", "primary_diagnosis_code",
    "hospital_name", "hospital_type", "region", "teaching_hospital", "age_years", "age_group", "gender", "race",
    "ethnicity", "provider_full_name", ("specialty", "provider_specialty"), ("department", "provider_department"),
    "provider_type", "facility_name", "facility_type", "diagnosis_description", "diagnosis_category",
    "severity_level", "encounter_type", "admission_source", "discharge_disposition", "admission_date",
    "discharge_date", "length_of_stay", "admission_date_day", "admission_date_month", "admission_date_quarter",
    "admission_date_year", "admission_day_of_week", "total_charges", "is_readmission", "is_mortality",
    "is_emergency", "is_transfer", "loaded_at_timestamp"]


def fct_encounters(enriched: DataFrame) -> DataFrame:
    def out(x):
        if isinstance(x, tuple):
            return F.col(x[0]).alias(x[1])
        if x.startswith("admission_date_") and x != "admission_date_day_of_week":
            return F.to_date(x).alias(x)   # calendar parts as DATE
        return F.col(x)
    return enriched.select(*[out(x) for x in FCT_ENCOUNTER_COLUMNS])


FCT_BILLING_COLUMNS = [
    "transaction_id", "hospital_id", "encounter_id", "patient_id", "payer_id", "payer_name", "payer_type",
    "expected_reimbursement_rate", "encounter_type", "discharge_date", "transaction_date", "days_in_ar",
    "charge_amount", "payment_amount", "adjustment_amount", "collected_amount", "denied_amount",
    "collection_rate_pct", "expected_payment", "payment_variance", "payment_status", "denial_reason", "is_denied",
    "is_paid", "is_pending", "is_over_30_days", "is_over_60_days", "is_over_90_days", "ar_aging_bucket"]


def fct_billing_transactions(rc: DataFrame) -> DataFrame:
    return rc.select(*FCT_BILLING_COLUMNS)


# K15 ----------------------------------------------------------------------
def sla_monitoring(encounters: DataFrame, patients: DataFrame, billing: DataFrame, fct_enc: DataFrame,
                   checked_at: str) -> DataFrame:
    """G03 union of per-table freshness rows (NULL-padded) + data quality over
    the encounter fact, combined with the I18 three-state statuses."""
    from ..functions.scores import sla_status
    c = F.col
    enc_f = encounters.groupBy("hospital_id").agg(
        F.max("loaded_at_timestamp").alias("last_load_timestamp"),
        F.max("source_updated_at_timestamp").alias("last_source_update_timestamp")).select(
        F.lit("encounters").alias("table_name"), "hospital_id", "last_load_timestamp", "last_source_update_timestamp",
        fn.boundary_diff("minute", "last_source_update_timestamp", "last_load_timestamp").alias("freshness_lag_minutes"))
    pat_f = patients.groupBy("hospital_id").agg(F.max("loaded_at_timestamp").alias("last_load_timestamp")).select(
        F.lit("patients").alias("table_name"), "hospital_id", "last_load_timestamp")
    bil_f = billing.groupBy("hospital_id").agg(F.max("loaded_at_timestamp").alias("last_load_timestamp")).select(
        F.lit("billing").alias("table_name"), "hospital_id", "last_load_timestamp")
    sf = enc_f.unionByName(pat_f, allowMissingColumns=True).unionByName(bil_f, allowMissingColumns=True)
    dq = (fct_enc.groupBy("hospital_id").agg(
        F.count("encounter_id").alias("total_encounters"), F.countDistinct("patient_id").alias("total_patients"),
        _sum_if(c("length_of_stay") < 0).cast("bigint").alias("invalid_los_count"),
        _sum_if(c("total_charges") < 0).cast("bigint").alias("invalid_charges_count"),
        _sum_if(c("discharge_date") < c("admission_date")).cast("bigint").alias("invalid_dates_count"))
        .withColumn("data_quality_score_pct",
                    F.when(c("total_encounters") > 0,
                           (c("total_encounters") - (c("invalid_los_count") + c("invalid_charges_count")
                                                     + c("invalid_dates_count"))) * 100.0 / c("total_encounters"))
                    .otherwise(F.lit(100.0))))
    fresh = F.max(F.when(c("table_name") == "encounters", c("freshness_lag_minutes")))
    s = (sf.groupBy("hospital_id").agg(
        fresh.alias("encounters_freshness_minutes"),
        F.max(F.when(c("table_name") == "patients", c("last_load_timestamp"))).alias("patients_last_load"),
        F.max(F.when(c("table_name") == "billing", c("last_load_timestamp"))).alias("billing_last_load"))
        .join(dq, "hospital_id", "left"))
    fs = sla_status("encounters_freshness_minutes", 240, 360)
    qs = sla_status("data_quality_score_pct", 99, 95, higher_is_better=True)
    return (s.withColumn("freshness_sla_status", fs).withColumn("quality_sla_status", qs)
            .withColumn("overall_sla_status",
                        F.when((c("freshness_sla_status") == "BREACH") | (c("quality_sla_status") == "BREACH"), "BREACH")
                        .when((c("freshness_sla_status") == "WARNING") | (c("quality_sla_status") == "WARNING"), "WARNING")
                        .otherwise("COMPLIANT"))
            .withColumn("data_quality_score_pct", fn.r4("data_quality_score_pct"))
            .select("hospital_id", "encounters_freshness_minutes", "patients_last_load", "billing_last_load",
                    "freshness_sla_status", "total_encounters", "total_patients", "data_quality_score_pct",
                    "quality_sla_status", "invalid_los_count", "invalid_charges_count", "invalid_dates_count",
                    "overall_sla_status", F.lit(checked_at).cast("timestamp_ntz").alias("check_timestamp")))


# ---------------------------------------------------------------------------
# Observability marts over platform logs
# ---------------------------------------------------------------------------
# Hospital filter patterns (case-insensitive, first group).
HOSPITAL_FILTER_PATTERNS = [r"""hospital_id\s*=\s*['"]([A-Z0-9_]+)['"]""",
                            r"""hospital_id\s*IN\s*\(['"]([A-Z0-9_]+)['"]"""]
CREDIT_PRICE_USD = 4


def hospital_from_query(text) -> F.Column:
    """First matching pattern's group 1, else 'UNATTRIBUTED'."""
    t = F.col(text) if isinstance(text, str) else text
    tries = [F.nullif(F.regexp_extract(t, "(?i)" + p, 1), F.lit("")) for p in HOSPITAL_FILTER_PATTERNS]
    # correction: tenant ids are folded to upper case, as the master lists them
    return F.upper(F.coalesce(*tries, F.lit("UNATTRIBUTED")))


# K16 ----------------------------------------------------------------------
def cost_attribution(history: DataFrame, metering: DataFrame, database: str, since: str | None = None) -> DataFrame:
    """Cost per tenant-day. Correction: metering is aggregated per day
    *before* the join (one row per day), so allocated shares sum to the day's
    warehouse cost; a day without metering allocates 0."""
    from pyspark.sql import Window
    c = F.col
    if since is not None:       # an incremental run's window; by default the whole log
        metering = metering.filter(c("start_time") >= F.lit(since).cast("timestamp_ntz"))
        history = history.filter(c("start_time") >= F.lit(since).cast("timestamp_ntz"))
    day_cost = (metering
                .groupBy(F.to_date(F.date_trunc("day", "start_time")).alias("metric_date"))
                .agg((F.sum("credits_used") * CREDIT_PRICE_USD).alias("day_cost_usd")))
    qa = (history.filter((c("database_name") == database) & (c("execution_status") == "SUCCESS"))
          .select("query_id", "start_time", hospital_from_query("query_text").alias("hospital_id"),
                  (c("total_elapsed_time").cast("decimal(20,3)") / 1000).alias("execution_time_seconds"),
                  "credits_used_cloud_services"))
    qc = (qa.groupBy("hospital_id", F.to_date(F.date_trunc("day", "start_time")).alias("metric_date"))
          .agg(F.count("query_id").alias("queries_executed"),
               F.sum("execution_time_seconds").alias("total_execution_time_seconds"),
               F.sum("credits_used_cloud_services").alias("cloud_services_credits")))
    day = Window.partitionBy("metric_date")
    alloc = (qc.join(day_cost, "metric_date", "left")
             .withColumn("total_warehouse_time_day", F.sum("total_execution_time_seconds").over(day))
             .withColumn("warehouse_cost_usd",
                         F.when(c("total_warehouse_time_day") > 0,
                                fn.round_half_up(c("total_execution_time_seconds").cast("double")
                                                 / c("total_warehouse_time_day").cast("double")
                                                 * F.coalesce(c("day_cost_usd"), F.lit(0)).cast("double"), 6))
                         .otherwise(F.lit(0.0)).cast("decimal(20,6)")))
    d = (alloc.withColumn("cloud_services_cost_usd", c("cloud_services_credits") * CREDIT_PRICE_USD)
         .withColumn("total_cost_usd", c("cloud_services_cost_usd") + c("warehouse_cost_usd"))
         .withColumn("total_credits_used", c("cloud_services_credits") + c("warehouse_cost_usd") / CREDIT_PRICE_USD))
    t = Window.partitionBy("hospital_id").orderBy("metric_date")
    w = (d.withColumn("cumulative_cost_usd", F.sum("total_cost_usd").over(t.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("cost_7days_ago", F.lag("total_cost_usd", 7).over(t)))
    return w.select(
        "hospital_id", "metric_date", "queries_executed", fn.r4("total_execution_time_seconds").alias("total_execution_time_seconds"),
        fn.r4("cloud_services_cost_usd").alias("cloud_services_cost_usd"), fn.r4("warehouse_cost_usd").alias("warehouse_cost_usd"),
        fn.r4("total_cost_usd").alias("total_cost_usd"), fn.r4("total_credits_used").alias("total_credits_used"),
        fn.r4("cumulative_cost_usd").alias("cumulative_cost_usd"), fn.r4("cost_7days_ago").alias("cost_7days_ago"),
        fn.r4(F.when(c("cost_7days_ago") > 0, (c("total_cost_usd") - c("cost_7days_ago")).cast("double") * 100.0
                     / c("cost_7days_ago").cast("double")).otherwise(F.lit(0.0))).alias("cost_change_pct_wow"))


# K17 ----------------------------------------------------------------------
# Tables holding PHI (schema, table, level).
PHI_TABLES = [("RAW_PHI", t, "HIGH") for t in (
    "RAW_PATIENTS", "RAW_ENCOUNTERS", "RAW_BILLING_TRANSACTIONS", "RAW_CLINICAL_ORDERS", "RAW_CLINICAL_RESULTS",
    "RAW_VITAL_SIGNS", "RAW_MEDICATION_ADMINISTRATION", "RAW_PATIENT_ALLERGIES", "RAW_PATIENT_COVERAGE",
    "RAW_SDOH_SCREENINGS")] + [("STAGING", t, "MEDIUM") for t in (
        "STG_HEALTHCARE__PATIENTS", "STG_HEALTHCARE__ENCOUNTERS", "STG_HEALTHCARE__PROVIDERS")]
AUTHORIZED_ROLES = ["ACCOUNTADMIN", "SYSADMIN", "HIPAA_AUDITOR", "DBT_DEV_ROLE", "DBT_PROD_ROLE", "DBT_CI_ROLE"]


def phi_access_log(history: DataFrame, since=None, database: str | None = None) -> DataFrame:
    """C11 text-contains join against the fixed PHI table list, evaluated per
    query row: one regular expression collects the listed names that the upper
    cased text contains (none is part of another), so the inner join +
    group-by-query of the warehouse becomes a map-only step (no join, no
    shuffle). Correction: the highest level is the highest by rank (HIGH over
    MEDIUM), not the greatest string."""
    c = F.col
    q = history.filter(c("execution_status") == "SUCCESS")
    if database is not None:
        q = q.filter(c("database_name") == database)
    if since is not None:
        q = q.filter(c("start_time") > since)
    listed = "(" + "|".join(t for _s, t, _lv in PHI_TABLES) + ")"
    q = q.withColumn("_phi", F.array_distinct(F.regexp_extract_all(F.upper(c("query_text")), F.lit(listed), F.lit(1))))
    high = F.array(*[F.lit(t) for _s, t, lv in PHI_TABLES if lv == "HIGH"])
    level = F.when(F.arrays_overlap(c("_phi"), high), "HIGH").otherwise("MEDIUM")
    role = c("role_name")
    rows_mod = c("rows_inserted") + c("rows_updated") + c("rows_deleted")
    return (q.filter(F.size("_phi") > 0).select(
        "query_id", c("start_time").alias("access_timestamp"), "user_name", "role_name", "session_id",
        "database_name", "schema_name", "warehouse_name", "query_text", "execution_status", "rows_produced",
        rows_mod.alias("rows_modified"), "bytes_scanned", "execution_time", "total_elapsed_time", "query_type",
        F.array_join(F.array_sort("_phi"), ", ").alias("phi_tables_accessed"),
        level.alias("highest_phi_level"),
        hospital_from_query("query_text").alias("hospital_id_filter"),
        F.when(c("query_type") == "SELECT", "READ").when(c("query_type").isin("INSERT", "UPDATE", "DELETE", "MERGE"), "WRITE")
        .when(c("query_type").isin("CREATE", "ALTER", "DROP"), "DDL").otherwise("OTHER").alias("access_type"),
        F.when(role.isin("ACCOUNTADMIN", "SYSADMIN"), "AUTHORIZED_ADMIN").when(role == "HIPAA_AUDITOR", "AUTHORIZED_AUDITOR")
        .when(role.like("HOSPITAL_%_PHI_ANALYST"), "AUTHORIZED_PHI_ANALYST")
        .when((role == "DBT_DEV_ROLE") & c("database_name").like("%_DEV"), "AUTHORIZED_DEV")
        .when((role == "DBT_PROD_ROLE") & c("database_name").like("%_PROD"), "AUTHORIZED_PROD")
        .otherwise("REVIEW_REQUIRED").alias("access_authorization_status"),
        F.coalesce((c("rows_produced") > 10000) | (rows_mod > 1000)
                   | (c("query_text").ilike("%select * from%") & (c("rows_produced") > 1000)), F.lit(False)).alias("is_bulk_access"),
        F.coalesce(~role.isin(*AUTHORIZED_ROLES) & ~role.like("HOSPITAL_%_PHI_ANALYST") & ~role.like("HOSPITAL_%_ANALYST"),
                   F.lit(False)).alias("is_unauthorized"),
        fn.boundary_diff("second", "start_time", "end_time").alias("access_duration_seconds"),
        (c("credits_used_cloud_services") * 4.0).alias("estimated_cost_usd")))


def hipaa_audit_trail(log: DataFrame, sample_chars: int | None = None) -> DataFrame:
    """``sample_chars``: keep only so many characters of the query text
    (by default all). The compliance notes are fixed values."""
    c = F.col
    st = c("access_authorization_status")
    return log.select(
        fn.surrogate_key("query_id").alias("audit_id"), "query_id", "access_timestamp", "user_name", "role_name",
        "session_id", "database_name", "schema_name", "warehouse_name",
        F.coalesce(c("hospital_id_filter"), F.lit("ALL_HOSPITALS")).alias("hospital_id"), "phi_tables_accessed",
        c("highest_phi_level").alias("phi_level"), "access_type", "access_authorization_status",
        c("rows_produced").alias("records_accessed"), c("rows_modified").alias("records_modified"), "bytes_scanned",
        "is_bulk_access", "is_unauthorized", c("execution_time").alias("execution_time_ms"),
        c("total_elapsed_time").alias("total_elapsed_time_ms"), "access_duration_seconds",
        fn.r4("estimated_cost_usd").alias("estimated_cost_usd"),
        (c("query_text") if sample_chars is None else F.substring("query_text", 1, sample_chars)).alias("query_text_sample"),
        # The published compliance notes.
        F.when(c("is_unauthorized"), "ALERT: Unauthorized PHI access detected")
        .when(c("is_bulk_access") & ~st.isin("AUTHORIZED_ADMIN", "AUTHORIZED_AUDITOR"), "WARNING: Bulk PHI access by non-admin role")
        .when((c("access_type") == "WRITE") & ~c("role_name").like("DBT_%"), "NOTICE: Direct PHI modification (non-ETL)")
        .when((c("highest_phi_level") == "HIGH") & (st == "REVIEW_REQUIRED"),
              "REVIEW: High-level PHI access requires authorization review")
        .otherwise("COMPLIANT: Standard authorized access").alias("compliance_note"))
