"""Clinical and business scores (I-family) as ``Column`` builders.

Each score is *data* (band tables below) plus one generic builder that
turns a band table into a CASE expression; scoring a DataFrame is a single
projection inside whole-stage codegen. A missing (NULL) input contributes 0
unless the score says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import col

# ---------------------------------------------------------------------------
# Band builders
#   at_least(x, [(t1, p1), (t2, p2), ...], below)   x >= t1 -> p1, x >= t2 -> p2 ... else below
#   at_most(x,  [(t1, p1), ...], above)             x <= t1 -> p1 ... else above
#   less_than(x, [(t1, p1), ...], above)            x <  t1 -> p1 ... else above
# NULL input -> ``null_points`` (0 by default).
# ---------------------------------------------------------------------------


def _chain(pairs, test, x: Column, tail, null_points) -> Column:
    out = F.when(x.isNull(), F.lit(null_points))
    for t, p in pairs:
        out = out.when(test(x, t), F.lit(p))
    return out.otherwise(F.lit(tail))


def at_least(x, bands, below, null_points=0) -> Column:
    return _chain(bands, lambda c, t: c >= t, col(x), below, null_points)


def at_most(x, bands, above, null_points=0) -> Column:
    return _chain(bands, lambda c, t: c <= t, col(x), above, null_points)


def less_than(x, bands, above, null_points=0) -> Column:
    return _chain(bands, lambda c, t: c < t, col(x), above, null_points)


def flag_points(flag, points: int = 1) -> Column:
    return F.when(F.coalesce(col(flag), F.lit(False)), F.lit(points)).otherwise(F.lit(0))


def total(*parts: Column) -> Column:
    return reduce(lambda a, b: a + b, parts)


def label(x, bands, otherwise) -> Column:
    """Category label from descending ``(min_value, label)`` bands."""
    c = col(x)
    out = None
    for t, lab in bands:
        out = F.when(c >= t, F.lit(lab)) if out is None else out.when(c >= t, F.lit(lab))
    return out.otherwise(F.lit(otherwise))


def lookup(x, table: dict, otherwise=None) -> Column:
    c = col(x)
    out = None
    for k, v in table.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(otherwise))


def f_to_c(temp_f) -> Column:
    return (col(temp_f) - 32) * 5 / 9


# ---------------------------------------------------------------------------
# Published score tables (APACHE II, SOFA, qSOFA, MEWS, NEWS2,
# CHA2DS2-VASc, HAS-BLED, Charlson) and the reference's category cut-offs.
# ---------------------------------------------------------------------------
APACHE_TEMP_C = ([(41, 4), (39, 3), (38.5, 1), (36, 0), (34, 1), (32, 2), (30, 3)], 4)
APACHE_MAP = ([(160, 4), (130, 3), (110, 2), (70, 0), (50, 2)], 4)
APACHE_HR = ([(180, 4), (140, 3), (110, 2), (70, 0), (55, 2), (40, 3)], 4)
APACHE_RR = ([(50, 4), (35, 3), (25, 1), (12, 0), (10, 1), (6, 2)], 4)
APACHE_AADO2 = ([(500, 4), (350, 3), (200, 2)], 0)          # FiO2 >= 0.5: A-a gradient 713*FiO2 - PaO2
APACHE_PAO2 = ([(70, 0), (61, 1), (55, 3)], 4)              # FiO2 < 0.5
APACHE_PH = ([(7.7, 4), (7.6, 3), (7.5, 1), (7.33, 0), (7.25, 2), (7.15, 3)], 4)
APACHE_NA = ([(180, 4), (160, 3), (155, 2), (150, 1), (130, 0), (120, 2), (111, 3)], 4)
APACHE_K = ([(7, 4), (6, 3), (5.5, 1), (3.5, 0), (3, 1), (2.5, 2)], 4)
APACHE_CREAT = ([(3.5, 4), (2, 3), (1.5, 2), (0.6, 0)], 2)
APACHE_HCT = ([(60, 4), (50, 2), (46, 1), (30, 0), (20, 2)], 4)
APACHE_WBC = ([(40, 4), (20, 2), (15, 1), (3, 0), (1, 2)], 4)
APACHE_AGE = ([(75, 6), (65, 5), (55, 3), (45, 2)], 0)
APACHE_CHRONIC_EMERGENCY, APACHE_CHRONIC_ELECTIVE = 5, 2
APACHE_MORTALITY = [(4, 4), (9, 8), (14, 15), (19, 25), (24, 40), (29, 55), (34, 73)]   # score <= t -> %
APACHE_MORTALITY_MAX = 85

SOFA_PF = ([(400, 0), (300, 1), (200, 2), (100, 3)], 4)
SOFA_PLATELETS = ([(150, 0), (100, 1), (50, 2), (20, 3)], 4)
SOFA_BILIRUBIN = ([(1.2, 0), (2.0, 1), (6.0, 2), (12.0, 3)], 4)     # value < t -> points
SOFA_CREATININE = ([(1.2, 0), (2.0, 1), (3.5, 2), (5.0, 3)], 4)     # value < t -> points
SOFA_URINE = ([(500, 0), (200, 3)], 4)
SOFA_GCS = [(15, 15, 0), (13, 14, 1), (10, 12, 2), (6, 9, 3)]        # (low, high, points); < 6 -> 4

MEWS_SBP = ([(200, 2), (101, 0), (81, 1), (71, 2)], 3)
MEWS_HR = ([(130, 2), (111, 1), (51, 0), (41, 1)], 2)
MEWS_RR = ([(30, 3), (21, 2), (15, 0), (9, 1)], 2)
MEWS_TEMP_C = ([(38.5, 2), (35, 0)], 2)
MEWS_AVPU = {"A": 0, "V": 1, "P": 2, "U": 3}
MEWS_CATEGORY = [(5, "Critical (Urgent medical review required)"), (3, "High (Increase monitoring frequency)"),
                 (1, "Medium (Continue monitoring)"), (0, "Low (Routine monitoring)")]

NEWS2_RR = ([(8, 3), (11, 1), (20, 0), (24, 2)], 3)         # value <= t -> points
NEWS2_SPO2 = ([(91, 3), (93, 2), (95, 1)], 0)
NEWS2_SUPPLEMENTAL_O2 = 2
NEWS2_TEMP_C = ([(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)], 2)
NEWS2_SBP = ([(90, 3), (100, 2), (110, 1), (219, 0)], 3)
NEWS2_HR = ([(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)], 3)
NEWS2_CONSCIOUSNESS = 3
NEWS2_LEVEL = [(7, "High"), (5, "Medium")]

# NEWS component columns of the vitals staging model (between-style bands)
NEWS_RR_COMPONENT = [(None, 8, 3), (9, 11, 1), (21, 24, 2), (25, None, 3)]
NEWS_SPO2_COMPONENT = [(None, 91, 3), (92, 93, 2), (94, 95, 1)]
NEWS_SBP_COMPONENT = [(None, 90, 3), (91, 100, 2), (101, 110, 1), (220, None, 3)]
NEWS_HR_COMPONENT = [(None, 40, 3), (41, 50, 1), (91, 110, 1), (111, 130, 2), (131, None, 3)]
NEWS_CATEGORY = [(7, "High Risk"), (5, "Medium Risk"), (3, "Low Risk")]

CHA2DS2_AGE = ([(75, 2), (65, 1)], 0)
CHA2DS2_CATEGORY = {0: "Low Risk (No anticoagulation)", 1: "Low-Moderate Risk (Consider anticoagulation)"}
CHA2DS2_HIGH = "High Risk (Anticoagulation recommended)"
CHA2DS2_ANNUAL_STROKE = {0: 0.0, 1: 1.3, 2: 2.2, 3: 3.2, 4: 4.0, 5: 6.7, 6: 9.8, 7: 9.6, 8: 6.7, 9: 15.2}

HASBLED_CATEGORY = [(5, "High Risk (≥5% annual bleeding risk)"), (3, "Moderate Risk (3-4% annual bleeding risk)"),
                    (0, "Low Risk (1-2% annual bleeding risk)")]
HASBLED_ANNUAL_BLEEDING = {0: 1.13, 1: 1.02, 2: 1.88, 3: 3.74, 4: 8.70}
HASBLED_ANNUAL_BLEEDING_5PLUS = 12.50


# ---------------------------------------------------------------------------
# I01 / I02 APACHE II
# ---------------------------------------------------------------------------
def apache_ii(age=None, temperature_c=None, map_mmhg=None, heart_rate=None, respiratory_rate=None,
              pao2=None, fio2=None, arterial_ph=None, serum_sodium=None, serum_potassium=None,
              serum_creatinine=None, hematocrit=None, wbc_count=None, gcs_score=None,
              has_chronic_disease=None, admission_type=None) -> Column:
    def opt(x, table):
        return F.lit(0) if x is None else at_least(x, *table)

    if pao2 is not None and fio2 is not None:
        f, p = col(fio2), col(pao2)
        oxy = (F.when(f >= 0.5, at_least(713 * f - p, *APACHE_AADO2))
               .when(f < 0.5, at_least(p, *APACHE_PAO2)).otherwise(F.lit(0)))
    else:
        oxy = F.lit(0)
    if gcs_score is None:
        gcs = F.lit(0)
    else:
        g = col(gcs_score)
        gcs = F.when(g.between(3, 15), 15 - g).otherwise(F.lit(0))
    if has_chronic_disease is None:
        chronic = F.lit(0)
    else:
        adm = F.upper(col(admission_type)) if admission_type is not None else F.lit("ELECTIVE")
        chronic = (F.when(F.coalesce(col(has_chronic_disease), F.lit(False)),
                          F.when(adm.isin("EMERGENCY", "URGENT"), F.lit(APACHE_CHRONIC_EMERGENCY))
                          .otherwise(F.lit(APACHE_CHRONIC_ELECTIVE))).otherwise(F.lit(0)))
    return total(opt(temperature_c, APACHE_TEMP_C), opt(map_mmhg, APACHE_MAP), opt(heart_rate, APACHE_HR),
                 opt(respiratory_rate, APACHE_RR), oxy, opt(arterial_ph, APACHE_PH),
                 opt(serum_sodium, APACHE_NA), opt(serum_potassium, APACHE_K),
                 opt(serum_creatinine, APACHE_CREAT), opt(hematocrit, APACHE_HCT), opt(wbc_count, APACHE_WBC),
                 gcs, opt(age, APACHE_AGE), chronic)


def apache_ii_mortality(score) -> Column:
    s = col(score)
    out = F.when(s.isNull(), F.lit(None))
    for t, pct in APACHE_MORTALITY:
        out = out.when(s <= t, F.lit(pct))
    return out.otherwise(F.lit(APACHE_MORTALITY_MAX))


# ---------------------------------------------------------------------------
# I03 SOFA, I04 qSOFA
# ---------------------------------------------------------------------------
def sofa(pao2_fio2_ratio=None, platelets=None, bilirubin=None, map_mmhg=None, gcs_score=None,
         creatinine=None, urine_output_ml=None) -> Column:
    z = F.lit(0)
    resp = z if pao2_fio2_ratio is None else at_least(pao2_fio2_ratio, *SOFA_PF)
    coag = z if platelets is None else at_least(platelets, *SOFA_PLATELETS)
    liver = z if bilirubin is None else less_than(bilirubin, *SOFA_BILIRUBIN)
    cardio = z if map_mmhg is None else F.when(col(map_mmhg) < 70, F.lit(1)).otherwise(F.lit(0))
    if gcs_score is None:
        cns = z
    else:
        g = col(gcs_score)
        cns = F.when(g.isNull(), F.lit(0))
        for lo, hi, p in SOFA_GCS:
            cns = cns.when(g.between(lo, hi), F.lit(p))
        cns = cns.when(g < 6, F.lit(4)).otherwise(F.lit(0))
    if creatinine is not None:
        renal = less_than(creatinine, *SOFA_CREATININE)
    elif urine_output_ml is not None:
        renal = at_least(urine_output_ml, *SOFA_URINE)
    else:
        renal = z
    return total(resp, coag, liver, cardio, cns, renal)


def qsofa(respiratory_rate, systolic_bp, altered_mentation=None) -> Column:
    am = F.lit(0) if altered_mentation is None else flag_points(altered_mentation)
    return total(F.when(col(respiratory_rate) >= 22, 1).otherwise(0),
                 F.when(col(systolic_bp) <= 100, 1).otherwise(0), am)


# ---------------------------------------------------------------------------
# I05 MEWS
# ---------------------------------------------------------------------------
def mews(systolic_bp=None, heart_rate=None, respiratory_rate=None, temperature_c=None, avpu=None) -> Column:
    def opt(x, table):
        return F.lit(0) if x is None else at_least(x, *table)
    av = F.lit(0) if avpu is None else lookup(F.upper(col(avpu)), MEWS_AVPU, 0)
    return total(opt(systolic_bp, MEWS_SBP), opt(heart_rate, MEWS_HR), opt(respiratory_rate, MEWS_RR),
                 opt(temperature_c, MEWS_TEMP_C), av)


def mews_category(score) -> Column:
    s = col(score)
    return F.when(s.isNull(), "Unknown").otherwise(label(s, MEWS_CATEGORY, "Unknown"))


# ---------------------------------------------------------------------------
# I06 NEWS2, I07 NEWS partial
# ---------------------------------------------------------------------------
def news2(respiratory_rate=None, spo2=None, on_supplemental_oxygen=None, temperature_c=None,
          systolic_bp=None, heart_rate=None, consciousness_alert=None) -> Column:
    def opt(x, table):
        return F.lit(0) if x is None else at_most(x, *table)
    o2 = F.lit(0) if on_supplemental_oxygen is None else flag_points(on_supplemental_oxygen, NEWS2_SUPPLEMENTAL_O2)
    cons = (F.lit(0) if consciousness_alert is None else
            F.when(col(consciousness_alert) == F.lit(False), F.lit(NEWS2_CONSCIOUSNESS)).otherwise(F.lit(0)))
    return total(opt(respiratory_rate, NEWS2_RR), opt(spo2, NEWS2_SPO2), o2, opt(temperature_c, NEWS2_TEMP_C),
                 opt(systolic_bp, NEWS2_SBP), opt(heart_rate, NEWS2_HR), cons)


def news2_level(score) -> Column:
    s = col(score)
    return F.when(s.isNull(), "Unknown").otherwise(label(s, NEWS2_LEVEL, "Low"))


def ranged_points(x, bands) -> Column:
    """Points from inclusive ``(low, high, points)`` ranges (None = open end); else 0."""
    c = col(x)
    out = None
    for lo, hi, p in bands:
        if lo is None:
            cond = c <= hi
        elif hi is None:
            cond = c >= lo
        else:
            cond = c.between(lo, hi)
        out = F.when(cond, F.lit(p)) if out is None else out.when(cond, F.lit(p))
    return out.otherwise(F.lit(0))


def news_category(total_score) -> Column:
    return label(total_score, NEWS_CATEGORY, "Normal")


# ---------------------------------------------------------------------------
# I08 CHA2DS2-VASc, I09 HAS-BLED
# ---------------------------------------------------------------------------
def cha2ds2_vasc(age=None, gender=None, has_chf=None, has_hypertension=None, has_stroke_tia=None,
                 has_vascular_disease=None, has_diabetes=None) -> Column:
    def fl(x, p=1):
        return F.lit(0) if x is None else flag_points(x, p)
    a = F.lit(0) if age is None else at_least(age, *CHA2DS2_AGE)
    g = F.lit(0) if gender is None else F.when(F.upper(col(gender)) == "F", 1).otherwise(0)
    return total(fl(has_chf), fl(has_hypertension), a, fl(has_diabetes), fl(has_stroke_tia, 2),
                 fl(has_vascular_disease), g)


def cha2ds2_vasc_category(score) -> Column:
    s = col(score)
    return (F.when(s == 0, CHA2DS2_CATEGORY[0]).when(s == 1, CHA2DS2_CATEGORY[1])
            .when(s >= 2, CHA2DS2_HIGH).otherwise("Unknown"))


def cha2ds2_vasc_annual_stroke_risk(score) -> Column:
    return lookup(score, CHA2DS2_ANNUAL_STROKE, None)


def hasbled(*flags) -> Column:
    """Sum of the 9 HAS-BLED flags (hypertension, renal, liver, stroke,
    bleeding, labile INR, age > 65, antiplatelet, alcohol); NULL flag -> 0."""
    return total(*[flag_points(f) for f in flags]) if flags else F.lit(0)


def hasbled_category(score) -> Column:
    s = col(score)
    return F.when(s.isNull(), "Unknown").otherwise(label(s, HASBLED_CATEGORY, "Unknown"))


def hasbled_annual_bleeding_risk(score) -> Column:
    s = col(score)
    return F.when(s >= 5, F.lit(HASBLED_ANNUAL_BLEEDING_5PLUS)).otherwise(lookup(s, HASBLED_ANNUAL_BLEEDING, None))


# ---------------------------------------------------------------------------
# I10 / I11 Charlson comorbidity from ICD-10 (Quan coding), first match wins.
# Fixed values: (condition, weight, 3-char codes, 4-char codes, 3-char ranges)
# ---------------------------------------------------------------------------
CHARLSON = [
    ("myocardial_infarction", 1, ["I21", "I22"], ["I252"], []),
    ("congestive_heart_failure", 1, ["I43", "I50"],
     ["I099", "I110", "I130", "I132", "I255", "I420", "I425", "I426", "I427", "I428", "I429", "P290"], []),
    ("peripheral_vascular_disease", 1, ["I70", "I71"],
     ["I731", "I738", "I739", "I771", "I790", "I792", "K551", "K558", "K559", "Z958", "Z959"], []),
    ("cerebrovascular_disease", 1, ["G45", "G46", "I60", "I61", "I62", "I63", "I64", "I65", "I66", "I67", "I68", "I69"],
     ["H340"], []),
    ("dementia", 1, ["F00", "F01", "F02", "F03", "G30"], ["F051", "G311"], []),
    ("chronic_pulmonary_disease", 1, [], ["I278", "I279", "J684", "J701", "J703"], [("J40", "J47"), ("J60", "J67")]),
    ("rheumatic_disease", 1, ["M05", "M06", "M32", "M33", "M34"], ["M315", "M351", "M353", "M360"], []),
    ("peptic_ulcer_disease", 1, ["K25", "K26", "K27", "K28"], [], []),
    ("moderate_severe_liver_disease", 3, [],
     ["I850", "I859", "I864", "I982", "K704", "K711", "K721", "K729", "K765", "K766", "K767"], []),
    ("mild_liver_disease", 1, ["B18", "K73", "K74"],
     ["K700", "K701", "K702", "K703", "K709", "K713", "K714", "K715", "K717", "K760", "K762", "K763", "K764",
      "K768", "K769", "Z944"], []),
    ("diabetes_with_complications", 2, [],
     ["E102", "E103", "E104", "E105", "E107", "E112", "E113", "E114", "E115", "E117", "E122", "E123", "E124",
      "E125", "E127", "E132", "E133", "E134", "E135", "E137", "E142", "E143", "E144", "E145", "E147"], []),
    ("diabetes_without_complications", 1, ["E10", "E11", "E12", "E13", "E14"], [], []),
    ("hemiplegia_paraplegia", 2, ["G81", "G82"],
     ["G041", "G114", "G801", "G802", "G830", "G831", "G832", "G833", "G834", "G839"], []),
    ("renal_disease", 2, ["N18", "N19"],
     ["I120", "I131", "N032", "N033", "N034", "N035", "N036", "N037", "N052", "N053", "N054", "N055", "N056",
      "N057", "N250", "Z490", "Z491", "Z492", "Z940", "Z992"], []),
    ("metastatic_solid_tumor", 6, [], [], [("C77", "C80")]),
    ("malignancy", 2,
     ["C43", "C45", "C46", "C47", "C48", "C49", "C50", "C51", "C52", "C53", "C54", "C55", "C56", "C57", "C58",
      "C60", "C61", "C62", "C63", "C64", "C65", "C66", "C67", "C68", "C69", "C70", "C71", "C72", "C73", "C74",
      "C75", "C76", "C81", "C82", "C83", "C84", "C85", "C88", "C90", "C91", "C92", "C93", "C94", "C95", "C96",
      "C97"], [], [("C00", "C26"), ("C30", "C34"), ("C37", "C41")]),
    ("hiv_aids", 6, ["B20", "B21", "B22", "B24"], [], []),
]
CHARLSON_WEIGHT = {name: w for name, w, *_ in CHARLSON}
# severe form supersedes the mild form of the same disease
CHARLSON_SUPERSEDES = [("diabetes_with_complications", "diabetes_without_complications"),
                       ("moderate_severe_liver_disease", "mild_liver_disease"),
                       ("metastatic_solid_tumor", "malignancy")]


def normalize_icd10(icd10) -> Column:
    """Dots removed, upper-cased."""
    return F.upper(F.translate(col(icd10), ".", ""))


def _charlson_chain(icd10, normalized: bool, value) -> Column:
    """CASE over the CHARLSON table, first match wins; ``value(i, name)``
    gives the result of branch i."""
    code = col(icd10) if normalized else normalize_icd10(icd10)
    p3, p4 = F.substring(code, 1, 3), F.substring(code, 1, 4)
    out = None
    for i, (name, _w, three, four, ranges) in enumerate(CHARLSON):
        conds = []
        if three:
            conds.append(p3.isin(three))
        if four:
            conds.append(p4.isin(four))
        conds += [p3.between(lo, hi) for lo, hi in ranges]
        if name == "myocardial_infarction":
            conds.append(code.startswith("I252"))
        cond = reduce(lambda a, b: a | b, conds)
        out = F.when(cond, value(i, name)) if out is None else out.when(cond, value(i, name))
    return out


def charlson_condition(icd10, normalized: bool = False) -> Column:
    """First matching Charlson condition of an ICD-10 code (NULL if none).
    Pass ``normalized=True`` with a column already holding the normalized
    code, so the normalisation runs once per row instead of once per branch."""
    return _charlson_chain(icd10, normalized, lambda i, n: F.lit(n)).otherwise(F.lit(None))


def charlson_prefix_rows() -> list[tuple[int, str, int]]:
    """(prefix length, prefix, rule index) generated from CHARLSON: 3-char
    codes, 4-char codes and 3-char ranges expanded (letter + 2 digits).
    Earlier rules win, so a code keeps the lowest index it matches."""
    rows = []
    for i, (name, _w, three, four, ranges) in enumerate(CHARLSON):
        rows += [(3, x, i) for x in three]
        rows += [(4, x, i) for x in four]
        for lo, hi in ranges:
            letter, a, b = lo[0], int(lo[1:]), int(hi[1:])
            rows += [(3, f"{letter}{k:02d}", i) for k in range(a, b + 1)]
        if name == "myocardial_infarction":
            rows.append((4, "I252", i))
    best: dict[tuple[int, str], int] = {}
    for ln, px, i in rows:
        best[(ln, px)] = min(i, best.get((ln, px), i))
    return [(ln, px, i) for (ln, px), i in sorted(best.items())]


def charlson_weight(condition) -> Column:
    return lookup(condition, CHARLSON_WEIGHT, 0)


def charlson_age_points(age) -> Column:
    a = col(age)
    return F.when(a >= 80, 4).when(a >= 70, 3).when(a >= 60, 2).when(a >= 50, 1).otherwise(0)


# ---------------------------------------------------------------------------
# I18 SLA three-state status
# ---------------------------------------------------------------------------
def sla_status(value, compliant_max, warning_max, higher_is_better: bool = False) -> Column:
    v = col(value)
    if higher_is_better:
        return (F.when(v >= compliant_max, "COMPLIANT").when(v >= warning_max, "WARNING").otherwise("BREACH"))
    return F.when(v <= compliant_max, "COMPLIANT").when(v <= warning_max, "WARNING").otherwise("BREACH")
