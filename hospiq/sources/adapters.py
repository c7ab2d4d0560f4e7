"""Logical healthcare tables derived from the driver's TPC-H-like tables.

Every derivation is plain, deterministic column arithmetic on the driver
rows, so the work (and the output) grows with the scale factor:

* tenants      <- nation x region (25 tenants, bounded)
* patients     <- customer, providers <- supplier, facilities <- nation x 5 units
* encounters   <- orders x customer
* billing, clinical orders, lab results, medication administrations <- lineitem
* vitals, query history, warehouse metering <- events
* problems, allergies, coverage, SDOH <- customer; measures, care plans,
  referrals, prior authorizations <- encounters

Joins used here are equi-joins on the natural TPC-H keys (shuffle joins that
AQE may turn into broadcasts when a side turns out small at run time); the
only explicit broadcasts are of tables with a fixed bound (nations, the
1-row supplier count, code lists).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .driver import read_driver

# ---------------------------------------------------------------------------
# Fixed values of the adapter design (code lists cycled by key modulus).
# ---------------------------------------------------------------------------
ICD_CODES = ["A41.9", "I21.9", "I50.9", "E11.9", "J44.9", "N18.6", "C78.0", "K70.3"]
DRUGS = ["Aspirin", "Insulin", "Heparin", "Vancomycin", "Metoprolol", "Morphine", "Penicillin", "Warfarin"]
LAB_TESTS = ["Glucose", "Potassium", "Sodium", "Hemoglobin", "Creatinine", "Troponin", "Lactate", "Lipid Panel"]
FACILITY_TYPES = ["Emergency Department", "Medical-Surgical Unit", "Intensive Care Unit",
                  "Operating Room", "Outpatient Clinic"]
SPECIALTIES = ["Cardiology", "Internal Medicine", "Emergency Medicine", "General Surgery"]
DEPARTMENTS = ["Cardiology", "Medicine", "Emergency", "Surgery"]

# (code, description, category, severity_level, is_chronic)
DIAGNOSES = [
    ("A41.9", "Sepsis, unspecified organism", "Infectious", "Severe", False),
    ("I21.9", "Acute myocardial infarction, unspecified", "Cardiovascular", "Severe", False),
    ("I50.9", "Heart failure, unspecified", "Cardiovascular", "Moderate", True),
    ("E11.9", "Type 2 diabetes mellitus without complications", "Endocrine", "Moderate", True),
    ("J44.9", "Chronic obstructive pulmonary disease, unspecified", "Respiratory", "Moderate", True),
    ("N18.6", "End stage renal disease", "Renal", "Severe", True),
    ("C78.0", "Secondary malignant neoplasm of lung", "Oncology", "Severe", True),
    ("K70.3", "Alcoholic cirrhosis of liver", "Gastrointestinal", "Severe", True),
]
PAYER_TYPES = ["Government", "Commercial", "Self-Pay"]
N_PAYERS = 10
N_TENANTS = 25

STAR_AS_OF = "2001-08-05"      # default as-of date for star-derived tables (a few days after the last admission)
EVENT_AS_OF = "2024-01-31"     # default as-of date for event-derived tables
LOADED_AT = "2001-12-30 00:00:00"


def tenant_id(nation_col: str) -> F.Column:
    """HOSP_0007 style tenant id from a nation key expression."""
    return F.concat(F.lit("HOSP_"), F.lpad(F.expr(nation_col).cast("string"), 4, "0"))


def pick(values: list[str], key_expr: str) -> F.Column:
    """Element ``key % len(values)`` of a fixed list (element_at is 1-based)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.expr(f"({key_expr}) % {len(values)}") + 1).cast("int"))


def hours(expr: str) -> str:
    return f"make_dt_interval(0, cast({expr} as int), 0, 0)"


class HospitalSource:
    """Lazily derived raw tables over one driver scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return read_driver(self.spark, self.sf_dir, name)

    # ---------------- dimensions -----------------------------------------
    @cached_property
    def hospitals(self) -> DataFrame:
        n = self._t("nation").alias("n")
        r = self._t("region").alias("r")
        return (n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(
                    tenant_id("n_nationkey").alias("hospital_id"),
                    F.concat(F.col("n_name"), F.lit(" MEDICAL CENTER")).alias("hospital_name"),
                    pick(["Academic Medical Center", "Community Hospital", "Critical Access Hospital"],
                         "n_nationkey").alias("hospital_type"),
                    (F.col("n_nationkey") * 10 + 50).cast("bigint").alias("bed_count"),
                    F.col("n_name").alias("city"),
                    F.col("n_name").alias("state"),
                    F.col("r_name").alias("region"),
                    pick(["Epic", "Cerner", "Meditech"], "n_nationkey").alias("emr_system"),
                    pick(["Enterprise", "Professional", "Standard", "Basic"], "n_nationkey").alias("contract_tier"),
                    F.expr("timestamp_ntz'2019-01-01 00:00:00' + make_dt_interval(n_nationkey * 30, 0, 0, 0)")
                    .alias("contract_start_date"),
                    F.lit(True).alias("is_active"),
                    (F.col("n_nationkey") % 2 == 0).alias("teaching_hospital"),
                    F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
                    F.lit("hospitals.parquet").alias("_source_file"),
                ))

    @cached_property
    def patients(self) -> DataFrame:
        c = self._t("customer")
        return c.select(
            F.concat(F.lit("PAT_"), F.col("c_custkey").cast("string")).alias("patient_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("MRN"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("mrn"),
            F.md5(F.concat(F.lit("ssn"), F.col("c_custkey").cast("string"))).alias("ssn_hash"),
            F.concat(F.lit("First"), F.col("c_custkey").cast("string")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.expr("case when c_custkey % 97 = 0 then null "
                   "else date_add(date'1900-01-01', cast(c_custkey * 37 % 36500 as int)) end").alias("date_of_birth"),
            F.expr("case when c_custkey % 2 = 0 then 'F' else 'M' end").alias("gender"),
            pick(["White", "Black", "Asian", "Hispanic", "Other"], "c_custkey").alias("race"),
            F.expr("case when c_custkey % 4 = 0 then 'Hispanic' else 'Non-Hispanic' end").alias("ethnicity"),
            F.lpad((F.col("c_custkey") * 61 % 100000).cast("string"), 5, "0").alias("zip_code"),
            F.md5(F.concat(F.lit("tel"), F.col("c_custkey").cast("string"))).alias("phone_number_hash"),
            F.md5(F.concat(F.lit("mail"), F.col("c_custkey").cast("string"))).alias("email_hash"),
            F.expr("case when c_custkey % 10 = 0 then 'Spanish' else 'English' end").alias("primary_language"),
            pick(["Married", "Single", "Widowed"], "c_custkey").alias("marital_status"),
            F.lit(None).cast("timestamp_ntz").alias("first_encounter_date"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
            F.lit("patients.parquet").alias("_source_file"),
        )

    @cached_property
    def providers(self) -> DataFrame:
        s = self._t("supplier")
        return s.select(
            F.concat(F.lit("PRV_"), F.col("s_suppkey").cast("string")).alias("provider_id"),
            tenant_id(f"s_suppkey % {N_TENANTS}").alias("hospital_id"),
            F.lpad(F.col("s_suppkey").cast("string"), 10, "0").alias("npi"),
            F.lit("Pat").alias("provider_first_name"),
            F.col("s_name").alias("provider_last_name"),
            pick(SPECIALTIES, "s_suppkey div 25").alias("specialty"),
            pick(DEPARTMENTS, "s_suppkey div 25").alias("department"),
            F.expr("case when s_suppkey % 3 = 0 then 'NP' else 'MD' end").alias("provider_type"),
            F.expr("date_add(date'1990-01-01', cast(s_suppkey * 53 % 4000 as int))").alias("hire_date"),
            F.lit(True).alias("is_active"),
            (F.col("s_suppkey") % 5 != 0).alias("accepts_new_patients"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
            F.lit("providers.parquet").alias("_source_file"),
        )

    @cached_property
    def facilities(self) -> DataFrame:
        n = self._t("nation")
        types = F.array(*[F.lit(t) for t in FACILITY_TYPES])
        return (n.select("n_nationkey", "n_name", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
                .select(
                    F.concat(F.lit("FAC_"), F.col("n_nationkey").cast("string"), F.lit("_"),
                             F.col("k").cast("string")).alias("facility_id"),
                    tenant_id("n_nationkey").alias("hospital_id"),
                    F.concat(F.col("n_name"), F.lit(" "), F.element_at(types, F.col("k") + 1)).alias("facility_name"),
                    F.element_at(types, F.col("k") + 1).alias("facility_type"),
                    (F.col("n_nationkey") + F.col("k") * 5 + 10).cast("bigint").alias("bed_capacity"),
                    ((F.col("n_nationkey") * 5 + F.col("k")) % 25 != 24).alias("is_active"),
                    F.expr("timestamp_ntz'2000-01-01 00:00:00'").alias("opened_date"),
                    F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
                    F.lit("facilities.parquet").alias("_source_file"),
                ))

    @cached_property
    def diagnoses(self) -> DataFrame:
        schema = ("diagnosis_code string, diagnosis_description string, category string, "
                  "severity_level string, is_chronic boolean")
        return (self.spark.createDataFrame(DIAGNOSES, schema)
                .withColumn("_source_file", F.lit("diagnoses.csv"))
                .withColumn("_loaded_at", F.expr(f"timestamp_ntz'{LOADED_AT}'")))

    @cached_property
    def payers(self) -> DataFrame:
        rows = [(f"PAY_{i}", f"Payer {i}", PAYER_TYPES[i % 3], round(0.50 + 0.04 * i, 4), True)
                for i in range(N_PAYERS)]
        return (self.spark.createDataFrame(
            rows, "payer_id string, payer_name string, payer_type string, reimbursement_rate double, is_active boolean")
            .withColumn("reimbursement_rate", F.col("reimbursement_rate").cast("decimal(5,4)"))
            .withColumn("_source_file", F.lit("payers.csv"))
            .withColumn("_loaded_at", F.expr(f"timestamp_ntz'{LOADED_AT}'")))

    @cached_property
    def procedures(self) -> DataFrame:
        p = self._t("part")
        return p.select(
            F.concat(F.lit("PROC_"), F.col("p_partkey").cast("string")).alias("procedure_code"),
            F.col("p_name").alias("procedure_description"),
            F.col("p_type").alias("category"),
            (F.col("p_retailprice") * 0.8).cast("decimal(10,2)").alias("typical_charge_min"),
            (F.col("p_retailprice") * 1.2).cast("decimal(10,2)").alias("typical_charge_max"),
            F.lit("procedures.csv").alias("_source_file"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
        )

    # ---------------- encounters -----------------------------------------
    @cached_property
    def n_suppliers(self) -> int:
        return self._t("supplier").count()

    @cached_property
    def _order_base(self) -> DataFrame:
        """orders x customer with the encounter type and admission time (internal)."""
        o = self._t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                     "o_totalprice", "o_orderstatus")
        c = self._t("customer").select("c_custkey", "c_nationkey")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .withColumn("encounter_type", F.expr(
                    "case o_orderpriority when '1-URGENT' then 'Emergency' when '2-HIGH' then 'Inpatient' "
                    "when '3-MEDIUM' then 'Inpatient' when '4-NOT SPECIFIED' then 'Outpatient' "
                    "else 'Observation' end"))
                .withColumn("admission_date", F.expr(f"o_orderdate + {hours('o_orderkey % 24')}")))

    @cached_property
    def encounters(self) -> DataFrame:
        # Provider of tenant n is supplier n + 25*j, chosen by arithmetic on
        # the supplier count (a scalar from one count() of the scan - no join).
        b = self._order_base.withColumn("n_sup", F.lit(self.n_suppliers))
        prov_nation = f"case when o_orderkey % 50 = 7 then (c_nationkey + 1) % {N_TENANTS} else c_nationkey end"
        prov_count = f"case when n_sup > pn then (n_sup - 1 - pn) div {N_TENANTS} + 1 else 0 end"
        los = ("case encounter_type when 'Inpatient' then 1 + o_orderkey % 9 "
               "when 'Observation' then o_orderkey % 3 else 0 end")
        disch_hours = ("case when encounter_type in ('Emergency', 'Outpatient') then 2 + o_orderkey % 5 "
                       "else o_orderkey % 7 end")
        return (b
                .withColumn("pn", F.expr(prov_nation))
                .withColumn("pc", F.expr(prov_count))
                .withColumn("los_days", F.expr(los))
                .select(
                    F.concat(F.lit("ENC_"), F.col("o_orderkey").cast("string")).alias("encounter_id"),
                    tenant_id("c_nationkey").alias("hospital_id"),
                    F.concat(F.lit("PAT_"), F.col("o_custkey").cast("string")).alias("patient_id"),
                    F.expr(f"case when pc > 0 then concat('PRV_', cast(pn + {N_TENANTS} * (o_orderkey % pc) as string)) "
                           "end").alias("provider_id"),
                    F.expr("concat('FAC_', cast(c_nationkey as string), '_', cast(case encounter_type "
                           "when 'Emergency' then 0 when 'Inpatient' then (case when o_orderkey % 5 = 0 then 2 else 1 end) "
                           "when 'Observation' then 1 else 4 end as string))").alias("facility_id"),
                    F.col("admission_date"),
                    F.expr("case when encounter_type = 'Inpatient' and o_orderkey % 101 = 0 then null "
                           "when o_orderkey % 211 = 0 then admission_date - make_dt_interval(0, 1, 0, 0) "
                           f"else admission_date + make_dt_interval(cast(los_days as int), cast({disch_hours} as int), 0, 0) end")
                    .alias("discharge_date"),
                    F.col("los_days").cast("decimal(10,2)").alias("length_of_stay"),
                    F.col("encounter_type"),
                    pick(["Emergency", "Elective", "Transfer"], "o_orderkey").alias("admission_source"),
                    F.expr("case when o_orderkey % 20 = 0 then 'Deceased' "
                           "when o_orderkey % 4 = 1 then 'SNF' when o_orderkey % 4 = 2 then 'Rehab' "
                           "else 'Home' end").alias("discharge_disposition"),
                    pick(ICD_CODES, "o_orderkey").alias("primary_diagnosis_code"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("total_charges"),
                    F.lit(False).alias("is_readmission"),
                    F.expr("admission_date + make_dt_interval(1, 0, 0, 0)").alias("_loaded_at"),
                    F.lit("encounters.parquet").alias("_source_file"),
                    F.expr("admission_date + make_dt_interval(0, 23, 0, 0)").alias("_source_updated_at"),
                ))

    # ---------------- lineitem-derived facts -------------------------------
    @cached_property
    def _line_base(self) -> DataFrame:
        """lineitem x (orders x customer): one clinical/billing line per item.

        Shuffle join on the order key (the fact-to-fact join of the star)."""
        li = self._t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
                                        "l_shipdate")
        ob = self._order_base.select("o_orderkey", "o_custkey", "c_nationkey", "admission_date")
        return (li.join(ob, li.l_orderkey == ob.o_orderkey)
                .withColumn("q", F.col("l_quantity").cast("int"))
                .withColumn("line_key", F.concat_ws("_", *[F.col(c).cast("string") for c in
                                                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]))
                .withColumn("order_type", pick(["LAB", "MEDICATION", "RADIOLOGY", "PROCEDURE"], "l_linenumber"))
                .withColumn("order_datetime", F.expr(f"admission_date + {hours('3 * l_linenumber')}")))

    @cached_property
    def billing_transactions(self) -> DataFrame:
        b = self._line_base
        status = F.expr("case when l_returnflag = 'A' and l_linestatus = 'F' then 'Paid' "
                        "when l_returnflag = 'A' then 'Partial' when l_returnflag = 'R' then 'Denied' "
                        "else 'Pending' end")
        b = (b.withColumn("payment_status", status)
             .withColumn("ext_c", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
             .withColumn("disc_c", F.round(F.col("l_discount") * 100).cast("bigint")))
        return b.select(
            F.concat(F.lit("TXN_"), F.col("line_key")).alias("transaction_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("ENC_"), F.col("l_orderkey").cast("string")).alias("encounter_id"),
            F.concat(F.lit("PAT_"), F.col("o_custkey").cast("string")).alias("patient_id"),
            F.concat(F.lit("PAY_"), (F.col("l_partkey") % N_PAYERS).cast("string")).alias("payer_id"),
            F.col("l_shipdate").alias("transaction_date"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("charge_amount"),
            # money in integer cents with explicit half-up rounding (no float ties)
            F.expr("cast(case payment_status when 'Paid' then (ext_c * (100 - disc_c) + 50) div 100 "
                   "when 'Partial' then (ext_c * (100 - disc_c) + 100) div 200 else 0 end / 100.0 "
                   "as decimal(12,2))").alias("payment_amount"),
            F.expr("cast(case when payment_status in ('Paid', 'Partial') then (ext_c * disc_c + 50) div 100 "
                   "else 0 end / 100.0 as decimal(12,2))").alias("adjustment_amount"),
            F.expr("case when payment_status = 'Denied' then element_at(array('Prior authorization not obtained', "
                   "'Medical necessity not established', 'Duplicate claim'), cast(l_orderkey % 3 as int) + 1) end")
            .alias("denial_reason"),
            F.col("payment_status"),
            F.expr("l_shipdate + make_dt_interval(1, 0, 0, 0)").alias("_loaded_at"),
            F.lit("billing_transactions.parquet").alias("_source_file"),
        )

    @cached_property
    def clinical_orders(self) -> DataFrame:
        b = self._line_base.withColumn("order_status", F.expr(
            "case when (l_orderkey + l_linenumber) % 23 = 0 then 'CANCELLED' when l_linestatus = 'F' then 'COMPLETED' "
            "when l_returnflag = 'N' then 'ORDERED' else 'IN_PROGRESS' end"))
        is_lab = F.col("order_type") == "LAB"
        is_med = F.col("order_type") == "MEDICATION"
        return b.select(
            F.concat(F.lit("ORD_"), F.col("line_key")).alias("order_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("ENC_"), F.col("l_orderkey").cast("string")).alias("encounter_id"),
            F.concat(F.lit("PAT_"), F.col("o_custkey").cast("string")).alias("patient_id"),
            F.concat(F.lit("PRV_"), F.col("l_suppkey").cast("string")).alias("provider_id"),
            "order_type",
            F.concat(F.lit("OC"), F.col("l_partkey").cast("string")).alias("order_code"),
            F.when(is_lab, F.concat(pick(LAB_TESTS, "l_partkey"),
                                    F.when(F.col("l_partkey") % 3 == 0, F.lit(" + Blood Culture")).otherwise(F.lit(""))))
            .when(is_med, pick(DRUGS, "l_partkey"))
            .otherwise(F.concat(F.lit("Order "), F.col("l_partkey").cast("string"))).alias("order_description"),
            "order_status",
            "order_datetime",
            F.expr(f"order_datetime + {hours('l_partkey % 3')}").alias("scheduled_datetime"),
            F.expr(f"case when order_status = 'COMPLETED' then order_datetime + {hours('q % 6 + 12 * (l_partkey % 5)')} end")
            .alias("completed_datetime"),
            F.expr("case when l_suppkey % 5 = 0 then 'STAT' when l_suppkey % 5 = 1 then 'URGENT' else 'ROUTINE' end")
            .alias("priority"),
            F.concat(F.lit("PRV_"), F.col("l_suppkey").cast("string")).alias("ordering_provider_id"),
            F.lit("Main Campus").alias("performing_location"),
            F.when(is_med, pick(DRUGS, "l_partkey")).alias("medication_name"),
            F.when(is_med, F.concat((F.col("q") % 10 + 1).cast("string"), F.lit(" mg"))).alias("dose"),
            F.when(is_med, pick(["PO", "IV", "IM", "SC"], "l_partkey")).alias("route"),
            F.when(is_med, F.lit("Q8H")).alias("frequency"),
            F.when(is_med, (F.col("q") % 14).cast("bigint")).alias("duration_days"),
            F.when(is_lab, F.lit("Blood")).alias("specimen_type"),
            F.when(is_lab, F.expr(f"order_datetime + {hours('1')}")).alias("collection_datetime"),
            F.when(is_lab, F.concat(F.lit("RES_"), F.col("line_key"))).alias("result_id"),
            F.expr("order_datetime + make_dt_interval(1, 0, 0, 0)").alias("_loaded_at"),
            F.lit("clinical_orders.parquet").alias("_source_file"),
        )

    @cached_property
    def clinical_results(self) -> DataFrame:
        # Reference range (low, high, units) per test of LAB_TESTS.
        lows = [70.0, 3.5, 135.0, 12.0, 0.6, 0.0, 0.5, 0.0]
        highs = [100.0, 5.0, 145.0, 17.5, 1.3, 0.04, 2.2, 200.0]
        units = ["mg/dL", "mmol/L", "mmol/L", "g/dL", "mg/dL", "ng/mL", "mmol/L", "mg/dL"]
        lo_arr = F.array(*[F.lit(v) for v in lows])
        hi_arr = F.array(*[F.lit(v) for v in highs])
        b = (self._line_base.filter(F.col("order_type") == "LAB")
             .withColumn("ti", (F.col("l_partkey") % 8 + 1).cast("int"))
             .withColumn("lo", F.element_at(lo_arr, F.col("ti")))
             .withColumn("hi", F.element_at(hi_arr, F.col("ti")))
             .withColumn("val", F.round(F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("q") - 15) / 10.0, 4))
             .withColumn("collected", F.expr(f"order_datetime + {hours('1')}"))
             .withColumn("resulted", F.expr(f"collected + {hours('(q * 7) % 30 + 1')}")))
        return b.select(
            F.concat(F.lit("RES_"), F.col("line_key")).alias("result_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("ORD_"), F.col("line_key")).alias("order_id"),
            F.concat(F.lit("PAT_"), F.col("o_custkey").cast("string")).alias("patient_id"),
            F.concat(F.lit("ENC_"), F.col("l_orderkey").cast("string")).alias("encounter_id"),
            F.lit("LAB").alias("result_type"),
            F.concat(F.lit("T"), (F.col("ti") - 1).cast("string")).alias("test_code"),
            pick(LAB_TESTS, "l_partkey").alias("test_name"),
            F.concat(F.lit("T"), (F.col("ti") - 1).cast("string")).alias("component_code"),
            pick(LAB_TESTS, "l_partkey").alias("component_name"),
            F.col("val").cast("decimal(18,4)").cast("string").alias("result_value"),
            F.col("val").cast("decimal(18,4)").alias("result_value_numeric"),
            F.element_at(F.array(*[F.lit(u) for u in units]), F.col("ti")).alias("result_units"),
            F.col("lo").cast("decimal(18,4)").alias("reference_range_low"),
            F.col("hi").cast("decimal(18,4)").alias("reference_range_high"),
            F.expr("case when val > hi then 'H' when val < lo then 'L' else 'N' end").alias("abnormal_flag"),
            F.col("resulted").alias("result_datetime"),
            F.col("collected").alias("collected_datetime"),
            F.col("resulted").alias("resulted_datetime"),
            F.expr("case when l_returnflag = 'N' then 'PRELIMINARY' when l_orderkey % 29 = 0 then 'CORRECTED' "
                   "else 'FINAL' end").alias("result_status"),
            F.lit("Main Lab").alias("performing_lab"),
            F.lit(None).cast("string").alias("interpreting_provider_id"),
            F.lit(None).cast("string").alias("imaging_modality"),
            F.lit(None).cast("string").alias("impression"),
            F.lit(None).cast("string").alias("report_text"),
            F.expr(f"resulted + {hours('2')}").alias("_loaded_at"),
        )

    @cached_property
    def medication_administration(self) -> DataFrame:
        b = (self._line_base.filter(F.col("order_type") == "MEDICATION")
             .withColumn("status", F.expr("case l_suppkey % 20 when 0 then 'REFUSED' when 1 then 'HELD' "
                                          "when 2 then 'MISSED' else 'GIVEN' end"))
             .withColumn("scheduled", F.expr(f"order_datetime + {hours('2')}")))
        return b.select(
            F.concat(F.lit("ADM_"), F.col("line_key")).alias("admin_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("ENC_"), F.col("l_orderkey").cast("string")).alias("encounter_id"),
            F.concat(F.lit("PAT_"), F.col("o_custkey").cast("string")).alias("patient_id"),
            F.concat(F.lit("ORD_"), F.col("line_key")).alias("order_id"),
            pick(DRUGS, "l_partkey").alias("medication_name"),
            F.concat((F.col("q") % 10 + 1).cast("string"), F.lit(" mg")).alias("dose"),
            pick(["PO", "IV", "IM", "SC"], "l_partkey").alias("route"),
            F.col("scheduled").alias("scheduled_datetime"),
            F.expr("case when status = 'GIVEN' then scheduled + make_dt_interval(0, 0, q * 3, 0) end")
            .alias("administered_datetime"),
            F.concat(F.lit("PRV_"), F.col("l_suppkey").cast("string")).alias("administered_by_provider_id"),
            F.col("status").alias("administration_status"),
            F.expr("case when status = 'REFUSED' then 'Patient declined' end").alias("refusal_reason"),
            F.expr("case when status = 'HELD' then 'Clinical hold' end").alias("hold_reason"),
            (F.col("l_partkey") % 10 != 0).alias("barcode_scanned"),
            F.expr("case when l_partkey % 3 = 0 then null else concat('PRV_', cast(l_suppkey + 25 as string)) end")
            .alias("witnessed_by_provider_id"),
            (F.col("l_orderkey") % 37 == 0).alias("adverse_reaction_flag"),
            F.expr("case when l_orderkey % 37 = 0 then 'Rash' end").alias("reaction_description"),
            F.expr(f"scheduled + {hours('4')}").alias("_loaded_at"),
        )

    # ---------------- event-derived facts ----------------------------------
    @cached_property
    def _latest_order(self) -> DataFrame:
        """Latest order (encounter) per customer: partial/final aggregate on custkey."""
        ob = self._order_base
        return (ob.groupBy("o_custkey")
                .agg(F.max(F.struct("o_orderkey", "admission_date", "c_nationkey")).alias("m"))
                .select(F.col("o_custkey").alias("user_id"), F.col("m.o_orderkey").alias("last_orderkey"),
                        F.col("m.admission_date").alias("last_admission"), F.col("m.c_nationkey").alias("nation")))

    @cached_property
    def vital_signs(self) -> DataFrame:
        ev = self._t("events").select("event_id", "user_id")
        b = (ev.join(self._latest_order, "user_id")
             .withColumn("sbp", F.expr("80 + event_id * 11 % 150"))
             .withColumn("dbp", F.expr("50 + event_id * 5 % 50"))
             .withColumn("wt", F.expr("50 + user_id % 50"))
             .withColumn("ht", F.expr("150 + user_id % 40"))
             .withColumn("mt", F.expr("last_admission + make_dt_interval(0, cast(event_id % 72 as int), "
                                      "cast(event_id % 60 as int), 0)")))
        return b.select(
            F.concat(F.lit("VIT_"), F.col("event_id").cast("string")).alias("vital_id"),
            tenant_id("nation").alias("hospital_id"),
            F.concat(F.lit("ENC_"), F.col("last_orderkey").cast("string")).alias("encounter_id"),
            F.concat(F.lit("PAT_"), F.col("user_id").cast("string")).alias("patient_id"),
            F.col("mt").alias("measurement_datetime"),
            F.expr("94.0 + (event_id % 80) / 10.0").cast("decimal(5,2)").alias("temperature_f"),
            F.expr("35 + event_id * 7 % 110").cast("bigint").alias("heart_rate_bpm"),
            F.expr("6 + event_id * 3 % 24").cast("bigint").alias("respiratory_rate"),
            F.col("sbp").cast("bigint").alias("systolic_bp"),
            F.col("dbp").cast("bigint").alias("diastolic_bp"),
            F.expr("85 + event_id * 13 % 16").cast("bigint").alias("oxygen_saturation_pct"),
            F.col("wt").cast("decimal(6,2)").alias("weight_kg"),
            F.col("ht").cast("decimal(5,1)").alias("height_cm"),
            F.expr("round(wt / ((ht / 100.0) * (ht / 100.0)), 1)").cast("decimal(4,1)").alias("bmi"),
            F.expr("event_id % 11").cast("bigint").alias("pain_score"),
            F.expr("(sbp + 2 * dbp) div 3").cast("bigint").alias("map_mmhg"),
            pick(["SITTING", "STANDING", "SUPINE"], "event_id").alias("position"),
            pick(["RN", "MD", "MA"], "event_id div 3").alias("measured_by_role"),
            F.expr(f"mt + {hours('1')}").alias("_loaded_at"),
        )

    # ---------------- customer-derived clinical history --------------------
    def _per_customer(self, n: int, keep: str) -> DataFrame:
        """customer x k (k in 0..n-1) filtered by ``keep``; a generator, no join."""
        c = self._t("customer").select("c_custkey", "c_nationkey", "c_acctbal")
        return (c.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
                .filter(F.expr(keep))
                .withColumn("ck", F.concat_ws("_", F.col("c_custkey").cast("string"), F.col("k").cast("string"))))

    @cached_property
    def problem_list(self) -> DataFrame:
        b = (self._per_customer(3, "k <= c_custkey % 3")
             .withColumn("di", F.expr("(c_custkey + 3 * k) % 8"))
             .withColumn("status", F.expr("case (c_custkey + k) % 5 when 0 then 'RESOLVED' when 1 then 'INACTIVE' "
                                          "else 'ACTIVE' end"))
             .withColumn("onset", F.expr("date_add(date'1990-01-01', cast((c_custkey * 7 + k * 131) % 4000 as int))")))
        codes = F.array(*[F.lit(d[0]) for d in DIAGNOSES])
        descs = F.array(*[F.lit(d[1]) for d in DIAGNOSES])
        chronic = F.array(*[F.lit(d[4]) for d in DIAGNOSES])
        i = (F.col("di") + 1).cast("int")
        return b.select(
            F.concat(F.lit("PRB_"), F.col("ck")).alias("problem_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("PAT_"), F.col("c_custkey").cast("string")).alias("patient_id"),
            F.element_at(codes, i).alias("diagnosis_code"),
            F.element_at(descs, i).alias("diagnosis_description"),
            F.col("status").alias("problem_status"),
            F.col("onset").alias("onset_date"),
            F.expr("case when status = 'RESOLVED' then date_add(onset, 90) end").alias("resolution_date"),
            F.expr("date_add(date'2001-01-01', cast((c_custkey + k) % 300 as int))").alias("last_reviewed_date"),
            pick(["MILD", "MODERATE", "SEVERE"], "c_custkey + k").alias("severity"),
            F.element_at(chronic, i).alias("is_chronic"),
            (F.col("k") == 0).alias("is_primary_diagnosis"),
            F.lit(None).cast("string").alias("documented_by_provider_id"),
            F.col("onset").alias("documentation_date"),
            F.lit(None).cast("string").alias("clinical_notes"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
        )

    # Fixed values of the allergy design: (allergen, allergen_type)
    ALLERGENS = [("Penicillin", "DRUG"), ("Aspirin", "DRUG"), ("Sulfa", "DRUG"), ("Peanuts", "FOOD"),
                 ("Latex", "ENVIRONMENTAL"), ("Heparin Sodium", "DRUG"), ("Morphine", "DRUG"), ("Shellfish", "FOOD")]

    @cached_property
    def patient_allergies(self) -> DataFrame:
        b = (self._per_customer(2, "k < c_custkey % 3")
             .withColumn("ai", F.expr("case when k = 1 and c_custkey % 11 = 0 then c_custkey % 8 "
                                      "else (c_custkey + 5 * k) % 8 end + 1").cast("int"))
             .withColumn("status", F.expr("case when (c_custkey + k) % 7 = 0 then 'RESOLVED' else 'ACTIVE' end"))
             .withColumn("onset", F.expr("date_add(date'1985-01-01', cast((c_custkey * 11 + k * 97) % 5000 as int))")))
        names = F.array(*[F.lit(a) for a, _ in self.ALLERGENS])
        types = F.array(*[F.lit(t) for _, t in self.ALLERGENS])
        return b.select(
            F.concat(F.lit("ALG_"), F.col("ck")).alias("allergy_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("PAT_"), F.col("c_custkey").cast("string")).alias("patient_id"),
            F.element_at(types, F.col("ai")).alias("allergen_type"),
            F.concat(F.lit("AL"), F.col("ai").cast("string")).alias("allergen_code"),
            F.element_at(names, F.col("ai")).alias("allergen_name"),
            pick(["RASH", "ANAPHYLAXIS", "GI_UPSET"], "c_custkey + k").alias("reaction_type"),
            pick(["MILD", "MODERATE", "SEVERE", "LIFE_THREATENING"], "c_custkey * 3 + k").alias("severity"),
            F.col("status").alias("allergy_status"),
            F.col("onset").alias("onset_date"),
            F.expr("case when status = 'RESOLVED' then date_add(onset, 365) end").alias("resolution_date"),
            F.lit(None).cast("string").alias("documented_by_provider_id"),
            F.col("onset").alias("documentation_date"),
            F.lit(None).cast("string").alias("clinical_notes"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
        )

    @cached_property
    def patient_coverage(self) -> DataFrame:
        b = (self._per_customer(2, "k = 0 or c_custkey % 4 = 0")
             .withColumn("ded", F.expr("500 + (c_custkey % 5) * 500"))
             .withColumn("oop", F.expr("3000 + (c_custkey % 4) * 1000"))
             .withColumn("eff", F.expr("date_add(date'1995-01-01', cast(c_custkey % 1000 as int))")))
        return b.select(
            F.concat(F.lit("COV_"), F.col("ck")).alias("coverage_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("PAT_"), F.col("c_custkey").cast("string")).alias("patient_id"),
            F.concat(F.lit("PAY_"), ((F.col("c_custkey") + 3 * F.col("k")) % N_PAYERS).cast("string")).alias("payer_id"),
            F.concat(F.lit("POL"), F.col("ck")).alias("policy_number"),
            F.lit("GRP1").alias("group_number"),
            F.concat(F.lit("SUB"), F.col("c_custkey").cast("string")).alias("subscriber_id"),
            F.lit(None).cast("string").alias("subscriber_name"),
            pick(["SELF", "SPOUSE", "CHILD", "OTHER"], "c_custkey + k").alias("subscriber_relationship"),
            F.col("eff").alias("effective_date"),
            F.expr("case when (c_custkey + k) % 6 = 0 then date_add(eff, 700) end").alias("termination_date"),
            F.expr("case when (c_custkey + k) % 6 = 0 then 'TERMINATED' when (c_custkey + k) % 13 = 0 then 'SUSPENDED' "
                   "else 'ACTIVE' end").alias("coverage_status"),
            pick(["HMO", "PPO", "EPO", "POS"], "c_custkey").alias("plan_type"),
            F.expr("case when c_custkey % 2 = 0 then 'INDIVIDUAL' else 'FAMILY' end").alias("coverage_level"),
            F.col("ded").cast("decimal(10,2)").alias("deductible_amount"),
            F.expr("least(ded, ((c_custkey * 37) % 21) * 50)").cast("decimal(10,2)").alias("deductible_met_amount"),
            F.col("oop").cast("decimal(10,2)").alias("out_of_pocket_max"),
            F.expr("least(oop, ((c_custkey * 17) % 31) * 100)").cast("decimal(10,2)").alias("out_of_pocket_met"),
            F.expr("20 + (c_custkey % 3) * 10").cast("decimal(10,2)").alias("copay_amount"),
            F.expr("10 + (c_custkey % 3) * 10").cast("decimal(5,2)").alias("coinsurance_pct"),
            (F.col("k") + 1).cast("bigint").alias("coverage_priority"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
        )

    @cached_property
    def sdoh_screenings(self) -> DataFrame:
        b = self._per_customer(1, "c_custkey % 3 <> 2").withColumn(
            "housing", pick(["STABLE", "STABLE", "UNSTABLE", "HOMELESS", "TRANSITIONAL"], "c_custkey"))
        e = F.expr
        return b.select(
            F.concat(F.lit("SDH_"), F.col("c_custkey").cast("string")).alias("screening_id"),
            tenant_id("c_nationkey").alias("hospital_id"),
            F.concat(F.lit("PAT_"), F.col("c_custkey").cast("string")).alias("patient_id"),
            F.lit(None).cast("string").alias("encounter_id"),
            e("date_add(date'2001-01-01', cast(c_custkey % 300 as int))").alias("screening_date"),
            F.col("housing").alias("housing_status"),
            (F.col("housing") != "STABLE").alias("housing_concerns"),
            e("c_custkey % 7 = 0").alias("food_insecurity_flag"),
            e("c_custkey % 11 = 0").alias("difficulty_affording_food"),
            e("c_custkey % 5 = 1").alias("transportation_barriers"),
            e("c_custkey % 9 = 0").alias("difficulty_paying_utilities"),
            e("c_custkey % 8 = 3").alias("difficulty_affording_medications"),
            e("c_custkey % 10").cast("bigint").alias("social_isolation_score"),
            e("c_custkey % 23 = 0").alias("safety_concerns"),
            e("c_custkey % 29 = 0").alias("intimate_partner_violence_screen"),
            pick(["EMPLOYED", "UNEMPLOYED", "RETIRED", "DISABLED"], "c_custkey").alias("employment_status"),
            pick(["HIGH_SCHOOL", "COLLEGE", "GRADUATE", "NONE"], "c_custkey div 4").alias("highest_education_level"),
            e("c_custkey % 5 + 1").cast("bigint").alias("health_literacy_score"),
            F.lit("AHC HRSN").alias("screening_tool_name"),
            F.lit(None).cast("string").alias("referrals_text"),
            F.expr(f"timestamp_ntz'{LOADED_AT}'").alias("_loaded_at"),
        )

    # ---------------- encounter-derived programmes -------------------------
    def _enc_src(self) -> DataFrame:
        return (self._order_base
                .withColumn("hid", tenant_id("c_nationkey"))
                .withColumn("eid", F.concat(F.lit("ENC_"), F.col("o_orderkey").cast("string")))
                .withColumn("pid", F.concat(F.lit("PAT_"), F.col("o_custkey").cast("string")))
                .withColumn("adm_date", F.to_date("admission_date")))

    # Fixed values of the measure design: (code, name, category) by diagnosis slot 0..4
    MEASURES = [("SEP-1", "Severe Sepsis and Septic Shock", "SEPSIS"),
                ("AMI-8a", "Primary PCI Within 90 Minutes", "AMI"),
                ("HF-2", "Heart Failure LVS Assessment", "HF"),
                ("STK-4", "Thrombolytic Therapy", "STROKE"),
                ("PN-6", "Pneumonia Antibiotic Selection", "PNEUMONIA")]

    @cached_property
    def quality_measures(self) -> DataFrame:
        b = self._enc_src().filter(F.col("o_orderkey") % 8 < 5).withColumn("mi", (F.col("o_orderkey") % 8 + 1).cast("int"))
        arr = lambda j: F.array(*[F.lit(m[j]) for m in self.MEASURES])
        code = F.element_at(arr(0), F.col("mi"))
        e = F.expr
        return b.select(
            F.concat(F.lit("QM_"), F.col("o_orderkey").cast("string")).alias("measure_id"),
            F.col("hid").alias("hospital_id"), F.col("eid").alias("encounter_id"), F.col("pid").alias("patient_id"),
            code.alias("measure_code"), F.element_at(arr(1), F.col("mi")).alias("measure_name"),
            F.element_at(arr(2), F.col("mi")).alias("measure_category"),
            e("o_orderkey % 5 <> 0").alias("numerator_eligible"),
            e("o_orderkey % 13 <> 0").alias("denominator_eligible"),
            e("o_orderkey % 17 = 0").alias("exclusion_applied"),
            e("case when o_orderkey % 17 = 0 then 'Comfort care' end").alias("exclusion_reason"),
            e("case when mi = 1 then 20 + o_orderkey % 90 end").cast("bigint").alias("door_to_antibiotic_minutes"),
            e("case when mi = 2 then 40 + o_orderkey % 100 end").cast("bigint").alias("door_to_balloon_minutes"),
            e("case when mi = 4 then 10 + o_orderkey % 50 end").cast("bigint").alias("door_to_needle_minutes"),
            F.lit(None).cast("string").alias("metric_component"),
            F.lit(None).cast("string").alias("component_value"),
            F.col("admission_date").alias("component_timestamp"),
            e("o_orderkey % 5 <> 0 and o_orderkey % 7 <> 0").alias("compliance_flag"),
            F.concat(F.lit("Q"), F.quarter("admission_date").cast("string")).alias("reporting_quarter"),
            F.year("admission_date").cast("bigint").alias("reporting_year"),
            F.expr("admission_date + make_dt_interval(2, 0, 0, 0)").alias("_loaded_at"),
        )

    @cached_property
    def care_plans(self) -> DataFrame:
        b = (self._enc_src().filter((F.col("encounter_type") == "Inpatient") & (F.col("o_orderkey") % 10 < 7))
             .withColumn("status", F.expr("case o_orderkey % 5 when 0 then 'ACTIVE' when 1 then 'ACTIVE' "
                                          "when 4 then 'DISCONTINUED' else 'COMPLETED' end")))
        e = F.expr
        return b.select(
            F.concat(F.lit("CP_"), F.col("o_orderkey").cast("string")).alias("care_plan_id"),
            F.col("hid").alias("hospital_id"), F.col("eid").alias("encounter_id"), F.col("pid").alias("patient_id"),
            pick(ICD_CODES, "o_orderkey").alias("problem_description"),
            F.lit("Stabilise condition").alias("goal_description"),
            F.lit("Care coordination").alias("intervention_description"),
            F.col("status").alias("plan_status"),
            F.col("adm_date").alias("start_date"),
            e("date_add(adm_date, cast(30 + o_orderkey % 60 as int))").alias("target_date"),
            e("case when status = 'COMPLETED' then date_add(adm_date, cast(o_orderkey % 90 as int)) end")
            .alias("completion_date"),
            F.lit(None).cast("string").alias("created_by_provider_id"),
            F.lit(None).cast("string").alias("assigned_to_provider_ids"),
            F.lit(None).cast("string").alias("progress_notes"),
            e("date_add(adm_date, cast(o_orderkey % 120 as int))").alias("last_evaluated_date"),
            F.expr("admission_date + make_dt_interval(1, 0, 0, 0)").alias("_loaded_at"),
        )

    @cached_property
    def referrals(self) -> DataFrame:
        b = (self._enc_src().filter(F.col("o_orderkey") % 4 == 0)
             .withColumn("status", F.expr("case o_orderkey % 7 when 0 then 'PENDING' when 1 then 'PENDING' "
                                          "when 2 then 'SCHEDULED' when 6 then 'CANCELLED' else 'COMPLETED' end"))
             .withColumn("ref_date", F.date_add("adm_date", 1))
             .withColumn("appt", F.expr("case when status in ('SCHEDULED', 'COMPLETED') "
                                        "then date_add(ref_date, cast(o_orderkey % 40 as int)) "
                                        "when status = 'PENDING' and o_orderkey % 3 = 0 then date_add(ref_date, 5) end")))
        e = F.expr
        return b.select(
            F.concat(F.lit("REF_"), F.col("o_orderkey").cast("string")).alias("referral_id"),
            F.col("hid").alias("hospital_id"), F.col("pid").alias("patient_id"), F.col("eid").alias("encounter_id"),
            pick(["SPECIALIST", "DME", "HOME_HEALTH", "SNF"], "o_orderkey div 4").alias("referral_type"),
            F.lit(None).cast("string").alias("referring_provider_id"),
            F.lit(None).cast("string").alias("referred_to_provider_id"),
            F.lit(None).cast("string").alias("referred_to_facility"),
            pick(["Cardiology", "Nephrology", "Pulmonology", "Oncology"], "o_orderkey div 8").alias("specialty"),
            F.col("status").alias("referral_status"),
            F.col("ref_date").alias("referral_date"),
            F.col("appt").alias("appointment_date"),
            e("case when status = 'COMPLETED' then date_add(appt, 2) end").alias("completion_date"),
            F.lit("Specialist evaluation").alias("reason_for_referral"),
            pick(ICD_CODES, "o_orderkey").alias("diagnosis_codes"),
            pick(["ROUTINE", "URGENT", "EMERGENT"], "o_orderkey div 3").alias("urgency"),
            e("o_orderkey % 2 = 0").alias("follow_up_required"),
            e("o_orderkey % 6 = 0").alias("follow_up_completed"),
            F.expr("admission_date + make_dt_interval(1, 0, 0, 0)").alias("_loaded_at"),
        )

    @cached_property
    def prior_authorizations(self) -> DataFrame:
        b = (self._enc_src().filter(F.col("o_orderkey") % 5 == 1)
             .withColumn("status", pick(["PENDING", "APPROVED", "APPROVED", "DENIED", "EXPIRED"], "o_orderkey div 5"))
             .withColumn("req", F.date_sub("adm_date", 3))
             .withColumn("dec", F.expr("case when status <> 'PENDING' then date_add(req, cast(o_orderkey % 10 as int)) end"))
             .withColumn("ua", F.expr("10 + o_orderkey % 20"))
             .withColumn("uu", F.expr("(o_orderkey * 7) % (ua + 1)")))
        e = F.expr
        return b.select(
            F.concat(F.lit("PA_"), F.col("o_orderkey").cast("string")).alias("auth_id"),
            F.col("hid").alias("hospital_id"), F.col("pid").alias("patient_id"),
            F.concat(F.lit("PAY_"), (F.col("o_orderkey") % N_PAYERS).cast("string")).alias("payer_id"),
            F.col("eid").alias("encounter_id"),
            F.concat(F.lit("AUTH"), F.col("o_orderkey").cast("string")).alias("auth_number"),
            pick(["SERVICE", "MEDICATION", "DME"], "o_orderkey").alias("auth_type"),
            F.concat(F.lit("SVC"), (F.col("o_orderkey") % 50).cast("string")).alias("service_code"),
            F.lit("Authorised service").alias("service_description"),
            F.col("status").alias("auth_status"),
            F.col("req").alias("request_date"), F.col("dec").alias("decision_date"),
            F.col("dec").alias("effective_date"),
            e("case when dec is not null then date_add(dec, 90) end").alias("expiration_date"),
            F.col("ua").cast("bigint").alias("units_authorized"),
            F.col("uu").cast("bigint").alias("units_used"),
            (F.col("ua") - F.col("uu")).cast("bigint").alias("units_remaining"),
            pick(ICD_CODES, "o_orderkey").alias("diagnosis_codes"),
            F.lit(None).cast("string").alias("clinical_notes"),
            e("case when status = 'DENIED' then 'Not medically necessary' end").alias("denial_reason"),
            F.expr("admission_date + make_dt_interval(1, 0, 0, 0)").alias("_loaded_at"),
        )

    # ---------------- platform logs (derived from events) ------------------
    # Fixed values of the log design: tables a query may touch (schema, table).
    LOG_TABLES = [("RAW_PHI", "RAW_PATIENTS"), ("RAW_PHI", "RAW_ENCOUNTERS"), ("RAW_PHI", "RAW_BILLING_TRANSACTIONS"),
                  ("RAW_PHI", "RAW_CLINICAL_ORDERS"), ("RAW_PHI", "RAW_CLINICAL_RESULTS"), ("RAW_PHI", "RAW_VITAL_SIGNS"),
                  ("RAW_PHI", "RAW_MEDICATION_ADMINISTRATION"), ("RAW_PHI", "RAW_PATIENT_ALLERGIES"),
                  ("STAGING", "STG_HEALTHCARE__PATIENTS"), ("STAGING", "STG_HEALTHCARE__ENCOUNTERS"),
                  ("RAW_PHI", "RAW_PAYERS"), ("MARTS", "FCT_FINANCIAL_PERFORMANCE"), ("RAW_PHI", "RAW_SDOH_SCREENINGS")]
    CURRENT_DATABASE = "HEALTHCARE_PROD"

    @cached_property
    def query_history(self) -> DataFrame:
        ev = self._t("events")
        tabs = F.array(*[F.lit(f"{s}.{t}") for s, t in self.LOG_TABLES])
        n = len(self.LOG_TABLES)
        hosp = tenant_id("user_id % 25")
        e = F.expr
        b = (ev.withColumn("elapsed", F.round(F.col("value") * 1000).cast("bigint"))
             .withColumn("tbl", F.element_at(tabs, (F.col("event_id") % n + 1).cast("int")))
             .withColumn("tbl2", F.element_at(tabs, ((F.col("event_id") * 7 + 3) % n + 1).cast("int")))
             .withColumn("qtype", e("case event_type when 'purchase' then 'INSERT' when 'signup' then 'MERGE' "
                                    "when 'error' then 'DELETE' else 'SELECT' end"))
             .withColumn("filter_txt", F.when(F.col("event_id") % 4 == 0,
                                              F.concat(F.lit(" WHERE hospital_id = '"), hosp, F.lit("'")))
                         .when(F.col("event_id") % 4 == 1,
                               F.concat(F.lit(" WHERE hospital_id IN ('"), hosp, F.lit("', 'HOSP_9999')")))
                         .when(F.col("event_id") % 4 == 2,
                               F.concat(F.lit(" where HOSPITAL_ID='"), F.lower(hosp), F.lit("'")))
                         .otherwise(F.lit("")))
             .withColumn("sel", F.when(F.col("event_id") % 3 == 0, F.lit("select * from "))
                         .otherwise(F.lit("SELECT count(*) FROM ")))
             .withColumn("join_txt", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit(" JOIN "), F.col("tbl2")))
                         .otherwise(F.lit(""))))
        build = F.col("user_id") % 6 == 3     # the transformation service account's runs
        text = (F.when(build & (F.col("event_type") == "purchase"),
                       F.lit("create or replace table MARTS.FCT_ENCOUNTERS as select * from INT_ENCOUNTERS_ENRICHED"))
                .when(build & (F.col("event_type") == "signup"),
                      F.lit("merge into MARTS.FCT_ENCOUNTERS using INT_ENCOUNTERS_ENRICHED on encounter_id"))
                .when(build & (F.col("event_type") == "click"),
                      F.lit("delete from MARTS.FCT_ENCOUNTERS where loaded_at_timestamp > current_date - 1"))
                .when(F.col("qtype") == "SELECT", F.concat(F.col("sel"), F.col("tbl"), F.col("join_txt"), F.col("filter_txt")))
                .when(F.col("qtype") == "INSERT", F.concat(F.lit("INSERT INTO "), F.col("tbl"), F.lit(" SELECT * FROM staging_batch"),
                                                         F.col("filter_txt")))
                .when(F.col("qtype") == "MERGE", F.concat(F.lit("MERGE INTO "), F.col("tbl"), F.lit(" USING updates"),
                                                        F.col("filter_txt")))
                .otherwise(F.concat(F.lit("DELETE FROM "), F.col("tbl"), F.col("filter_txt"))))
        role = (F.when(F.col("user_id") % 6 == 0, F.lit("SYSADMIN"))
                .when(F.col("user_id") % 6 == 1, F.concat(F.lit("HOSPITAL_"), hosp, F.lit("_PHI_ANALYST")))
                .when(F.col("user_id") % 6 == 2, F.concat(F.lit("HOSPITAL_"), hosp, F.lit("_ANALYST")))
                .when(F.col("user_id") % 6 == 3, F.lit("DBT_PROD_ROLE"))
                .when(F.col("user_id") % 6 == 4, F.lit("HIPAA_AUDITOR"))
                .otherwise(F.lit("MARKETING_ROLE")))
        q = F.col("qtype")
        rows = F.round(F.col("value") * 100).cast("bigint")
        return b.select(
            F.concat(F.lit("Q"), F.col("event_id").cast("string")).alias("query_id"),
            text.alias("query_text"),
            F.when(F.col("event_id") % 10 == 0, F.lit("HEALTHCARE_DEV")).otherwise(F.lit(self.CURRENT_DATABASE))
            .alias("database_name"),
            F.split(F.col("tbl"), r"\.").getItem(0).alias("schema_name"),
            F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("user_name"),
            role.alias("role_name"),
            (F.col("user_id") * 1000 + F.dayofmonth("ts")).cast("bigint").alias("session_id"),
            F.when(F.col("user_id") % 2 == 0, F.lit("TRANSFORM_WH")).otherwise(F.lit("ANALYTICS_WH")).alias("warehouse_name"),
            F.lit("XSMALL").alias("warehouse_size"),
            F.col("ts").alias("start_time"),
            F.timestamp_add("MILLISECOND", F.col("elapsed"), F.col("ts")).alias("end_time"),
            F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("execution_status"),
            F.when(F.col("event_type") == "error", F.lit("100038")).alias("error_code"),
            F.when(F.col("event_type") == "error", F.lit("Numeric value is not recognized")).alias("error_message"),
            F.when(q == "SELECT", rows).otherwise(F.lit(0).cast("bigint")).alias("rows_produced"),
            F.when(q == "INSERT", rows).otherwise(F.lit(0).cast("bigint")).alias("rows_inserted"),
            F.when(q == "MERGE", rows).otherwise(F.lit(0).cast("bigint")).alias("rows_updated"),
            F.when(q == "DELETE", rows).otherwise(F.lit(0).cast("bigint")).alias("rows_deleted"),
            (rows * 512).alias("bytes_scanned"),
            F.expr("elapsed - (elapsed * 4) div 5").alias("compilation_time"),
            F.expr("(elapsed * 4) div 5").alias("execution_time"),
            F.col("elapsed").alias("total_elapsed_time"),
            (F.col("value") / 100.0).cast("decimal(18,6)").alias("credits_used_cloud_services"),
            q.alias("query_type"),
            F.lit(None).cast("string").alias("query_tag"),
        )

    @cached_property
    def warehouse_metering(self) -> DataFrame:
        """Hourly credits per warehouse: count of queries in the hour / 10."""
        ev = self._t("events")
        return (ev.groupBy(F.date_trunc("hour", "ts").alias("start_time"),
                           F.when(F.col("user_id") % 2 == 0, F.lit("TRANSFORM_WH")).otherwise(F.lit("ANALYTICS_WH"))
                           .alias("warehouse_name"))
                .agg((F.count(F.lit(1)) / 10.0).cast("decimal(18,6)").alias("credits_used"))
                .withColumn("end_time", F.col("start_time") + F.expr("INTERVAL 1 HOUR")))

    @cached_property
    def user_hospital_mapping(self) -> DataFrame:
        """Generic-analyst grants: every user with user_id % 6 = 2 is mapped to
        its own tenant and the next one; the second grant has expired."""
        ev = self._t("events").select("user_id").filter(F.col("user_id") % 6 == 2).distinct()
        return ev.select(
            F.concat(F.lit("USER_"), F.col("user_id").cast("string")).alias("user_name"),
            F.lit("HOSPITAL_ANALYST").alias("role_name"),
            F.explode(F.array(F.struct(tenant_id("user_id % 25").alias("h"), F.lit("2099-12-31").alias("e")),
                              F.struct(tenant_id("(user_id + 1) % 25").alias("h"), F.lit("2023-12-31").alias("e"))))
            .alias("g")).select(
            "user_name", "role_name", F.col("g.h").alias("hospital_id"),
            F.lit("2020-01-01").cast("date").alias("access_start_date"), F.col("g.e").cast("date").alias("access_end_date"),
            F.lit("care team").alias("access_reason"))
