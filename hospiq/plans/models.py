"""The model graph: raw -> staging -> intermediate -> marts as lazily built
DataFrames over one source. Catalyst sees each requested mart as one plan."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources.adapters import STAR_AS_OF, HospitalSource
from . import intermediate as J
from . import marts as K
from . import risk as R
from . import staging as B


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = STAR_AS_OF):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = HospitalSource(spark, sf_dir)
        self.as_of = as_of

    def materialize(self, name: str, path: str) -> DataFrame:
        """Write model ``name`` once to ``path`` (shared storage) and use the
        written table from then on: models built afterwards read it instead
        of recomputing its lineage. Call before the dependents are built."""
        if name in self.__dict__ and getattr(self, "_materialized", {}).get(name) == path:
            return self.__dict__[name]
        getattr(self, name).write.mode("overwrite").parquet(path)
        df = self.spark.read.parquet(path)
        self.__dict__[name] = df
        self.__dict__.setdefault("_materialized", {})[name] = path
        return df

    # staging
    @cached_property
    def hospitals(self) -> DataFrame:
        return B.stg_hospitals(self.raw.hospitals)

    @cached_property
    def patients(self) -> DataFrame:
        return B.stg_patients(self.raw.patients, self.as_of)

    @cached_property
    def providers(self) -> DataFrame:
        return B.stg_providers(self.raw.providers, self.as_of)

    @cached_property
    def facilities(self) -> DataFrame:
        return B.stg_facilities(self.raw.facilities)

    @cached_property
    def diagnoses(self) -> DataFrame:
        return B.stg_diagnoses(self.raw.diagnoses)

    @cached_property
    def payers(self) -> DataFrame:
        return B.stg_payers(self.raw.payers)

    @cached_property
    def procedures(self) -> DataFrame:
        return B.stg_procedures(self.raw.procedures)

    @cached_property
    def encounters(self) -> DataFrame:
        # the staged encounter model is the attribute-carrying validation
        # output projected to its own columns (one pipeline, pruned by Catalyst)
        return self.encounters_with_attrs.select(*B.ENCOUNTER_COLUMNS)

    @cached_property
    def encounters_with_attrs(self) -> DataFrame:
        return B.encounters_validated(self.raw.encounters, self.patients, self.providers, self.facilities,
                                      attrs=True)

    # intermediate
    @cached_property
    def encounters_enriched(self) -> DataFrame:
        return J.encounters_enriched(self.encounters_with_attrs, self.hospitals, self.diagnoses)

    @cached_property
    def patient_journey(self) -> DataFrame:
        return J.patient_journey(self.encounters_enriched)

    # marts
    @cached_property
    def clinical_quality_metrics(self) -> DataFrame:
        return K.clinical_quality_metrics(self.patient_journey)

    # ---- clinical facts
    @cached_property
    def billing(self) -> DataFrame:
        return B.stg_billing(self.raw.billing_transactions)

    @cached_property
    def clinical_orders(self) -> DataFrame:
        return B.stg_clinical_orders(self.raw.clinical_orders)

    @cached_property
    def clinical_results(self) -> DataFrame:
        return B.stg_clinical_results(self.raw.clinical_results)

    @cached_property
    def medication_administration(self) -> DataFrame:
        return B.stg_medication_administration(self.raw.medication_administration)

    @cached_property
    def vital_signs(self) -> DataFrame:
        return B.stg_vital_signs(self.raw.vital_signs)

    @cached_property
    def vitals_enriched(self) -> DataFrame:
        return J.vitals_enriched(self.vital_signs, self.encounters, self.patients, self.hospitals)

    @cached_property
    def lab_results_enriched(self) -> DataFrame:
        return J.lab_results_enriched(self.clinical_results, self.clinical_orders, self.encounters, self.patients,
                                      self.providers, self.hospitals)

    @cached_property
    def billed_encounters(self) -> DataFrame:
        """What billing takes from the encounters."""
        return self.encounters.select("encounter_id", "encounter_type", "discharge_date")

    @cached_property
    def revenue_cycle(self) -> DataFrame:
        return J.revenue_cycle(self.billing, self.payers, self.billed_encounters)

    @cached_property
    def early_warning_surveillance(self) -> DataFrame:
        return K.early_warning_surveillance(self.vitals_enriched)

    @cached_property
    def laboratory_quality_metrics(self) -> DataFrame:
        return K.laboratory_quality_metrics(J.lab_results_enriched(
            self.clinical_results, self.clinical_orders, self.encounters, self.patients, self.providers, self.hospitals,
            narrow=True))

    @cached_property
    def financial_performance(self) -> DataFrame:
        return K.financial_performance(self.revenue_cycle)

    # ---- history / programmes
    @cached_property
    def problem_list(self) -> DataFrame:
        return B.stg_problem_list(self.raw.problem_list, self.as_of)

    @cached_property
    def patient_allergies(self) -> DataFrame:
        return B.stg_patient_allergies(self.raw.patient_allergies, self.as_of)

    @cached_property
    def patient_coverage(self) -> DataFrame:
        return B.stg_patient_coverage(self.raw.patient_coverage, self.as_of)

    @cached_property
    def sdoh_screenings(self) -> DataFrame:
        return B.stg_sdoh_screenings(self.raw.sdoh_screenings)

    @cached_property
    def quality_measures(self) -> DataFrame:
        return B.stg_quality_measures(self.raw.quality_measures)

    @cached_property
    def care_plans(self) -> DataFrame:
        return B.stg_care_plans(self.raw.care_plans, self.as_of)

    @cached_property
    def referrals(self) -> DataFrame:
        return B.stg_referrals(self.raw.referrals, self.as_of)

    @cached_property
    def prior_authorizations(self) -> DataFrame:
        return B.stg_prior_authorizations(self.raw.prior_authorizations, self.as_of)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return J.orders_enriched(self.clinical_orders, self.clinical_results, self.encounters, self.patients,
                                 self.providers, self.hospitals, self.procedures)

    @cached_property
    def orders_for_measures(self) -> DataFrame:
        return J.orders_for_measures(self.clinical_orders, self.encounters, self.patients, self.providers, self.hospitals)

    @cached_property
    def medication_safety(self) -> DataFrame:
        return J.medication_safety(self.medication_administration, self.clinical_orders, self.patient_allergies,
                                   self.encounters, self.patients, self.providers, self.hospitals)

    @cached_property
    def measure_results(self) -> DataFrame:
        return J.measure_results(self.quality_measures, self.encounters)

    @cached_property
    def comorbidity_index(self) -> DataFrame:
        return J.comorbidity_index(self.patients, self.problem_list, self.encounters)

    @cached_property
    def medication_safety_metrics(self) -> DataFrame:
        return K.medication_safety_metrics(J.medication_safety(
            self.medication_administration, self.clinical_orders, self.patient_allergies, self.encounters, self.patients,
            self.providers, self.hospitals, narrow=True))

    def cms_core_measures(self, min_denominator: int = K.CMS_MIN_DENOMINATOR) -> DataFrame:
        return K.cms_core_measures(self.encounters_enriched, self.vitals_enriched, self.orders_for_measures,
                                   min_denominator)

    @cached_property
    def quality_measure_performance(self) -> DataFrame:
        return K.quality_measure_performance(self.measure_results, self.comorbidity_index)

    @cached_property
    def patient_profile(self) -> DataFrame:
        return J.patient_profile(self.patients, self.hospitals, self.problem_list, self.patient_allergies,
                                 self.patient_coverage, self.vitals_enriched, self.sdoh_screenings, self.encounters,
                                 self.medication_administration, self.as_of)

    @cached_property
    def population_health(self) -> DataFrame:
        return K.population_health(self.patient_profile, self.hospitals)

    @cached_property
    def prior_auth_enriched(self) -> DataFrame:
        return J.prior_auth_enriched(self.prior_authorizations, self.payers, self.billing)

    @cached_property
    def referrals_enriched(self) -> DataFrame:
        return J.referrals_enriched(self.referrals, self.encounters, self.providers)

    @cached_property
    def encounter_severity(self) -> DataFrame:
        return R.encounter_severity(self.encounters, self.patients, self.vital_signs, self.clinical_results, self.comorbidity_index)

    @cached_property
    def stroke_and_bleeding_risk(self) -> DataFrame:
        return R.stroke_and_bleeding_risk(self.patients, self.comorbidity_index, self.vital_signs, self.medication_administration,
                                          self.problem_list, self.encounters)

    @cached_property
    def provider_summary(self) -> DataFrame:
        return K.provider_summary(self.patient_journey)

    @cached_property
    def provider_performance(self) -> DataFrame:
        return K.provider_performance(self.provider_summary)

    @cached_property
    def prior_authorization_metrics(self) -> DataFrame:
        return K.prior_authorization_metrics(self.prior_auth_enriched)

    @cached_property
    def care_coordination_metrics(self) -> DataFrame:
        return K.care_coordination_metrics(self.referrals_enriched, self.care_plans, self.comorbidity_index)

    @cached_property
    def operational_metrics(self) -> DataFrame:
        return K.operational_metrics(self.encounters_enriched, self.facilities, self.as_of)

    @cached_property
    def fct_encounters(self) -> DataFrame:
        return K.fct_encounters(self.encounters_enriched)

    @cached_property
    def fct_billing_transactions(self) -> DataFrame:
        return K.fct_billing_transactions(self.revenue_cycle)

    @cached_property
    def sla_monitoring(self) -> DataFrame:
        return K.sla_monitoring(self.encounters, self.patients, self.billing, self.fct_encounters, f"{self.as_of} 00:00:00")

    # ---- observability (event-derived logs; their own as-of)
    event_as_of = "2024-01-31"

    @cached_property
    def cost_attribution(self) -> DataFrame:
        return K.cost_attribution(self.raw.query_history, self.raw.warehouse_metering, self.raw.CURRENT_DATABASE)

    @cached_property
    def hipaa_audit_trail(self) -> DataFrame:
        """Every access in the log; incremental builds pass ``since`` and append."""
        return self.audit_trail_since(None)

    def audit_trail_since(self, since: str | None) -> DataFrame:
        from pyspark.sql import functions as F
        mark = None if since is None else F.lit(since).cast("timestamp_ntz")
        return K.hipaa_audit_trail(K.phi_access_log(self.raw.query_history, mark, self.raw.CURRENT_DATABASE))
