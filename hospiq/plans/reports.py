"""Operational reports (O-family): the aggregations behind the monitoring
screens and ad-hoc analyses, as DataFrames over the marts. Top-k reports use
``orderBy().limit()`` (planned as TakeOrderedAndProject: a per-partition
top-k, then a merge of k rows per partition) with an id as the last sort key
so ties are deterministic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import core as fn

c = F.col


def _latest_per_tenant(df: DataFrame, order_col: str) -> DataFrame:          # D18
    w = Window.partitionBy("hospital_id").orderBy(c(order_col).desc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).filter(c("_rn") == 1).drop("_rn")


# O01 ----------------------------------------------------------------------
def sla_overview(sla: DataFrame, order_col: str = "check_timestamp") -> DataFrame:
    latest = _latest_per_tenant(sla, order_col)
    s = latest.agg(F.count(F.lit(1)).alias("hospitals"),
                   F.count(F.when(c("overall_sla_status") == "COMPLIANT", 1)).alias("compliant_hospitals"),
                   fn.mean4("data_quality_score_pct").alias("_q"), fn.mean4("encounters_freshness_minutes").alias("_f"),
                   F.sum("total_encounters").alias("total_encounters"))
    return s.select("hospitals", "compliant_hospitals",
                    fn.r4(F.when(c("hospitals") > 0, c("compliant_hospitals") * 100.0 / c("hospitals")).otherwise(0.0))
                    .alias("compliance_rate_pct"),
                    fn.r4("_q").alias("avg_quality_score_pct"), fn.r4("_f").alias("avg_freshness_minutes"),
                    "total_encounters",
                    fn.r4(F.greatest(F.lit(0.0), 100 - c("_f") / 240 * 100)).alias("freshness_score"))


# O02 ----------------------------------------------------------------------
def cost_summary(cost: DataFrame) -> DataFrame:
    """Totals; the mean daily cost is total cost / number of days (every day
    present has at least one row), so one aggregation suffices."""
    tot = cost.agg(F.sum("total_cost_usd").alias("total_cost"), F.countDistinct("metric_date").alias("_days"),
                   F.sum("queries_executed").alias("total_queries"), F.sum("total_credits_used").alias("total_credits"),
                   fn.mean4("total_execution_time_seconds").alias("_exec"))
    return tot.select(fn.r4("total_cost").alias("total_cost_usd"),
                      fn.r4(F.when(c("_days") > 0, c("total_cost") / c("_days"))).alias("avg_daily_cost_usd"),
                      "total_queries",
                      fn.r4(F.when(c("total_queries") > 0, c("total_cost") / c("total_queries")).otherwise(0.0))
                      .alias("avg_cost_per_query_usd"),
                      fn.r4("total_credits").alias("total_credits_used"),
                      fn.r4("_exec").alias("avg_execution_time_seconds"))


def cost_by_tenant(cost: DataFrame) -> DataFrame:
    t = cost.groupBy("hospital_id").agg(F.sum("total_cost_usd").alias("_c"), F.sum("queries_executed").alias("queries"))
    w = Window.orderBy(c("_c").desc(), c("hospital_id"))   # one row per tenant: a bounded global ranking
    return t.select("hospital_id", fn.r4("_c").alias("total_cost_usd"), "queries",
                    F.row_number().over(w).alias("cost_rank"))


# O03 ----------------------------------------------------------------------
def access_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("total_access_events"),
        F.count(F.when(c("is_unauthorized"), 1)).alias("unauthorized_attempts"),
        F.count(F.when(c("is_bulk_access"), 1)).alias("bulk_access_events"),
        F.countDistinct("user_name").alias("unique_users"),
        F.sum("records_accessed").alias("total_records_accessed"),
        F.sum("records_modified").alias("records_modified"),
        fn.r4(fn.mean4("estimated_cost_usd")).alias("avg_cost_per_query"),
        fn.r4(F.sum("bytes_scanned") / (1024 ** 3)).alias("total_gb_scanned"))


def access_by_status(audit: DataFrame) -> DataFrame:
    return audit.groupBy("access_authorization_status").agg(F.count(F.lit(1)).alias("events"))


def daily_access(audit: DataFrame) -> DataFrame:
    return (audit.groupBy(F.to_date("access_timestamp").alias("date"), "access_authorization_status")
            .agg(F.count(F.lit(1)).alias("count")))


def top_users(audit: DataFrame, k: int = 10) -> DataFrame:
    u = audit.groupBy("user_name").agg(F.count("audit_id").alias("access_events"),
                                       F.sum("records_accessed").alias("records_accessed"),
                                       F.count(F.when(c("is_unauthorized"), 1)).alias("unauthorized"),
                                       fn.r4(F.sum("estimated_cost_usd")).alias("total_cost_usd"))
    return u.orderBy(c("access_events").desc(), c("user_name")).limit(k)


# O04 ----------------------------------------------------------------------
def tenant_comparison(hospitals: DataFrame, quality: DataFrame, audit: DataFrame, ops: DataFrame,
                      as_of: str, audit_as_of: str, days: int = 7) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    a_since = F.date_sub(F.lit(audit_as_of).cast("date"), days)
    q = quality.filter(c("metric_date") >= since).groupBy("hospital_id").agg(
        fn.r4(fn.mean4("readmission_rate_30day_pct")).alias("readmission_rate_30day_pct"),
        fn.r4(fn.mean4("mortality_rate_pct")).alias("mortality_rate_pct"),
        fn.r4(fn.mean4("avg_length_of_stay")).alias("avg_length_of_stay"),
        F.sum("total_encounters").alias("total_encounters"))
    cst = audit.filter(c("access_timestamp") >= a_since).groupBy("hospital_id").agg(
        fn.r4(F.sum("estimated_cost_usd")).alias("estimated_cost_usd"),
        fn.r4(fn.mean4("estimated_cost_usd")).alias("cost_per_query"))
    o = ops.filter(c("metric_date") >= since).groupBy("hospital_id").agg(
        fn.r4(fn.mean4("bed_occupancy_rate_pct")).alias("bed_occupancy_rate_pct"),
        F.sum("inpatient_admissions").alias("inpatient_admissions"))
    h = hospitals.select("hospital_id", "hospital_name", "hospital_type", "bed_count", "region", "emr_system",
                         "contract_tier", "teaching_hospital")
    return h.join(q, "hospital_id", "left").join(cst, "hospital_id", "left").join(o, "hospital_id", "left")


def comparison_by(comparison: DataFrame, dim: str) -> DataFrame:
    return comparison.groupBy(dim).agg(F.count(F.lit(1)).alias("hospitals"),
                                       fn.r4(fn.mean4("readmission_rate_30day_pct")).alias("avg_readmission_rate"),
                                       F.sum("total_encounters").alias("total_encounters"))


def top_hospitals(comparison: DataFrame, metric: str, k: int = 5, largest: bool = True) -> DataFrame:   # F04
    o = c(metric).desc() if largest else c(metric).asc()
    return (comparison.filter(c(metric).isNotNull()).orderBy(o, c("hospital_id"))
            .limit(k).select("hospital_id", "hospital_name", metric))


# O05 ----------------------------------------------------------------------
def alert_list(sla: DataFrame, quality: DataFrame, ops: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    fmt1 = lambda x: F.format_number(x, 1)
    s = _latest_per_tenant(sla, "check_timestamp").filter(c("overall_sla_status").isin("BREACH", "WARNING")).select(
        F.when(c("overall_sla_status") == "BREACH", "Critical").otherwise("Warning").alias("severity"),
        F.lit("SLA").alias("category"), "hospital_id",
        F.when(c("overall_sla_status") == "BREACH",
               F.concat(F.lit("SLA breach detected - Quality: "),
                        F.coalesce(F.concat(fmt1(c("data_quality_score_pct")), F.lit("%")), F.lit("N/A")),
                        F.lit(", Freshness: "),
                        F.coalesce(F.concat(F.format_number(c("encounters_freshness_minutes").cast("double"), 0),
                                            F.lit(" min")), F.lit("N/A"))))
        .otherwise(F.concat(F.lit("SLA warning - Quality: "), fmt1(c("data_quality_score_pct")), F.lit("%")))
        .alias("message"), F.to_date("check_timestamp").alias("alert_date"))
    rq = quality.filter(c("metric_date") >= since)
    q1 = rq.filter(c("readmission_rate_30day_pct") > 10).select(
        F.lit("Critical").alias("severity"), F.lit("Clinical Quality").alias("category"), "hospital_id",
        F.concat(F.lit("High readmission rate: "), F.format_number("readmission_rate_30day_pct", 2),
                 F.lit("% (Target: <5%)")).alias("message"), c("metric_date").alias("alert_date"))
    q2 = rq.filter(c("mortality_rate_pct") > 5).select(
        F.lit("Warning").alias("severity"), F.lit("Clinical Quality").alias("category"), "hospital_id",
        F.concat(F.lit("Elevated mortality rate: "), F.format_number("mortality_rate_pct", 2), F.lit("%"))
        .alias("message"), c("metric_date").alias("alert_date"))
    ro = ops.filter((c("metric_date") >= since) & (c("bed_occupancy_rate_pct") > 85)).select(
        F.when(c("bed_occupancy_rate_pct") > 95, "Critical").otherwise("Warning").alias("severity"),
        F.lit("Operations").alias("category"), "hospital_id",
        F.when(c("bed_occupancy_rate_pct") > 95,
               F.concat(F.lit("Critical bed capacity: "), fmt1(c("bed_occupancy_rate_pct")), F.lit("% occupancy")))
        .otherwise(F.concat(F.lit("High bed occupancy: "), fmt1(c("bed_occupancy_rate_pct")), F.lit("%")))
        .alias("message"), c("metric_date").alias("alert_date"))
    alerts = s.unionByName(q1).unionByName(q2).unionByName(ro)
    return alerts.orderBy(F.when(c("severity") == "Critical", 0).otherwise(1), c("alert_date").desc_nulls_last(), "hospital_id")


# O06 / O07 -------------------------------------------------------------------
def clinical_latest_day(quality: DataFrame) -> DataFrame:
    """The last day's figures over all tenants: days are summed in one pass and
    the last of them is taken (an empty mart gives one row of NULLs)."""
    days = quality.filter(c("metric_date").isNotNull()).groupBy("metric_date").agg(
        F.sum("total_encounters").alias("total_encounters"),
        fn.r4(fn.mean4("readmission_rate_30day_pct")).alias("avg_readmission_rate"),
        fn.r4(fn.mean4("mortality_rate_pct")).alias("avg_mortality_rate"),
        fn.r4(fn.mean4("avg_length_of_stay")).alias("avg_los"),
        F.sum("high_risk_patients").alias("high_risk_patients"))
    return days.agg(F.max_by(F.struct(*days.columns[1:]), "metric_date").alias("d")).select("d.*")


def financial_summary(fin: DataFrame) -> DataFrame:
    s = fin.agg(F.sum("total_charges").alias("tc"), F.sum("total_collections").alias("tcol"),
                F.sum("total_denials").alias("td"), fn.mean4("denial_rate_pct").alias("_dr"),
                fn.mean4("avg_days_in_ar").alias("_ar"))
    return s.select(fn.r2("tc").alias("total_charges"), fn.r2("tcol").alias("total_collections"),
                    fn.r2("td").alias("total_denials"),
                    fn.r4(F.when(c("tc") > 0, c("tcol") / c("tc") * 100).otherwise(0.0)).alias("avg_collection_rate"),
                    fn.r4("_dr").alias("avg_denial_rate"), fn.r4("_ar").alias("avg_days_in_ar"))


# O08 ----------------------------------------------------------------------
def provider_analysis(perf: DataFrame, k: int = 10, min_volume: int = 50) -> DataFrame:
    """F02 best / worst k providers (minimum volume) + G03 specialty benchmark rows."""
    eligible = perf.filter(c("total_encounters") >= min_volume)
    cols = ["provider_full_name", "specialty", "readmission_rate_pct", c("total_encounters").cast("double").alias("total_encounters")]
    top = (eligible.orderBy(c("readmission_rate_pct").asc(), c("provider_id")).limit(k)
           .select(F.lit("Top 10 - Lowest Readmissions").alias("category"), *cols))
    bottom = (eligible.orderBy(c("readmission_rate_pct").desc(), c("provider_id")).limit(k)
              .select(F.lit("Bottom 10 - Highest Readmissions").alias("category"), *cols))
    bench = perf.groupBy("specialty").agg(fn.mean4("readmission_rate_pct").alias("a"),
                                          fn.mean4("total_encounters").alias("v")).select(
        F.lit("Specialty Benchmark").alias("category"), c("specialty").alias("provider_full_name"),
        F.lit(None).cast("string").alias("specialty"), fn.r4("a").alias("readmission_rate_pct"),
        fn.r4("v").alias("total_encounters"))
    return top.unionByName(bottom).unionByName(bench)


# O09 ----------------------------------------------------------------------
# Build strategy -> query-text pattern.
STRATEGY_PATTERNS = {"full_refresh": "%create or replace table%fct_encounters%",
                     "incremental_merge": "%merge into%fct_encounters%",
                     "incremental_delete_insert": "%delete from%fct_encounters%"}


def strategy_benchmark(history: DataFrame, as_of: str, runs: int = 10, pattern_table: dict | None = None) -> DataFrame:
    pats = pattern_table or STRATEGY_PATTERNS
    since = F.date_sub(F.lit(as_of).cast("date"), 30)
    strat = None
    for name, p in pats.items():
        strat = F.when(c("query_text").ilike(p), name) if strat is None else strat.when(c("query_text").ilike(p), name)
    q = (history.filter((c("execution_status") == "SUCCESS") & (c("start_time") >= since))
         .withColumn("strategy", strat).filter(c("strategy").isNotNull())
         .select("strategy", "query_id", "start_time", (c("total_elapsed_time") / 1000).alias("execution_seconds")))
    w = Window.partitionBy("strategy").orderBy(c("start_time").desc(), c("query_id").desc())
    last = q.withColumn("_rn", F.row_number().over(w)).filter(c("_rn") <= runs)   # top-k per group
    s = last.groupBy("strategy").agg(F.count(F.lit(1)).alias("run_count"), fn.mean4("execution_seconds").alias("_avg"),
                                     F.min("execution_seconds").alias("_min"), F.max("execution_seconds").alias("_max"),
                                     F.percentile("execution_seconds", 0.5).alias("_med"))
    worst = Window.partitionBy()     # at most one row per strategy: a bounded window over ()
    return s.select("strategy", "run_count", fn.r4("_avg").alias("avg_execution_seconds"),
                    fn.r4("_min").alias("min_execution_seconds"), fn.r4("_max").alias("max_execution_seconds"),
                    fn.r4("_med").alias("median_execution_seconds"),
                    fn.r4((F.max("_avg").over(worst) - c("_avg")) * 100.0 / F.max("_avg").over(worst))
                    .alias("improvement_vs_worst_pct"))


# O11 ----------------------------------------------------------------------
def sla_status_distribution(sla: DataFrame) -> DataFrame:
    return sla.groupBy("overall_sla_status").agg(F.count(F.lit(1)).alias("hospitals"))


def daily_volume(ops: DataFrame) -> DataFrame:
    return ops.groupBy("metric_date").agg(F.sum("inpatient_admissions").alias("inpatient_admissions"),
                                          F.sum("emergency_visits").alias("emergency_visits"))


# O12 ----------------------------------------------------------------------
def recent_window(mart: DataFrame, date_col: str, as_of: str, days: int, page: int | None = None) -> DataFrame:
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    recent = mart.filter(c(date_col) >= since).orderBy(c(date_col).desc(), c("hospital_id"))
    return recent if page is None else recent.limit(page)


# O13 ----------------------------------------------------------------------
def incident_scope(audit_log: DataFrame, user: str, own_tenant: str) -> DataFrame:
    return (audit_log.filter((c("user_name") == user) & c("is_unauthorized") & (c("hospital_id") != own_tenant))
            .groupBy(c("hospital_id").alias("compromised_hospital_id"))
            .agg(F.countDistinct("query_id").alias("unauthorized_queries"),
                 F.sum("records_accessed").alias("total_rows_accessed"),
                 F.min("access_timestamp").alias("first_access"), F.max("access_timestamp").alias("last_access"))
            .withColumn("exposure_duration_hours", fn.boundary_diff("hour", "first_access", "last_access")))
