"""Tenant isolation and access control (M-family).

Row access policies become ordinary predicates: the access context (role,
user, database, as-of date) is known when the query is built, so each policy
resolves on the driver to either "all rows", "no rows", a literal
``hospital_id = 'X'`` filter (pushed down to the scan), or - for generic
analysts - a left-semi join with that user's currently valid grants (a
handful of rows). De-identification (M05-M07) and cross-tenant
reference drop (M08) live in the staging layer.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


@dataclass(frozen=True)
class AccessContext:
    role: str
    user: str = "ANONYMOUS"
    database: str = "HEALTHCARE_PROD"
    as_of: str = "2024-01-31"


def sql_like(value: str, pattern: str) -> bool:
    """SQL LIKE on literals ('%' any run, '_' exactly one character)."""
    rx = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern)
    return re.fullmatch(rx, value, flags=re.S) is not None


# Decision kinds
ALL, NONE = "all", "none"


def _environment_grant(ctx: AccessContext) -> bool:
    r, db = ctx.role, ctx.database
    return ((r == "DBT_CI_ROLE" and (sql_like(db, "%_CI") or sql_like(db, "%_DEV")))
            or (r == "DBT_DEV_ROLE" and sql_like(db, "%_DEV"))
            or (r == "DBT_PROD_ROLE" and sql_like(db, "%_PROD")))


def isolation_decision(ctx: AccessContext):
    """('all'|'none'|('tenant', id)|('mapped', user))."""
    r = ctx.role
    if r in ("ACCOUNTADMIN", "SYSADMIN") or _environment_grant(ctx) or r == "HIPAA_AUDITOR":
        return ALL
    if sql_like(r, "HOSPITAL_%_ANALYST") and not sql_like(r, "%_PHI_ANALYST"):
        return ("tenant", re.sub(r"HOSPITAL_(.*)_ANALYST", r"\1", r, count=1))
    if r == "HOSPITAL_ANALYST":
        return ("mapped", ctx.user)
    return NONE   # fail closed


def phi_decision(ctx: AccessContext):
    """Stricter policy for PHI tables."""
    r = ctx.role
    if r in ("ACCOUNTADMIN", "PHI_ADMIN", "HIPAA_AUDITOR") or _environment_grant(ctx):
        return ALL
    if sql_like(r, "HOSPITAL_%_PHI_ANALYST"):
        return ("tenant", re.sub(r"HOSPITAL_(.*)_PHI_ANALYST", r"\1", r, count=1))
    return NONE


def apply_decision(df: DataFrame, decision, ctx: AccessContext, mapping: DataFrame | None = None,
                   tenant_column: str = "hospital_id") -> DataFrame:
    if decision == ALL:
        return df
    if decision == NONE:
        return df.filter(F.lit(False))
    kind, arg = decision
    if kind == "tenant":
        return df.filter(c(tenant_column) == F.lit(arg))
    if mapping is None:
        return df.filter(F.lit(False))
    today = F.lit(ctx.as_of).cast("date")
    grants = (mapping.filter((c("user_name") == F.lit(arg))
                             & today.between(c("access_start_date"), c("access_end_date")))
              .select(c("hospital_id").alias(tenant_column)).distinct())
    # one user's grants
    return df.join(grants, tenant_column, "left_semi")


# Policy by table class. Which raw tables get which policy.
PHI_TABLES = {"raw_patients"}
REFERENCE_TABLES = {"raw_diagnoses", "raw_procedures", "raw_payers"}


def policy_for(table: str) -> str | None:
    t = table.lower()
    if t in REFERENCE_TABLES:
        return None
    return "phi" if t in PHI_TABLES else "isolation"


def secure_view(table: str, df: DataFrame, ctx: AccessContext, mapping: DataFrame | None = None) -> DataFrame:
    policy = policy_for(table)
    if policy is None:
        return df
    decision = phi_decision(ctx) if policy == "phi" else isolation_decision(ctx)
    return apply_decision(df, decision, ctx, mapping)


def visible_tenants(df: DataFrame, ctx: AccessContext, mapping: DataFrame | None = None,
                    table: str = "raw_encounters") -> DataFrame:
    """Row counts per tenant as seen under a role."""
    return secure_view(table, df, ctx, mapping).groupBy("hospital_id").agg(F.count(F.lit(1)).alias("row_count"))


# ---------------------------------------------------------------------------
# M09 dataset whitelist page (aggregate marts only)
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Dataset:
    name: str
    mart: str
    description: str
    date_column: str | None
    order_by: str


# Exposed datasets (name, warehouse attribute, description, date column, order column).
DATASETS = {d.name: d for d in [
    Dataset("clinical-quality", "clinical_quality_metrics", "Daily readmission, mortality and length-of-stay metrics",
            "metric_date", "metric_date"),
    Dataset("core-measures", "quality_measure_performance", "Quarterly core-measure performance", None,
            "reporting_quarter"),
    Dataset("early-warning", "early_warning_surveillance", "Daily NEWS distribution, sepsis and deterioration alerts",
            "metric_date", "metric_date"),
    Dataset("laboratory-quality", "laboratory_quality_metrics", "Daily lab turnaround and critical-value metrics",
            "metric_date", "metric_date"),
    Dataset("medication-safety", "medication_safety_metrics", "Daily barcode compliance, allergy conflicts",
            "metric_date", "metric_date"),
    Dataset("financial-performance", "financial_performance", "Daily revenue cycle metrics", "metric_date",
            "metric_date"),
    Dataset("prior-authorizations", "prior_authorization_metrics", "Monthly prior authorization metrics by payer",
            "request_month", "request_month"),
    Dataset("operational", "operational_metrics", "Daily volumes, bed occupancy and patient flow", "metric_date",
            "metric_date"),
    Dataset("care-coordination", "care_coordination_metrics", "Monthly referral and care plan management",
            "metric_month", "metric_month"),
    Dataset("cost-attribution", "cost_attribution", "Daily platform cost attributed per hospital", "metric_date",
            "metric_date"),
]}
MAX_PAGE_SIZE = 1000


class DatasetError(ValueError):
    pass


def dataset_page(warehouse, name: str, ctx: AccessContext, hospital_id: str | None = None,
                 start_date: str | None = None, end_date: str | None = None, limit: int = 100, offset: int = 0,
                 mapping: DataFrame | None = None, max_page_size: int = MAX_PAGE_SIZE) -> DataFrame:
    """Whitelisted mart page under the caller's row policy: tenant filter,
    inclusive date range, newest first then tenant, limit/offset (F03)."""
    ds = DATASETS.get(name)
    if ds is None:
        raise DatasetError(f"Unknown dataset {name!r}")
    if limit < 1 or offset < 0:
        raise DatasetError("limit must be >= 1 and offset >= 0")
    if limit > max_page_size:
        raise DatasetError(f"limit must be <= {max_page_size}")
    if (start_date or end_date) and ds.date_column is None:
        raise DatasetError(f"Dataset {name!r} does not support date filters")
    if start_date and end_date and start_date > end_date:
        raise DatasetError("start_date must be on or before end_date")
    df = getattr(warehouse, ds.mart)
    df = apply_decision(df, isolation_decision(ctx), ctx, mapping)
    if hospital_id is not None:
        df = df.filter(c("hospital_id") == hospital_id)
    if start_date is not None:
        df = df.filter(c(ds.date_column) >= F.lit(start_date).cast("date"))
    if end_date is not None:
        df = df.filter(c(ds.date_column) <= F.lit(end_date).cast("date"))
    return df.orderBy(c(ds.order_by).desc_nulls_first(), c("hospital_id").asc_nulls_last()).offset(offset).limit(limit)
