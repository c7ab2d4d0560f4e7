"""Scalar column helpers (H-family). All return ``Column`` expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# H06 date difference counted in unit *boundaries* (warehouse semantics):
# 10:59 -> 11:01 is one hour, 23:59 -> 00:01 is one day.
# ---------------------------------------------------------------------------
def boundary_diff(unit: str, start: ColumnOrName, end: ColumnOrName) -> Column:
    a, b = col(start), col(end)
    u = unit.lower()
    if u == "day":
        return F.datediff(F.to_date(b), F.to_date(a))
    if u == "year":
        return F.year(b) - F.year(a)
    if u == "month":
        return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))
    if u in ("hour", "minute", "second"):
        trunc = u.upper()
        return F.timestamp_diff(trunc, F.date_trunc(trunc, a), F.date_trunc(trunc, b))
    raise ValueError(f"unsupported unit {unit}")


# ---------------------------------------------------------------------------
# H10 guarded division / percentages
# ---------------------------------------------------------------------------
def safe_divide(num: ColumnOrName, den: ColumnOrName, default=None) -> Column:
    n, d = col(num), col(den)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return F.when(d.isNull() | (d == 0), dflt).otherwise(n.cast("double") / d.cast("double"))


def pct(num: ColumnOrName, den: ColumnOrName, decimals: int = 2, default=None) -> Column:
    """Percentage 0-100 rounded; NULL (or ``default``) for a zero/NULL denominator."""
    return F.round(safe_divide(col(num) * 100.0, den, default), decimals)


def rate_or_zero(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num*100.0/den`` when ``den > 0`` else 0 (the marts' inline pattern)."""
    d = col(den)
    return F.when(d > 0, col(num).cast("double") * 100.0 / d.cast("double")).otherwise(F.lit(0.0))


def round_half_up(c: ColumnOrName, places: int) -> Column:
    """floor(x * 10^n + 0.5) / 10^n on the double value.

    Defined by IEEE arithmetic only, so every engine that computes the same
    double rounds it the same way (round() differs between engines at ties)."""
    k = 10 ** places
    return F.floor(col(c).cast("double") * k + 0.5) / k


def r4(c: ColumnOrName) -> Column:
    """Ratios and means are published rounded to 4 places."""
    return round_half_up(c, 4)


def r2(c: ColumnOrName) -> Column:
    """Money is published rounded to cents."""
    return round_half_up(c, 2)


def mean4(c: ColumnOrName) -> Column:
    """Mean of values published at 4 decimals: summed exactly as decimals."""
    return F.sum(col(c).cast("decimal(24,4)")).cast("double") / F.count(col(c))


def mean(c: ColumnOrName) -> Column:
    """Average as exact sum / count (decimal and integer sums are exact, so
    the quotient does not depend on the summation order)."""
    return F.sum(col(c)).cast("double") / F.count(col(c))


# ---------------------------------------------------------------------------
# NULL-propagating greatest / least (warehouse semantics, §1.5-2)
# ---------------------------------------------------------------------------
def least_strict(*cols: ColumnOrName) -> Column:
    cs = [col(c) for c in cols]
    any_null = reduce(lambda x, y: x | y, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


# ---------------------------------------------------------------------------
# H08 age
# ---------------------------------------------------------------------------
def age_years(dob: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Completed years: floor(months_between(as_of, dob) / 12)."""
    return F.floor(F.months_between(col(as_of), col(dob)) / 12).cast("int")


# The published age groups and ten-year age bands.
def age_group(age: ColumnOrName) -> Column:
    a = col(age)
    return (F.when(a < 18, "Pediatric").when(a.between(18, 64), "Adult")
            .when(a >= 65, "Geriatric").otherwise("Unknown"))


def age_bucket(age: ColumnOrName) -> Column:
    a = col(age)
    out = F.when(a < 10, "0-9")
    for lo in range(10, 90, 10):
        out = out.when(a < lo + 10, f"{lo}-{lo + 9}")
    return out.when(a >= 90, "90+").otherwise("Unknown")


def is_pediatric(age: ColumnOrName) -> Column:
    return F.coalesce(col(age) < 18, F.lit(False))


def is_geriatric(age: ColumnOrName) -> Column:
    return F.coalesce(col(age) >= 65, F.lit(False))


# ---------------------------------------------------------------------------
# M05 ZIP Safe Harbor. 3-digit ZIP areas of 20,000 or fewer
# people that must be published as '000'.
# ---------------------------------------------------------------------------
RESTRICTED_ZIP3 = ["036", "059", "063", "102", "203", "556", "692", "790", "821",
                   "823", "830", "831", "878", "879", "884", "890", "893"]


def deidentify_zip(z: ColumnOrName) -> Column:
    z3 = F.substring(F.trim(col(z).cast("string")), 1, 3)
    return (F.when(col(z).isNull(), F.lit(None))
            .when(~z3.rlike("^[0-9]{3}"), F.lit("000"))
            .when(z3.isin(RESTRICTED_ZIP3), F.lit("000"))
            .otherwise(z3))


# ---------------------------------------------------------------------------
# H11 length of stay in midnights; H12 A/R ageing bucket
# ---------------------------------------------------------------------------
def los_midnights(admission: ColumnOrName, discharge: ColumnOrName) -> Column:
    a, d = col(admission), col(discharge)
    return (F.when(d.isNull(), F.lit(None)).when(d < a, F.lit(None))
            .otherwise(F.datediff(F.to_date(d), F.to_date(a))))


# The published ageing bands.
def ar_aging_bucket(days: ColumnOrName) -> Column:
    d = col(days)
    return (F.when(d.isNull(), "Unknown").when(d <= 30, "0-30").when(d <= 60, "31-60")
            .when(d <= 90, "61-90").when(d <= 120, "91-120").otherwise("120+"))


# ---------------------------------------------------------------------------
# H13 tenant-scoped surrogate key. Fixed value: the NULL placeholder string
# of the common surrogate-key convention.
# ---------------------------------------------------------------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: ColumnOrName) -> Column:
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def tenant_surrogate_key(*cols: ColumnOrName) -> Column:
    return surrogate_key("hospital_id", *cols)


# ---------------------------------------------------------------------------
# H14 severity rank; I13 readmission rate (aggregate expression)
# ---------------------------------------------------------------------------
# The order of severities.
SEVERITY_RANK = {"LIFE_THREATENING": 1, "SEVERE": 2, "MODERATE": 3, "MILD": 4}


def severity_rank(sev: ColumnOrName) -> Column:
    s = col(sev)
    out = None
    for k, v in SEVERITY_RANK.items():
        out = F.when(s == k, v) if out is None else out.when(s == k, v)
    return out.otherwise(5)


def readmission_rate(readmit: ColumnOrName, encounter_type: ColumnOrName) -> Column:
    inp = F.sum(F.when(col(encounter_type) == "Inpatient", 1).otherwise(0))
    re = F.sum(F.when(col(readmit) == F.lit(True), 1).otherwise(0))
    return F.when(inp > 0, re * 100.0 / inp).otherwise(F.lit(0.0))


# H16 delimited list split with trimming
def split_list(c: ColumnOrName, sep: str = ",") -> Column:
    return F.transform(F.split(col(c), sep), lambda x: F.trim(x))


def day_name(ts: ColumnOrName) -> Column:
    """Full English day name (the reference compares against 'Monday')."""
    return F.date_format(col(ts), "EEEE")
