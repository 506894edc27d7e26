"""Column expressions for cleaning, features and scoring.

Every function takes and returns Columns, so Catalyst folds them into one
projection and they also run on streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast.schema import CONTRACT_MONTHS, DEFAULTS, TENURE_COHORTS

_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def numeric_or_null(c: Column | str) -> Column:
    """Text to double; text that is not a plain number, or NaN, becomes null.

    The pattern comes first because the cast alone takes text such as ``12d``.
    """
    return F.regexp_extract(col(c).cast("string"), _NUMBER, 0).try_cast("double")


def is_yes(c: Column | str) -> Column:
    """1 for "Yes", 0 for anything else, missing included."""
    return F.coalesce((col(c) == "Yes").cast("int"), F.lit(0))


def flag(c: Column | str, no_value: int = 0) -> Column:
    """Yes to 1, No to ``no_value``, every other text and missing to 0."""
    c = col(c)
    return F.when(c == "Yes", 1).when(c == "No", no_value).otherwise(0)


def unit_clip(c: Column) -> Column:
    """Clip to [0, 1], keeping null (``greatest``/``least`` alone skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0)))


def lookup(c: Column | str, mapping: Mapping[str, object], default: object = None) -> Column:
    """Literal dictionary lookup."""
    c = col(c)
    out = None
    for text, value in mapping.items():
        out = F.when(c == text, value) if out is None else out.when(c == text, value)
    return out.otherwise(F.lit(default))


# --- features -----------------------------------------------------------------


def charge_volatility(
    monthly: Column | str = "MonthlyCharges",
    total: Column | str = "TotalCharges",
    tenure: Column | str = "tenure",
) -> Column:
    """Gap between the current charge and the lifetime average, relative, in [0, 1]."""
    monthly, total, tenure = col(monthly), col(total), col(tenure)
    average = F.when(tenure > 0, F.try_divide(total, tenure)).otherwise(monthly)
    return unit_clip(F.try_divide(F.abs(monthly - average), monthly + F.lit(1e-9)))


def service_density(present: Iterable[str], of: int) -> Column:
    """Share of ``of`` services in use; a missing flag or column counts as unused."""
    total = F.lit(0)
    for name in present:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total / F.lit(float(of))


def contract_months(c: Column | str = "Contract") -> Column:
    return lookup(c, CONTRACT_MONTHS, 1)


def support_recency(
    tech_support: Column | None,
    contract: Column | str = "Contract",
    tenure: Column | str = "tenure",
) -> Column:
    """Friction (monthly contract without support) decayed by tenure."""
    friction = col(contract) == "Month-to-month"
    if tech_support is not None:
        friction = friction & (tech_support == 0)
    return F.coalesce(friction, F.lit(False)).cast("int") / (F.lit(1.0) + F.log1p(col(tenure)))


def _by_cohort(tenure: Column, values: list) -> Column:
    out = None
    for i, (_, low, high) in enumerate(TENURE_COHORTS):
        # bins are right-closed: all but the first start just above the one before
        above = tenure >= low if i == 0 else tenure > TENURE_COHORTS[i - 1][2]
        inside = above & (tenure <= high)
        out = F.when(inside, values[i]) if out is None else out.when(inside, values[i])
    return out


def tenure_cohort_id(tenure: Column | str = "tenure") -> Column:
    """0-based cohort number; null outside the covered months."""
    return _by_cohort(col(tenure), list(range(len(TENURE_COHORTS))))


def tenure_cohort(tenure: Column | str = "tenure") -> Column:
    """Cohort label; null outside the covered months."""
    return _by_cohort(col(tenure), [label for label, _, _ in TENURE_COHORTS])


# --- revenue ------------------------------------------------------------------


def lifetime_value(monthly: Column | str = "MonthlyCharges", tenure: Column | str = "tenure") -> Column:
    """Value so far, ranked inside a tenure cohort."""
    return col(monthly) * col(tenure)


def estimated_clv(
    monthly: Column | str = "MonthlyCharges",
    tenure: Column | str = "tenure",
    extra_months: int = DEFAULTS.clv_extra_months,
) -> Column:
    """Value so far plus the next ``extra_months`` months."""
    return col(monthly) * (col(tenure) + F.lit(extra_months))


def revenue_at_risk(
    probability: Column | str = "churn_probability", clv: Column | str = "estimated_clv"
) -> Column:
    return col(probability) * col(clv)


def risk_tier(
    probability: Column | str = "churn_probability",
    threshold: float = DEFAULTS.threshold,
    critical: float = DEFAULTS.critical_risk,
) -> Column:
    p = col(probability)
    return F.when(p >= critical, "critical").when(p >= threshold, "high").when(p.isNotNull(), "low")


# --- scores -------------------------------------------------------------------


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 when the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        F.try_divide(part.cast("double"), whole.cast("double"))
    )


def fbeta_score(precision: Column | str, recall: Column | str, beta: float = DEFAULTS.beta) -> Column:
    """F-beta; recall weighs beta squared times as much as precision."""
    p, r = col(precision), col(recall)
    square = float(beta) ** 2
    return F.when(p + r == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.lit(1 + square) * (p * r), F.lit(square) * p + r)
    )


# --- report text --------------------------------------------------------------


def currency(c: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(col(c), 0))


def percent(c: Column | str, digits: int = 1) -> Column:
    return F.concat(F.format_number(col(c) * 100, digits), F.lit("%"))
