"""Risk lists and the figures of the retention report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.schema import DEFAULTS


def high_risk(
    df: DataFrame,
    threshold: float = DEFAULTS.threshold,
    probability: str = "churn_probability",
    clv: str = "estimated_clv",
) -> DataFrame:
    """Accounts at or above the threshold with their revenue at risk, unordered."""
    return df.where(F.col(probability) >= threshold).withColumn(
        "revenue_at_risk", C.revenue_at_risk(probability, clv)
    )


def get_high_risk_customers(
    df: DataFrame,
    churn_proba_col: str = "churn_probability",
    threshold: float = DEFAULTS.threshold,
    clv_col: str = "estimated_clv",
    top: int | None = None,
    key: str = DEFAULTS.key,
) -> DataFrame:
    """Accounts to contact, dearest first; the key settles ties.

    With ``top`` only the first rows are kept, found without a full sort.
    """
    out = high_risk(df, threshold, churn_proba_col, clv_col).orderBy(F.desc("revenue_at_risk"), key)
    return out if top is None else out.limit(top)


def risk_tiers(df: DataFrame, probability: str = "churn_probability", **levels: float) -> DataFrame:
    return df.withColumn("risk_tier", C.risk_tier(probability, **levels))


def revenue_summary(
    df: DataFrame,
    probability: str = "churn_probability",
    threshold: float = DEFAULTS.threshold,
) -> DataFrame:
    """One row: accounts at or above the threshold and their revenue at risk.

    Without a revenue column each such account counts with a flat value.
    """
    risky = F.col(probability) >= threshold
    accounts = F.count_if(risky)
    if "revenue_at_risk" in df.columns:
        money = F.coalesce(F.sum(F.when(risky, F.col("revenue_at_risk"))), F.lit(0.0))
    else:
        money = accounts * F.lit(DEFAULTS.fallback_account_value)
    return df.agg(accounts.alias("high_risk_accounts"), money.alias("revenue_at_risk"))


def revenue_gauge(summary: DataFrame, max_value: float = DEFAULTS.gauge_max) -> DataFrame:
    """Add the gauge reading: band, distance to the lower mark, alarm at the upper one."""
    low, high = max_value * DEFAULTS.gauge_low, max_value * DEFAULTS.gauge_high
    money = F.col("revenue_at_risk")
    return summary.withColumns(
        {
            "band": F.when(money < low, "low").when(money <= high, "medium").otherwise("high"),
            "delta": money - F.lit(low),
            "alarm": money >= high,
        }
    )


def kpi_row(
    df: DataFrame,
    evaluation: DataFrame | None = None,
    probability: str = "churn_probability",
    threshold: float = DEFAULTS.threshold,
) -> DataFrame:
    """Revenue at risk, high-risk accounts, recall and AUC; one row for each evaluation.

    Without one, or with an empty table of them, it is one row with null model figures.
    """
    summary = revenue_summary(df, probability, threshold)
    if evaluation is None:
        return summary.withColumns(
            {"recall": F.lit(None).cast("double"), "auc_roc": F.lit(None).cast("double")}
        )
    one = F.lit(1)
    right = evaluation.select("recall", "auc_roc").withColumn("_one", one)
    return summary.withColumn("_one", one).join(right, "_one", "left").drop("_one")


def kpi_text(kpis: DataFrame) -> DataFrame:
    """The KPI row as display text."""
    missing = F.lit("N/A")
    return kpis.select(
        C.currency("revenue_at_risk").alias("revenue_at_risk"),
        F.format_number("high_risk_accounts", 0).alias("high_risk_accounts"),
        F.coalesce(C.percent("recall"), missing).alias("recall"),
        F.coalesce(F.format_number("auc_roc", 3), missing).alias("auc_roc"),
    )


def top_features(importance: DataFrame, top_n: int = DEFAULTS.top_features) -> DataFrame:
    return importance.orderBy(F.desc("importance_gain"), "feature").limit(top_n)
