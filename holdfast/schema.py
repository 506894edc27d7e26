"""Account table layout and default parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 21 account columns, in file order.
ACCOUNT_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),  # text: blank for new accounts
        T.StructField("Churn", T.StringType()),
    ]
)
ACCOUNT_COLUMNS = ACCOUNT_SCHEMA.fieldNames()

# yes/no columns that cleaning turns into 0/1.
FLAG_COLUMNS = [
    "Partner",
    "Dependents",
    "PhoneService",
    "PaperlessBilling",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]

# The eight services behind the adoption density.
SERVICE_COLUMNS = [
    "PhoneService",
    "MultipleLines",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]

# Model inputs treated as categories.
CATEGORICAL_COLUMNS = ["Contract", "PaymentMethod", "InternetService", "gender"]

# Contract length in months; anything else counts as 1.
CONTRACT_MONTHS = {"Month-to-month": 1, "One year": 12, "Two year": 24}

# Tenure cohorts as (label, lowest month, highest month), both included.
TENURE_COHORTS = [
    ("0-12m", 0, 12),
    ("13-24m", 13, 24),
    ("25-36m", 25, 36),
    ("37-48m", 37, 48),
    ("49-72m", 49, 72),
]

ENGINEERED_COLUMNS = [
    "charge_volatility_ratio",
    "service_adoption_density",
    "tenure_contract_interaction",
    "support_recency_score",
    "cohort_clv_percentile",
]


@dataclass(frozen=True)
class Defaults:
    """Default parameters of the retention workflow."""

    key: str = "customerID"
    target: str = "Churn"
    test_size: float = 0.2
    seed: int = 42
    folds: int = 5
    threshold: float = 0.40
    beta: float = 2.0
    cost_fn: float = 500.0
    cost_fp: float = 50.0
    clv_extra_months: int = 6
    fallback_account_value: float = 250.0
    critical_risk: float = 0.7
    gauge_max: float = 5_000_000.0
    gauge_low: float = 0.3
    gauge_high: float = 0.6
    trees: int = 500
    learning_rate: float = 0.05
    depth: int = 6
    min_child_rows: int = 20
    subsample: float = 0.8
    positive_weight: float = 3.0
    top_features: int = 15
    fit_rows: int = 1_000_000


DEFAULTS = Defaults()
