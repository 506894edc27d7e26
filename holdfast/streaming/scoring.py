"""Score accounts as they arrive.

Cleaning, the features (with percentiles against the fitted cohorts) and both
kinds of model are projections, so a stream needs no state and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast.functions import columns as C
from holdfast.operators.clean import AccountCleanerModel
from holdfast.operators.features import ChurnFeaturesModel
from holdfast.operators.report import high_risk
from holdfast.schema import DEFAULTS


def score_stream(
    accounts: DataFrame, cleaner: AccountCleanerModel, features: ChurnFeaturesModel, model
) -> DataFrame:
    """Raw account stream to scored accounts with estimated value."""
    if features.getOrDefault("percentileMode") != "fitted":
        raise ValueError("streams need ChurnFeatures(percentileMode='fitted')")
    scored = model.predict_proba(features.transform(cleaner.transform(accounts)))
    return scored.withColumn("estimated_clv", C.estimated_clv())


def risk_alerts(scored: DataFrame, threshold: float = DEFAULTS.threshold) -> DataFrame:
    """Only accounts at or above the threshold, with revenue at risk and tier."""
    return high_risk(scored, threshold).withColumn("risk_tier", C.risk_tier(threshold=threshold))
