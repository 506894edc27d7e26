"""The tables behind the panels of the retention report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast.operators import report as R
from holdfast.operators.metrics import normalized_cost
from holdfast.operators.segments import score_distribution, score_histogram
from holdfast.schema import DEFAULTS


def churn_report(
    predictions: DataFrame,
    importance: DataFrame | None = None,
    curve: DataFrame | None = None,
    evaluation: DataFrame | None = None,
    threshold: float = DEFAULTS.threshold,
    top: int = 50,
    max_value: float = DEFAULTS.gauge_max,
) -> dict[str, DataFrame]:
    """Named tables: KPI row and text, gauge, distributions, curve, importance, top list."""
    kpis = R.kpi_row(predictions, evaluation, threshold=threshold)
    out = {
        "kpis": kpis,
        "kpi_text": R.kpi_text(kpis),
        "gauge": R.revenue_gauge(R.revenue_summary(predictions, threshold=threshold), max_value),
        "score_distribution": score_distribution(predictions),
        "score_histogram": score_histogram(predictions),
        "top_accounts": R.risk_tiers(
            R.get_high_risk_customers(predictions, threshold=threshold, top=top),
            threshold=threshold,
        ),
    }
    if curve is not None:
        out["threshold_curve"] = normalized_cost(curve)
    if importance is not None:
        out["importance"] = R.top_features(importance)
    return out
