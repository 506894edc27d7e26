"""The retention workflow: read, clean, derive, split, learn, evaluate, rank, write."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.clean import AccountCleaner
from holdfast.operators.features import ChurnFeatures, predictions_table
from holdfast.operators.learn import BoostedChurnModel, ChallengerChurnModel
from holdfast.operators.metrics import ChurnEvaluator, churn_rate
from holdfast.operators.ranking import stratified_split
from holdfast.operators.report import get_high_risk_customers
from holdfast.schema import DEFAULTS
from holdfast.session import materialize
from holdfast.sources.sinks import write_features, write_report


def with_target(accounts: DataFrame) -> DataFrame:
    """Raw accounts with their label as ``_target``, for splits ahead of cleaning."""
    return accounts.withColumn("_target", F.coalesce(F.col(DEFAULTS.target) == "Yes", F.lit(False)))


def prepare(
    fit_rows: DataFrame, *parts: DataFrame, no_value: int = 0, percentile_mode: str = "batch"
) -> list[DataFrame]:
    """Cleaned feature tables of raw ``parts``, fitted on ``fit_rows`` alone, each written once."""
    cleaner = AccountCleaner(noValue=no_value).fit(fit_rows)
    features = ChurnFeatures(percentileMode=percentile_mode).fit(cleaner.transform(fit_rows))
    return [materialize(features.transform(cleaner.transform(p)).drop("_target")) for p in parts]


def run_pipeline(
    accounts: DataFrame,
    output: str | None = None,
    threshold: float = DEFAULTS.threshold,
    cost_fn: float = DEFAULTS.cost_fn,
    cost_fp: float = DEFAULTS.cost_fp,
    beta: float = DEFAULTS.beta,
    test_size: float = DEFAULTS.test_size,
    seed: int = DEFAULTS.seed,
    no_value: int = 0,
    percentile_mode: str = "batch",
    fit_on_all: bool = False,
    exclude: tuple[str, ...] = (),
    primary: dict[str, Any] | None = None,
    challenger: dict[str, Any] | None = None,
) -> dict[str, Any]:
    """Run the workflow on a raw account table.

    Cleaning and features are fitted on the training accounts; ``fit_on_all``
    fits and transforms all accounts together before the split. With ``output``
    the feature table, model, lists and curves are written below that folder.
    """
    target, key = DEFAULTS.target, DEFAULTS.key
    labelled = with_target(accounts)
    modes = {"no_value": no_value, "percentile_mode": percentile_mode}
    if fit_on_all:
        (table,) = prepare(labelled, labelled, **modes)
        train, test = stratified_split(table, target, key, test_size, seed)
    else:
        raw_train, raw_test = stratified_split(labelled, "_target", key, test_size, seed)
        train, test = prepare(raw_train, raw_train, raw_test, **modes)
        table = train.unionByName(test)

    lead = BoostedChurnModel(threshold, exclude, **(primary or {})).fit(train)
    rival = ChallengerChurnModel(threshold, exclude, **(challenger or {})).fit(train)

    evaluator = ChurnEvaluator(threshold, cost_fn, cost_fp, beta)
    scored = materialize(lead.predict_proba(test))
    rival_scored = materialize(rival.predict_proba(test))
    predictions = predictions_table(scored)
    high_risk = get_high_risk_customers(predictions, threshold=threshold)
    curve = evaluator.get_threshold_curve(scored)
    importance = lead.get_feature_importance()

    if output is not None:
        base = output.rstrip("/")
        write_features(table, f"{base}/features")
        lead.save(f"{base}/model")
        write_report(high_risk, f"{base}/high_risk_customers")
        write_report(curve, f"{base}/threshold_curve")
        write_report(importance, f"{base}/feature_importance")

    return {
        "eval_result": evaluator.evaluate(scored),
        "challenger_eval": evaluator.evaluate(rival_scored),
        "model": lead,
        "challenger": rival,
        "features": table,
        "split_rates": churn_rate(
            train.select(target, F.lit("train").alias("split")).unionByName(
                test.select(target, F.lit("test").alias("split"))
            ),
            by=["split"],
        ),
        "predictions": predictions,
        "high_risk": high_risk,
        "threshold_df": curve,
        "importance_df": importance,
        "lift_df": evaluator.get_lift_curve(scored),
    }
