"""Plan checks: no row-level data in a single task, pruning, one shuffle of rows."""

import re

import pytest
from pyspark.sql import functions as F

from holdfast.operators import metrics as M
from holdfast.operators import survival as S
from holdfast.operators.features import cohort_clv_percentile, row_features
from holdfast.operators.ranking import stratified_folds, stratified_split
from holdfast.operators.report import get_high_risk_customers

SMALL = {"rows_per_cell": 50, "max_cells": 32}


@pytest.fixture(scope="module")
def scored(spark, sf, tmp_path_factory):
    from holdfast.plans.queries import cleaned

    path = str(tmp_path_factory.mktemp("plans") / "scored")
    df = cleaned(spark, sf).withColumn("estimated_clv", F.col("MonthlyCharges") * 10)
    df.write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_inputs(text):
    """First operator below each single-task exchange that is no projection."""
    lines = [x.strip(" :+-*()0123456789") for x in text.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Exchange SinglePartition"):
            yield next(x for x in lines[i + 1 :] if not x.startswith(("Project", "Filter")))


@pytest.mark.parametrize(
    "make",
    [
        lambda df: cohort_clv_percentile(df, **SMALL),
        lambda df: M.ChurnEvaluator().evaluate(df, **SMALL),
        lambda df: M.threshold_curve(df),
        lambda df: M.lift_curve(df, **SMALL),
        lambda df: S.concordance(df, "churn_probability", **SMALL),
        lambda df: S.kaplan_meier(df),
    ],
    ids=["percentile", "evaluate", "thresholds", "lift", "concordance", "kaplan_meier"],
)
def test_single_tasks_see_only_aggregates(scored, make):
    for below in single_inputs(plan(make(scored))):
        assert re.match(r"HashAggregate|ObjectHashAggregate|SortAggregate", below), below


def test_split_and_folds_do_not_shuffle(scored):
    for df in (*stratified_split(scored, "Churn", "customerID"), stratified_folds(scored, "Churn", "customerID")):
        assert "Exchange" not in plan(df)


def test_row_features_do_not_shuffle(scored):
    assert "Exchange" not in plan(row_features(scored))


def test_percentile_shuffles_rows_once(scored):
    text = plan(cohort_clv_percentile(scored, **SMALL))
    above_broadcast = text.split("BroadcastExchange")[0]
    assert above_broadcast.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in text


def test_high_risk_filter_is_pushed_and_columns_pruned(scored):
    text = plan(get_high_risk_customers(scored).select("customerID", "revenue_at_risk"))
    assert "GreaterThanOrEqual(churn_probability,0.4)" in text
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "TechSupport" not in schema


def test_top_list_needs_no_full_sort(scored):
    assert "TakeOrderedAndProject" in plan(get_high_risk_customers(scored, top=50))


def test_no_cross_joins(scored):
    for df in (M.ChurnEvaluator().evaluate(scored), M.lift_curve(scored), S.concordance(scored, "churn_probability")):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    "make",
    [
        lambda df: M.ChurnEvaluator().evaluate(df, **SMALL),
        # one level of cells
        lambda df: S.concordance(df, "churn_probability", **{**SMALL, "max_cells": 4096}),
    ],
    ids=["evaluate", "concordance"],
)
def test_running_totals_read_the_shuffled_table_twice_and_the_input_once(scored, make):
    conf = scored.sparkSession.conf
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables beyond the limit
    try:
        df = make(scored)
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
    finally:
        conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert final.count("ReusedExchange") == 1
    assert final.count("FileScan") == 1
