import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from holdfast.operators import metrics as M
from holdfast.operators.report import get_high_risk_customers

SMALL = {"rows_per_cell": 10, "max_cells": 16}


def scored(spark, n, shift, seed=11, decimals=None):
    """A third of the accounts churn; scores are logistic, moved up by ``shift`` for those that do."""
    draw = np.random.default_rng(seed)
    y = (draw.random(n) < 1 / 3).astype(int)
    p = 1 / (1 + np.exp(0.8 - 5 * shift * y - draw.normal(0, 1.2, n)))
    if decimals is not None:
        p = np.round(p, decimals)
    frame = pd.DataFrame({"customerID": [f"C{i}" for i in range(n)], "Churn": y, "churn_probability": p})
    return frame, spark.createDataFrame(frame).repartition(3)


def brute_auc(y, p):
    a, b = p[y == 1][:, None], p[y == 0][None, :]
    return ((a > b) + (a == b) / 2).mean()


def brute_ap(y, p):
    out, last = 0.0, 0.0
    for s in np.unique(p)[::-1]:
        hit = p >= s
        recall = y[hit].sum() / y.sum()
        out += (recall - last) * y[hit].mean()
        last = recall
    return out


def test_cost_matrix_by_hand(spark):
    # three caught, one missed, two flagged in vain, four left alone: 500 + 2 * 50 lost, 3 * 500 saved
    rows = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    got = M.business_cost_matrix(spark.createDataFrame(rows, "Churn int, predicted int")).first().asDict()
    assert got["true_positives"] == 3 and got["true_negatives"] == 4
    assert got["false_positives"] == 2 and got["false_negatives"] == 1
    assert got["total_business_cost_usd"] == 600.0 and got["estimated_revenue_saved_usd"] == 1500.0


def test_missed_churn_costs_more(spark):
    y = [1, 0, 0, 0, 1, 0, 1]
    costs = []
    for predicted in (1, 0):
        df = spark.createDataFrame([(v, predicted) for v in y], "Churn int, predicted int")
        costs.append(M.business_cost_matrix(df).first()["total_business_cost_usd"])
    assert costs == [200.0, 1500.0]


@pytest.mark.parametrize("decimals,cells", [(None, {}), (2, {}), (2, SMALL), (None, SMALL)])
def test_evaluation(spark, decimals, cells):
    frame, df = scored(spark, 200, 0.3, decimals=decimals)
    y, p = frame["Churn"].to_numpy(), frame["churn_probability"].to_numpy()
    row = M.ChurnEvaluator().evaluate(df, **cells).first()
    assert row["auc_roc"] == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert row["auc_pr"] == pytest.approx(brute_ap(y, p), abs=1e-12)
    tp = int(((p >= 0.4) & (y == 1)).sum())
    assert row["true_positives"] == tp
    precision, recall = tp / (p >= 0.4).sum(), tp / y.sum()
    assert row["precision"] == precision and row["recall"] == recall
    assert row["f2_score"] == pytest.approx(5 * precision * recall / (4 * precision + recall))
    assert row["threshold_used"] == 0.4


def test_areas_match_spark_ml(spark):
    _, df = scored(spark, 300, 0.3, decimals=2)
    ml = df.withColumn("Churn", F.col("Churn").cast("double"))
    for metric, mine in (
        ("areaUnderROC", M.roc_auc(df)),
        ("areaUnderPR", M.average_precision(df, trapezoid=True)),
    ):
        theirs = BinaryClassificationEvaluator(
            rawPredictionCol="churn_probability", labelCol="Churn", metricName=metric, numBins=0
        ).evaluate(ml)
        assert mine.first()[0] == pytest.approx(theirs, abs=1e-12)


def test_one_sided_labels(spark):
    df = spark.createDataFrame([("a", 0, 0.1), ("b", 0, 0.2)], "customerID string, Churn int, churn_probability double")
    row = M.ChurnEvaluator().evaluate(df).first()
    assert row["auc_roc"] is None and row["auc_pr"] is None
    assert (row["precision"], row["recall"], row["f2_score"]) == (0.0, 0.0, 0.0)


def test_threshold_curve(spark):
    frame, df = scored(spark, 300, 0.25)
    curve = M.ChurnEvaluator().get_threshold_curve(df).toPandas()
    assert curve["threshold"].tolist() == [k / 100 for k in range(10, 90, 5)]
    y, p = frame["Churn"].to_numpy(), frame["churn_probability"].to_numpy()
    for _, row in curve.iterrows():
        flagged = p >= row["threshold"]
        assert row["flagged_customers"] == flagged.sum()
        assert row["recall"] == y[flagged].sum() / y.sum()
        assert row["business_cost_usd"] == 500 * y[~flagged].sum() + 50 * (1 - y[flagged]).sum()
    assert curve["flagged_customers"].is_monotonic_decreasing
    assert curve["recall"].is_monotonic_decreasing
    best = M.best_threshold(M.threshold_curve(df)).first()
    assert best["f2_score"] == curve["f2_score"].max()
    assert M.normalized_cost(M.threshold_curve(df)).agg(F.max("normalized_cost")).first()[0] == 1.0


def test_threshold_is_inclusive_and_nothing_flagged(spark):
    df = spark.createDataFrame([(1, 0.4), (0, 0.1)], "Churn int, churn_probability double")
    curve = {r["threshold"]: r for r in M.threshold_curve(df).collect()}
    assert curve[0.4]["flagged_customers"] == 1
    assert curve[0.45]["flagged_customers"] == 0 and curve[0.45]["precision"] == 0.0


def test_lift(spark):
    _, df = scored(spark, 500, 0.3)
    lift = M.ChurnEvaluator().get_lift_curve(df).toPandas()
    assert lift["bin"].tolist() == list(range(1, 11)) and (lift["accounts"] == 50).all()
    assert lift["lift"].iloc[0] > 1
    assert lift["cumulative_gain"].iloc[-1] == 1.0


@pytest.mark.parametrize("decimals", [0, 1])
@pytest.mark.parametrize("n,bins", [(203, 10), (97, 7), (5, 10)])
def test_lift_with_heavy_ties(spark, decimals, n, bins):
    import hashlib

    frame, df = scored(spark, n, 0.3, decimals=decimals)
    got = M.lift_curve(df, bins=bins, **SMALL).toPandas().set_index("bin")
    frame["d"] = [hashlib.md5(f"42:{k}".encode()).hexdigest() for k in frame["customerID"]]
    order = frame.sort_values(["churn_probability", "d"], ascending=[False, True]).reset_index(drop=True)
    order["bin"] = order.index * bins // n + 1
    want = order.groupby("bin")["Churn"].agg(["size", "sum"])
    assert got["accounts"].to_dict() == want["size"].to_dict()
    assert got["churned"].to_dict() == want["sum"].to_dict()


def test_high_risk_by_hand(spark):
    rows = [("u", 0.39, 9000.0), ("v", 0.40, 250.0), ("w", 0.95, 120.0), ("x", 0.02, 700.0), ("y", 0.55, 60.0)]
    df = spark.createDataFrame(rows, "customerID string, churn_probability double, estimated_clv double")
    got = [(r["customerID"], round(r["revenue_at_risk"], 6)) for r in get_high_risk_customers(df).collect()]
    assert got == [("w", 114.0), ("v", 100.0), ("y", 33.0)]
    assert [r[0] for r in get_high_risk_customers(df, top=1).collect()] == ["w"]


def test_weighted_fbeta(spark):
    rows = [(1, 0.9, 100.0), (1, 0.1, 300.0), (0, 0.8, 50.0)]
    df = spark.createDataFrame(rows, "Churn int, churn_probability double, estimated_clv double")
    row = M.revenue_weighted_fbeta(df).first()
    p, r = 100 / 150, 100 / 400
    assert row["weighted_fbeta"] == pytest.approx(5 * p * r / (4 * p + r))
