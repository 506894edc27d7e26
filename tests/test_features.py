import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators.features import ChurnFeatures, cohort_clv_percentile, cohort_stats, row_features
from holdfast.schema import ENGINEERED_COLUMNS, SERVICE_COLUMNS


@pytest.fixture(scope="module")
def frame():
    """Every cohort, contract and service count comes up; charges follow tenure."""
    draw = np.random.default_rng(5)
    number = np.arange(132)
    tenure = 1 + number * 5 % 71
    charge = 18.5 + number * 37 % 95
    flags = {name: (number >> bit) & 1 for bit, name in enumerate(SERVICE_COLUMNS)}
    return pd.DataFrame(
        {
            "customerID": [f"K-{i:03d}" for i in number],
            "tenure": tenure,
            "MonthlyCharges": charge,
            "TotalCharges": (charge * tenure * draw.lognormal(0, 0.2, len(number))).round(2),
            "Contract": np.array(["Two year", "Month-to-month", "One year", "Month-to-month"])[number % 4],
            **flags,
            "Churn": (draw.random(len(number)) < 0.27).astype(int),
        }
    )


@pytest.fixture(scope="module")
def result(spark, frame):
    df = spark.createDataFrame(frame)
    return ChurnFeatures().fit(df).transform(df).toPandas()


def test_all_features_present(result):
    assert set(ENGINEERED_COLUMNS) <= set(result.columns)


def test_ranges(result):
    assert result["service_adoption_density"].between(0, 1).all()
    assert (result["charge_volatility_ratio"] >= 0).all()
    assert result["cohort_clv_percentile"].between(0, 1, inclusive="right").all()
    assert (result["tenure_contract_interaction"] > 0).all()


def test_values_match_pandas(frame, result):
    f = frame.set_index("customerID")
    r = result.set_index("customerID").loc[f.index]
    average = f["TotalCharges"] / f["tenure"]
    want = ((f["MonthlyCharges"] - average).abs() / (f["MonthlyCharges"] + 1e-9)).clip(0, 1)
    np.testing.assert_array_equal(r["charge_volatility_ratio"], want)
    np.testing.assert_array_equal(r["service_adoption_density"], f[SERVICE_COLUMNS].sum(axis=1) / 8)
    cohort = pd.cut(f["tenure"], [0, 12, 24, 36, 48, 72], include_lowest=True)
    want = (f["MonthlyCharges"] * f["tenure"]).groupby(cohort, observed=False).rank(pct=True)
    np.testing.assert_array_equal(r["cohort_clv_percentile"], want)
    friction = (f["TechSupport"] == 0) & (f["Contract"] == "Month-to-month")
    np.testing.assert_allclose(r["support_recency_score"], friction / (1 + np.log1p(f["tenure"])), rtol=1e-15)


def test_fit_on_train_transform_test(spark, frame):
    train, test = spark.createDataFrame(frame[:80]), spark.createDataFrame(frame[80:])
    out = ChurnFeatures().fit(train).transform(test).toPandas()
    assert out[[c for c in ENGINEERED_COLUMNS if c != "support_recency_score"]].notna().all().all()


def test_missing_service_columns_keep_the_divisor(spark):
    df = spark.createDataFrame([(5, 10.0, 50.0, "One year", 1)], "tenure int, MonthlyCharges double, TotalCharges double, Contract string, PhoneService int")
    assert row_features(df).first()["service_adoption_density"] == 1 / 8


def test_cohort_stats_keeps_empty_cohorts(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (80, 1.0)], "tenure int, MonthlyCharges double")
    rows = {r["tenure_cohort"]: r for r in cohort_stats(df).collect()}
    assert len(rows) == 5
    assert rows["0-12m"]["mean"] == 15.0 and rows["0-12m"]["std"] == pytest.approx(np.std([10, 20], ddof=1))
    assert rows["49-72m"]["mean"] is None


def test_fitted_statistics(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("b", 2, 10.0)], "customerID string, tenure int, MonthlyCharges double")
    stats = ChurnFeatures().fit(df).cohort_clv_stats
    assert stats["0-12m"]["mean"] == 15.0 and np.isnan(stats["13-24m"]["mean"])


def test_fitted_percentile_does_not_depend_on_the_batch(spark, frame):
    df = spark.createDataFrame(frame)
    model = ChurnFeatures(percentileMode="fitted").fit(df)
    whole = model.transform(df).select("customerID", "cohort_clv_percentile")
    part = model.transform(df.where("tenure > 30")).select("customerID", "cohort_clv_percentile")
    assert part.exceptAll(whole).count() == 0
    exact = cohort_clv_percentile(df).select("customerID", F.col("cohort_clv_percentile").alias("exact"))
    gap = whole.join(exact, "customerID").agg(F.max(F.abs(F.col("exact") - F.col("cohort_clv_percentile")))).first()[0]
    assert gap < 0.1  # cohorts of a dozen rows; steps of one row


def test_edge_rows(spark):
    rows = [("a", None, 10.0), ("b", 0, 10.0), ("c", 12, 10.0), ("d", 73, 10.0), ("e", 5, None), ("f", -1, 3.0)]
    df = spark.createDataFrame(rows, "customerID string, tenure int, MonthlyCharges double")
    got = {r[0]: r["cohort_clv_percentile"] for r in cohort_clv_percentile(df).collect()}
    assert got == {"a": None, "b": 0.5, "c": 1.0, "d": None, "e": None, "f": None}
