import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from holdfast.operators.clean import AccountCleaner, AccountCleanerModel, drop_non_features, missing_report
from holdfast.operators.features import ChurnFeatures
from holdfast.sources import accounts_from_orders


def test_median_counts_only_numbers(spark):
    rows = [("1",), ("3",), ("10",), (" ",), (None,), ("12d",), ("NaN",)]
    df = spark.createDataFrame(rows, "TotalCharges string")
    model = AccountCleaner().fit(df)
    assert model.median_total_charges == 3.0
    got = [r["TotalCharges"] for r in model.transform(df).collect()]
    assert got == [1.0, 3.0, 10.0, 3.0, 3.0, 3.0, 3.0]
    assert tuple(missing_report(df).first()) == (7, 4)


def test_fill_uses_the_fitted_median(spark):
    train = spark.createDataFrame([("2",), ("4",)], "TotalCharges string")
    test = spark.createDataFrame([("100",), (" ",)], "TotalCharges string")
    got = [r[0] for r in AccountCleaner().fit(train).transform(test).collect()]
    assert got == [100.0, 3.0]


def test_no_number_at_all(spark):
    df = spark.createDataFrame([(" ",)], "TotalCharges string")
    assert AccountCleaner().fit(df).transform(df).first()[0] is None


def test_only_text_flags_are_coded(spark):
    df = spark.createDataFrame([("1", 7, "No", "Yes")], "TotalCharges string, Partner int, TechSupport string, Churn string")
    row = AccountCleaner(noValue=1).fit(df).transform(df).first()
    assert (row["Partner"], row["TechSupport"], row["Churn"]) == (7, 1, 1)


def test_same_columns_same_order(spark, sf):
    raw = accounts_from_orders(spark, sf)
    assert AccountCleaner().fit(raw).transform(raw).columns == raw.columns


def test_median_equals_numpy(spark, sf):
    raw = accounts_from_orders(spark, sf)
    values = raw.where("TotalCharges <> ' '").select(F.col("TotalCharges").cast("double")).toPandas()
    assert AccountCleaner().fit(raw).median_total_charges == np.median(values)


def test_pipeline_round_trip(spark, sf, tmp_path):
    raw = accounts_from_orders(spark, sf)
    fitted = Pipeline(stages=[AccountCleaner(noValue=1), ChurnFeatures(percentileMode="fitted")]).fit(raw)
    path = str(tmp_path / "prep")
    fitted.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], AccountCleanerModel)
    assert fitted.transform(raw).exceptAll(again.transform(raw)).count() == 0


def test_feature_selection(spark, sf):
    df = accounts_from_orders(spark, sf).withColumn("contract_months", F.lit(1))
    left = drop_non_features(df)
    assert not {"customerID", "Churn", "contract_months"} & set(left)
    assert len(left) == len(df.columns) - 3


def test_bad_mode():
    with pytest.raises(ValueError):
        ChurnFeatures(percentileMode="other")
