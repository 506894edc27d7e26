import pytest
from pyspark.sql import functions as F

from holdfast.operators.clean import AccountCleaner
from holdfast.operators.features import ChurnFeatures
from holdfast.operators.learn import BoostedChurnModel
from holdfast.plans.pipeline import run_pipeline
from holdfast.plans.report import churn_report
from holdfast.sources import accounts_from_orders
from holdfast.streaming.scoring import risk_alerts, score_stream

FAST = {"trees": 2, "depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def accounts(spark, sf):
    return accounts_from_orders(spark, sf).drop("churn_probability")


@pytest.mark.parametrize("fit_on_all", [False, True])
def test_pipeline(accounts, spark, tmp_path, fit_on_all):
    out = str(tmp_path / "run")
    got = run_pipeline(accounts, out, fit_on_all=fit_on_all, primary=FAST, challenger=FAST)
    assert got["predictions"].count() == 300
    assert got["features"].count() == 1500
    assert 0.5 < got["eval_result"].first()["auc_roc"] <= 1
    assert 0.5 < got["challenger_eval"].first()["auc_roc"] <= 1
    assert got["lift_df"].count() == 10
    rates = {r["split"]: r["churn_rate"] for r in got["split_rates"].collect()}
    assert abs(rates["train"] - rates["test"]) < 0.002
    assert spark.read.parquet(f"{out}/features").count() == 1500
    high = spark.read.option("header", True).csv(f"{out}/high_risk_customers")
    assert high.count() == got["high_risk"].count()
    assert spark.read.option("header", True).csv(f"{out}/threshold_curve").count() == 16
    assert spark.read.option("header", True).csv(f"{out}/feature_importance").count() > 15
    report = churn_report(
        got["predictions"], got["importance_df"], got["threshold_df"], got["eval_result"], top=7
    )
    assert report["top_accounts"].count() <= 7
    assert report["kpis"].first()["recall"] == got["eval_result"].first()["recall"]
    assert report["importance"].count() == 15
    assert report["threshold_curve"].agg(F.max("normalized_cost")).first()[0] == 1.0
    assert report["score_histogram"].agg(F.sum("accounts")).first()[0] == 300


def test_stream_scores_like_a_batch(accounts, spark, tmp_path):
    cleaner = AccountCleaner().fit(accounts)
    clean = cleaner.transform(accounts)
    features = ChurnFeatures(percentileMode="fitted").fit(clean)
    model = BoostedChurnModel(**FAST).fit(features.transform(clean))
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    accounts.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(accounts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    alerts = risk_alerts(score_stream(stream, cleaner, features, model))
    run = (
        alerts.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start(sink)
    )
    assert run.awaitTermination(300)
    batch = risk_alerts(score_stream(accounts, cleaner, features, model))
    streamed = spark.read.parquet(sink)
    assert streamed.count() > 0
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0
    assert streamed.count() == batch.count()
    with pytest.raises(ValueError):
        score_stream(accounts, cleaner, ChurnFeatures().fit(clean), model)
