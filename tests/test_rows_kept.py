"""No row is lost, and no search goes on forever, whatever keys and labels are missing."""

from holdfast.operators import learn as L
from holdfast.operators import ranking as R
from holdfast.operators.lookups import attach_attributes
from holdfast.operators.report import kpi_row


def table(spark, null_keys=0, null_labels=0, n=100):
    rows = [(None if i < null_keys else f"k{i}", None if n - i <= null_labels else i % 3 == 0) for i in range(n)]
    return spark.createDataFrame([(k, None if y is None else int(y)) for k, y in rows], "customerID string, Churn int")


def test_split_keeps_every_row(spark):
    for df in (table(spark), table(spark, null_keys=10), table(spark, null_labels=10), table(spark, 50, 20)):
        train, test = R.stratified_split(df, "Churn", "customerID")
        assert train.count() + test.count() == 100


def test_split_is_exact_with_missing_labels(spark):
    train, test = R.stratified_split(table(spark, null_labels=10), "Churn", "customerID")
    assert test.count() == 20
    assert test.where("Churn is null").count() == 2


def test_folds_end_with_half_the_keys_missing(spark):
    folded = R.stratified_folds(table(spark, null_keys=50), "Churn", "customerID", 5)
    assert folded.count() == 100 and folded.where("fold is null").count() == 0


def test_empty_split(spark):
    train, test = R.stratified_split(table(spark, n=0), "Churn", "customerID")
    assert train.count() + test.count() == 0


def test_attributes_may_be_missing(spark):
    scored = spark.createDataFrame([("a", 0.5), ("b", 0.7)], "customerID string, p double")
    known = spark.createDataFrame([("a", "One year")], "customerID string, Contract string")
    got = {r["customerID"]: r["Contract"] for r in attach_attributes(scored, known, ["Contract"]).collect()}
    assert got == {"a": "One year", "b": None}


def test_one_row_per_evaluation(spark):
    scored = spark.createDataFrame([("a", 0.9, 10.0, 9.0)], "customerID string, churn_probability double, estimated_clv double, revenue_at_risk double")
    two = spark.createDataFrame([(0.5, 0.8), (0.6, 0.7)], "recall double, auc_roc double")
    assert kpi_row(scored, two).count() == 2 and kpi_row(scored, two.limit(0)).count() == 1


def test_search_leaves_the_model_alone(spark):
    model = L.BoostedChurnModel(0.3, exclude=("a",))
    rows = [(f"k{i}", i % 2, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "customerID string, Churn int, x double")
    model.params.update({"maxIter": 1} if "maxIter" in model.params else {})
    L.search(df, model, {"maxIter": [1]}, folds=2)
    assert model.exclude == ("a",)
