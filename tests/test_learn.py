import pytest
from pyspark.sql import functions as F

from holdfast.operators import learn as L
from holdfast.operators.metrics import roc_auc
from holdfast.operators.ranking import stratified_split, time_folds
from holdfast.operators.tuning import RuleModel, StackedModel
from holdfast.plans.queries import training_table
from holdfast.schema import CATEGORICAL_COLUMNS

FAST = {"trees": 3, "depth": 3, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def table(spark, sf):
    return training_table(spark, sf).cache()


@pytest.fixture(scope="module")
def parts(table):
    return stratified_split(table, "Churn", "customerID")


@pytest.fixture(scope="module")
def boosted(parts):
    return L.BoostedChurnModel(**FAST).fit(parts[0])


def test_scores(boosted, parts):
    scored = boosted.predict_proba(parts[1])
    assert scored.count() == 300
    assert scored.where("churn_probability BETWEEN 0 AND 1").count() == 300
    assert scored.where("predicted <> cast(churn_probability >= 0.4 AS int)").count() == 0
    assert roc_auc(scored).first()[0] > 0.55


def test_importance(boosted, spark):
    rows = boosted.get_feature_importance(spark).collect()
    gains = [r["importance_gain"] for r in rows]
    assert gains == sorted(gains, reverse=True) and gains[0] > 1  # raw, not scaled
    assert sum(r["importance_share"] for r in rows) == pytest.approx(1.0)
    assert all((r["splits"] > 0) == (r["importance_gain"] > 0) for r in rows)
    assert {"tenure", "Contract"} <= {r["feature"] for r in rows}


def test_save_and_load(boosted, parts, tmp_path):
    path = str(tmp_path / "model")
    boosted.save(path)
    again = L.BoostedChurnModel(**FAST).load(path)
    a = boosted.predict_proba(parts[1]).select("customerID", "churn_probability")
    assert a.exceptAll(again.predict_proba(parts[1]).select("customerID", "churn_probability")).count() == 0


def test_challenger_with_unseen_category(parts):
    model = L.ChallengerChurnModel(**FAST).fit(parts[0])
    odd = parts[1].withColumn("Contract", F.when(F.col("tenure") > 40, F.col("Contract")).otherwise("new"))
    scored = model.predict_proba(odd.withColumn("gender", F.lit(None).cast("string")))
    assert scored.where("churn_probability BETWEEN 0 AND 1").count() == 300


def test_inputs(table):
    numeric, categorical = L.feature_groups(table)
    assert sorted(categorical) == sorted(CATEGORICAL_COLUMNS)
    assert not {"Churn", "contract_months", "customerID"} & {*numeric, *categorical}
    assert L.categorical_positions(["tenure", "Contract", "gender"]) == [1, 2]


def test_out_of_fold_covers_every_account(table):
    make = lambda: L.BoostedChurnModel(**{**FAST, "trees": 1}, exclude=("fold",))
    out = L.out_of_fold_scores(table, make, folds=2)
    assert out.count() == table.count() == out.select("customerID").distinct().count()


def test_folds_read_their_input_once(spark, table, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: read.add(1) or v, "double")
    raw = table.withColumn("MonthlyCharges", count("MonthlyCharges"))
    make = lambda: RuleModel("tenure", 12)
    fitted = lambda rows, *parts: [p.where(F.lit(rows.agg(F.max("MonthlyCharges")).first()[0]) > 0) for p in parts]
    monkeypatch.setattr(L, "ROWS_PER_FILE", 100)  # cut into many files
    out = L.out_of_fold_scores(raw, make, folds=3, prepare=fitted)
    assert out.select("customerID", "MonthlyCharges").distinct().count() == table.count()
    assert read.value == table.count()
    read.value = 0
    stacked = StackedModel({"rule": make}, folds=3).fit(raw, prepare=fitted)
    assert set(stacked.weights) == {"rule"} and read.value == table.count()


def test_forward_scores(table):
    make = lambda: L.BoostedChurnModel(**{**FAST, "trees": 1}, exclude=("fold",))
    folded = time_folds(table, "tenure", 2)
    out = L.forward_scores(folded, make, "fold", 2)
    assert out.count() == folded.where("fold = 1").count()


def test_ensemble(spark):
    df = spark.createDataFrame([(0.2, 0.8, None), (0.2, 0.8, 0.5)], "a double, b double, c double")
    assert [r[0] for r in L.ensemble(df, {"a": 3, "b": 1}, "p").select("p").collect()] == [pytest.approx(0.35)] * 2
    assert [r[0] for r in L.ensemble(df, {"a": 1, "c": 1}, "p").select("p").collect()] == [None, pytest.approx(0.35)]


def test_permutation_moves_every_value_once(spark, monkeypatch):
    monkeypatch.setattr(L, "_CYCLE_ROWS", 100)
    df = spark.range(1000).select(F.col("id").cast("string").alias("customerID"), F.col("id").alias("v"), (F.col("id") * 2).alias("w"))
    out = L.permute_columns(df, ["v", "w"]).cache()
    assert out.select("v__other").distinct().count() == 1000
    assert out.where("w__other <> 2 * v__other").count() == 0  # moved together
    assert out.where("v = v__other").count() < 10
    assert abs(out.stat.corr("v", "v__other")) < 0.15


def test_permutation_importance(boosted, parts):
    rows = L.permutation_importance(parts[1], boosted, ["Contract", "gender", ("Contract", "tenure")])
    got = {r["feature"]: r["importance"] for r in rows.collect()}
    assert got["Contract"] > got["gender"] - 0.02
    assert set(got) == {"Contract", "gender", "Contract x tenure"}


def test_search(table, spark):
    model = L.BoostedChurnModel(**{**FAST, "trees": 1})
    found = L.search(table, model, {"maxDepth": [1, 2], "stepSize": [0.1, 0.2]}, folds=2, trials=2)
    rows = L.search_results(found, spark).collect()
    assert len(rows) == 2 and all(0 <= r["f2_score"] <= 1 for r in rows)


def test_categories_of_many_levels(table):
    many = table.withColumn("PaymentMethod", F.concat(F.lit("p"), F.pmod(F.xxhash64("customerID"), F.lit(100))))
    scored = L.BoostedChurnModel(trees=1, depth=2).fit(many).predict_proba(many)
    assert scored.where("churn_probability BETWEEN 0 AND 1").count() == many.count()


def test_fit_rows_bound_the_fit_and_not_the_scores(table):
    n = table.count()
    some = L.BoostedChurnModel(fit_rows=300)._labelled(table, "Churn")
    keys = {r[0] for r in some.select("customerID").collect()}
    assert 200 < len(keys) < 400
    assert keys == {r[0] for r in L.BoostedChurnModel(fit_rows=300)._labelled(table.repartition(3), "Churn").select("customerID").collect()}
    for whole in (None, n):
        assert L.BoostedChurnModel(fit_rows=whole)._labelled(table, "Churn").count() == n
    model = L.BoostedChurnModel(fit_rows=300, trees=2, depth=2).fit(table)
    assert model.predict_proba(table).count() == n
