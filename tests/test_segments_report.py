import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import report as R
from holdfast.operators import segments as G
from holdfast.operators.lookups import attach_attributes, map_values


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 400
    frame = pd.DataFrame(
        {
            "customerID": [f"C{i}" for i in range(n)],
            "Contract": rng.choice(["a", "b"], n, p=[0.9, 0.1]),
            "Churn": rng.integers(0, 2, n),
            "churn_probability": np.round(rng.uniform(size=n), 2),
            "revenue_at_risk": rng.uniform(0, 100, n),
            "charge_volatility_ratio": rng.uniform(0, 0.3, n),
            "service_adoption_density": rng.integers(0, 9, n) / 8,
        }
    )
    return frame, spark.createDataFrame(frame).cache()


def test_segment_lift(table):
    frame, df = table
    got = {r["segment"]: r for r in G.segment_lift(df).collect()}
    inside = frame["charge_volatility_ratio"] > 0.15
    want = frame.loc[inside, "Churn"].mean()
    row = got["volatile_charges"]
    assert row["accounts"] == inside.sum() and row["churn_rate"] == want
    assert row["lift"] == pytest.approx(want / frame["Churn"].mean())
    assert row["rest_churn_rate"] == pytest.approx(frame.loc[~inside, "Churn"].mean())


def test_distribution(table):
    frame, df = table
    got = G.score_distribution(df, rows_per_cell=20, max_cells=16).toPandas().set_index("Contract")
    want = frame.groupby("Contract")["churn_probability"].describe()
    np.testing.assert_allclose(got.loc[want.index, ["q1", "median_score", "q3"]], want[["25%", "50%", "75%"]])
    assert G.score_distribution(df.drop("Contract")).first()["Contract"] == "Month-to-month"


def test_distribution_of_many_groups(table):
    _, df = table
    many = df.withColumn("Contract", F.col("customerID"))
    out = G.score_distribution(many)
    assert out.count() == 400
    assert out.where("median_score <> min_score").count() == 0


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.999,), (1.0,), (None,)], "churn_probability double")
    got = {r["bin"]: r["accounts"] for r in G.score_histogram(df).collect()}
    assert got == {0: 1, 1: 1, 19: 2}


def test_mutual_information(table):
    frame, df = table
    got = {r[0]: r[1] for r in G.mutual_information(df, {"Contract": F.col("Contract"), "same": F.col("Churn"), "none": F.lit(1)}).collect()}
    joint = pd.crosstab(frame["Contract"], frame["Churn"], normalize=True)
    outer = np.outer(joint.sum(axis=1), joint.sum(axis=0))
    assert got["Contract"] == pytest.approx((joint * np.log(joint / outer)).to_numpy().sum())
    q = frame["Churn"].mean()
    assert got["same"] == pytest.approx(-(q * math.log(q) + (1 - q) * math.log(1 - q)))
    assert got["none"] == pytest.approx(0.0, abs=1e-12)


def test_revenue_and_gauge(table, spark):
    frame, df = table
    risky = frame["churn_probability"] >= 0.4
    row = R.revenue_summary(df).first()
    assert row["high_risk_accounts"] == risky.sum()
    assert row["revenue_at_risk"] == pytest.approx(frame.loc[risky, "revenue_at_risk"].sum())
    flat = R.revenue_summary(df.drop("revenue_at_risk")).first()
    assert flat["revenue_at_risk"] == risky.sum() * 250
    bands = [
        tuple(R.revenue_gauge(spark.createDataFrame([(m,)], "revenue_at_risk double"), 100.0).first())[1:]
        for m in (10.0, 30.0, 60.0, 61.0)
    ]
    assert bands == [("low", -20.0, False), ("medium", 0.0, False), ("medium", 30.0, True), ("high", 31.0, True)]


def test_kpis(table, spark):
    _, df = table
    kpis = R.kpi_row(df)
    assert kpis.first()["recall"] is None
    text = R.kpi_text(kpis).first()
    assert (text["recall"], text["auc_roc"]) == ("N/A", "N/A")
    evaluation = spark.createDataFrame([(0.7914, 0.66974)], "recall double, auc_roc double")
    text = R.kpi_text(R.kpi_row(df, evaluation)).first()
    assert (text["recall"], text["auc_roc"]) == ("79.1%", "0.670")


def test_lookups(spark, table):
    _, df = table
    scores = df.select("customerID", "churn_probability")
    assert attach_attributes(scores, df, ["Contract"]).count() == 400
    mapping = spark.createDataFrame([("a", 1)], "k string, v int")
    got = map_values(df, "Contract", mapping, "k", "v", "m", 7)
    assert got.where("(Contract = 'a' AND m = 1) OR (Contract = 'b' AND m = 7)").count() == 400
    assert got.columns == [*df.columns, "m"]


def test_top_features(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.7), ("c", 0.2)], "feature string, importance_gain double")
    assert [r[0] for r in R.top_features(df, 2).collect()] == ["b", "c"]


def _kernel_density(values, at, width):
    return np.exp(-(((at[:, None] - values) / width) ** 2) / 2).sum(axis=1) / np.sqrt(2 * np.pi) / width / len(values)


def test_score_density(table):
    frame, df = table
    got = G.score_density(df).toPandas()
    for name, part in frame.groupby("Contract"):
        p = part["churn_probability"].to_numpy()
        width = 1.059 * min(p.std(ddof=1), np.subtract(*np.quantile(p, [0.75, 0.25])) / 1.349) * len(p) ** -0.2
        mine = got[got["Contract"] == name].sort_values("score")
        assert mine["bandwidth"].to_numpy() == pytest.approx(width) and (mine["accounts"] == len(p)).all()
        assert mine["density"].to_numpy() == pytest.approx(_kernel_density(p, mine["score"].to_numpy(), width))


def test_score_density_off_the_grid(spark):
    """Scores between grid places err by the squared grid step; equal scores and a lone one have a width."""
    rng = np.random.default_rng(3)
    p = rng.beta(2, 5, 2000)
    rows = [("many", float(x)) for x in p] + [("equal", 0.5)] * 5 + [("lone", 1.0), (None, 0.2), (None, 0.4), ("many", None)]
    got = G.score_density(spark.createDataFrame(rows, "Contract string, churn_probability double")).toPandas()
    many = got[got["Contract"] == "many"].sort_values("score")
    want = _kernel_density(p, many["score"].to_numpy(), many["bandwidth"].iloc[0])
    assert np.abs(many["density"].to_numpy() - want).max() < 1e-3 * want.max()
    assert set(got["Contract"]) == {"many", "equal", "lone", "missing"} and (many["accounts"] == 2000).all()
    equal = got[got["Contract"] == "equal"]
    assert equal["bandwidth"].iloc[0] == 0.001 and equal["density"].idxmax() == (equal["score"] - 0.5).abs().idxmin()
    empty = spark.createDataFrame([], "Contract string, churn_probability double")
    assert G.score_density(empty).count() == 0
