import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import learn as L
from holdfast.operators import trees as T
from holdfast.operators.ranking import stratified_split
from holdfast.plans.queries import training_table


@pytest.fixture(scope="module")
def parts(spark, sf):
    return stratified_split(training_table(spark, sf).cache(), "Churn", "customerID")


def random_tree(rng, features, depth, tree=0):
    """Nodes of one random tree with given covers; some splits by categories."""
    rows, counter = [], itertools.count()

    def grow(cover, level):
        node = next(counter)
        if level == depth or rng.random() < 0.15 and level:
            rows.append({"tree": tree, "node": node, "left": None, "right": None, "feature": None, "threshold": None,
                         "categories": None, "cover": cover, "value": float(rng.normal())})
            return node
        share = rng.uniform(0.1, 0.9)
        feature = str(rng.choice(features))
        by_category = feature == "c"
        row = {"tree": tree, "node": node, "feature": feature, "threshold": None if by_category else float(rng.normal()),
               "categories": [0.0, 2.0] if by_category else None, "cover": cover, "value": 0.0}
        rows.append(row)
        row["left"], row["right"] = grow(cover * share, level + 1), grow(cover * (1 - share), level + 1)
        return node

    grow(100.0, 0)
    return rows


def expectation(table, node, x, known):
    """Mean value below a node, following known features and weighting unknown ones by cover."""
    row = table[node]
    if row["left"] is None:
        return row["value"]
    if row["feature"] in known:
        v = x[row["feature"]]
        left = v in row["categories"] if row["categories"] is not None else v <= row["threshold"]
        return expectation(table, row["left"] if left else row["right"], x, known)
    parts = [table[row[c]]["cover"] / row["cover"] * expectation(table, row[c], x, known) for c in ("left", "right")]
    return sum(parts)


def brute_effects(rows, features, x):
    table = {r["node"]: r for r in rows}
    out = {}
    for f in features:
        others = [g for g in features if g != f]
        total = 0.0
        for k in range(len(others) + 1):
            weight = math.factorial(k) * math.factorial(len(others) - k) / math.factorial(len(features))
            for known in itertools.combinations(others, k):
                total += weight * (expectation(table, 0, x, {*known, f}) - expectation(table, 0, x, set(known)))
        out[f] = total
    return out


@pytest.mark.parametrize("limit", [10, 1])
def test_effects_equal_all_subsets(limit, monkeypatch):
    monkeypatch.setattr(T, "_PATTERN_FEATURES", limit)  # by patterns, and row by row
    rng = np.random.default_rng(4)
    features = ["a", "b", "c", "d", "e"]
    for depth in (0, 1, 3, 5):
        rows = random_tree(rng, features, depth)
        forest = T.Attributions(rows, features)
        x = rng.normal(size=(7, 5))
        x[:, 2] = rng.integers(0, 4, 7)
        got = forest.effects(x)
        for i in range(len(x)):
            row = dict(zip(features, x[i]))
            want = brute_effects(rows, features, row)
            np.testing.assert_allclose(got[i], [want[f] for f in features], atol=1e-12)
            whole = expectation({r["node"]: r for r in rows}, 0, row, set(features))
            assert forest.base + got[i].sum() == pytest.approx(whole)


def test_effects_add_up_to_scores(parts):
    train, test = parts
    boosted = L.BoostedChurnModel(trees=4, depth=4, learning_rate=0.3).fit(train)
    both = boosted.explain(boosted.predict_proba(test)).select("churn_probability", "margin", "effects").toPandas()
    np.testing.assert_allclose(both["churn_probability"], 1 / (1 + np.exp(-2 * both["margin"])), atol=1e-12)
    assert set(both["effects"][0]) == set(T.model_inputs(boosted)[0])
    forest = L.ChallengerChurnModel(trees=4, depth=4).fit(train)
    both = forest.explain(forest.predict_proba(test)).toPandas()
    np.testing.assert_allclose(both["churn_probability"], both["margin"], atol=1e-12)
    assert len(both) == test.count()


def test_gain_of_a_stump_by_hand(spark):
    rows = [(str(i), i % 4 // 2, int(i % 4 == 3), int(i % 5 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "customerID string, Churn int, sign int, noise int")
    model = L.BoostedChurnModel(trees=1, depth=1, min_child_rows=1, positive_weight=1.0, subsample=1.0, feature_subset="all").fit(df)
    got = {r["feature"]: tuple(r)[1:] for r in model.get_feature_importance().collect()}
    # labels -1 and 1: squares about the mean before, less those on either side of sign
    y = np.array([2 * r[1] - 1 for r in rows])
    sign = np.array([r[2] for r in rows])
    squares = lambda v: ((v - v.mean()) ** 2).sum()
    want = squares(y) - squares(y[sign == 1]) - squares(y[sign == 0])
    assert got["sign"] == (pytest.approx(want), 1.0, 1) and got["noise"] == (0.0, 0.0, 0)
    nodes = {r["node"]: r for r in model.nodes().collect()}
    assert nodes[0]["feature"] == "sign" and nodes[0]["cover"] == 80 and nodes[0]["threshold"] == 0.5
    assert nodes[nodes[0]["right"]]["value"] == pytest.approx(y[sign == 1].mean())


def test_nodes_rank_features_as_spark_does(parts):
    model = L.BoostedChurnModel(trees=1, depth=3).fit(parts[0])
    shares = {r["feature"]: r["importance_share"] for r in model.get_feature_importance().collect()}
    known = dict(zip(T.model_inputs(model)[0], model.model_.stages[-1].featureImportances.toArray()))
    assert shares == pytest.approx(known)


def test_cover_by_rows_with_missing_values(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (None, 1), (5.0, None)], "x double, Churn int")
    splits = [(0, 0, 1, 2, "x", 1.5), (0, 1, None, None, None, None), (0, 2, None, None, None, None)]
    got = {r["node"]: (r["cover"], r["value"]) for r in T.cover_by_rows(splits, df, "Churn").collect()}
    assert got == {0: (3.0, pytest.approx(2 / 3)), 1: (1.0, 1.0), 2: (2.0, 0.5)}


def test_strongest(spark):
    df = spark.createDataFrame([({"a": 0.2, "b": -1.0, "c": 0.5, "d": 0.1},)], "effects map<string,double>")
    got = df.select(T.strongest("effects", 2).alias("r")).first()["r"]
    assert [(r["feature"], r["effect"]) for r in got] == [("c", 0.5), ("a", 0.2)]
