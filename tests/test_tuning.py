import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.operators import tuning as U


@pytest.fixture(scope="module")
def accounts(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        x = rng.random()
        rows.append((f"k{i}", int(rng.random() < (0.75 if x > 0.6 else 0.1)), x, rng.random()))
    return spark.createDataFrame(rows, "customerID string, Churn int, x double, noise double").repartition(3).cache()


class Clock:
    """Moves on by ``step`` seconds each time a model is fitted."""

    def __init__(self, step):
        self.now, self.step = 0.0, step

    def __call__(self):
        return self.now

    def maker(self, column="x"):
        def make(cut):
            self.now += self.step
            return U.RuleModel(column, cut)

        return make


def test_draws():
    space = {"a": [1, 2], "b": ["x", "y", "z"]}
    assert U.draws(space, 6, 1) == [{"a": a, "b": b} for a, b in itertools.product([1, 2], "xyz")]
    some = U.draws(space, 4, 1)
    assert len(some) == 4 and some == U.draws(space, 4, 1) and all(some.count(s) == 1 for s in some)
    wide = {"d": U.Between(2, 9), "rate": U.Between(0.01, 1.0, log=True), "s": U.Between(0.5, 1.0)}
    many = U.draws(wide, 150, 3)
    assert len(many) == 150 and all(2 <= m["d"] <= 9 and isinstance(m["d"], int) and 0.01 <= m["rate"] <= 1 for m in many)
    assert 30 < sum(m["rate"] < 0.1 for m in many) < 120  # even in logs


def test_best_equals_the_whole_grid(accounts):
    cuts = [0.05, 0.2, 0.35, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95]
    make = lambda cut: U.RuleModel("x", cut)
    halved = U.halving_search(accounts, make, {"cut": cuts}, seconds=1e6, rungs=2)
    whole = U.halving_search(accounts, make, {"cut": cuts}, seconds=1e6, rungs=1)
    assert halved.best == whole.best and halved.score == whole.score
    trials = halved.trials.collect()
    assert [sum(r["rung"] == k for r in trials) for k in (0, 1)] == [9, 3]
    assert [r["share"] for r in trials if r["rung"] == 0] == [1 / 3] * 9
    assert sum(r["status"] == "kept" for r in trials) == 4


def test_search_ends_in_time(accounts):
    clock = Clock(1.0)
    space = {"cut": U.Between(0.01, 0.99)}
    found = U.halving_search(accounts, clock.maker(), space, trials=150, seconds=12, rungs=3, parallelism=1, clock=clock)
    assert clock.now <= 13
    rows = found.trials.collect()
    assert sum(r["rung"] == 0 for r in rows) == 150
    done = [sum(r["rung"] == k and r["f2_score"] is not None for r in rows) for k in range(3)]
    assert done[0] == 4 and done[2] >= 1  # a third of the time each, so the last rung is reached
    assert any(r["status"] == "out of time" and r["f2_score"] is None for r in rows)
    last = max((r for r in rows if r["rung"] == 2 and r["f2_score"] is not None), key=lambda r: r["f2_score"])
    assert found.score == last["f2_score"]


def test_no_time_is_an_error(accounts):
    clock = Clock(1.0)
    with pytest.raises(TimeoutError):
        U.halving_search(accounts, clock.maker(), {"cut": [0.1]}, seconds=0, clock=clock)


matrices = st.integers(1, 4).flatmap(
    lambda k: st.tuples(
        st.lists(st.lists(st.integers(-4, 4), min_size=k, max_size=k), min_size=k, max_size=8),
        st.lists(st.integers(-4, 4), min_size=8, max_size=8),
    )
)


@settings(max_examples=300, deadline=None)
@given(matrices)
def test_solution_is_the_best_of_all_sets(drawn):
    a = np.array(drawn[0], float)
    y = np.array(drawn[1][: len(a)], float)
    gram, target = a.T @ a, a.T @ y
    w = U.nonnegative_solution(gram, target)
    assert (w >= 0).all()
    worth = lambda v: v @ gram @ v - 2 * target @ v
    best = 0.0
    for size in range(1, len(target) + 1):
        for free in itertools.combinations(range(len(target)), size):
            v = np.zeros(len(target))
            v[list(free)] = np.linalg.lstsq(gram[np.ix_(free, free)], target[list(free)], rcond=None)[0]
            if (v >= -1e-12).all():
                best = min(best, worth(v))
    assert worth(w) <= best + 1e-8


def test_stack_weights(spark):
    rng = np.random.default_rng(2)
    a, b, c = rng.random((3, 400))
    y = (rng.random(400) < np.clip(0.7 * a + 0.2 * b, 0, 1)).astype(int)
    rows = [tuple(map(float, r)) + (int(v),) for r, v in zip(zip(a, b, -c), y)] + [(None, 0.1, 0.1, 1), (0.5, 0.5, 0.5, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, Churn int")
    got = U.stack_weights(df, ["a", "b", "c"])
    assert got["c"] == 0.0 and got["a"] > 0.4
    plain = np.linalg.lstsq(np.column_stack((a, b)), y, rcond=None)[0]
    assert [got["a"], got["b"]] == pytest.approx(plain)
    assert U.stack_weights(df.where("a > 5"), ["a", "b"]) == {"a": 0.0, "b": 0.0}
    ask = spark.createDataFrame([(0.9, 0.9, None), (None, 0.5, 0.5)], "a double, b double, c double")
    assert [r[0] for r in ask.select(U.weighted_score({"a": 2.0, "b": 0.1, "c": 0.0})).collect()] == [1.0, None]


def test_stacked_model_prefers_the_score_that_tells(accounts):
    makers = {"good": lambda: U.RuleModel("x", 0.6), "poor": lambda: U.RuleModel("noise", 0.9)}
    model = U.StackedModel(makers, folds=3).fit(accounts)
    assert model.weights["good"] > 5 * model.weights["poor"]
    out = model.predict_proba(accounts)
    assert out.columns[-4:] == ["good", "poor", "churn_probability", "predicted"]
    assert out.count() == 600 and out.where("churn_probability BETWEEN 0 AND 1").count() == 600
    assert out.where((F.col("x") >= 0.6) & (F.col("churn_probability") < 0.5)).count() == 0
