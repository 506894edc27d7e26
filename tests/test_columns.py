import math

import pytest
from pyspark.sql import functions as F

from holdfast.functions import columns as C


def one(spark, rows, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def test_numeric_or_null(spark):
    texts = ["1", " 12.5 ", "-3e2", ".5", "5.", " ", "", "12d", "1,000", "abc", "NaN", "0x10", None, "1 2"]
    got = [r[0] for r in one(spark, [(t,) for t in texts], "t string", C.numeric_or_null("t"))]
    assert got == [1.0, 12.5, -300.0, 0.5, 5.0] + [None] * 9


def test_numeric_or_null_on_numbers(spark):
    rows = [(1.5,), (float("nan"),), (None,), (float("inf"),)]
    got = [r[0] for r in one(spark, rows, "t double", C.numeric_or_null("t"))]
    assert got == [1.5, None, None, math.inf]


def test_flags_and_target(spark):
    rows = [("Yes",), ("No",), ("No phone service",), ("No internet service",), ("?",), (None,)]
    got = one(spark, rows, "c string", C.flag("c"), C.flag("c", 1), C.is_yes("c"))
    assert got == [(1, 1, 1), (0, 1, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_unit_clip_keeps_missing(spark):
    rows = [(-0.5,), (0.25,), (7.0,), (None,)]
    assert [r[0] for r in one(spark, rows, "x double", C.unit_clip(F.col("x")))] == [0.0, 0.25, 1.0, None]


def test_cohort_edges(spark):
    rows = [(t,) for t in (None, -1, 0, 12, 13, 24, 25, 36, 37, 48, 49, 72, 73)]
    got = [r[0] for r in one(spark, rows, "tenure int", C.tenure_cohort())]
    labels = ["0-12m", "0-12m", "13-24m", "13-24m", "25-36m", "25-36m", "37-48m", "37-48m", "49-72m", "49-72m"]
    assert got == [None, None, *labels, None]


def test_volatility_edges(spark):
    rows = [
        (10, 50.0, 600.0),  # average 60
        (0, 50.0, None),  # no history
        (None, 50.0, 10.0),
        (5, None, 10.0),
        (5, 50.0, None),
        (1, 1.0, 500.0),  # clipped
    ]
    got = [r[0] for r in one(spark, rows, "tenure int, MonthlyCharges double, TotalCharges double", C.charge_volatility())]
    assert got[0] == pytest.approx(10 / (50 + 1e-9))
    assert got[1:] == [0.0, 0.0, None, None, 1.0]


def test_support_recency_edges(spark):
    rows = [
        (0, "Month-to-month", 0),
        (9, "Month-to-month", 0),
        (9, "Month-to-month", 1),
        (9, "Month-to-month", None),
        (9, "One year", 0),
        (9, None, 0),
        (None, "Month-to-month", 0),
    ]
    schema = "tenure int, Contract string, TechSupport int"
    got = [r[0] for r in one(spark, rows, schema, C.support_recency(F.col("TechSupport")))]
    decayed = 1 / (1 + math.log1p(9))
    assert got == [1.0, pytest.approx(decayed), 0.0, 0.0, 0.0, 0.0, None]
    without = [r[0] for r in one(spark, rows, schema, C.support_recency(None))]
    assert without[2] == pytest.approx(decayed)


def test_contract_months_and_lookup(spark):
    rows = [("Month-to-month",), ("One year",), ("Two year",), ("Decade",), (None,)]
    got = [r[0] for r in one(spark, rows, "Contract string", C.contract_months())]
    assert got == [1, 12, 24, 1, 1]


def test_fbeta(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.5, 0.8)]
    got = [r[0] for r in one(spark, rows, "p double, r double", C.fbeta_score("p", "r"))]
    assert got[:3] == [1.0, 0.0, 0.0]
    assert got[3] == pytest.approx(5 * 0.4 / (4 * 0.5 + 0.8))


def test_tiers_and_text(spark):
    rows = [(0.2,), (0.4,), (0.7,), (None,)]
    assert [r[0] for r in one(spark, rows, "p double", C.risk_tier("p"))] == ["low", "high", "critical", None]
    assert one(spark, [(1234567.8, 0.7916)], "m double, p double", C.currency("m"), C.percent("p")) == [("$1,234,568", "79.2%")]
