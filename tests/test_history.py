import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import lookups
from holdfast.operators.history import (
    event_support_recency,
    last_before,
    month_ends,
    rolling_charge_volatility,
    support_recency_as_of,
)


def test_rolling_volatility(spark):
    bills = [("a", 1, 10.0), ("a", 2, 5.0), ("a", 2, 15.0), ("a", 9, 10.0), ("b", 5, 40.0), ("b", 7, 10.0)]
    df = spark.createDataFrame(bills, "id string, m int, x double")
    got = {(r["id"], r["month"]): r for r in rolling_charge_volatility(df, "id", F.col("m"), F.col("x")).collect()}
    assert got["a", 1]["charge_volatility_ratio"] == 0.0
    assert got["a", 2]["charge"] == 20.0 and got["a", 2]["charge_volatility_ratio"] == pytest.approx(0.5)
    assert got["a", 9]["average_charge"] is None  # nothing in the six months before
    assert got["b", 7]["charge_volatility_ratio"] == 1.0  # clipped


def test_event_recency(spark):
    events = spark.createDataFrame(
        [(1, "2024-01-01 23:00:00", "error"), (1, "2024-01-03 01:00:00", "error"), (2, "2024-01-10 00:00:00", "view")],
        "user_id long, ts string, event_type string",
    ).withColumn("ts", F.to_timestamp("ts"))
    accounts = spark.createDataFrame([(1,), (2,)], "k long")
    got = {r["k"]: r for r in event_support_recency(accounts, events, "k").collect()}
    assert got[1]["days_since_support"] == 7
    assert got[1]["support_recency_score"] == pytest.approx(1 / (1 + np.log1p(7)))
    assert got[2]["days_since_support"] is None and got[2]["support_recency_score"] == 0.0


def test_lookup_with_hot_keys(spark, monkeypatch):
    """A third of the rows share one key; the right side is too large to broadcast."""
    monkeypatch.setattr(lookups, "_BROADCAST_ROWS", 10)
    n = 3000
    key = np.where(np.arange(n) % 3 == 0, 7, np.arange(n) % 500)
    left = pd.DataFrame({"id": np.arange(n), "k": pd.array(key, dtype="Int64")})
    left.loc[:20, "k"] = pd.NA
    right = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    df = spark.createDataFrame([(i, None if pd.isna(k) else int(k)) for i, k in zip(left["id"], left["k"])], "id long, k long")
    out = lookups.join_lookup(df, right, "k", "id")
    assert out.count() == n
    assert out.where("(k < 400 AND v = k * 10) OR ((k IS NULL OR k >= 400) AND v IS NULL)").count() == n
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in text


@pytest.mark.parametrize("slices", [{}, {"rows_per_slice": 7, "max_slices": 200}])
def test_recency_as_of(spark, slices):
    """One account holds most rows; moments repeat, and some have no account or time."""
    rng = np.random.default_rng(2)
    user = np.where(rng.random(600) < 0.6, 1, rng.integers(2, 20, 600))
    second = rng.integers(0, 40 * 86400, 600) // 3600 * 3600
    asked = rng.random(600) < 0.5
    moments = [(int(u), int(t), i) for i, (u, t, a) in enumerate(zip(user, second, asked)) if a]
    contacts = [(int(u), int(t)) for u, t, a in zip(user, second, asked) if not a]
    moments += [(1, 86400, -1)] * 30 + [(None, 5, -2), (1, None, -3), (99, 5, -4)]
    contacts += [(None, 1), (1, None)]
    at = F.timestamp_seconds("t").alias("t")
    left = spark.createDataFrame(moments, "k long, t long, id long").select("k", at, "id")
    right = spark.createDataFrame(contacts, "k long, t long").select("k", at)
    got = support_recency_as_of(left, right, "k", "t", **slices)
    assert got.count() == len(moments)
    found = {(r["id"], r["k"], r["s"]): r for r in got.withColumn("s", F.unix_seconds("t")).withColumn("c", F.unix_seconds("last_contact")).collect()}
    for k, t, i in moments:
        known = [c for u, c in contacts if u == k and c is not None and t is not None and c <= t] if k is not None else []
        row = found[i, k, t]
        assert row["c"] == (max(known) if known else None)
        days = t // 86400 - max(known) // 86400 if known else None
        assert row["days_since_support"] == days
        assert row["support_recency_score"] == pytest.approx(1 / (1 + np.log1p(days)) if known else 0.0)


def test_recency_windows_hold_one_slice(spark):
    """No window is partitioned by the account alone, but for one row per slice."""
    at = F.timestamp_seconds("id").alias("t")
    rows = spark.range(500).select(F.lit(1).alias("k"), at)
    out = last_before(rows, rows.where("second(t) = 0"), "k", "t", rows_per_slice=50)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window [" in line or line.startswith("Window [")]
    assert sum("[k#" in w and "_slice#" in w for w in windows) == 2
    assert out.count() == 500 and out.where("last_contact <= t").count() == 500
    empty = rows.where("k = 2")
    assert last_before(rows, empty, "k", "t").where("last_contact IS NULL").count() == 500
    assert last_before(empty, rows, "k", "t").count() == 0


def test_month_ends(spark):
    df = spark.createDataFrame([(1, "2024-01-31"), (2, "2024-03-01")], "k long, d string")
    df = df.select("k", F.to_timestamp("d").alias("first"))
    got = month_ends(df, "k", "first", F.to_date(F.lit("2024-03-15")))
    days = sorted((r["k"], str(r["month_end"])) for r in got.collect())
    assert days == [(1, f"2024-{x} 23:59:59.999999") for x in ("01-31", "02-29", "03-31")] + [(2, "2024-03-31 23:59:59.999999")]
