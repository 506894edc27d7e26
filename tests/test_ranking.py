import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import ranking as K

SMALL = {"rows_per_cell": 20, "max_cells": 32}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value and one group; with missing values."""
    rng = np.random.default_rng(1)
    n = 2000
    value = np.round(rng.normal(size=n), 2)
    value[: n // 3] = 0.0
    value[:5] = -0.0
    group = rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]).astype(object)
    frame = pd.DataFrame({"id": [f"k{i}" for i in range(n)], "v": value, "g": group})
    frame.loc[rng.choice(n, 50), "v"] = np.nan
    frame.loc[rng.choice(n, 30), "g"] = None
    return frame, spark.createDataFrame(frame).repartition(4).cache()


@pytest.mark.parametrize("cells", [{}, SMALL, {"rows_per_cell": 1, "max_cells": 64}])
def test_percent_rank_matches_pandas(skewed, cells):
    frame, df = skewed
    got = K.average_percent_rank(df, "v", "id", "r", group="g", **cells).toPandas().set_index("id")["r"]
    want = frame.set_index("id").groupby("g")["v"].rank(pct=True)
    want = want.reindex(frame["id"])
    pd.testing.assert_series_equal(got.reindex(frame["id"]), want, check_names=False, check_exact=True)


def test_percent_rank_one_value(spark):
    df = spark.range(100).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(3.0).alias("v"))
    got = K.average_percent_rank(df, "v", "id", "r", **SMALL).select("r").distinct().collect()
    assert [r[0] for r in got] == [0.505]


def test_percent_rank_keeps_all_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "id string, v double")
    assert [r["r"] for r in K.average_percent_rank(df, "v", "id", "r").collect()] == [None, None]


@pytest.mark.parametrize("cells", [{}, SMALL])
def test_running_totals(skewed, cells):
    frame, df = skewed
    sums = {"n": F.lit(1).cast("long")}
    got = K.running_totals(df, "v", sums, "g", **cells).toPandas().sort_values(["_group", "_value"])
    known = frame.dropna()
    want = known.assign(v=known["v"] + 0.0).groupby(["g", "v"]).size().rename("n").reset_index()
    want["below"] = want.groupby("g")["n"].cumsum() - want["n"]
    assert got["n"].tolist() == want["n"].tolist()
    assert got["n_below"].tolist() == want["below"].tolist()
    assert got["n_total"].tolist() == want.groupby("g")["n"].transform("sum").tolist()


@pytest.mark.parametrize("cells", [{}, SMALL])
def test_quantiles_match_numpy(skewed, cells):
    frame, df = skewed
    wanted = [0.0, 0.25, 0.5, 0.75, 1.0]
    n, values = K.exact_quantiles(df, "v", wanted, **cells)
    assert n == frame["v"].count()
    np.testing.assert_allclose(values, np.quantile(frame["v"].dropna(), wanted), rtol=0, atol=1e-12)
    names = {f"q{i}": q for i, q in enumerate(wanted)}
    found = K.group_quantiles(df, "v", names, "g", **cells).toPandas().set_index("_group")
    for g, part in frame.dropna().groupby("g")["v"]:
        np.testing.assert_allclose(found.loc[g, list(names)].to_numpy(float), np.quantile(part, wanted), rtol=0, atol=1e-12)
    assert K.exact_median(df, "v", **cells) == frame["v"].median()


def test_median_of_nothing(spark):
    assert K.exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None


@pytest.mark.parametrize("cells", [{}, SMALL])
def test_a_hundred_groups(spark, cells):
    id_ = F.col("id")
    df = spark.range(3000).select(
        id_.cast("string").alias("id"), (id_ % 100).alias("g"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("v")
    )
    frame = df.toPandas()
    found = K.group_quantiles(df, "v", {"m": 0.5}, "g", **cells).toPandas()
    want = frame.groupby("g")["v"].median()
    assert len(found) == 100 and found.set_index(found["_group"].astype(int))["m"].sort_index().tolist() == want.tolist()
    got = K.average_percent_rank(df, "v", "id", "r", group="g", **cells).toPandas().set_index("id")["r"]
    rank = frame.set_index("id").groupby("g")["v"].rank(pct=True)
    pd.testing.assert_series_equal(got.reindex(rank.index), rank, check_names=False)


@pytest.mark.parametrize("n", [2000, 8000, 32000])
@pytest.mark.parametrize("limit", [K.BROADCAST_CUTS, 1])
def test_rows_per_cell_stay_bounded_as_tables_grow(spark, monkeypatch, n, limit):
    monkeypatch.setattr(K, "BROADCAST_CUTS", limit)
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.randn(7)).alias("v"), F.col("id")).cache()
    prepared = K._prepared(df, "v", None)
    rows, points = K._cut_points(prepared, 20, 16)
    celled = K._with_cells(prepared, rows, points, 20, 16)
    sizes = celled.groupBy(K.CELL).agg(F.count("*").alias("n"), F.countDistinct("v").alias("values")).toPandas()
    assert sizes["n"].sum() == n
    assert sizes.loc[sizes["values"] > 1, "n"].max() <= 200
    spans = celled.groupBy(K.CELL).agg(F.min("v").alias("low"), F.max("v").alias("high")).toPandas().sort_values(K.CELL)
    assert (spans["low"].to_numpy()[1:] > spans["high"].to_numpy()[:-1]).all()


def test_neighbouring_cut_points():
    up = math.nextafter(1.0, math.inf)
    assert K._apart([up, 1.0, math.inf, 1.0, -2.5]) == [-2.5, 1.0]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(f"K{i}", int(i % 13 < 4)) for i in range(1237)]
    return spark.createDataFrame(rows, "id string, y int").cache()


def test_split_is_exact_and_stable(labelled):
    train, test = K.stratified_split(labelled, "y", "id", 0.2, 42)
    n = labelled.count()
    assert test.count() == math.ceil(0.2 * n)
    assert train.count() == n - test.count()
    assert train.join(test, "id").count() == 0
    sizes = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    quota = K.largest_remainder(sizes, math.ceil(0.2 * n))
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == quota
    again = K.stratified_split(labelled.repartition(7), "y", "id", 0.2, 42)[1]
    assert {r["id"] for r in test.collect()} == {r["id"] for r in again.collect()}
    other = K.stratified_split(labelled, "y", "id", 0.2, 43)[1]
    assert {r["id"] for r in test.collect()} != {r["id"] for r in other.collect()}


@pytest.mark.parametrize("size", [0.0, 1.0])
def test_split_extremes(labelled, size):
    train, test = K.stratified_split(labelled, "y", "id", size)
    assert (train.count(), test.count()) == ((1237, 0) if size == 0 else (0, 1237))


def test_folds_are_exact(labelled):
    folds = K.stratified_folds(labelled, "y", "id", 5).groupBy("fold", "y").count().toPandas()
    table = folds.pivot(index="fold", columns="y", values="count")
    assert (table.max() - table.min() <= 1).all()
    assert table.sum(axis=1).max() - table.sum(axis=1).min() <= 1
    assert table.to_numpy().sum() == 1237


def test_fold_sizes_by_dealing():
    sizes = {0: 7, 1: 6}
    dealt = [0] * 7 + [1] * 6
    want = {g: [sum(1 for i, d in enumerate(dealt) if d == g and i % 3 == f) for f in range(3)] for g in sizes}
    assert K.fold_sizes(sizes, 3) == want


@pytest.mark.parametrize("cells", [{}, SMALL])
def test_time_folds(spark, cells):
    rows = [(i, int(t)) for i, t in enumerate(np.random.default_rng(3).integers(0, 60, 1000))]
    out = K.time_folds(spark.createDataFrame(rows, "id int, t int"), "t", 4, **cells).toPandas()
    spans = out.groupby("fold")["t"].agg(["min", "max", "size"])
    assert (spans["min"].to_numpy()[1:] > spans["max"].to_numpy()[:-1]).all()
    assert spans["size"].between(200, 300).all()


def test_values_are_derived_once_where_there_are_cells(spark):
    read = spark.sparkContext.accumulator(0)
    derived = F.udf(lambda v: read.add(1) or v, "double")("v")
    data = [(float(i * 37 % 1000),) for i in range(1000)] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(data, "v double")
    assert K.exact_median(df, derived, rows_per_cell=100) == 499.5
    assert read.value == 1002
    assert K.values_at_ranks(df, derived, lambda n: [0, n - 1], rows_per_cell=100) == (1000, {0: 0.0, 999: 999.0})
