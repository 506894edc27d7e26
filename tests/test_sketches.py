import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators.sketches import (
    cohort_sketches,
    features_from_sketches,
    merged_sketches,
    rank_error,
    store_batch,
)
from holdfast.functions import columns as C


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(4)
    rows = [(int(t), float(m)) for t, m in zip(rng.integers(1, 30, 20_000), rng.gamma(2, 40, 20_000).round(2))]
    rows += [(0, 10.0)] * 3000 + [(5, None), (None, 4.0)]
    return spark.createDataFrame(rows, "tenure int, MonthlyCharges double").withColumn("b", F.rand(1) < 0.3).cache()


def test_batches_merge(spark, values, tmp_path):
    """Sketches of two batches stand for all rows; a batch that runs again counts once."""
    folder = str(tmp_path)
    store_batch(cohort_sketches(values.where("b"), 256), folder, "1")
    for _ in range(2):
        store_batch(cohort_sketches(values.where("NOT b"), 256), folder, "2")
    merged = merged_sketches(spark, folder, 256)
    model = features_from_sketches(merged)
    known = values.withColumn("v", C.lifetime_value()).withColumn("c", C.tenure_cohort()).where("c IS NOT NULL AND v IS NOT NULL")
    frame = known.select("c", "v").toPandas()
    assert {r["cohort"]: r["accounts"] for r in merged.collect()} == frame.groupby("c").size().to_dict()
    stats = model.cohort_clv_stats
    flat = model.getOrDefault("cohortPoints")
    for i, label in enumerate(stats):
        v = np.sort(frame.loc[frame["c"] == label, "v"].to_numpy())
        points = np.array(flat[i * 999 : (i + 1) * 999])
        if not len(v):
            assert np.isnan(points).all() and np.isnan(stats[label]["mean"])
            continue
        assert stats[label]["mean"] == pytest.approx(v.mean()) and stats[label]["std"] == pytest.approx(v.std(ddof=1))
        below, upto = np.searchsorted(v, points) / len(v), np.searchsorted(v, points, "right") / len(v)
        asked, error = np.arange(1, 1000) / 1000, 2 * rank_error(256)
        assert ((below - error <= asked) & (asked <= upto + error)).all()


def test_no_accounts(spark, values, tmp_path):
    store_batch(cohort_sketches(values.where("false")), str(tmp_path), "1")
    model = features_from_sketches(merged_sketches(spark, str(tmp_path)))
    assert np.isnan(model.getOrDefault("cohortPoints")).all()
