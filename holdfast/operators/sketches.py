"""Cohort percentiles from quantile sketches that are stored per batch and merged later.

A batch is read once; what stays of it is one KLL sketch per cohort, with its moments. Sketches of
any batches merge without the rows, on the JVM, and a batch that runs again replaces its own.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.operators.features import POINTS, ChurnFeaturesModel
from holdfast.operators.ranking import double_array
from holdfast.schema import TENURE_COHORTS

SKETCH_SIZE = 1024
_SCHEMA = "cohort string, accounts long, mean double, variance double, sketch binary"


def rank_error(k: int = SKETCH_SIZE) -> float:
    """Error of one rank, as a share of the rows, that a sketch of size k keeps in 99 of 100 cases."""
    return 2.296 / k**0.9723


def cohort_sketches(accounts: DataFrame, k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch of the customer value per cohort; tasks sketch their rows first, so a cohort may hold all."""
    known = accounts.select(C.tenure_cohort().alias("cohort"), C.lifetime_value().cast("double").alias("v"))
    return (
        known.where(F.col("cohort").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("cohort")
        .agg(
            F.count("*").alias("accounts"),
            F.avg("v").alias("mean"),
            F.var_pop("v").alias("variance"),
            F.kll_sketch_agg_double("v", k).alias("sketch"),
        )
    )


def store_batch(sketches: DataFrame, folder: str, batch: str) -> None:
    """Keep the sketches of a batch; storing the same batch again replaces them."""
    sketches.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={batch}")


def merged_sketches(spark: SparkSession, folder: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One sketch per cohort over all stored batches: a row per batch and cohort goes in."""
    n, mean = F.col("accounts"), F.col("mean")
    squares = F.sum(n * (F.col("variance") + mean * mean))
    total = F.sum(n * mean) / F.sum(n)
    return (
        spark.read.schema(_SCHEMA)
        .parquet(folder)
        .groupBy("cohort")
        .agg(
            F.sum("accounts").alias("accounts"),
            total.alias("mean"),
            F.greatest(squares / F.sum(n) - total * total, F.lit(0.0)).alias("variance"),
            F.kll_merge_agg_double("sketch", k).alias("sketch"),
        )
    )


def features_from_sketches(sketches: DataFrame) -> ChurnFeaturesModel:
    """The feature model fitted on all sketched batches: percentiles are against their cohorts.

    The driver reads one row per cohort. A percentile is off by at most the sketch's rank error and
    one step of the model's quantiles; cohorts without accounts give none.
    """
    ranks = double_array([i / POINTS for i in range(1, POINTS)])
    rows = sketches.select(
        "cohort", "accounts", "mean", "variance", F.kll_sketch_get_quantile_double("sketch", ranks).alias("points")
    ).collect()
    by_label = {row["cohort"]: row for row in rows}
    means, stds, points = [], [], []
    for label, _, _ in TENURE_COHORTS:
        row = by_label.get(label)
        n = row["accounts"] if row else 0
        means.append(row["mean"] if row else math.nan)
        stds.append(math.sqrt(row["variance"] * n / (n - 1)) if n > 1 else math.nan)
        points.extend(row["points"] if row else [math.nan] * (POINTS - 1))
    return ChurnFeaturesModel()._set(
        percentileMode="fitted", cohortMeans=means, cohortStds=stds, cohortPoints=points
    )
