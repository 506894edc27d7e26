"""The five engineered features."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.operators.ranking import average_percent_rank, double_array
from holdfast.schema import DEFAULTS, SERVICE_COLUMNS, TENURE_COHORTS

POINTS = 1000  # stored quantiles per cohort
_SALTS = 512


def row_features(df: DataFrame) -> DataFrame:
    """The four features that need only the row itself, plus contract_months.

    One projection; runs on streaming DataFrames too.
    """
    services = [name for name in SERVICE_COLUMNS if name in df.columns]
    support = F.col("TechSupport") if "TechSupport" in df.columns else None
    months = C.contract_months()
    return df.withColumns(
        {
            "charge_volatility_ratio": C.charge_volatility(),
            "service_adoption_density": C.service_density(services, len(SERVICE_COLUMNS)),
            "contract_months": months,
            "tenure_contract_interaction": F.col("tenure") * months,
            "support_recency_score": C.support_recency(support),
        }
    )


def cohort_clv_percentile(
    df: DataFrame, key: str = DEFAULTS.key, output: str = "cohort_clv_percentile", **cells: int
) -> DataFrame:
    """Percent rank of the value so far among accounts of the same tenure cohort."""
    return average_percent_rank(
        df, C.lifetime_value(), key, output, group=C.tenure_cohort_id(), **cells
    )


def cohort_stats(df: DataFrame) -> DataFrame:
    """Mean and sample deviation of the value so far, one row for every cohort.

    Cohorts without accounts keep a row with nulls.
    """
    clv = C.lifetime_value()
    labels = [label for label, _, _ in TENURE_COHORTS]
    stats = df.groupBy(C.tenure_cohort().alias("tenure_cohort")).agg(
        F.avg(clv).alias("mean"), F.stddev_samp(clv).alias("std")
    )
    cohorts = df.sparkSession.createDataFrame([(x,) for x in labels], "tenure_cohort string")
    return cohorts.join(stats, "tenure_cohort", "left")


class _FeatureParams(Params):
    percentileMode = Param(
        Params._dummy(),
        "percentileMode",
        "batch ranks inside the transformed table; fitted ranks against the fitted table",
        TypeConverters.toString,
    )

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(percentileMode="batch")


class ChurnFeatures(Estimator, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns cohort statistics; see ``ChurnFeaturesModel``."""

    @keyword_only
    def __init__(self, *, percentileMode: str = "batch"):
        super().__init__()
        if percentileMode not in ("batch", "fitted"):
            raise ValueError("percentileMode is 'batch' or 'fitted'")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ChurnFeaturesModel:
        labels = [label for label, _, _ in TENURE_COHORTS]
        clv = C.lifetime_value()
        # five cohorts: a handful of rows
        rows = (
            dataset.groupBy(C.tenure_cohort().alias("cohort"))
            .agg(F.avg(clv).alias("mean"), F.stddev_samp(clv).alias("std"))
            .collect()
        )
        by_label = {row["cohort"]: row for row in rows}
        nan = float("nan")  # stands for "none": params hold plain doubles
        model = ChurnFeaturesModel()
        self._copyValues(model)
        model._set(
            cohortMeans=[_number(by_label, x, "mean", nan) for x in labels],
            cohortStds=[_number(by_label, x, "std", nan) for x in labels],
        )
        if self.getOrDefault("percentileMode") == "fitted":
            points = _cohort_points(dataset)
            flat = []
            for x in labels:
                flat.extend(points.get(x) or [nan] * (POINTS - 1))
            model._set(cohortPoints=flat)
        return model


def _cohort_points(df: DataFrame) -> dict[str, list[float]]:
    """Quantiles of the value so far per cohort, from sketches merged in two steps.

    There are only five cohorts, so sketches of all tasks are first merged over
    many salts; each merged sketch then counts with its number of rows.
    """
    at = double_array([i / POINTS for i in range(1, POINTS)])
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS))  # by the row, however it is partitioned
    parts = (
        df.select(C.tenure_cohort().alias("cohort"), C.lifetime_value().alias("v"), salt.alias("s"))
        .where(F.col("cohort").isNotNull() & F.col("v").isNotNull())
        .groupBy("cohort", "s")
        .agg(F.count("*").alias("n"), F.percentile_approx("v", at, 10 * POINTS).alias("q"))
    )
    merged = (
        parts.select("cohort", "n", F.explode("q").alias("v"))
        .groupBy("cohort")
        .agg(F.percentile("v", at, F.col("n")).alias("points"))
    )
    return {row["cohort"]: row["points"] for row in merged.collect()}


def _number(rows: dict, label: str, field: str, default: float) -> float:
    value = rows[label][field] if label in rows else None
    return default if value is None else float(value)


class ChurnFeaturesModel(Model, _FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds contract_months and the five features."""

    cohortMeans = Param(
        Params._dummy(), "cohortMeans", "mean value per cohort", TypeConverters.toListFloat
    )
    cohortStds = Param(
        Params._dummy(), "cohortStds", "sample deviation per cohort", TypeConverters.toListFloat
    )
    cohortPoints = Param(
        Params._dummy(), "cohortPoints", "value quantiles per cohort", TypeConverters.toListFloat
    )

    def __init__(self) -> None:
        super().__init__()

    @property
    def cohort_clv_stats(self) -> dict[str, dict[str, float]]:
        means, stds = self.getOrDefault("cohortMeans"), self.getOrDefault("cohortStds")
        return {
            label: {"mean": means[i], "std": stds[i]}
            for i, (label, _, _) in enumerate(TENURE_COHORTS)
        }

    def _transform(self, dataset: DataFrame) -> DataFrame:
        features = row_features(dataset)
        if self.getOrDefault("percentileMode") == "fitted":
            return self._fitted_percentile(features)
        return cohort_clv_percentile(features)

    def _fitted_percentile(self, df: DataFrame) -> DataFrame:
        """Share of the fitted cohort's quantiles at or below the value; row-local."""
        columns = df.columns
        flat = self.getOrDefault("cohortPoints")
        width = POINTS - 1
        out = df.withColumn("_value", C.lifetime_value() + F.lit(0.0))
        percent = F.lit(None).cast("double")
        cohort = C.tenure_cohort_id()
        for i in range(len(TENURE_COHORTS)):
            points = [p for p in flat[i * width : (i + 1) * width] if math.isfinite(p)]
            if not points:
                continue
            edges = sorted(set(points))
            out = Bucketizer(
                splits=[-math.inf, *edges, math.inf],
                inputCol="_value",
                outputCol=f"_b{i}",
                handleInvalid="keep",
            ).transform(out)
            # equal points raise the share by more than one step
            shares = [0.0] + [sum(p <= e for p in points) / width for e in edges]
            share = F.element_at(double_array(shares), F.col(f"_b{i}").cast("int") + 1)
            percent = F.when((cohort == i) & F.col("_value").isNotNull(), share).otherwise(percent)
        return out.withColumn("cohort_clv_percentile", percent).select(
            *columns, "cohort_clv_percentile"
        )


def predictions_table(
    scored: DataFrame, probability: str = "churn_probability", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key, contract, charge, tenure, score, estimated value and revenue at risk."""
    clv = C.estimated_clv()
    return scored.select(
        DEFAULTS.key,
        "Contract",
        "MonthlyCharges",
        "tenure",
        F.col(probability).alias("churn_probability"),
        clv.alias("estimated_clv"),
        C.revenue_at_risk(F.col(probability), clv).alias("revenue_at_risk"),
        *keep,
    )
