"""Segment studies: churn lift, score distribution, mutual information."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.ranking import group_quantiles
from holdfast.schema import DEFAULTS

# The two published segments.
DEFAULT_SEGMENTS = {
    "volatile_charges": "charge_volatility_ratio > 0.15",
    "fewer_than_2_services": "service_adoption_density * 8 < 2",
}


def segment_lift(
    df: DataFrame,
    segments: Mapping[str, str] | None = None,
    label: str = DEFAULTS.target,
) -> DataFrame:
    """Churn rate in and outside each segment, relative to the overall rate.

    One pass: every segment is a pair of conditional counts in one aggregate,
    turned into one row per segment afterwards.
    """
    segments = dict(segments or DEFAULT_SEGMENTS)
    churned = F.col(label) == 1
    inside = {n: F.coalesce(F.expr(s), F.lit(False)) for n, s in segments.items()}
    aggregates = [F.count("*").alias("n"), F.count_if(churned).alias("k")]
    for i, condition in enumerate(inside.values()):
        aggregates += [
            F.count_if(condition).alias(f"n{i}"),
            F.count_if(condition & churned).alias(f"k{i}"),
        ]
    row = df.where(F.col(label).isNotNull()).agg(*aggregates)
    per_segment = F.array(
        *[
            F.struct(
                F.lit(name).alias("segment"),
                F.col(f"n{i}").alias("accounts"),
                F.col(f"k{i}").alias("churned"),
            )
            for i, name in enumerate(segments)
        ]
    )
    base = F.try_divide(F.col("k"), F.col("n"))
    rate = F.try_divide(F.col("churned"), F.col("accounts"))
    rest = F.try_divide(F.col("k") - F.col("churned"), F.col("n") - F.col("accounts"))
    return row.select("n", "k", F.explode(per_segment).alias("s")).select("n", "k", "s.*").select(
        "segment",
        "accounts",
        "churned",
        rate.alias("churn_rate"),
        rest.alias("rest_churn_rate"),
        base.alias("base_churn_rate"),
        F.try_divide(rate, base).alias("lift"),
    )


def _with_group(df: DataFrame, group: str) -> DataFrame:
    """Without the group column, all rows count as one group."""
    if group in df.columns:
        return df
    return df.withColumn(group, F.lit("Month-to-month"))


def group_values(df: DataFrame, column: str = "Contract") -> DataFrame:
    """Distinct values of a column."""
    return _with_group(df, column).select(column).distinct()


def score_distribution(
    df: DataFrame,
    probability: str = "churn_probability",
    group: str = "Contract",
    **cells: int,
) -> DataFrame:
    """Count, range, mean and exact quartiles of the score per group."""
    known = _with_group(df, group).where(F.col(probability).isNotNull())
    basic = [
        F.count("*").alias("accounts"),
        F.min(probability).alias("min_score"),
        F.max(probability).alias("max_score"),
        F.avg(probability).alias("mean_score"),
    ]
    parts = {"q1": 0.25, "median_score": 0.5, "q3": 0.75}
    quartiles = group_quantiles(known, probability, parts, group, **cells)
    return (
        known.groupBy(group)
        .agg(*basic)
        .join(quartiles, F.col(group).cast("string") == F.col("_group"))
        .select(group, "accounts", "min_score", "max_score", "mean_score", *parts)
    )


def score_histogram(
    df: DataFrame,
    probability: str = "churn_probability",
    group: str = "Contract",
    bins: int = 20,
) -> DataFrame:
    """Accounts per group and equal-width score bin; a score of 1 joins the last bin."""
    p = F.col(probability)
    place = F.floor(p * F.lit(bins)).cast("int")
    return (
        _with_group(df, group)
        .where(p.isNotNull())
        .groupBy(group, F.when(place >= bins, bins - 1).otherwise(place).alias("bin"))
        .agg(F.count("*").alias("accounts"))
        .withColumn("bin_start", F.col("bin") / F.lit(float(bins)))
    )


def score_density(
    df: DataFrame,
    probability: str = "churn_probability",
    group: str = "Contract",
    points: int = 101,
    steps: int = 10,
    **cells: int,
) -> DataFrame:
    """Gaussian kernel density of the scores, between 0 and 1, per group at equidistant points.

    The one pass over rows deals each score to the two nearest of ``(points - 1) * steps + 1`` grid
    places, in proportion to its nearness. What follows is a convolution of those weights with the
    kernel, whose size depends on groups and grid alone. Scores on the grid give the exact density;
    others an error of the order of the squared grid step. The bandwidth is Silverman's rule,
    ``1.059 * min(std, iqr / 1.349) / n ** 0.2``, with exact quartiles; a group whose quartiles are
    equal uses its deviation, one of equal scores a grid step. Missing scores are left out.
    """
    last = (points - 1) * steps
    scores = _with_group(df, group).where(F.col(probability).isNotNull())
    known = scores.select(F.coalesce(F.col(group).cast("string"), F.lit("missing")).alias(group), probability)
    place = F.col(probability) * F.lit(last)
    left = F.least(F.greatest(F.floor(place), F.lit(0)), F.lit(last - 1)).cast("int")
    weights = (
        known.groupBy(group, left.alias("_left"))
        .agg(F.count("*").alias("_n"), F.sum(place - left).alias("_right"))
        .select(
            group,
            F.explode(
                F.array(
                    F.struct(F.col("_left").alias("_at"), (F.col("_n") - F.col("_right")).alias("_weight")),
                    F.struct((F.col("_left") + 1).alias("_at"), F.col("_right").alias("_weight")),
                )
            ).alias("_w"),
        )
        .groupBy(group, F.col("_w._at").alias("_at"))
        .agg(F.sum("_w._weight").alias("_weight"))
    )
    quartiles = group_quantiles(known, probability, {"_q1": 0.25, "_q3": 0.75}, group, **cells)
    spread = F.when(
        F.col("_q3") > F.col("_q1"), F.least("_std", (F.col("_q3") - F.col("_q1")) / F.lit(1.349))
    ).otherwise(F.col("_std"))
    rule = F.lit(1.059) * spread * F.pow(F.col("accounts").cast("double"), F.lit(-0.2))
    shapes = (
        known.groupBy(group)
        .agg(F.count("*").alias("accounts"), F.stddev_samp(probability).alias("_std"))
        .join(quartiles, F.col(group) == F.col("_group"))
        .select(group, "accounts", F.when(rule > 0, rule).otherwise(1.0 / last).alias("bandwidth"))
    )
    score = F.col("_point") / F.lit(float(points - 1))
    apart = (score - F.col("_at") / F.lit(float(last))) / F.col("bandwidth")
    kernel = F.exp(apart * apart * F.lit(-0.5)) / F.lit(math.sqrt(2 * math.pi))
    return (
        weights.join(shapes, group)
        .withColumn("_point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy(group, "accounts", "bandwidth", "_point")
        .agg(F.sum(F.col("_weight") * kernel).alias("_sum"))
        .select(
            group,
            score.alias("score"),
            (F.col("_sum") / (F.col("accounts") * F.col("bandwidth"))).alias("density"),
            "bandwidth",
            "accounts",
        )
    )


def mutual_information(
    df: DataFrame, features: Mapping[str, Column], label: str = DEFAULTS.target
) -> DataFrame:
    """Mutual information, in nats, of each discrete feature with the label.

    Rows are counted per (feature, value, label) in one pass; the marginals are
    windows over that small table. Missing values are a value of their own.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.coalesce(c.cast("string"), F.lit("missing")).alias("value"),
            )
            for name, c in features.items()
        ]
    )
    joint = (
        df.where(F.col(label).isin(0, 1))
        .select(F.col(label).alias("label"), F.explode(pairs).alias("f"))
        .groupBy("f.feature", "f.value", "label")
        .agg(F.count("*").alias("n"))
        .withColumn("nv", F.sum("n").over(Window.partitionBy("feature", "value")))  # two rows each
    )
    by_label = (
        joint.groupBy("feature", "label")
        .agg(F.sum("n").alias("nl"))
        .withColumn("nt", F.sum("nl").over(Window.partitionBy("feature")))
    )
    part = F.col("n") / F.col("nt")
    term = part * F.ln(
        F.col("n").cast("double") * F.col("nt") / (F.col("nv").cast("double") * F.col("nl"))
    )
    return (
        joint.join(F.broadcast(by_label), ["feature", "label"])  # two rows per feature
        .groupBy("feature")
        .agg(F.sum(term).alias("mutual_information"))
    )
