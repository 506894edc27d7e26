"""Evaluation of churn scores, in counts and in money."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.operators.ranking import digest_cuts, key_digest, running_totals
from holdfast.schema import DEFAULTS

# Default threshold grid, 0.10 to 0.85; whole hundredths keep 0.40 exact.
THRESHOLD_GRID = tuple(k / 100 for k in range(10, 90, 5))


# --- confusion in counts and money ---------------------------------------------


def _confusion(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "true_positives": F.count_if((predicted == 1) & (label == 1)),
        "true_negatives": F.count_if((predicted == 0) & (label == 0)),
        "false_positives": F.count_if((predicted == 1) & (label == 0)),
        "false_negatives": F.count_if((predicted == 0) & (label == 1)),
    }


def _costs(cost_fn: float, cost_fp: float) -> dict[str, Column]:
    tp, fn, fp = F.col("true_positives"), F.col("false_negatives"), F.col("false_positives")
    saved = tp * F.lit(float(cost_fn))
    return {
        "total_business_cost_usd": F.bround(
            fn * F.lit(float(cost_fn)) + fp * F.lit(float(cost_fp)), 2
        ),
        "estimated_revenue_saved_usd": F.bround(saved, 2),
        "net_saved_usd": F.bround(saved - tp * F.lit(float(cost_fp)), 2),
    }


def business_cost_matrix(
    df: DataFrame,
    label: str = DEFAULTS.target,
    predicted: str = "predicted",
    cost_fn: float = DEFAULTS.cost_fn,
    cost_fp: float = DEFAULTS.cost_fp,
) -> DataFrame:
    """One row: confusion counts, cost of errors, revenue saved, and saved net of offers."""
    counts = _confusion(F.col(label), F.col(predicted))
    return df.agg(*[c.alias(n) for n, c in counts.items()]).withColumns(_costs(cost_fn, cost_fp))


def with_prediction(
    df: DataFrame, threshold: float = DEFAULTS.threshold, probability: str = "churn_probability"
) -> DataFrame:
    return df.withColumn("predicted", (F.col(probability) >= threshold).cast("int"))


def churn_rate(df: DataFrame, label: str = DEFAULTS.target, by: Sequence[str] = ()) -> DataFrame:
    """Accounts and mean label, overall or per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("accounts"), F.avg(F.col(label)).alias("churn_rate")
    )


# --- curves ---------------------------------------------------------------------


def _known(df: DataFrame, label: str, probability: str) -> DataFrame:
    return df.where(F.col(label).isin(0, 1) & F.col(probability).isNotNull())


def score_curve(
    df: DataFrame, label: str = DEFAULTS.target, probability: str = "churn_probability", **cells: int
) -> DataFrame:
    """One row per distinct score with positives and negatives at, below and in all.

    Columns: score, pos, neg, pos_below, neg_below, pos_total, neg_total.
    """
    totals = running_totals(
        _known(df, label, probability),
        probability,
        {
            "pos": (F.col(label) == 1).cast("long"),
            "neg": (F.col(label) == 0).cast("long"),
        },
        **cells,
    )
    return totals.drop("_group").withColumnRenamed("_value", "score")


def _auc_roc() -> Column:
    """Chance that a positive outscores a negative, ties counted half; over a score curve."""
    wins = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return F.when(pairs > 0, F.try_divide(F.sum(wins), pairs))


def _average_precision() -> Column:
    """Precision at each distinct score, weighted by the recall gained there."""
    pos_from = F.col("pos_total") - F.col("pos_below")
    neg_from = F.col("neg_total") - F.col("neg_below")
    step = F.col("pos") * (pos_from.cast("double") / (pos_from + neg_from))
    positives = F.max("pos_total")
    return F.when(positives > 0, F.try_divide(F.sum(step), positives.cast("double")))


def _trapezoid_precision() -> Column:
    """Area under the precision-recall curve with straight lines between scores."""
    pos_from = (F.col("pos_total") - F.col("pos_below")).cast("double")
    neg_from = (F.col("neg_total") - F.col("neg_below")).cast("double")
    pos_above, neg_above = pos_from - F.col("pos"), neg_from - F.col("neg")
    here = pos_from / (pos_from + neg_from)
    # the curve starts flat at the precision of the highest score
    above = F.when(pos_above + neg_above > 0, F.try_divide(pos_above, pos_above + neg_above))
    step = F.col("pos") * (here + F.coalesce(above, here)) / F.lit(2.0)
    positives = F.max("pos_total")
    return F.when(positives > 0, F.try_divide(F.sum(step), positives.cast("double")))


def roc_auc(
    df: DataFrame, label: str = DEFAULTS.target, probability: str = "churn_probability", **cells: int
) -> DataFrame:
    return score_curve(df, label, probability, **cells).agg(_auc_roc().alias("auc_roc"))


def average_precision(
    df: DataFrame,
    label: str = DEFAULTS.target,
    probability: str = "churn_probability",
    trapezoid: bool = False,
    **cells: int,
) -> DataFrame:
    area = _trapezoid_precision() if trapezoid else _average_precision()
    return score_curve(df, label, probability, **cells).agg(area.alias("auc_pr"))


def threshold_curve(
    df: DataFrame,
    label: str = DEFAULTS.target,
    probability: str = "churn_probability",
    thresholds: Sequence[float] = THRESHOLD_GRID,
    cost_fn: float = DEFAULTS.cost_fn,
    cost_fp: float = DEFAULTS.cost_fp,
    beta: float = DEFAULTS.beta,
) -> DataFrame:
    """Precision, recall, F-beta, cost and flagged accounts per threshold.

    One pass over the rows: each is counted under the highest threshold it
    reaches, and the few counts are summed from the top.
    """
    grid = sorted(set(thresholds))
    p = F.col(probability)
    reached = F.lit(0)
    for t in grid:
        reached = reached + (p >= F.lit(t)).cast("int")
    counts = (
        _known(df, label, probability)
        .groupBy(reached.alias("step"))
        .agg(
            F.sum((F.col(label) == 1).cast("long")).alias("pos"),
            F.sum((F.col(label) == 0).cast("long")).alias("neg"),
        )
    )
    # thresholds nobody reaches keep a row: one zero row per step
    steps = df.sparkSession.range(len(grid) + 1).select(
        F.col("id").cast("int").alias("step"),
        F.lit(0).cast("long").alias("pos"),
        F.lit(0).cast("long").alias("neg"),
    )
    table = (
        counts.unionByName(steps).groupBy("step").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    upward = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()  # len(grid) + 1 rows
    tp, fp = F.sum("pos").over(upward), F.sum("neg").over(upward)
    values = F.array(*[F.lit(float(t)) for t in grid])
    curve = (
        table.select(
            "step",
            tp.alias("tp"),
            fp.alias("fp"),
            (F.sum("pos").over(whole) - tp).alias("fn"),
        )
        .where("step > 0")
        .select(
            F.element_at(values, F.col("step")).alias("threshold"),
            C.safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
            C.safe_ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
            F.bround(F.col("fn") * float(cost_fn) + F.col("fp") * float(cost_fp), 2).alias(
                "business_cost_usd"
            ),
            (F.col("tp") + F.col("fp")).alias("flagged_customers"),
        )
    )
    return curve.select(
        "threshold",
        "precision",
        "recall",
        C.fbeta_score("precision", "recall", beta).alias("f2_score"),
        "business_cost_usd",
        "flagged_customers",
    )


def normalized_cost(curve: DataFrame) -> DataFrame:
    """Add each threshold's cost relative to the dearest one."""
    highest = F.max("business_cost_usd").over(Window.partitionBy())  # one row per threshold
    return curve.withColumn(
        "normalized_cost", F.try_divide(F.col("business_cost_usd"), highest)
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row with the highest F-beta; the lowest threshold among equals."""
    return curve.orderBy(F.desc("f2_score"), "threshold").limit(1)


def lift_curve(
    df: DataFrame,
    label: str = DEFAULTS.target,
    probability: str = "churn_probability",
    key: str = DEFAULTS.key,
    bins: int = 10,
    seed: int = DEFAULTS.seed,
    **cells: int,
) -> DataFrame:
    """Churn rate per equal-sized bin of the score ranking, best bin first.

    Rows are ordered by score, highest first, and by hashed key within a score,
    so accounts of equal score are dealt to bins without regard to their key's
    meaning. Row r (0-based) of n belongs to bin floor(r x bins / n). Only the
    bins - 1 cut positions are looked up; rows are then assigned one by one.
    """
    known = _known(df, label, probability)
    curve = score_curve(df, label, probability, **cells)
    scores = curve.select(
        "score",
        (F.col("pos_total") + F.col("neg_total")).alias("n"),
        (F.col("pos") + F.col("neg")).alias("ties"),
        # rows with higher scores
        (
            F.col("pos_total") + F.col("neg_total")
            - F.col("pos_below") - F.col("neg_below") - F.col("pos") - F.col("neg")
        ).alias("above"),
    )
    # bin b opens at row ceil(b x n / bins), so these are the bins that open inside a score
    opened = scores.withColumns(
        {
            "low": F.expr(f"(above * {bins}) div n + 1"),
            "high": F.expr(f"least(((above + ties) * {bins}) div n, {bins - 1})"),
        }
    ).where("low <= high")
    cut_rows = (
        opened.withColumn("bin", F.explode(F.sequence("low", "high")))
        .select("bin", "score", F.expr(f"(bin * n + {bins - 1}) div {bins} - above").alias("k"), "ties")
        .collect()  # one row per cut
        if bins > 1
        else []
    )
    digest = key_digest(key, seed)
    score = F.col(probability).cast("double") + F.lit(0.0)
    place = F.lit(0)
    inside: dict[float, list[int]] = {}  # cuts that fall between rows of equal score
    for row in cut_rows:
        if row["k"] == row["ties"]:
            place = place + (score < F.lit(row["score"])).cast("int")
        else:
            inside.setdefault(row["score"], []).append(row["k"])
    ends = {}
    if inside:
        tied = known.where(score.isin(*inside))
        ends = digest_cuts(tied, score, digest, lambda _: inside, max_groups=bins)
    for s, digests in ends.items():
        for d in digests:
            beyond = (score < F.lit(s)) | ((score == F.lit(s)) & (digest > F.lit(d)))
            place = place + beyond.cast("int")
    counted = (
        known.withColumn("bin", place + 1)
        .groupBy("bin")
        .agg(
            F.count("*").alias("accounts"),
            F.sum((F.col(label) == 1).cast("long")).alias("churned"),
        )
    )
    whole = Window.partitionBy()  # one row per bin
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    overall = F.sum("churned").over(whole) / F.sum("accounts").over(whole)
    rate = F.col("churned") / F.col("accounts")
    return counted.select(
        "bin",
        "accounts",
        "churned",
        rate.alias("churn_rate"),
        F.try_divide(rate, overall).alias("lift"),
        F.try_divide(F.sum("churned").over(upto), F.sum("churned").over(whole)).alias(
            "cumulative_gain"
        ),
    ).orderBy("bin")


# --- evaluator -------------------------------------------------------------------


class ChurnEvaluator:
    """Metrics of a scored table at one threshold and along the curves."""

    def __init__(
        self,
        threshold: float = DEFAULTS.threshold,
        cost_fn: float = DEFAULTS.cost_fn,
        cost_fp: float = DEFAULTS.cost_fp,
        beta: float = DEFAULTS.beta,
    ):
        self.threshold = threshold
        self.cost_fn = cost_fn
        self.cost_fp = cost_fp
        self.beta = beta

    def evaluate(
        self,
        df: DataFrame,
        label: str = DEFAULTS.target,
        probability: str = "churn_probability",
        **cells: int,
    ) -> DataFrame:
        """One row with AUCs, confusion, F-beta and costs; all from one score table."""
        curve = score_curve(df, label, probability, **cells)
        flagged = F.col("score") >= F.lit(self.threshold)
        zero = F.lit(0).cast("long")
        counts = {
            "true_positives": F.sum(F.when(flagged, F.col("pos")).otherwise(zero)),
            "true_negatives": F.sum(F.when(flagged, zero).otherwise(F.col("neg"))),
            "false_positives": F.sum(F.when(flagged, F.col("neg")).otherwise(zero)),
            "false_negatives": F.sum(F.when(flagged, zero).otherwise(F.col("pos"))),
        }
        row = curve.agg(
            _auc_roc().alias("auc_roc"),
            _average_precision().alias("auc_pr"),
            *[F.coalesce(c, zero).alias(n) for n, c in counts.items()],
        )
        tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
        return (
            row.withColumns(
                {
                    "precision": C.safe_ratio(tp, tp + fp),
                    "recall": C.safe_ratio(tp, tp + fn),
                    "threshold_used": F.lit(float(self.threshold)),
                    **_costs(self.cost_fn, self.cost_fp),
                }
            )
            .withColumn("f2_score", C.fbeta_score("precision", "recall", self.beta))
            .select(
                "auc_roc",
                "auc_pr",
                "f2_score",
                "precision",
                "recall",
                "threshold_used",
                *counts,
                "total_business_cost_usd",
                "estimated_revenue_saved_usd",
                "net_saved_usd",
            )
        )

    def get_threshold_curve(
        self,
        df: DataFrame,
        label: str = DEFAULTS.target,
        probability: str = "churn_probability",
        thresholds: Sequence[float] = THRESHOLD_GRID,
    ) -> DataFrame:
        return threshold_curve(
            df, label, probability, thresholds, self.cost_fn, self.cost_fp, self.beta
        ).orderBy("threshold")

    def get_lift_curve(
        self,
        df: DataFrame,
        label: str = DEFAULTS.target,
        probability: str = "churn_probability",
        key: str = DEFAULTS.key,
        bins: int = 10,
    ) -> DataFrame:
        return lift_curve(df, label, probability, key, bins)


def revenue_weighted_fbeta(
    df: DataFrame,
    label: str = DEFAULTS.target,
    probability: str = "churn_probability",
    weight: str = "estimated_clv",
    threshold: float = DEFAULTS.threshold,
    beta: float = DEFAULTS.beta,
) -> DataFrame:
    """Precision, recall and F-beta with each account counted by its value."""
    flagged, churned = F.col(probability) >= threshold, F.col(label) == 1
    money = F.col(weight)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, money)), F.lit(0.0))

    sums = _known(df, label, probability).agg(
        total(flagged & churned).alias("tp_value"),
        total(flagged & ~churned).alias("fp_value"),
        total(~flagged & churned).alias("fn_value"),
    )
    tp, fp, fn = F.col("tp_value"), F.col("fp_value"), F.col("fn_value")
    return sums.withColumns(
        {
            "weighted_precision": C.safe_ratio(tp, tp + fp),
            "weighted_recall": C.safe_ratio(tp, tp + fn),
        }
    ).withColumn(
        "weighted_fbeta", C.fbeta_score("weighted_precision", "weighted_recall", beta)
    )
