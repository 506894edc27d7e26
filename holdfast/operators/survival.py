"""Time-to-churn: Kaplan-Meier, Cox proportional hazards, concordance."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import AFTSurvivalRegression, AFTSurvivalRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions import columns as C
from holdfast.operators.ranking import ROWS_PER_CELL, double_array, running_totals
from holdfast.operators.risk_sets import MAX_CELLS, RiskSets
from holdfast.schema import DEFAULTS
from holdfast.session import materialize, shared_folder

_MAX_LEVELS = 1000
_WARM_ROWS = 1_000_000
_BROADCAST_DURATIONS = 1_000_000  # 16 bytes each


# --- life tables ------------------------------------------------------------------


def life_table(
    df: DataFrame,
    duration: str = "tenure",
    event: str = DEFAULTS.target,
    group: str = "Contract",
) -> DataFrame:
    """Accounts at risk and churned per group and month; starts at month 0.

    Rows are counted per group and month before any window, so windows see one
    row per month of each group.
    """
    known = df.where(
        F.col(duration).isNotNull() & F.col(event).isNotNull() & F.col(group).isNotNull()
    )
    counts = known.groupBy(F.col(group).alias("contract_type"), F.col(duration).alias("timeline")).agg(
        F.sum(F.col(event).cast("long")).alias("churned"), F.count("*").alias("leaving")
    )
    # every curve starts at month 0, also where nobody has tenure 0
    start = counts.groupBy("contract_type").agg(F.min("timeline").alias("first")).where("first > 0")
    zero = F.lit(0).cast("long")
    start = start.select(
        "contract_type",
        F.lit(0).cast(df.schema[duration].dataType).alias("timeline"),
        zero.alias("churned"),
        zero.alias("leaving"),
    )
    later = Window.partitionBy("contract_type").orderBy(F.desc("timeline")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return counts.unionByName(start).select(
        "contract_type", "timeline", "churned", F.sum("leaving").over(later).alias("at_risk")
    )


def kaplan_meier(
    df: DataFrame,
    duration: str = "tenure",
    event: str = DEFAULTS.target,
    group: str = "Contract",
) -> DataFrame:
    """Survival probability per group and month."""
    table = life_table(df, duration, event, group)
    upto = Window.partitionBy("contract_type").orderBy("timeline").rowsBetween(
        Window.unboundedPreceding, 0
    )
    gone = F.col("churned") >= F.col("at_risk")
    log_step = F.when(~gone, F.log1p(-F.col("churned") / F.col("at_risk"))).otherwise(0.0)
    ended = F.max(gone.cast("int")).over(upto) == 1
    return table.select(
        "timeline",
        F.when(ended, 0.0).otherwise(F.exp(F.sum(log_step).over(upto))).alias("survival_probability"),
        "contract_type",
        "at_risk",
        "churned",
    )


def monthly_hazard(
    df: DataFrame,
    duration: str = "tenure",
    event: str = DEFAULTS.target,
    group: str = "Contract",
    renewals: Sequence[int] = (12, 24, 36),
) -> DataFrame:
    """Churn hazard per group and month beside its neighbours, to spot renewal cliffs."""
    months = Window.partitionBy("contract_type").orderBy("timeline")
    hazard = F.try_divide(F.col("churned"), F.col("at_risk"))
    out = life_table(df, duration, event, group).withColumn("hazard", hazard)
    return out.select(
        "contract_type",
        "timeline",
        "at_risk",
        "churned",
        "hazard",
        F.lag("hazard").over(months).alias("previous_hazard"),
        F.lead("hazard").over(months).alias("next_hazard"),
    ).withColumns(
        {
            "renewal_month": F.col("timeline").isin(*renewals),
            "spike": F.coalesce(
                (F.col("hazard") > F.col("previous_hazard"))
                & (F.col("hazard") > F.col("next_hazard")),
                F.lit(False),
            ),
        }
    )


# Upper tail of the normal distribution, Abramowitz and Stegun 26.2.17.
_TAIL_STEP = 0.2316419
_TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def _normal_tail(z: Column) -> Column:
    """Probability of a standard normal value above ``z``, to 7.5e-8."""
    far = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_TAIL_STEP) * far)
    series = F.lit(0.0)
    for b in reversed(_TAIL):
        series = (series + F.lit(b)) * t
    upper = F.exp(far * far * F.lit(-0.5)) / F.lit(math.sqrt(2 * math.pi)) * series
    return F.when(z >= 0, upper).otherwise(F.lit(1.0) - upper)


def _rates_apart(churned: Column, at_risk: Column, other_churned: Column, other_at_risk: Column) -> Column:
    """Difference of two hazards in standard errors under one hazard; null where nobody is at risk."""
    both = F.try_divide(churned + other_churned, at_risk + other_at_risk)
    variance = both * (F.lit(1.0) - both) * (F.lit(1.0) / at_risk + F.lit(1.0) / other_at_risk)
    gap = churned / at_risk - other_churned / other_at_risk
    tested = (at_risk > 0) & (other_at_risk > 0)
    return F.when(tested & (variance > 0), gap / F.sqrt(variance)).when(tested, F.lit(0.0))


def _holm(table: DataFrame, p: str, output: str) -> DataFrame:
    """Holm's correction over the tested months of each group."""
    ranked = Window.partitionBy("contract_type").orderBy(F.col(p).asc_nulls_last(), "timeline")
    tests = F.count(p).over(Window.partitionBy("contract_type"))
    step = F.least(F.lit(1.0), F.col(p) * (tests - F.row_number().over(ranked) + 1))
    so_far = ranked.rowsBetween(Window.unboundedPreceding, 0)
    return table.withColumn(output, step).withColumn(
        output, F.when(F.col(p).isNotNull(), F.max(output).over(so_far))
    )


def hazard_cliffs(
    df: DataFrame,
    duration: str = "tenure",
    event: str = DEFAULTS.target,
    group: str = "Contract",
    window: int = 6,
    alpha: float = 0.01,
) -> DataFrame:
    """Months in which the hazard jumps, by a scan of the life table; one row per group and month.

    A ``cliff`` is a month whose hazard lies above that of the ``window`` months before it and above
    that of the ``window`` months after it; the larger of both p-values counts. A ``shift`` is a month
    from which the hazard stays higher or lower: cliffs aside, the ``window`` months from it on differ
    from those before, more than around any other month as near. Both are corrected by Holm over the
    months of a group, at level ``alpha``. Months nobody left in have no row, nor has a start of the
    curve without churn; the first and the last month have no neighbours on one side and are no cliffs.
    Durations are whole months. Windows see one row per month of a group.
    """
    table = life_table(df, duration, event, group).withColumn("timeline", F.col("timeline").cast("long"))
    table = table.where("timeline > 0 OR churned > 0")
    months = Window.partitionBy("contract_type").orderBy("timeline")
    before, after = months.rangeBetween(-window, -1), months.rangeBetween(1, window)
    beside = table.withColumns(
        {
            "_z1": _rates_apart(
                F.col("churned"), F.col("at_risk"), F.sum("churned").over(before), F.sum("at_risk").over(before)
            ),
            "_z2": _rates_apart(
                F.col("churned"), F.col("at_risk"), F.sum("churned").over(after), F.sum("at_risk").over(after)
            ),
        }
    )
    # least() passes over nulls, so a side without months must be asked for
    weaker = F.when(F.col("_z1").isNotNull() & F.col("_z2").isNotNull(), F.least("_z1", "_z2"))
    spikes = _holm(beside.withColumn("z_cliff", weaker).withColumn("_p", _normal_tail(weaker)), "_p", "p_cliff")
    cliff = F.coalesce(F.col("p_cliff") < alpha, F.lit(False))
    level = spikes.withColumn("cliff", cliff).withColumns(
        {
            "_c": F.when(~F.col("cliff"), F.col("churned")).otherwise(0),
            "_n": F.when(~F.col("cliff"), F.col("at_risk")).otherwise(0),
        }
    )
    later = months.rangeBetween(0, window - 1)
    step = _rates_apart(
        F.sum("_c").over(later), F.sum("_n").over(later), F.sum("_c").over(before), F.sum("_n").over(before)
    )
    scanned = level.withColumn("z_shift", step)
    tail = F.least(F.lit(1.0), F.lit(2.0) * _normal_tail(F.abs("z_shift")))
    scanned = _holm(scanned.withColumn("_p", tail), "_p", "p_shift")
    # the clearest month of its surroundings, the earliest of equal ones
    size = F.abs("z_shift")
    ahead = F.coalesce(F.max(size).over(before), F.lit(-1.0))
    behind = F.coalesce(F.max(size).over(after), F.lit(-1.0))
    clearest = (size > ahead) & (size >= behind)
    return scanned.withColumn("shift", F.coalesce((F.col("p_shift") < alpha) & clearest, F.lit(False))).select(
        "contract_type",
        "timeline",
        "at_risk",
        "churned",
        F.try_divide(F.col("churned"), F.col("at_risk")).alias("hazard"),
        "z_cliff",
        "p_cliff",
        "cliff",
        "z_shift",
        "p_shift",
        "shift",
    )


# --- concordance ------------------------------------------------------------------


def concordance(
    df: DataFrame,
    risk: str,
    duration: str = "tenure",
    event: str = DEFAULTS.target,
    **cells: int,
) -> DataFrame:
    """Harrell's concordance of a risk score with churn order; one row.

    A pair counts when one account churned at t and the other stayed longer (or
    was still there at t). It is concordant when the churned one has the higher
    score; equal scores count half.

    No pairs are formed. Durations, any numbers, are numbered in order. Two
    numbers differ first, reading binary digits from the top, at one digit b: they
    share the digits above it, and the shorter has 0 there. So per digit, accounts
    with equal higher digits form a block, and every pair of different durations
    meets in exactly one block: churned accounts with digit 0 against all accounts
    with digit 1. Equal durations are blocks of their own, churned against censored.
    Per block the pairs follow from running counts along the score. Counts of pairs
    are exact decimals.
    """
    known = df.select(
        (C.nan_to_null(F.col(risk).cast("double")) + F.lit(0.0)).alias("risk"),
        (C.nan_to_null(F.col(duration).cast("double")) + F.lit(0.0)).alias("t"),
        (F.col(event) == 1).cast("long").alias("e"),
    ).dropna()
    # equal (score, duration) pairs are merged before they are copied per digit, and scored once
    known = materialize(known.groupBy("risk", "t").agg(F.sum("e").alias("e"), F.count("*").alias("n")))
    facts = known.agg(
        F.sum("n").alias("rows"),
        F.min("t").alias("least"),
        F.max("t").alias("most"),
        F.count_if(F.col("t") != F.floor("t")).alias("broken"),
    ).first()
    if not facts["rows"] or (facts["least"] >= 0 and facts["most"] < 2**31 and not facts["broken"]):
        # whole numbers from 0 on are in order as they are
        known, top = known.withColumn("d", F.col("t").cast("long")), int(facts["most"] or 0)
    else:
        known, top = _numbered(known, **cells)
    digits = max(1, top.bit_length())
    blocks = []
    zero = F.lit(0).cast("long")
    for b in range(digits):
        upper = F.shiftright("d", b + 1)
        one = F.shiftright("d", b).bitwiseAND(F.lit(1)) == 1
        blocks.append(
            F.struct(
                F.concat_ws(":", F.lit(b), upper).alias("block"),
                F.when(one, zero).otherwise(F.col("e")).alias("churned"),
                F.when(one, F.col("n")).otherwise(zero).alias("stayed"),
            )
        )
    blocks.append(
        F.struct(
            F.concat_ws(":", F.lit("="), F.col("d")).alias("block"),
            F.col("e").alias("churned"),
            (F.col("n") - F.col("e")).alias("stayed"),
        )
    )
    parts = (
        known.select("risk", F.explode(F.array(*blocks)).alias("p"))
        .select("risk", "p.*")
        .where("churned > 0 OR stayed > 0")
    )
    totals = running_totals(
        parts, "risk", {"churned": F.col("churned"), "stayed": F.col("stayed")}, "block", **cells
    )
    # blocks without pairs go; as both totals are asked for, both sides of the join above
    # need the same columns and read one shuffled table
    totals = totals.where((F.col("churned_total") > 0) & (F.col("stayed_total") > 0))
    # pairs of fewer rows than this fit a long, and so do all sums of them
    kind = "long" if (facts["rows"] or 0) < 3_000_000_000 else "decimal(19,0)"

    def pairs(stayed: str) -> Column:
        found = F.sum(F.col("churned").cast(kind) * F.col(stayed).cast(kind))
        return F.coalesce(found.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))

    sums = totals.agg(
        pairs("stayed_total").alias("comparable_pairs"),
        pairs("stayed_below").alias("concordant_pairs"),
        pairs("stayed").alias("tied_pairs"),
    )
    comparable, concordant, tied = (F.col(c).cast("double") for c in sums.columns)
    return sums.withColumn(
        "concordance_index",
        F.when(comparable > 0, F.try_divide(concordant + tied / F.lit(2.0), comparable)),
    )


def _numbered(known: DataFrame, **cells: int) -> tuple[DataFrame, int]:
    """Column ``d`` with the number of each duration ``t`` in ascending order, and the last number."""
    one = {"one": F.lit(1).cast("long")}
    order = running_totals(known.select("t").distinct(), "t", one, **cells)
    order = materialize(order.select(F.col("_value").alias("t"), F.col("one_below").alias("d")))
    count = order.count()
    if count <= _BROADCAST_DURATIONS:
        order = F.broadcast(order)
    return known.join(order, "t"), count - 1


# --- Cox proportional hazards -------------------------------------------------------


class NotConverged(RuntimeError):
    """A fit that used up its passes."""


class _CoxParams(Params):
    durationCol = Param(Params._dummy(), "durationCol", "months observed, parts of months as well", TypeConverters.toString)
    eventCol = Param(Params._dummy(), "eventCol", "1 if churned at durationCol", TypeConverters.toString)
    covariates = Param(
        Params._dummy(),
        "covariates",
        "numeric covariate columns; empty for all numeric columns",
        TypeConverters.toListString,
    )
    categories = Param(
        Params._dummy(),
        "categories",
        "text columns coded one column per level, first level left out",
        TypeConverters.toListString,
    )
    ridge = Param(Params._dummy(), "ridge", "penalty on standardized coefficients", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "limit of passes over the data", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "longest step, in standard errors, that ends the fit", TypeConverters.toFloat)
    rowsPerCell = Param(Params._dummy(), "rowsPerCell", "rows of a cell of durations, about", TypeConverters.toInt)
    maxCells = Param(Params._dummy(), "maxCells", "cells of durations, at most", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(
            durationCol="tenure",
            eventCol=DEFAULTS.target,
            covariates=[],
            categories=["Contract"],
            ridge=0.0,
            maxIter=50,
            tol=1e-9,
            rowsPerCell=ROWS_PER_CELL,
            maxCells=MAX_CELLS,
        )


class CoxSurvival(Estimator, _CoxParams, DefaultParamsReadable, DefaultParamsWritable):
    """Cox model by Newton steps, ties after Efron, over any number of durations.

    Each step is one pass of risk-set sums (``risk_sets``); the driver sees one row per
    cell of durations and solves a p x p system. Steps go on until the last one is a
    billionth of a standard error (``tol``). On large tables the start comes from a fit on
    a sample, which saves passes and leaves the maximum as it is. Accounts with tenure 0
    or a missing value are left out.
    """

    @keyword_only
    def __init__(
        self,
        *,
        durationCol: str = "tenure",
        eventCol: str = DEFAULTS.target,
        covariates: Sequence[str] = (),
        categories: Sequence[str] = ("Contract",),
        ridge: float = 0.0,
        maxIter: int = 50,
        tol: float = 1e-9,
        rowsPerCell: int = ROWS_PER_CELL,
        maxCells: int = MAX_CELLS,
    ):
        super().__init__()
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})

    def _design(self, df: DataFrame) -> tuple[list[str], list[str], list[tuple[str, str]]]:
        """(numeric covariates, all covariate names, (column, level) of the coded ones)."""
        skip = {self.getOrDefault("durationCol"), self.getOrDefault("eventCol")}
        numeric = list(self.getOrDefault("covariates")) or [
            f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip
        ]
        coded = []
        for name in self.getOrDefault("categories"):
            if name not in df.columns:
                continue
            found = df.select(name).where(F.col(name).isNotNull()).distinct().limit(_MAX_LEVELS + 1)
            levels = sorted(row[0] for row in found.collect())
            if len(levels) > _MAX_LEVELS:
                raise ValueError(f"{name} has more than {_MAX_LEVELS} levels")
            coded.extend((name, level) for level in levels[1:])
        return numeric, [*numeric, *[f"{c}={v}" for c, v in coded]], coded

    def _fit(self, dataset: DataFrame) -> CoxSurvivalModel:
        numeric, names, coded = self._design(dataset)
        model = CoxSurvivalModel()
        self._copyValues(model)
        model._set(
            covariates=numeric,
            codedColumns=[c for c, _ in coded],
            codedLevels=[v for _, v in coded],
        )
        inputs = model._inputs()
        rows = dataset.select(
            C.nan_to_null(F.col(self.getOrDefault("durationCol")).cast("double")).alias("t"),
            F.col(self.getOrDefault("eventCol")).cast("int").alias("e"),
            *[c.alias(f"x{i}") for i, c in enumerate(inputs)],
        )
        complete = F.col("t") > 0
        for name in rows.columns[1:]:
            complete = complete & F.col(name).isNotNull()
        rows = rows.where(complete)
        summary = rows.agg(
            F.count("*").alias("n"),
            *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(inputs))],
            *[F.stddev_pop(f"x{i}").alias(f"s{i}") for i in range(len(inputs))],
        ).first()
        if not summary["n"]:
            raise ValueError("no complete rows with positive duration")
        means = np.array([summary[f"m{i}"] for i in range(len(inputs))])
        stds = np.array([summary[f"s{i}"] for i in range(len(inputs))])
        varying = [i for i in range(len(inputs)) if stds[i] > 1e-12 * max(1.0, abs(means[i]))]
        scaled = rows.select(
            "t",
            "e",
            *[
                ((F.col(f"x{i}") - float(means[i])) / float(stds[i])).alias(f"z{j}")
                for j, i in enumerate(varying)
            ],
        )
        start = np.zeros(len(varying))
        if summary["n"] > 4 * _WARM_ROWS:
            # a sample only chooses where the passes over all rows begin
            start = self._sample_start(scaled.where(F.rand(0) < _WARM_ROWS / summary["n"]), start)
        sets = self._risk_sets(scaled)
        try:
            beta, information, loglik, sums, steps = self._newton(sets, start)
            months, hazards, table = sets.baseline(beta, sums)
        finally:
            sets.release()
        covariance = np.linalg.inv(information)
        coef, error = np.zeros(len(inputs)), np.zeros(len(inputs))
        for j, i in enumerate(varying):
            coef[i] = beta[j] / stds[i]
            error[i] = math.sqrt(max(covariance[j, j], 0.0)) / stds[i]
        model._set(
            names=names,
            means=[float(v) for v in means],
            coefficients=[float(v) for v in coef],
            standardErrors=[float(v) for v in error],
            logLikelihood=float(loglik),
            steps=steps,
        )
        if table is None:
            model._set(
                baselineMonths=[float(v) for v in months],
                baselineHazard=[float(v) for v in np.cumsum(hazards)],
            )
        else:
            model._keep_baseline(table)
        return model

    def _risk_sets(self, scaled: DataFrame) -> RiskSets:
        return RiskSets(scaled, self.getOrDefault("rowsPerCell"), self.getOrDefault("maxCells"))

    def _sample_start(self, part: DataFrame, start: np.ndarray) -> np.ndarray:
        """Where the fit on a sample ends; a sample that can't be fitted leaves the start as it is."""
        sets = self._risk_sets(part)
        try:
            return self._newton(sets, start)[0]
        except (NotConverged, np.linalg.LinAlgError):
            return start
        finally:
            sets.release()

    def _newton(self, sets: RiskSets, start: np.ndarray):
        ridge, p = self.getOrDefault("ridge"), len(start)
        beta, best, step = start, None, None
        for passes in range(1, self.getOrDefault("maxIter") + 1):
            loglik, gradient, information, sums = sets.likelihood(beta)
            loglik -= ridge / 2 * float(beta @ beta)
            if best is not None and not loglik >= best[0] - 1e-9 * abs(best[0]):
                step = step / 2  # overshot: back half way
                beta = best[1] + step
                continue
            gradient = gradient - ridge * beta
            information = information + ridge * np.eye(p)
            if p and np.linalg.cond(information) > 1e12:
                # collinear covariates: the smallest ridge that makes the system solvable
                information = information + np.eye(p) * 1e-9 * max(1.0, float(np.trace(information)))
            step = np.linalg.solve(information, gradient) if p else np.zeros(0)
            errors = np.sqrt(np.clip(np.diag(np.linalg.inv(information)), 0, None)) if p else np.ones(0)
            best = (loglik, beta)
            beta = beta + step
            if not (np.abs(step) > self.getOrDefault("tol") * errors).any():
                return beta, information, loglik, sums, passes
        raise NotConverged("Cox fit did not converge; raise maxIter or ridge")


class CoxSurvivalModel(Model, _CoxParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted Cox model; ``transform`` adds the log relative hazard ``log_risk``."""

    names = Param(Params._dummy(), "names", "covariate names", TypeConverters.toListString)
    codedColumns = Param(Params._dummy(), "codedColumns", "column of each coded level", TypeConverters.toListString)
    codedLevels = Param(Params._dummy(), "codedLevels", "coded levels", TypeConverters.toListString)
    means = Param(Params._dummy(), "means", "covariate means", TypeConverters.toListFloat)
    coefficients = Param(Params._dummy(), "coefficients", "log hazard ratios", TypeConverters.toListFloat)
    standardErrors = Param(Params._dummy(), "standardErrors", "errors of coefficients", TypeConverters.toListFloat)
    baselineMonths = Param(Params._dummy(), "baselineMonths", "months with a hazard step, where a cell holds one", TypeConverters.toListFloat)
    baselineHazard = Param(Params._dummy(), "baselineHazard", "cumulative hazard at mean covariates", TypeConverters.toListFloat)
    baselineTable = Param(Params._dummy(), "baselineTable", "table of hazard steps, where there are many", TypeConverters.toString)
    logLikelihood = Param(Params._dummy(), "logLikelihood", "log partial likelihood", TypeConverters.toFloat)
    steps = Param(Params._dummy(), "steps", "passes over the data", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(baselineTable="")

    def _keep_baseline(self, steps: DataFrame) -> None:
        """Write (t, step) with the cumulative hazard, as a table of its own."""
        totals = running_totals(
            steps,
            "t",
            {"step": F.col("step")},
            rows_per_cell=self.getOrDefault("rowsPerCell"),
            max_cells=self.getOrDefault("maxCells"),
        )
        table = totals.select(F.col("_value").alias("t"), "step", (F.col("step_below") + F.col("step")).alias("hazard"))
        path = f"{shared_folder(steps.sparkSession).rstrip('/')}/baseline-{uuid.uuid4().hex}"
        table.write.parquet(path)
        self._set(baselineTable=path, baselineMonths=[], baselineHazard=[])

    def baseline(self) -> DataFrame:
        """One row per duration with events, ``t`` and the cumulative ``hazard`` up to it."""
        spark = SparkSession.getActiveSession()
        path = self.getOrDefault("baselineTable")
        if path:
            return spark.read.parquet(path).select("t", "hazard")
        known = zip(self.getOrDefault("baselineMonths"), self.getOrDefault("baselineHazard"))
        return spark.createDataFrame(list(known), "t double, hazard double")

    def save_baseline(self, path: str) -> CoxSurvivalModel:
        """Copy a baseline table to a folder of the caller's and read it from there; then save the model."""
        if self.getOrDefault("baselineTable"):
            spark = SparkSession.getActiveSession()
            spark.read.parquet(self.getOrDefault("baselineTable")).write.parquet(path)
            self._set(baselineTable=path)
        return self

    def _inputs(self) -> list[Column]:
        numeric = [C.nan_to_null(F.col(c).cast("double")) for c in self.getOrDefault("covariates")]
        coded = zip(self.getOrDefault("codedColumns"), self.getOrDefault("codedLevels"))
        return numeric + [(F.col(c) == F.lit(v)).cast("double") for c, v in coded]

    def _log_risk(self) -> Column:
        out = F.lit(0.0)
        for c, m, b in zip(
            self._inputs(), self.getOrDefault("means"), self.getOrDefault("coefficients")
        ):
            if b:
                out = out + F.lit(b) * (c - F.lit(m))
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("log_risk", self._log_risk())

    def get_hazard_ratios(self, spark=None) -> DataFrame:
        """One row per covariate: coefficient, hazard ratio with 95 % limits, Wald z and p."""
        spark = spark or SparkSession.getActiveSession()
        rows = []
        for name, b, se in zip(
            self.getOrDefault("names"),
            self.getOrDefault("coefficients"),
            self.getOrDefault("standardErrors"),
        ):
            z = b / se if se > 0 else None
            p = math.erfc(abs(z) / math.sqrt(2)) if z is not None else None
            reach = 1.959963984540054 * se
            rows.append(
                (name, b, math.exp(b), se, math.exp(b - reach), math.exp(b + reach), z, p)
            )
        return spark.createDataFrame(
            rows,
            "covariate string, coef double, hazard_ratio double, se double, "
            "hazard_ratio_lower double, hazard_ratio_upper double, z double, p double",
        )

    def cumulative_hazard_at(self, months: float) -> float:
        """Baseline cumulative hazard up to and including ``months``."""
        if self.getOrDefault("baselineTable"):
            reached = self.baseline().where(F.col("t") <= float(months)).agg(F.max("hazard")).first()[0]
            return float(reached or 0.0)
        return float(self._hazard_by([months])[0])

    def _hazard_by(self, times: Sequence[float]) -> np.ndarray:
        reached = np.searchsorted(self.getOrDefault("baselineMonths"), times, side="right")
        return np.concatenate(([0.0], self.getOrDefault("baselineHazard")))[reached]

    def predict_churn_probability_at(
        self,
        df: DataFrame,
        months: int = 12,
        given_tenure: bool = False,
        output: str = "churn_probability_at",
    ) -> DataFrame:
        """Add the probability of churn within ``months``.

        Counted from the start, or with ``given_tenure`` from the account's
        present tenure on. One projection; also runs on streaming DataFrames. Only with
        ``given_tenure`` and a baseline of very many durations are these looked up by a
        join, over a running total of hazard steps and asked durations.
        """
        columns, hazard = df.columns, None
        if not given_tenure:
            hazard = F.lit(self.cumulative_hazard_at(months))
        elif self.getOrDefault("baselineTable"):
            df, hazard = self._hazard_joined(df, months)
        else:
            tenure = F.col(self.getOrDefault("durationCol"))
            hazard = self._hazard_column(tenure + F.lit(months)) - self._hazard_column(tenure)
        risk = F.exp(self._log_risk())
        kept = [c for c in columns if c != output]
        return df.select(*kept, (F.lit(1.0) - F.exp(-hazard * risk)).alias(output))

    def _hazard_joined(self, df: DataFrame, months: float) -> tuple[DataFrame, Column]:
        """``df`` with the hazard of the ``months`` after each row's tenure, and that column."""
        tenure = C.nan_to_null(F.col(self.getOrDefault("durationCol")).cast("double")) + F.lit(0.0)
        asked = df.select(tenure.alias("t")).distinct().where("t IS NOT NULL")
        ends = asked.select(F.explode(F.array("t", F.col("t") + F.lit(float(months)))).alias("t"))
        steps = SparkSession.getActiveSession().read.parquet(self.getOrDefault("baselineTable")).select("t", "step")
        totals = running_totals(
            steps.unionByName(ends.withColumn("step", F.lit(0.0))),
            "t",
            {"step": F.col("step")},
            rows_per_cell=self.getOrDefault("rowsPerCell"),
            max_cells=self.getOrDefault("maxCells"),
        )
        upto = materialize(totals.select("_value", (F.col("step_below") + F.col("step")).alias("_upto")))
        later = upto.select(F.col("_value").alias("_end"), F.col("_upto").alias("_later"))
        found = (
            asked.withColumn("_end", F.col("t") + F.lit(float(months)))
            .join(upto.withColumnRenamed("_value", "t"), "t")
            .join(later, "_end")
            .select(F.col("t").alias("_tenure"), (F.col("_later") - F.col("_upto")).alias("_hazard"))
        )
        return df.withColumn("_tenure", tenure).join(found, "_tenure", "left"), F.col("_hazard")

    def _hazard_column(self, months: Column) -> Column:
        times = self.getOrDefault("baselineMonths")
        if all(t == int(t) for t in times):
            last = int(max(times))
            by_month = double_array(self._hazard_by(range(last + 1)).tolist())
            place = F.when(months > last, last).when(months < 0, 0).otherwise(months.cast("int"))
            return F.element_at(by_month, place + 1)
        reached = F.size(F.filter(double_array(times), lambda t: t <= months))
        hazard = F.element_at(double_array([0.0, *self.getOrDefault("baselineHazard")]), reached + 1)
        return F.when(months.isNotNull(), hazard)

    def concordance_index(self, df: DataFrame, **cells: int) -> DataFrame:
        """Harrell's concordance of this model's risk on ``df``; one row."""
        return concordance(
            self.transform(df),
            "log_risk",
            self.getOrDefault("durationCol"),
            self.getOrDefault("eventCol"),
            **cells,
        )

    def get_kaplan_meier_data(self, df: DataFrame, group: str = "Contract") -> DataFrame:
        return kaplan_meier(
            df, self.getOrDefault("durationCol"), self.getOrDefault("eventCol"), group
        ).orderBy("contract_type", "timeline")


class CoxChurnScore:
    """A Cox model as a churn classifier: the probability of churn within ``months``."""

    def __init__(self, covariates: Sequence[str], months: int = 12, threshold: float = DEFAULTS.threshold, **params):
        self.covariates, self.months, self.threshold, self.params = list(covariates), months, threshold, params
        self.model_: CoxSurvivalModel | None = None

    def fit(self, df: DataFrame, label: str = DEFAULTS.target) -> CoxChurnScore:
        self.model_ = CoxSurvival(covariates=self.covariates, eventCol=label, **self.params).fit(df)
        return self

    def predict_proba(self, df: DataFrame) -> DataFrame:
        out = self.model_.predict_churn_probability_at(df, self.months, output="churn_probability")
        return out.withColumn("predicted", (F.col("churn_probability") >= self.threshold).cast("int"))


# --- parametric comparison ----------------------------------------------------------


def fit_aft(
    df: DataFrame,
    covariates: Sequence[str],
    duration: str = "tenure",
    event: str = DEFAULTS.target,
    max_iter: int = 50,
) -> AFTSurvivalRegressionModel:
    """Weibull accelerated-failure-time model of the same data, built into Spark ML."""
    rows = df.where(F.col(duration) > 0).select(
        F.col(duration).cast("double").alias("label"),
        F.col(event).cast("double").alias("censor"),
        *covariates,
    )
    assembled = VectorAssembler(
        inputCols=list(covariates), outputCol="features", handleInvalid="skip"
    ).transform(rows)
    return AFTSurvivalRegression(maxIter=max_iter).fit(assembled)
