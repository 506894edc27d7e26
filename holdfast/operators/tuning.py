"""Selection by scores: a search under a budget of time, and learned weights of an ensemble."""

from __future__ import annotations

import functools
import itertools
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.metrics import threshold_curve
from holdfast.operators.ranking import _digest_at, key_digest, stratified_folds, stratified_split
from holdfast.schema import DEFAULTS
from holdfast.session import ROWS_PER_FILE, materialize

# --- successive halving -----------------------------------------------------------------


class Between(NamedTuple):
    """A range of a search space; whole numbers if both ends are, even steps in logs with ``log``."""

    low: float
    high: float
    log: bool = False

    def draw(self, rng: random.Random):
        if self.log:
            value = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        elif isinstance(self.low, int) and isinstance(self.high, int):
            return rng.randint(self.low, self.high)
        else:
            value = rng.uniform(self.low, self.high)
        return min(max(value, self.low), self.high)


class Found(NamedTuple):
    best: dict[str, Any]
    score: float
    trials: DataFrame  # trial, params, rung, share, f2_score, status


def draws(space: Mapping[str, Sequence | Between], trials: int, seed: int) -> list[dict[str, Any]]:
    """Seeded different combinations; all of them, in order, where lists give no more than ``trials``."""
    rng = random.Random(seed)
    if not any(isinstance(v, Between) for v in space.values()):
        if math.prod(len(v) for v in space.values()) <= trials:
            return [dict(zip(space, values)) for values in itertools.product(*space.values())]
    out: list[dict[str, Any]] = []
    for _ in range(20 * trials):
        one = {k: v.draw(rng) if isinstance(v, Between) else rng.choice(list(v)) for k, v in space.items()}
        if one not in out:
            out.append(one)
        if len(out) == trials:
            break
    return out


def f_beta(scored: DataFrame, label: str, threshold: float, beta: float) -> float:
    curve = threshold_curve(scored.select(F.col(label).alias("y"), F.col("churn_probability").alias("p")), "y", "p", [threshold], beta=beta)
    return float(curve.first()["f2_score"])


def halving_search(
    df: DataFrame,
    make_model: Callable[..., Any],
    space: Mapping[str, Sequence | Between],
    trials: int = 150,
    seconds: float = 600.0,
    keep: int = 3,
    rungs: int | None = None,
    label: str = DEFAULTS.target,
    key: str = DEFAULTS.key,
    seed: int = DEFAULTS.seed,
    threshold: float = DEFAULTS.threshold,
    beta: float = DEFAULTS.beta,
    parallelism: int = 2,
    clock: Callable[[], float] = time.monotonic,
) -> Found:
    """The combination with the highest F-beta, by successive halving within a time.

    ``make_model(**params)`` returns an unfitted model. Each rung fits the combinations left
    on a sample of the training part, ``keep`` times the one before, and measures them on a
    sample of the held-out part; the best 1 / ``keep`` of them go on, and the last rung has all
    rows. Samples are ranges of a hashed key, so each holds those before it, exact strata
    part training and held-out rows, and no result depends on how the table is stored.

    Every rung has an even share of the time left. What has not begun when it is up is left
    out (status "out of time"), in order of the rung before, so that a short time drops the
    least promising ones. The best one is that of the last rung with a score.
    """
    combos = draws(space, trials, seed)
    known = df.where(F.col(label).isNotNull())
    train, held = (materialize(p) for p in stratified_split(known, label, key, seed=seed))
    if rungs is None:
        rungs = max(1, round(math.log(max(len(combos), 1), keep)) + 1)
    start, left = clock(), list(range(len(combos)))
    rows: list[tuple] = []
    best: tuple[int, float] | None = None

    def params(i: int) -> str:
        return ", ".join(f"{k}={v}" for k, v in sorted(combos[i].items()))

    for rung in range(rungs):
        share = float(keep) ** (rung - rungs + 1)
        spot = key_digest(key, seed + 1)
        seen, test = (p.where(spot < _digest_at(share)) if share < 1 else p for p in (train, held))
        end = clock() + (start + seconds - clock()) / (rungs - rung)

        def measure(i: int) -> float | None:
            if clock() >= end:
                return None
            scored = make_model(**combos[i]).fit(seen, label).predict_proba(test)
            return f_beta(scored, label, threshold, beta)

        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            scores = dict(zip(left, pool.map(measure, left)))
        done = sorted((i for i in left if scores[i] is not None), key=lambda i: (-scores[i], i))
        wanted = max(1, math.ceil(len(left) / keep)) if rung + 1 < rungs else 1
        for i in left:
            status = "out of time" if scores[i] is None else "kept" if i in done[:wanted] else "dropped"
            rows.append((i, params(i), rung, share, scores[i], status))
        if not done:
            break
        best = (done[0], scores[done[0]])
        left = done[:wanted]
    if best is None:
        raise TimeoutError("no combination was measured within the time given")
    schema = "trial int, params string, rung int, share double, f2_score double, status string"
    return Found(combos[best[0]], best[1], df.sparkSession.createDataFrame(rows, schema))


class RuleModel:
    """Flags accounts whose ``column`` is at least ``cut``; nothing to fit. A baseline for searches."""

    def __init__(self, column: str, cut: float):
        self.column, self.cut = column, cut

    def fit(self, df: DataFrame, label: str = DEFAULTS.target) -> RuleModel:
        return self

    def predict_proba(self, df: DataFrame) -> DataFrame:
        return df.withColumn("churn_probability", F.coalesce(F.col(self.column) >= F.lit(self.cut), F.lit(False)).cast("double"))


# --- learned weights ---------------------------------------------------------------------


def nonnegative_solution(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The w >= 0 with the least w'Gw - 2 b'w, by growing and shrinking the set of positive ones."""
    k = len(target)
    w, free = np.zeros(k), np.zeros(k, bool)
    tol = 1e-12 * max(1.0, float(np.abs(target).max(initial=0.0)))
    for _ in range(30 * max(k, 1)):
        slope = target - gram @ w
        slope[free] = -np.inf
        if not k or slope.max() <= tol:
            return w
        free[int(slope.argmax())] = True
        while True:
            trial = np.zeros(k)
            trial[free] = np.linalg.lstsq(gram[np.ix_(free, free)], target[free], rcond=None)[0]
            if not (trial[free] <= 0).any():
                break
            # back to where the first weight reaches 0
            falling = free & (trial <= 0)
            step = float(np.min(w[falling] / (w[falling] - trial[falling]), initial=1.0))
            w = w + step * (trial - w)
            free &= w > tol
            w[~free] = 0.0
        w = trial
    return w


def stack_weights(df: DataFrame, scores: Sequence[str], label: str = DEFAULTS.target) -> dict[str, float]:
    """Non-negative weights of score columns whose weighted sum is nearest to the label, by squares.

    One pass: the driver sees the k x k sums of products. Rows with a missing score or
    label are left out. Scores should be of accounts their models have not seen.
    """
    pairs = [(i, j) for i in range(len(scores)) for j in range(i, len(scores))]
    a = [F.col(c).cast("double") for c in scores]
    y = F.col(label).cast("double")
    sums = df.dropna(subset=[*scores, label]).agg(
        *[F.sum(a[i] * a[j]).alias(f"g{i}_{j}") for i, j in pairs],
        *[F.sum(x * y).alias(f"b{i}") for i, x in enumerate(a)],
    ).first()
    gram = np.zeros((len(scores), len(scores)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"g{i}_{j}"] or 0.0
    target = np.array([sums[f"b{i}"] or 0.0 for i in range(len(scores))])
    # equal scales, so that tolerances mean the same for every score
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    w = nonnegative_solution(gram / np.outer(scale, scale), target / scale) / scale
    return dict(zip(scores, (float(v) for v in w)))


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of score columns times weights, within 0 and 1; null where a score with a weight is."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        if weight:
            total = total + F.col(name) * F.lit(float(weight))
    return F.when(total.isNotNull(), F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


class StackedModel:
    """Several models and the weights that out-of-fold scores of the training rows give them.

    ``makers`` maps names of scores to functions that return an unfitted model. ``prepare``
    fits features anew for each fold, as for ``out_of_fold_scores``.
    """

    def __init__(
        self,
        makers: Mapping[str, Callable[[], Any]],
        folds: int = DEFAULTS.folds,
        threshold: float = DEFAULTS.threshold,
        key: str = DEFAULTS.key,
        seed: int = DEFAULTS.seed,
    ):
        self.makers, self.folds, self.threshold, self.key, self.seed = dict(makers), folds, threshold, key, seed
        self.models: dict[str, Any] = {}
        self.weights: dict[str, float] = {}

    def fit(self, df: DataFrame, label: str = DEFAULTS.target, prepare: Callable | None = None, fold_label: str | None = None):
        """``df`` is a feature table, or with ``prepare`` the raw one, whose label is ``fold_label``."""
        folded = stratified_folds(df, fold_label or label, self.key, self.folds, self.seed, "_fold")
        folded = materialize(folded, ROWS_PER_FILE)  # every fold reads it many times
        df = folded.drop("_fold")
        parts = []
        for f in range(self.folds):
            seen, held = (folded.where(F.col("_fold") != f).drop("_fold"), folded.where(F.col("_fold") == f).drop("_fold"))
            if prepare is not None:
                seen, held = prepare(seen, seen, held)
            models = {name: make().fit(seen, label) for name, make in self.makers.items()}
            parts.append(self._scores(held, models).select(label, *self.makers))
        unseen = materialize(functools.reduce(DataFrame.unionByName, parts))
        self.weights = stack_weights(unseen, list(self.makers), label)
        rows = df if prepare is None else prepare(df, df)[0]
        self.models = {name: make().fit(rows, label) for name, make in self.makers.items()}
        return self

    def _scores(self, df: DataFrame, models: Mapping[str, Any]) -> DataFrame:
        out = df.drop("churn_probability", "predicted", *models)
        plain = out.columns
        for name, model in models.items():
            done = [c for c in out.columns if c not in plain]
            out = model.predict_proba(out).select(*plain, *done, F.col("churn_probability").alias(name))
        return out

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add each model's score, their weighted sum and the prediction at the threshold."""
        out = self._scores(df, self.models).withColumn("churn_probability", weighted_score(self.weights))
        return out.withColumn("predicted", (F.col("churn_probability") >= self.threshold).cast("int"))
