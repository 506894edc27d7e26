"""Churn classifiers on Spark ML, their selection and explanation."""

from __future__ import annotations

import math
import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators.clean import drop_non_features
from holdfast.operators.encoding import OrderedTargetEncoder, OrderedTargetModel
from holdfast.operators.metrics import roc_auc, threshold_curve
from holdfast.operators.ranking import key_digest, stratified_folds
from holdfast.operators.trees import attributed, forest_nodes, gain_by_feature, model_inputs
from holdfast.schema import CATEGORICAL_COLUMNS, DEFAULTS
from holdfast.session import ROWS_PER_FILE, ensure_checkpoint_dir, materialize

_LABEL, _WEIGHT = "_label", "_weight"
_MISSING = -1.0  # below every feature's range, so a tree can set it apart
_CYCLE_ROWS = 100_000


def feature_groups(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) model inputs of a feature table."""
    inputs = drop_non_features(df, tuple(exclude))
    categorical = [c for c in inputs if c in CATEGORICAL_COLUMNS]
    numeric = [
        c
        for c in inputs
        if c not in categorical and isinstance(df.schema[c].dataType, T.NumericType)
    ]
    return numeric, categorical


def categorical_positions(inputs: Sequence[str]) -> list[int]:
    return [i for i, c in enumerate(inputs) if c in CATEGORICAL_COLUMNS]


def _fill_stage(numeric: Sequence[str], categorical: Sequence[str]) -> SQLTransformer:
    """Doubles with missing marked; categories as text with missing as "nan"."""
    filled = [f"coalesce(cast(`{c}` as double), {_MISSING}D) AS `_n_{c}`" for c in numeric]
    texts = [f"coalesce(cast(`{c}` as string), 'nan') AS `_s_{c}`" for c in categorical]
    return SQLTransformer(statement=f"SELECT *, {', '.join([*filled, *texts])} FROM __THIS__")


def _most_levels(df: DataFrame, categorical: Sequence[str]) -> int:
    """Room for the levels of any categorical input, the missing and the unseen one among them."""
    if not categorical:
        return 0
    counts = df.agg(*[F.approx_count_distinct(c, 0.01).alias(c) for c in categorical]).first()
    return max(math.ceil(1.1 * n) + 2 for n in counts)


def _index_stage(categorical: Sequence[str]) -> StringIndexer:
    return StringIndexer(
        inputCols=[f"_s_{c}" for c in categorical],
        outputCols=[f"_i_{c}" for c in categorical],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


class _ChurnModel:
    """Shared parts of the classifiers: fit, score, importance, save and load.

    ``fit_rows`` bounds the labelled rows a model is fitted on: larger tables give a
    sample of about that many, drawn by hashed key, as hundreds of dependent rounds
    over all rows would not end. None fits on all of them. Every row is scored.
    """

    def __init__(self, threshold: float = DEFAULTS.threshold, exclude: Sequence[str] = (), **params):
        self.threshold = threshold
        self.exclude = tuple(exclude)
        self.params = params
        self.model_: PipelineModel | None = None

    def pipeline(self, df: DataFrame) -> Pipeline:
        raise NotImplementedError

    def _labelled(self, df: DataFrame, label: str) -> DataFrame:
        return self._bounded(df.where(F.col(label).isNotNull())).withColumns(
            {
                _LABEL: F.col(label).cast("double"),
                _WEIGHT: F.when(F.col(label) == 1, self.positive_weight).otherwise(1.0),
            }
        )

    def _bounded(self, df: DataFrame) -> DataFrame:
        most = self.params.get("fit_rows", DEFAULTS.fit_rows)
        n = df.count() if most is not None else 0
        if most is None or n <= most:
            return df
        numeric, categorical = feature_groups(df, self.exclude)
        key = [DEFAULTS.key] if DEFAULTS.key in df.columns else []
        spot = F.pmod(F.xxhash64(F.lit(self.params.get("seed", DEFAULTS.seed)), *key, *numeric, *categorical), F.lit(1 << 40))
        return df.where(spot < int(most / n * (1 << 40)))

    @property
    def positive_weight(self) -> float:
        return float(self.params.get("positive_weight", DEFAULTS.positive_weight))

    def fit(self, df: DataFrame, label: str = DEFAULTS.target):
        ensure_checkpoint_dir(df.sparkSession)
        self.model_ = self.pipeline(df).fit(self._labelled(df, label))
        return self

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add churn_probability and the prediction at the threshold."""
        columns = [c for c in df.columns if c not in ("churn_probability", "predicted")]
        scored = self.model_.transform(df.select(*columns))
        p = vector_to_array("probability")[1]
        return scored.select(*columns, p.alias("churn_probability")).withColumn(
            "predicted", (F.col("churn_probability") >= self.threshold).cast("int")
        )

    def nodes(self) -> DataFrame:
        """The fitted forest, one row per node."""
        return forest_nodes(self.model_.stages[-1], model_inputs(self)[0])

    def get_feature_importance(self, spark=None) -> DataFrame:
        """feature, importance_gain (raw, not scaled), its share and splits, most important first."""
        return gain_by_feature(self.nodes(), model_inputs(self)[0])

    def explain(self, df: DataFrame) -> DataFrame:
        """Add ``base_value``, ``margin`` and ``effects``, what each feature adds to an account's margin.

        Effects and base add up to the margin: half the log odds for boosted trees, the
        probability for a random forest.
        """
        columns = [c for c in df.columns if c not in ("base_value", "margin", "effects")]
        names, inputs = model_inputs(self)
        assembled = PipelineModel(self.model_.stages[:-1]).transform(df.select(*columns))
        found = attributed(assembled, self.nodes(), inputs, names)
        total = F.aggregate(F.map_values("effects"), F.lit(0.0), lambda a, v: a + v)
        return found.select(*columns, "base_value", (F.col("base_value") + total).alias("margin"), "effects")

    def save(self, path: str) -> None:
        """Write the fitted stages and, beside them, the threshold and exclusions."""
        from pyspark.sql import SparkSession

        self.model_.write().overwrite().save(path)
        settings = SparkSession.getActiveSession().createDataFrame(
            [(self.threshold, list(self.exclude))], "threshold double, exclude array<string>"
        )
        settings.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/settings")

    def load(self, path: str):
        from pyspark.sql import SparkSession

        self.model_ = PipelineModel.load(path)
        settings = SparkSession.getActiveSession().read.parquet(f"{path.rstrip('/')}/settings").first()
        self.threshold, self.exclude = settings["threshold"], tuple(settings["exclude"])
        return self


class BoostedChurnModel(_ChurnModel):
    """Gradient-boosted trees, churned accounts weighted up."""

    def pipeline(self, df: DataFrame) -> Pipeline:
        numeric, categorical = feature_groups(df, self.exclude)
        p = self.params
        stages = [_fill_stage(numeric, categorical)]
        if categorical:
            stages.append(_index_stage(categorical))
        inputs = [f"_n_{c}" for c in numeric] + [f"_i_{c}" for c in categorical]
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
        bins = max(p.get("bins", 64), _most_levels(df, categorical))
        stages.append(
            GBTClassifier(
                featuresCol="features",
                labelCol=_LABEL,
                weightCol=_WEIGHT,
                maxIter=p.get("trees", DEFAULTS.trees),
                stepSize=p.get("learning_rate", DEFAULTS.learning_rate),
                maxDepth=p.get("depth", DEFAULTS.depth),
                minInstancesPerNode=p.get("min_child_rows", DEFAULTS.min_child_rows),
                subsamplingRate=p.get("subsample", DEFAULTS.subsample),
                featureSubsetStrategy=str(p.get("feature_subset", DEFAULTS.subsample)),
                maxBins=bins,
                cacheNodeIds=True,
                checkpointInterval=10,
                seed=p.get("seed", DEFAULTS.seed),
            )
        )
        return Pipeline(stages=stages)


class ChallengerChurnModel(_ChurnModel):
    """Random forest on categories coded by ordered target statistics.

    Training rows are coded from the rows before them in several hashed orders, so that no
    code knows its own row's label; rows to be scored from all training rows.
    """

    def _encoder(self, categorical: Sequence[str]) -> OrderedTargetEncoder:
        p = self.params
        return OrderedTargetEncoder(
            inputCols=[f"_s_{c}" for c in categorical],
            outputCols=[f"_t_{c}" for c in categorical],
            labelCol=_LABEL,
            permutations=p.get("permutations", 4),
            priorWeight=float(p.get("smoothing", 1.0)),
            seed=p.get("seed", DEFAULTS.seed),
        )

    def _later_stages(self, numeric: Sequence[str], categorical: Sequence[str]) -> list:
        p = self.params
        inputs = [f"_n_{c}" for c in numeric] + [f"_t_{c}" for c in categorical]
        return [
            VectorAssembler(inputCols=inputs, outputCol="features"),
            RandomForestClassifier(
                featuresCol="features",
                labelCol=_LABEL,
                weightCol=_WEIGHT,
                numTrees=p.get("trees", DEFAULTS.trees),
                maxDepth=p.get("depth", DEFAULTS.depth),
                minInstancesPerNode=p.get("min_child_rows", DEFAULTS.min_child_rows),
                maxBins=p.get("bins", 64),
                cacheNodeIds=True,
                checkpointInterval=10,
                seed=p.get("seed", DEFAULTS.seed),
            ),
        ]

    def pipeline(self, df: DataFrame) -> Pipeline:
        """Stages for a cross-validated search, which fits and codes rows by all rows it is given."""
        numeric, categorical = feature_groups(df, self.exclude)
        coded = [self._encoder(categorical)] if categorical else []
        return Pipeline(stages=[_fill_stage(numeric, categorical), *coded, *self._later_stages(numeric, categorical)])

    def fit(self, df: DataFrame, label: str = DEFAULTS.target):
        ensure_checkpoint_dir(df.sparkSession)
        numeric, categorical = feature_groups(df, self.exclude)
        fill = _fill_stage(numeric, categorical)
        rows, done = fill.transform(self._labelled(df, label)), [fill]
        if categorical:
            encoder = self._encoder(categorical)
            done.append(encoder.fit(rows))
            rows = encoder.encode_training(rows)
        assembler, forest = self._later_stages(numeric, categorical)
        self.model_ = PipelineModel([*done, assembler, forest.fit(assembler.transform(rows))])
        return self

    def save(self, path: str) -> None:
        """As the other models; the table of levels moves to the model's folder."""
        coded = [s for s in self.model_.stages if isinstance(s, OrderedTargetModel)]
        for stage in coded:
            stage.keep_levels(f"{path.rstrip('/')}-levels")
        super().save(path)


# --- out-of-fold scores ---------------------------------------------------------

#: (rows to fit on, *tables) -> the tables with features fitted on those rows alone
Prepare = Callable[..., Sequence[DataFrame]]


def _unseen_scores(seen: DataFrame, held: DataFrame, make_model, label: str, prepare: Prepare | None) -> DataFrame:
    if prepare is not None:
        seen, held = prepare(seen, seen, held)
    return make_model().fit(seen, label).predict_proba(held)


def out_of_fold_scores(
    df: DataFrame,
    make_model,
    label: str = DEFAULTS.target,
    key: str = DEFAULTS.key,
    folds: int = DEFAULTS.folds,
    seed: int = DEFAULTS.seed,
    fold: str | None = None,
    prepare: Prepare | None = None,
) -> DataFrame:
    """Score every account by a model that has not seen it.

    ``make_model`` returns an unfitted model that ignores the fold column.
    Uses a given fold column, or exact stratified folds by hashed key. With
    ``prepare`` features are fitted anew for each fold, on the accounts outside it.
    The rows are written once with their folds, as every fold reads them many times.
    """
    if fold is None:
        fold = "fold"
        df = stratified_folds(df, label, key, folds, seed, fold)
    df = materialize(df, ROWS_PER_FILE)
    parts = []
    for f in range(folds):
        seen, held = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        parts.append(_unseen_scores(seen, held, make_model, label, prepare))
    return functools.reduce(DataFrame.unionByName, parts)


def forward_scores(
    df: DataFrame,
    make_model,
    fold: str,
    folds: int,
    label: str = DEFAULTS.target,
    prepare: Prepare | None = None,
) -> DataFrame:
    """Score each time fold by a model of the folds before it; the first has none."""
    parts = []
    for f in range(1, folds):
        seen, held = df.where(F.col(fold) < f), df.where(F.col(fold) == f)
        parts.append(_unseen_scores(seen, held, make_model, label, prepare))
    return functools.reduce(DataFrame.unionByName, parts)


def ensemble(df: DataFrame, weights: Mapping[str, float], output: str = "churn_probability") -> DataFrame:
    """Weighted mean of score columns; a missing score gives a missing mean."""
    total = sum(weights.values())
    out = F.lit(0.0)
    for name, weight in weights.items():
        out = out + F.col(name) * F.lit(weight / total)
    return df.withColumn(output, out)


# --- hyperparameter search -------------------------------------------------------


class FBetaEvaluator(Evaluator, HasLabelCol):
    """F-beta of a scored table at a threshold, for Spark ML tuning."""

    beta = Param(Params._dummy(), "beta", "weight of recall", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "lowest flagged score", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        labelCol: str = _LABEL,
        beta: float = DEFAULTS.beta,
        threshold: float = DEFAULTS.threshold,
    ):
        super().__init__()
        self._setDefault(labelCol=_LABEL, beta=DEFAULTS.beta, threshold=DEFAULTS.threshold)
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        p = vector_to_array("probability")[1]
        curve = threshold_curve(
            dataset.select(F.col(self.getLabelCol()).alias("y"), p.alias("p")),
            "y",
            "p",
            [self.getOrDefault("threshold")],
            beta=self.getOrDefault("beta"),
        )
        return float(curve.first()["f2_score"])

    def isLargerBetter(self) -> bool:
        return True


def search(
    df: DataFrame,
    model: _ChurnModel,
    grid: Mapping[str, Sequence[float]],
    label: str = DEFAULTS.target,
    key: str = DEFAULTS.key,
    folds: int = DEFAULTS.folds,
    seed: int = DEFAULTS.seed,
    trials: int | None = None,
    parallelism: int = 2,
) -> CrossValidatorModel:
    """Cross-validated search for the highest F-beta.

    ``grid`` maps names of the tree stage's params to values. With ``trials``
    a seeded draw of that many combinations is tried in place of all of them.
    """
    import copy
    import itertools
    import random

    ensure_checkpoint_dir(df.sparkSession)
    folded = stratified_folds(df, label, key, folds, seed, "_fold")
    model = copy.copy(model)  # the caller's model stays as it is
    model.exclude = (*model.exclude, "_fold")
    pipeline = model.pipeline(folded)
    trees = pipeline.getStages()[-1]
    combos = [
        {trees.getParam(n): v for n, v in zip(grid, values)}
        for values in itertools.product(*grid.values())
    ]
    if trials is not None and trials < len(combos):
        combos = random.Random(seed).sample(combos, trials)
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=combos,
        evaluator=FBetaEvaluator(threshold=model.threshold),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
    )
    return validator.fit(model._labelled(folded, label))


def search_results(found: CrossValidatorModel, spark) -> DataFrame:
    """One row per trial, best first."""
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(s))
        for m, s in zip(found.getEstimatorParamMaps(), found.avgMetrics)
    ]
    return spark.createDataFrame(rows, "params string, f2_score double").orderBy(
        F.desc("f2_score"), "params"
    )


# --- explanation -----------------------------------------------------------------


def permute_columns(
    df: DataFrame,
    columns: Sequence[str],
    key: str = DEFAULTS.key,
    seed: int = DEFAULTS.seed,
    rows: int | None = None,
    suffix: str = "__other",
) -> DataFrame:
    """Add, for each column, the value of another account drawn by hashed key.

    Accounts are dealt to cells by one hash and ordered by another inside the
    cell; each takes the values of the next one, the last those of the first. So
    every value is used exactly once, and the table is shuffled once for all
    columns. Cells hold about ``_CYCLE_ROWS`` accounts, whatever the table's size.
    """
    n = df.count() if rows is None else rows
    cells = max(1, n // _CYCLE_ROWS)
    spot = F.pmod(F.xxhash64(key_digest(key, seed)), F.lit(cells))
    order = key_digest(key, seed + 1)
    cycle = Window.partitionBy("_spot").orderBy("_order")
    whole = cycle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*columns)
    return (
        df.withColumns({"_spot": spot, "_order": order})
        .withColumn("_next", F.coalesce(F.lead(values).over(cycle), F.first(values).over(whole)))
        .withColumns({f"{c}{suffix}": F.col("_next")[c] for c in columns})
        .drop("_spot", "_order", "_next")
    )


def permutation_importance(
    df: DataFrame,
    model: _ChurnModel,
    features: Sequence[str | tuple[str, ...]],
    label: str = DEFAULTS.target,
    key: str = DEFAULTS.key,
    seed: int = DEFAULTS.seed,
) -> DataFrame:
    """Loss of ROC-AUC when a feature, or a tuple of features together, is permuted.

    A pair that loses more than its members alone interacts.
    """
    groups = [(f,) if isinstance(f, str) else tuple(f) for f in features]
    used = sorted({c for g in groups for c in g})
    shuffled = permute_columns(df, used, key, seed).persist()
    try:
        def auc(swapped: tuple[str, ...]) -> float:
            # one pass of scoring: label and score are written, and measured from there
            other = {c: F.col(f"{c}__other") for c in swapped}
            scored = model.predict_proba(shuffled.withColumns(other) if other else shuffled)
            written = materialize(scored.select(label, "churn_probability"))
            return roc_auc(written, label).first()["auc_roc"]

        base = auc(())
        rows = [(" x ".join(g), base, auc(g)) for g in groups]
    finally:
        shuffled.unpersist()
    return (
        df.sparkSession.createDataFrame(rows, "feature string, auc_roc double, permuted_auc double")
        .withColumn("importance", F.col("auc_roc") - F.col("permuted_auc"))
        .orderBy(F.desc("importance"), "feature")
    )
