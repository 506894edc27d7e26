"""Fitted forests as tables of nodes: raw gain per feature, and exact attributions per account.

A forest is small beside the data, at most trees x 2^(depth + 1) nodes, so its table may be
read by the driver and by every task. Attributions are evaluated where the rows are.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import shared_folder

NODE_SCHEMA = (
    "tree int, node int, left int, right int, feature string, threshold double, "
    "categories array<double>, gain double, cover double, value double"
)
_PATTERN_FEATURES = 10  # paths of more features are worked out row by row


# --- node tables ---------------------------------------------------------------------


def forest_nodes(forest, names: Sequence[str]) -> DataFrame:
    """One row per node of a fitted Spark ML forest, features by name.

    ``left`` and ``right`` are null in leaves. Rows go left if the feature is at most
    ``threshold``, or one of ``categories`` where these are given. ``gain`` is the loss of
    impurity per row, ``cover`` the weight of the training rows. ``value`` adds up over
    trees: to the margin of boosted trees, to the probability of a random forest.
    """
    spark = SparkSession.getActiveSession()
    path = f"{shared_folder(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    forest.write().save(path)
    n = F.col("nodeData")
    split = n["split"]
    stats = n["impurityStats"]
    weights = F.array(*[F.lit(float(w)) for w in forest.treeWeights])
    weight = F.element_at(weights, F.col("treeID") + 1)
    if isinstance(forest, GBTClassificationModel):
        cover, value = stats[0], n["prediction"] * weight
    else:
        # a tree votes with the shares of its leaf
        cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
        value = stats[1] / cover * weight / F.lit(float(sum(forest.treeWeights)))
    inner = n["leftChild"] >= 0
    ordered = split["numCategories"] < 0
    listed = F.array(*[F.lit(c) for c in names])
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        F.when(inner, n["leftChild"]).alias("left"),
        F.when(inner, n["rightChild"]).alias("right"),
        F.when(inner, F.try_element_at(listed, split["featureIndex"] + 1)).alias("feature"),
        F.when(inner & ordered, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~ordered, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["gain"]).alias("gain"),
        cover.alias("cover"),
        value.alias("value"),
    )


def gain_by_feature(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, importance_gain, importance_share and splits, most important first.

    ``importance_gain`` is the loss of impurity of a feature's splits, each times the weight
    of its rows, summed and not scaled; features without splits have 0.
    """
    spark = nodes.sparkSession
    found = nodes.where("feature IS NOT NULL").groupBy("feature").agg(
        F.sum(F.col("gain") * F.col("cover")).alias("importance_gain"), F.count("*").alias("splits")
    )
    listed = spark.createDataFrame([(c,) for c in names], "feature string")
    total = found.agg(F.sum("importance_gain").alias("_total"))
    return (
        listed.join(F.broadcast(found), "feature", "left")
        .crossJoin(F.broadcast(total))  # one row
        .select(
            "feature",
            F.coalesce("importance_gain", F.lit(0.0)).alias("importance_gain"),
            F.coalesce(F.try_divide("importance_gain", "_total"), F.lit(0.0)).alias("importance_share"),
            F.coalesce("splits", F.lit(0)).cast("long").alias("splits"),
        )
        .orderBy(F.desc("importance_gain"), "feature")
    )


def cover_by_rows(splits: Sequence[tuple], df: DataFrame, label: str) -> DataFrame:
    """Node table of given splits: covers are counts of ``df``'s rows, values mean labels.

    ``splits`` are (tree, node, left, right, feature, threshold), leaves with four nulls; the
    first node of a tree is its root. Trees weigh the same and values add up to their mean.
    One aggregate for all nodes. Missing values go right.
    """
    by_tree: dict[int, dict[int, tuple]] = {}
    for tree, node, *rest in splits:
        by_tree.setdefault(tree, {})[node] = tuple(rest)
    reach: dict[tuple[int, int], Column] = {}
    for tree, nodes in by_tree.items():
        todo = [(next(iter(nodes)), F.lit(True))]
        while todo:
            node, held = todo.pop()
            reach[tree, node] = held
            left, right, feature, threshold = nodes[node]
            if left is not None:
                goes = F.coalesce(F.col(feature) <= F.lit(float(threshold)), F.lit(False))
                todo += [(left, held & goes), (right, held & ~goes)]
    places = list(reach)
    counts = df.where(F.col(label).isNotNull()).agg(
        *[F.count_if(reach[p]).alias(f"n{i}") for i, p in enumerate(places)],
        *[F.sum(F.when(reach[p], F.col(label)).otherwise(0)).alias(f"y{i}") for i, p in enumerate(places)],
    ).first()
    rows = []
    for i, (tree, node) in enumerate(places):
        n, y = counts[f"n{i}"], counts[f"y{i}"] or 0
        left, right, feature, threshold = by_tree[tree][node]
        cut = None if threshold is None else float(threshold)
        value = y / n / len(by_tree) if n else 0.0
        rows.append((tree, node, left, right, feature, cut, None, None, float(n), float(value)))
    return df.sparkSession.createDataFrame(rows, NODE_SCHEMA)


# --- attributions ----------------------------------------------------------------------


class _Leaf(NamedTuple):
    features: tuple[int, ...]  # each once
    steps: tuple[tuple[int, bool, int], ...]  # (split, whether to the left, place of its feature)
    zero: np.ndarray  # per feature: share of rows that go this way
    value: float


def path_effects(zero: np.ndarray, follows: np.ndarray, value: float) -> np.ndarray:
    """Shapley values of a leaf for its features: rows of ``follows`` (0 or 1 per feature).

    A known feature leads to the leaf or away from it; an unknown one leads there by its
    share ``zero``. Over sets of k others the products sum to the coefficient of t^k in
    the product of (zero + follows t), and weigh k! (m - 1 - k)! / m!.
    """
    rows, m = follows.shape
    weights = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
    out = np.empty((rows, m))
    for i in range(m):
        poly = np.zeros((rows, m))
        poly[:, 0] = 1.0
        for j in range(m):
            if j != i:
                later = poly[:, :-1] * follows[:, j : j + 1]
                poly *= zero[j]
                poly[:, 1:] += later
        out[:, i] = value * (follows[:, i] - zero[i]) * (poly @ weights)
    return out


class Attributions:
    """Path-dependent attributions of a forest, for blocks of rows.

    ``effects`` of a row and the forest's mean ``base`` add up to its margin (boosted trees) or
    probability (random forest, trees of mean labels).
    """

    def __init__(self, nodes: Sequence[Mapping], features: Sequence[str]):
        self.features = list(features)
        place = {c: i for i, c in enumerate(self.features)}
        self.splits: list[tuple[int, float | None, np.ndarray | None]] = []
        self.leaves: list[_Leaf] = []
        self.base = 0.0
        trees: dict[int, dict[int, Mapping]] = {}
        for row in nodes:
            trees.setdefault(row["tree"], {})[row["node"]] = row
        for tree in sorted(trees):
            table = trees[tree]
            children = {row[c] for row in table.values() for c in ("left", "right") if row[c] is not None}
            (root,) = set(table) - children
            todo: list[tuple[int, float, tuple]] = [(root, 1.0, ())]
            while todo:
                node, share, path = todo.pop()
                row = table[node]
                if row["left"] is None:
                    self._add_leaf(path, float(row["value"]))
                    self.base += share * float(row["value"])
                    continue
                categories = row["categories"]
                left_codes = None if categories is None else np.array(sorted(categories))
                self.splits.append((place[row["feature"]], row["threshold"], left_codes))
                at = len(self.splits) - 1
                for child, left in ((row["left"], True), (row["right"], False)):
                    part = table[child]["cover"] / row["cover"] if row["cover"] else 0.5
                    todo.append((child, share * part, (*path, (at, left, part))))

    def _add_leaf(self, path: tuple, value: float) -> None:
        features: list[int] = []
        zero: list[float] = []
        steps = []
        for at, left, part in path:
            feature = self.splits[at][0]
            if feature not in features:
                features.append(feature)
                zero.append(1.0)
            k = features.index(feature)
            zero[k] *= part
            steps.append((at, left, k))
        self.leaves.append(_Leaf(tuple(features), tuple(steps), np.array(zero), value))

    def effects(self, x: np.ndarray) -> np.ndarray:
        """One column per feature for the rows of ``x``, whose columns are the features."""
        left = np.empty((len(self.splits), len(x)), bool)
        for at, (feature, threshold, codes) in enumerate(self.splits):
            left[at] = x[:, feature] <= threshold if codes is None else np.isin(x[:, feature], codes)
        out = np.zeros((len(self.features), len(x)))
        tables: dict[int, np.ndarray] = {}
        for leaf in self.leaves:
            m = len(leaf.features)
            if not m:
                continue
            follows = np.ones((m, len(x)), bool)
            for at, goes_left, k in leaf.steps:
                follows[k] &= left[at] if goes_left else ~left[at]
            if m <= _PATTERN_FEATURES:
                # each of 2^m answers once, then looked up by row
                if m not in tables:
                    tables[m] = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
                pattern = np.zeros(len(x), np.int32)
                for k in range(m):
                    pattern |= follows[k].astype(np.int32) << k
                found = path_effects(leaf.zero, tables[m], leaf.value)[pattern].T
            else:
                found = path_effects(leaf.zero, follows.T.astype(float), leaf.value).T
            for k, feature in enumerate(leaf.features):
                out[feature] += found[k]
        return out.T


def attributed(df: DataFrame, nodes: DataFrame, inputs: Column, features: Sequence[str], output: str = "effects") -> DataFrame:
    """Add ``base_value`` and ``output``, a map of each feature's effect on the account's score.

    ``inputs`` is the array of feature values, in the order of ``features``, as the forest
    was fitted on. Rows are worked out in the tasks that hold them; nothing is shuffled.
    """
    forest = Attributions([r.asDict() for r in nodes.collect()], features)

    @F.pandas_udf("array<double>")
    def effects(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.stack(batch.to_list()).astype(float) if len(batch) else np.zeros((0, len(forest.features)))
            yield pd.Series(list(forest.effects(x)), dtype=object)

    names = F.array(*[F.lit(c) for c in features])
    found = df.withColumn("_effects", effects(inputs))
    return found.withColumns(
        {"base_value": F.lit(float(forest.base)), output: F.map_from_arrays(names, F.col("_effects"))}
    ).drop("_effects")


def strongest(effects: Column | str, n: int = 3) -> Column:
    """The ``n`` features that raise a score most, as (feature, effect), largest first."""
    entries = F.filter(F.map_entries(effects), lambda e: e["value"] > 0)
    ordered = F.reverse(F.array_sort(F.transform(entries, lambda e: F.struct(e["value"].alias("effect"), e["key"].alias("feature")))))
    return F.slice(ordered, 1, n)


def model_inputs(model) -> tuple[list[str], Column]:
    """(feature names, column of their values) of a fitted churn model's assembled rows."""
    assembler = model.model_.stages[-2]
    names = [c.split("_", 2)[2] for c in assembler.getInputCols()]
    return names, vector_to_array(F.col(assembler.getOutputCol()))
