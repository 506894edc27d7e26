"""Ordered target statistics: categories as label means over the rows before, in a hashed order.

A row's code must not know its own label. Rows get a place by a digest of their key; the
code of a category is the smoothed mean label of the rows of that category with smaller
digests, averaged over several digests (permutations). The mean it is smoothed towards is
that of all rows before, so a row's label has no part in it either. Rows to be scored, whose
labels count nowhere, get the statistics of all training rows.

A category may hold most of the table. Rows are dealt to cells by ranges of the digest,
whatever their categories; counts per cell and level give what comes before a cell, and enter
the cell as one more row ahead of the others. So each permutation is one shuffle of keys and
categories, and every column's running sums are windows over rows that already lie together. A
task takes many cells, however small these are.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.operators.lookups import join_lookup
from holdfast.operators.ranking import ROWS_PER_CELL, key_digest
from holdfast.schema import DEFAULTS
from holdfast.session import materialize, shared_folder

_ALL = "*"  # column name of the statistics of all rows
_BROADCAST_LEVELS = 100_000
_DIGITS = 8  # hex digits of a digest that choose its cell
_ROW = "_row"
_CELL_ROWS = 20_000  # of a cell where there are several, so that tasks get even shares
_TASK_ROWS = 50_000


def _mean(total: Column, n: Column) -> Column:
    """Mean label of no or more rows, pulled to one half by one row's weight."""
    return (total + F.lit(0.5)) / (n + F.lit(1))


def _code(total: Column, n: Column, prior: Column, weight: float) -> Column:
    return (total + F.lit(float(weight)) * prior) / (n + F.lit(float(weight)))


def _level(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("nan"))


class _OrderedParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "category columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "code columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label, 0 or 1", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "key whose digest gives the order", TypeConverters.toString)
    permutations = Param(Params._dummy(), "permutations", "orders to average over", TypeConverters.toInt)
    priorWeight = Param(Params._dummy(), "priorWeight", "rows the prior mean counts for", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the digests", TypeConverters.toInt)
    rowsPerCell = Param(Params._dummy(), "rowsPerCell", "rows ordered together, about", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(
            labelCol=DEFAULTS.target,
            keyCol=DEFAULTS.key,
            permutations=4,
            priorWeight=1.0,
            seed=DEFAULTS.seed,
            rowsPerCell=ROWS_PER_CELL,
        )


class OrderedTargetEncoder(Estimator, _OrderedParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns label means per level; ``encode_training`` codes the training rows themselves.

    Missing categories are the level "nan". Rows without label are coded and count nowhere;
    rows of one key do not count for each other.
    """

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] = (),
        outputCols: Sequence[str] = (),
        labelCol: str = DEFAULTS.target,
        keyCol: str = DEFAULTS.key,
        permutations: int = 4,
        priorWeight: float = 1.0,
        seed: int = DEFAULTS.seed,
        rowsPerCell: int = ROWS_PER_CELL,
    ):
        super().__init__()
        self._set(**{k: list(v) if isinstance(v, tuple) else v for k, v in self._input_kwargs.items()})

    def _fit(self, dataset: DataFrame) -> OrderedTargetModel:
        label = F.col(self.getOrDefault("labelCol")).cast("long")
        columns = self.getOrDefault("inputCols")
        levels = F.array(
            F.struct(F.lit(_ALL).alias("column"), F.lit("").alias("level")),
            *[F.struct(F.lit(c).alias("column"), _level(c).alias("level")) for c in columns],
        )
        table = (
            dataset.where(label.isNotNull())
            .select(label.alias("y"), F.explode(levels).alias("l"))
            .groupBy("l.column", "l.level")
            .agg(F.sum("y").alias("total"), F.count("*").alias("n"))
        )
        path = f"{shared_folder(dataset.sparkSession).rstrip('/')}/levels-{uuid.uuid4().hex}"
        table.write.parquet(path)
        model = OrderedTargetModel()
        self._copyValues(model)
        return model._set(levels=path)

    def encode_training(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with a code for each category column, from the rows before alone."""
        columns = dataset.columns
        inputs, outputs = self.getOrDefault("inputCols"), self.getOrDefault("outputCols")
        data = materialize(dataset.withColumn(_ROW, F.monotonically_increasing_id()))
        n, most = data.count(), self.getOrDefault("rowsPerCell")
        cells = math.ceil(n / min(most, _CELL_ROWS)) if n > most else 1
        tasks = min(cells, math.ceil(n / _TASK_ROWS))
        # columns that have no part in the order stay behind where it takes a shuffle
        used = {_ROW, self.getOrDefault("keyCol"), self.getOrDefault("labelCol"), *inputs}
        coded = data if cells == 1 else data.select(*[c for c in data.columns if c in used])
        for p in range(self.getOrDefault("permutations")):
            coded = materialize(self._add_codes(coded, p, cells, tasks))
        mean = {
            o: sum((F.col(f"_{o}_{p}") for p in range(1, self.getOrDefault("permutations"))), F.col(f"_{o}_0"))
            / F.lit(self.getOrDefault("permutations"))
            for o in outputs
        }
        if cells > 1:
            coded = data.join(coded.select(_ROW, *[v.alias(f"_{o}") for o, v in mean.items()]), _ROW)
            mean = {o: F.col(f"_{o}") for o in outputs}
        return coded.select(*[c for c in columns if c not in outputs], *[v.alias(o) for o, v in mean.items()])

    def _add_codes(self, data: DataFrame, p: int, cells: int, tasks: int) -> DataFrame:
        """Codes of one permutation, as columns ``_<output>_<p>``."""
        inputs, outputs = self.getOrDefault("inputCols"), self.getOrDefault("outputCols")
        kept = data.columns
        label = F.col(self.getOrDefault("labelCol")).cast("long")
        digest = key_digest(self.getOrDefault("keyCol"), self.getOrDefault("seed") + p)
        place = F.conv(F.substring("_digest", 1, _DIGITS), 16, 10).cast("long")
        names = [f"_l{i}" for i in range(len(inputs))]
        rows = data.withColumn("_digest", digest).withColumns(
            {
                "_cell": F.shiftright(place * F.lit(cells), 4 * _DIGITS),
                "_y": F.coalesce(label, F.lit(0).cast("long")),
                "_n": label.isNotNull().cast("long"),
                "_of": F.lit(None).cast("int"),
                **{name: _level(c) for name, c in zip(names, inputs)},
            }
        )
        if cells > 1:
            rows = rows.unionByName(self._before_cells(rows, names), allowMissingColumns=True)
            rows = rows.repartition(tasks, "_cell")

        def upto(group: list[str], of: int) -> tuple[Column, Column]:
            """Sums over smaller digests: up to this one, less the rows that share it."""
            order = Window.partitionBy("_cell", *group).orderBy("_digest")
            upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
            same = Window.partitionBy("_cell", *group, "_digest")
            counted = F.col("_of").isNull() | (F.col("_of") == of)

            def below(name: str) -> Column:
                part = F.when(counted, F.col(name)).otherwise(F.lit(0).cast("long"))
                return F.sum(part).over(upto) - F.sum(part).over(same)

            return below("_y"), below("_n")

        whole = upto([], -1)
        rows = rows.withColumn("_prior", _mean(*whole))
        weight = self.getOrDefault("priorWeight")
        for i, (name, output) in enumerate(zip(names, outputs)):
            rows = rows.withColumn(f"_{output}_{p}", _code(*upto([name], i), F.col("_prior"), weight))
        return rows.where("_of IS NULL").select(*kept, *[f"_{o}_{p}" for o in outputs])

    def _before_cells(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """A row per cell and level with the sums of the cells before, ahead of the cell's digests."""
        kinds = F.array(
            F.struct(F.lit(-1).alias("of"), F.lit("").alias("level")),
            *[F.struct(F.lit(i).alias("of"), F.col(name).alias("level")) for i, name in enumerate(names)],
        )
        counts = (
            rows.select("_cell", "_y", "_n", F.explode(kinds).alias("k"))
            .groupBy("_cell", "k.of", "k.level")
            .agg(F.sum("_y").alias("_y"), F.sum("_n").alias("_n"))
        )
        earlier = Window.partitionBy("of", "level").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        level = [F.when(F.col("of") == i, F.col("level")).alias(name) for i, name in enumerate(names)]
        return counts.select(
            "_cell",
            F.lit("").alias("_digest"),  # smaller than any
            F.col("of").alias("_of"),
            *level,
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("long")).alias(c) for c in ("_y", "_n")],
        )


class OrderedTargetModel(Model, _OrderedParams, DefaultParamsReadable, DefaultParamsWritable):
    """Codes rows by the statistics of all training rows; an unseen level gets the mean of all."""

    levels = Param(Params._dummy(), "levels", "table of label sums per column and level", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()

    def keep_levels(self, path: str) -> OrderedTargetModel:
        """Copy the table to a folder of the caller's and read it from there."""
        if path != self.getOrDefault("levels"):
            SparkSession.getActiveSession().read.parquet(self.getOrDefault("levels")).write.mode("overwrite").parquet(path)
        return self._set(levels=path)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table = dataset.sparkSession.read.parquet(self.getOrDefault("levels"))
        every = table.where(F.col("column") == _ALL).first()
        prior = (every["total"] + 0.5) / (every["n"] + 1) if every else 0.5
        weight = self.getOrDefault("priorWeight")
        small = table.limit(_BROADCAST_LEVELS + 1).count() <= _BROADCAST_LEVELS
        outputs = self.getOrDefault("outputCols")
        out = dataset.drop(*outputs)
        for name, output in zip(self.getOrDefault("inputCols"), outputs):
            code = _code(F.col("total"), F.col("n"), F.lit(prior), weight)
            known = table.where(F.col("column") == name).select(F.col("level").alias("_level"), code.alias(output))
            out = out.withColumn("_level", _level(name))
            if small:
                out = out.join(F.broadcast(known), "_level", "left")
            else:
                out = join_lookup(out, known, "_level", self.getOrDefault("keyCol"))
            out = out.withColumn(output, F.coalesce(output, F.lit(prior))).drop("_level")
        return out
