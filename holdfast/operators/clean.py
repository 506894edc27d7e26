"""Cleaning of raw account tables."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions import columns as C
from holdfast.operators.ranking import exact_median
from holdfast.schema import DEFAULTS, FLAG_COLUMNS


class _CleanerParams(Params):
    noValue = Param(
        Params._dummy(),
        "noValue",
        "code of the answer No: 0 marks services in use, 1 marks services available",
        TypeConverters.toInt,
    )

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(noValue=0)


class AccountCleaner(Estimator, _CleanerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median of TotalCharges; see ``AccountCleanerModel``."""

    @keyword_only
    def __init__(self, *, noValue: int = 0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> AccountCleanerModel:
        median = exact_median(dataset, C.numeric_or_null("TotalCharges"))
        model = AccountCleanerModel()
        self._copyValues(model)
        if median is not None:
            model._set(medianTotalCharges=median)
        return model


class AccountCleanerModel(Model, _CleanerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric TotalCharges with missing values filled, 0/1 target and flags.

    One projection; runs on streaming DataFrames too.
    """

    medianTotalCharges = Param(
        Params._dummy(),
        "medianTotalCharges",
        "value that replaces missing or unreadable TotalCharges",
        TypeConverters.toFloat,
    )

    def __init__(self) -> None:
        super().__init__()

    @property
    def median_total_charges(self) -> float | None:
        return self.getOrDefault("medianTotalCharges") if self.isSet("medianTotalCharges") else None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        no_value = self.getOrDefault("noValue")
        total = F.coalesce(
            C.numeric_or_null("TotalCharges"), F.lit(self.median_total_charges).cast("double")
        )
        changed = {"TotalCharges": total}
        if DEFAULTS.target in dataset.columns:
            changed[DEFAULTS.target] = C.is_yes(DEFAULTS.target)
        for name in FLAG_COLUMNS:
            if name in dataset.columns and isinstance(dataset.schema[name].dataType, T.StringType):
                changed[name] = C.flag(name, no_value)
        return dataset.withColumns(changed)


def missing_report(df: DataFrame) -> DataFrame:
    """One row: accounts and TotalCharges values that are missing or unreadable."""
    return df.agg(
        F.count("*").alias("accounts"),
        F.count_if(C.numeric_or_null("TotalCharges").isNull()).alias("missing_total_charges"),
    )


def drop_non_features(df: DataFrame, extra: tuple[str, ...] = ()) -> list[str]:
    """Names of model inputs: all but the key, the target and contract_months."""
    dropped = {DEFAULTS.key, DEFAULTS.target, "contract_months", *extra}
    return [name for name in df.columns if name not in dropped]
