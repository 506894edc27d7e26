"""Writers for features, report tables and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame


def write_features(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Feature table as parquet; partition by Contract for per-contract readers."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_report(df: DataFrame, path: str, order_by: Sequence[Column | str] = ()) -> None:
    """Report table as a folder of CSV files with headers.

    ``order_by`` range-partitions, so file order and row order follow it
    without pulling the table into one task.
    """
    if order_by:
        df = df.orderBy(*order_by)
    options = {
        "header": True,
        "escape": '"',  # quotes are doubled, as other CSV readers expect
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    df.write.mode("overwrite").options(**options).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
