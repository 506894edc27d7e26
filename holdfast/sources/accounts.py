"""Account table reader and its checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.columns import nan_to_null
from holdfast.schema import ACCOUNT_COLUMNS, ACCOUNT_SCHEMA, DEFAULTS


class MissingColumnsError(ValueError):
    """Raised when expected account columns are absent."""

    def __init__(self, missing: set[str]):
        self.missing = missing
        super().__init__(f"missing account columns: {sorted(missing)}")


def validate_schema(df: DataFrame) -> DataFrame:
    """Check that every account column is present; extra columns pass. Runs no job."""
    missing = set(ACCOUNT_COLUMNS) - set(df.columns)
    if missing:
        raise MissingColumnsError(missing)
    return df


def _csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """Declared types for known columns, text for extras, in the header's order."""
    header = spark.read.options(header=True, escape='"').csv(path).columns
    known = {f.name: f for f in ACCOUNT_SCHEMA}
    return T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in header])


def read_accounts(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read and check an account table.

    A path that does not exist raises Spark's own PATH_NOT_FOUND error, which
    names the path. For CSV only the header decides column order, so files with
    extra or reordered columns read correctly; types are declared, not inferred.
    NaN becomes null, the only form of missing further on.
    """
    if fmt == "csv":
        reader = spark.read.options(header=True, enforceSchema=False, escape='"')
        df = reader.schema(_csv_schema(spark, path)).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    validate_schema(df)
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in doubles})


def target_distribution(df: DataFrame, target: str = DEFAULTS.target, digits: int = 3) -> DataFrame:
    """Relative frequency of each target value, missing values left out."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("accounts"))
    whole = Window.partitionBy()  # over one row per target value
    return counts.select(
        target,
        "accounts",
        F.bround(F.col("accounts") / F.sum("accounts").over(whole), digits).alias("share"),
    )


def frame_shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns); costs one counting job."""
    return df.count(), len(df.columns)
