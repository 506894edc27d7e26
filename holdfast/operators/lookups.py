"""Keyed lookups: customer attributes and user-supplied mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.schema import DEFAULTS

_BROADCAST_ROWS = 100_000
_HOT_SHARE = 1 / 200  # so there are fewer than 200 hot keys
_SALTS = 256


def attach_attributes(
    scored: DataFrame, attributes: DataFrame, columns: Sequence[str], key: str = DEFAULTS.key
) -> DataFrame:
    """Add attribute columns by customer key (unique on both sides); null where there are none."""
    return scored.join(attributes.select(key, *columns), key, "left")


def join_lookup(left: DataFrame, right: DataFrame, key: str, row_key: str) -> DataFrame:
    """Left join to a table with unique ``key``, whatever the spread of the left keys.

    A right side that a count shows to be small is broadcast. Otherwise rows of
    hot keys, which hold over 1/200 of the left rows each, are dealt by ``row_key``
    to as many tasks as there are salts, and their few right rows are copied.
    """
    if right.limit(_BROADCAST_ROWS + 1).count() <= _BROADCAST_ROWS:
        return left.join(F.broadcast(right), key, "left")
    total = left.count()
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    hot = [row[key] for row in counts.where(F.col("count") > total * _HOT_SHARE).collect()]
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False)) if hot else F.lit(False)
    # rows without a key match nothing, so they are dealt out as well
    dealt = F.pmod(F.xxhash64(row_key), F.lit(_SALTS)).cast("int")
    salted = left.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), dealt).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(right.withColumn("_salt", F.explode(copies)), [key, "_salt"], "left").drop(
        "_salt"
    )


def map_values(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    source: str,
    target: str,
    output: str,
    default: object = None,
    row_key: str = DEFAULTS.key,
) -> DataFrame:
    """Replace values by a mapping table with unique ``source``; unmapped gets ``default``."""
    columns = [c for c in df.columns if c != output]
    right = mapping.select(F.col(source).alias(column), F.col(target).alias("_to"))
    mapped = F.col("_to") if default is None else F.coalesce(F.col("_to"), F.lit(default))
    return join_lookup(df, right, column, row_key).select(*columns, mapped.alias(output))
