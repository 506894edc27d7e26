"""Tables kept up to date from a stream of events: counts per day, and the last contact per account.

The same expressions run on a batch table. Changed rows are written per micro-batch, under its
number, so a micro-batch that runs again after a restart replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def daily_kpis(
    events: DataFrame, time: str = "ts", kind: str = "event_type", value: str = "value", delay: str = "2 days"
) -> DataFrame:
    """Events and their value, in cents, per day and kind.

    A stream keeps a day's sums until the newest event is ``delay`` past its end. Rows that come later
    are dropped, and counted by ``late_rows``; a batch table has no late rows.
    """
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day").alias("_day"), F.col(kind).alias("kind"))
        .agg(
            F.count("*").alias("events"),
            F.sum(F.round(F.col(value) * 100).cast("long")).alias("value_cents"),
        )
        .select(F.col("_day.start").cast("date").alias("day"), "kind", "events", "value_cents")
    )


def last_contacts(
    events: DataFrame,
    user: str = "user_id",
    time: str = "ts",
    kind: str = "event_type",
    support: str = "error",
) -> DataFrame:
    """Last support event and their number per account; state is one row per account, no row is late."""
    return (
        events.where((F.col(kind) == support) & F.col(user).isNotNull())
        .groupBy(F.col(user).alias("account"))
        .agg(F.max(time).alias("last_contact"), F.count("*").alias("contacts"))
    )


def keep_current(changes: DataFrame, folder: str) -> StreamingQuery:
    """Run a stateful stream over what has arrived and end; changed rows go below ``folder``.

    Run again, it goes on from its progress in the same folder.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    run = (
        changes.writeStream.outputMode("update")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    run.awaitTermination()
    return run


def current(spark: SparkSession, folder: str, schema: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of each row written by ``keep_current``."""
    versions = spark.read.schema(f"{schema}, batch long").parquet(f"{folder}/rows")
    values = [c for c in versions.columns if c not in keys and c != "batch"]
    newest = F.max_by(F.struct(*values), "batch").alias("_row")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def late_rows(run: StreamingQuery) -> int:
    """Rows a run dropped for coming after the delay."""
    return sum(
        int(operator.get("numRowsDroppedByWatermark", 0))
        for progress in run.recentProgress
        for operator in progress["stateOperators"]
    )
