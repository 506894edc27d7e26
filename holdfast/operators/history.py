"""Variants of two features for when real histories are at hand.

The account table only allows proxies: lifetime averages for past charges, and
tenure for the time since the last support contact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import columns as C
from holdfast.operators.lookups import join_lookup
from holdfast.operators.ranking import MAX_CELLS, ROWS_PER_CELL, double_array


def rolling_charge_volatility(
    bills: DataFrame, key: str, month: Column, amount: Column, months: int = 6
) -> DataFrame:
    """Charge per account and month against the mean of the ``months`` before it.

    ``month`` is a running month number. Bills are summed per account and month
    before the window, so it never sees more than one row per month of an
    account, however many bills one account has.
    """
    monthly = bills.groupBy(key, month.alias("month")).agg(F.sum(amount).alias("charge"))
    before = Window.partitionBy(key).orderBy("month").rangeBetween(-months, -1)
    gap = F.try_divide(
        F.abs(F.col("charge") - F.col("average_charge")), F.col("charge") + F.lit(1e-9)
    )
    return monthly.withColumn("average_charge", F.avg("charge").over(before)).withColumn(
        "charge_volatility_ratio", C.unit_clip(F.coalesce(gap, F.lit(0.0)))
    )


def event_support_recency(
    accounts: DataFrame,
    events: DataFrame,
    key: str,
    user: str = "user_id",
    time: str = "ts",
    kind: str = "event_type",
    support: str = "error",
) -> DataFrame:
    """Days from an account's last support event to the newest event, and their decay.

    Accounts without a support event have no days and a score of 0. Events are
    reduced to one row per user before they meet the accounts.
    """
    newest = events.agg(F.max(time)).first()[0]
    last = (
        events.where(F.col(kind) == support)
        .groupBy(F.col(user).alias(key))
        .agg(F.max(time).alias("last_support"))
    )
    days = F.datediff(F.lit(newest).cast("date"), F.col("last_support").cast("date"))
    return join_lookup(accounts, last, key, key).withColumns(
        {
            "days_since_support": days,
            "support_recency_score": F.coalesce(
                F.lit(1.0) / (F.lit(1.0) + F.log1p(days)), F.lit(0.0)
            ),
        }
    )


def _slice_cuts(times: DataFrame, rows: int, most: int) -> list[float]:
    """Times, in seconds, that cut the whole table into slices of about ``rows`` rows."""
    pieces = min(most, -(-times.count() // rows))
    if pieces <= 1:
        return []
    shares = [i / pieces for i in range(1, pieces)]
    seconds = times.select(F.unix_micros("_time").cast("double").alias("_s"))
    return sorted(set(seconds.approxQuantile("_s", shares, 1 / (4 * pieces))))


def last_before(
    moments: DataFrame,
    contacts: DataFrame,
    key: str,
    time: str,
    rows_per_slice: int = ROWS_PER_CELL,
    max_slices: int = MAX_CELLS,
) -> DataFrame:
    """The latest contact at or before each moment: distinct (key, time) with ``last_contact``.

    ``contacts`` has the same two columns. Both tables are reduced to distinct pairs, put into one
    sorted union, and read from the oldest on. An account may hold most of the rows, so time is cut
    into slices of ``rows_per_slice`` rows of the whole table: no window sees more than a slice of an
    account, and the latest contact of its earlier slices comes in as one more row ahead of them.
    The cuts only decide balance. Rows without key or time take no part.
    """
    pairs = moments.select(F.col(key), F.col(time).cast("timestamp").alias("_time"), F.lit(1).alias("_asked"))
    seen = contacts.select(F.col(key), F.col(time).cast("timestamp").alias("_time"), F.lit(0).alias("_asked"))
    both = (
        pairs.unionByName(seen)
        .where(F.col(key).isNotNull() & F.col("_time").isNotNull())
        .groupBy(key, "_time")
        .agg(F.max("_asked").alias("_asked"), F.min("_asked").alias("_least"))
        .withColumn("_contact", F.when(F.col("_least") == 0, F.col("_time")))
        .drop("_least")
    )
    cuts = _slice_cuts(both, rows_per_slice, max_slices)
    if cuts:
        at = F.unix_micros("_time").cast("double")
        sliced = both.withColumn("_slice", F.array_size(F.filter(double_array(cuts), lambda c: c <= at)))
    else:
        sliced = both.withColumn("_slice", F.lit(0))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(key, "_slice")
        .agg(F.max("_contact").alias("_latest"))
        .select(
            key,
            "_slice",
            F.lit(None).cast("timestamp").alias("_time"),
            F.lit(0).alias("_asked"),
            F.max("_latest").over(earlier).alias("_contact"),
        )
        .where(F.col("_contact").isNotNull())
    )
    in_order = (
        Window.partitionBy(key, "_slice")
        .orderBy(F.col("_time").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        sliced.unionByName(carried)
        .withColumn("last_contact", F.max("_contact").over(in_order))
        .where("_asked = 1")
        .select(key, F.col("_time").alias(time), "last_contact")
    )


def support_recency_as_of(
    moments: DataFrame, contacts: DataFrame, key: str, time: str, **slices: int
) -> DataFrame:
    """Days since an account's last support contact, as known at each of its moments, and their decay.

    Every row of ``moments`` stays, with its other columns. Contacts after a moment are not known at
    it, those at the same time are. Moments without an earlier contact, key or time have no days and
    a score of 0.
    """
    found = last_before(moments, contacts, key, time, **slices).select(
        F.struct(F.col(key), F.col(time)).alias("_moment"), "last_contact"
    )
    known = F.col(key).isNotNull() & F.col(time).isNotNull()
    moment = F.when(known, F.struct(F.col(key), F.col(time).cast("timestamp").alias(time)))
    # equal moments of one account are dealt out by all their columns
    asked = moments.withColumn("_moment", moment).withColumn("_row", F.xxhash64(*moments.columns))
    days = F.datediff(F.col(time).cast("date"), F.col("last_contact").cast("date"))
    return (
        join_lookup(asked, found, "_moment", "_row")
        .select(*moments.columns, "last_contact")
        .withColumn("days_since_support", days)
        .withColumn(
            "support_recency_score",
            F.coalesce(F.lit(1.0) / (F.lit(1.0) + F.log1p("days_since_support")), F.lit(0.0)),
        )
    )


def month_ends(accounts: DataFrame, key: str, first: str, until: Column) -> DataFrame:
    """One row per account and month, at its end, from the month of ``first`` to that of ``until``."""
    starts = F.sequence(F.trunc(first, "month"), F.trunc(until, "month"), F.expr("INTERVAL 1 MONTH"))
    # the last microsecond, so that contacts of the month's last day count
    end = F.col("_start") + F.expr("INTERVAL 1 MONTH")
    return accounts.select(F.col(key), F.explode(starts).alias("_start")).select(
        key, (end.cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")).alias("month_end")
    )
