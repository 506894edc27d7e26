import pytest
from pyspark.sql import functions as F

from holdfast.streaming import state

SCHEMA = "ts timestamp, user_id long, event_type string, value double"


def _add(spark, folder, rows):
    df = spark.createDataFrame(rows, "t string, user_id long, event_type string, value double")
    df.select(F.to_timestamp("t").alias("ts"), "user_id", "event_type", "value").coalesce(1).write.mode("append").parquet(folder)


def _run(spark, folder, changes):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events")
    return state.keep_current(changes(stream), f"{folder}/{changes.__name__}")


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


KPIS = "day date, kind string, events long, value_cents long"
LAST = "account long, last_contact timestamp, contacts long"
FIRST = [("2024-01-01 10:00:00", 1, "error", 1.25), ("2024-01-01 11:00:00", 1, "view", 2.0), ("2024-01-02 09:00:00", 2, "error", 0.5)]
# a late row within the delay, one more day, a user seen before, rows without user, time or value
THEN = [("2024-01-01 23:00:00", 3, "error", 4.0), ("2024-01-03 01:00:00", 1, "error", None), ("2024-01-03 02:00:00", None, "error", 1.0), (None, 2, "error", 1.0)]


@pytest.mark.parametrize("changes, schema, keys", [(state.daily_kpis, KPIS, ["day", "kind"]), (state.last_contacts, LAST, ["account"])])
def test_stream_equals_batch_after_restart(spark, tmp_path, changes, schema, keys):
    folder = str(tmp_path)
    for rows in (FIRST, THEN):
        _add(spark, f"{folder}/events", rows)
        _run(spark, folder, changes)
        batch = changes(spark.read.schema(SCHEMA).parquet(f"{folder}/events"))
        now = state.current(spark, f"{folder}/{changes.__name__}", schema, keys)
        if changes is state.daily_kpis:
            batch, now = batch.where("day IS NOT NULL"), now.where("day IS NOT NULL")
        assert _rows(now) == _rows(batch)
    # nothing new: nothing changes
    _run(spark, folder, changes)
    again = state.current(spark, f"{folder}/{changes.__name__}", schema, keys)
    assert _rows(again.where(F.col(keys[0]).isNotNull())) == _rows(now)


def test_rows_beyond_the_delay_are_counted(spark, tmp_path):
    folder = str(tmp_path)
    _add(spark, f"{folder}/events", [("2024-01-20 00:00:00", 1, "view", 1.0)])
    _run(spark, folder, state.daily_kpis)
    _add(spark, f"{folder}/events", [("2024-01-19 00:00:00", 1, "view", 1.0), ("2024-01-02 00:00:00", 1, "view", 1.0)])
    run = _run(spark, folder, state.daily_kpis)
    days = {str(r["day"]) for r in state.current(spark, f"{folder}/daily_kpis", KPIS, ["day", "kind"]).collect()}
    assert days == {"2024-01-19", "2024-01-20"}
    assert state.late_rows(run) == 1
    _run(spark, folder, state.last_contacts)  # no row is late for the last contact
