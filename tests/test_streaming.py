"""Streams: restarts, repeated batches and what lateness means."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattlake.operators import alerts
from wattlake.sources.sinks import KeyedTable, VersionedTable
from wattlake.streaming import jobs

SCHEMA = "plant_id string, event_time timestamp_ntz, ingested_at timestamp_ntz, v int"


def land(spark, root, *rows):
    day = lambda d: dt.datetime(2024, 1, d) if d else None
    frame = spark.createDataFrame([(k, day(e), day(i), v) for k, e, i, v in rows], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(f"{root}/landing")


@pytest.mark.parametrize("kind", [VersionedTable, lambda spark, path: KeyedTable(spark, path, "plant_id", 8)])
def test_upsert_stream_equals_batch_and_survives_a_restart(spark, root, kind):
    table = kind(spark, f"{root}/table")
    stream = lambda: jobs.file_stream(spark, f"{root}/landing", SCHEMA, files_per_batch=1)
    land(spark, root, ("a", 1, 1, 1), ("b", 5, 1, 2))
    jobs.upsert_stream(stream(), table, f"{root}/checkpoint")
    land(spark, root, ("a", 1, 1, 3), ("b", 4, 2, 4), ("c", None, 2, 5))
    jobs.upsert_stream(stream(), table, f"{root}/checkpoint")
    expected = [("a", 3), ("b", 2), ("c", 5)]
    assert sorted((r.plant_id, r.v) for r in table.read().collect()) == expected
    jobs.upsert_stream(stream(), table, f"{root}/checkpoint")  # nothing new
    assert table.current_version() == 2
    assert sorted((r.plant_id, r.v) for r in table.read().collect()) == expected


def test_a_lost_checkpoint_repeats_batches_without_harm(spark, root):
    table = VersionedTable(spark, f"{root}/table")
    land(spark, root, ("a", 1, 1, 1), ("b", 2, 1, 2))
    jobs.upsert_stream(jobs.file_stream(spark, f"{root}/landing", SCHEMA), table, f"{root}/checkpoint-1")
    land(spark, root, ("c", 3, 1, 3))
    jobs.upsert_stream(jobs.file_stream(spark, f"{root}/landing", SCHEMA), table, f"{root}/checkpoint-2")
    assert sorted((r.plant_id, r.v) for r in table.read().collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert table.version_of(f"{root}/checkpoint-2", 0) == 2 and table.version_of(f"{root}/checkpoint-2", 1) == 3


def test_late_rows_are_kept_and_flagged(spark, root):
    for rows in ([("a", 10, 1, 1)], [("b", 9, 1, 2), ("c", 11, 1, 3)]):
        land(spark, root, *rows)
        stream = jobs.file_stream(spark, f"{root}/landing", SCHEMA).select("plant_id", F.col("event_time").alias("t"), "v")
        jobs.ingest_stream(stream, f"{root}/bronze", f"{root}/checkpoint", "t")
    got = {r.plant_id: (r.batch_id, r.is_late_arriving) for r in spark.read.parquet(f"{root}/bronze").collect()}
    assert got == {"a": (0, False), "b": (1, True), "c": (1, False)}


def test_windows_without_rows_on_a_stream_and_on_a_table(spark, root):
    """The log stops for hours, goes on in another run, and other metrics go on where this one is silent."""
    schema = "metric_timestamp timestamp, metric_name string, metric_value double"
    start = dt.datetime(2024, 1, 1)
    log = [(0, "bronze_rows_ingested", 5.0), (1.5, "other", 1.0), (2.2, "bronze_rows_ingested", 0.0), (3, "bronze_rows_ingested", 2.0),
           (9, "other", 1.0), (9.5, "bronze_rows_ingested", 4.0), (10, "other", 1.0), (30, "other", 1.0), (33, "bronze_rows_ingested", 1.0), (40, "other", 1.0)]
    rule = alerts.RULES["no_ingest"]
    for part in (log[:5], log[5:8], log[8:]):
        rows = [(start + dt.timedelta(hours=h), n, v) for h, n, v in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/log")
        jobs.alert_stream(jobs.file_stream(spark, f"{root}/log", schema), rule, f"{root}/alerts", f"{root}/checkpoint")
    got = sorted(map(tuple, spark.read.parquet(f"{root}/alerts").select("window_start", "window_end", "metric_value").collect()))
    whole = alerts.breaches(spark.read.schema(schema).parquet(f"{root}/log"), rule)
    passed = start + dt.timedelta(hours=33)  # the last window with a row before 40 less the lateness
    want = sorted(map(tuple, whole.filter(F.col("window_start") <= F.lit(passed)).select("window_start", "window_end", "metric_value").collect()))
    assert got == want and len(got) == len({w for w, *_ in got}) > 25


def test_many_windows_are_made_by_many_rows(spark):
    span = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20, 3, 2))], "from timestamp, last timestamp")
    made = sorted(r.window_start for r in alerts.every_window(span, "5 minutes").collect())
    assert made == [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * k) for k in range((19 * 24 + 3) * 12 + 1)]
