"""Streams over files landed from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog.registry import query
from wattlake.catalog.sql import summed, with_ctes
from wattlake.functions.text import lookup
from wattlake.operators import alerts
from wattlake.session import new_folder
from wattlake.sources import bindings
from wattlake.sources.sinks import KeyedTable
from wattlake.streaming import jobs



@query("str_01_incremental_files", "SELECT event_id, ts, event_type, value FROM events")
def incremental_files(spark, sf_dir):
    """Two runs over a folder that grows between them; the second reads only the new files."""
    folder = new_folder(spark, "str-01")
    events = bindings.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    for arrival in (F.col("event_type") == "error", F.col("event_type") != "error"):
        events.filter(arrival).write.mode("append").parquet(f"{folder}/landing")
        stream = jobs.file_stream(spark, f"{folder}/landing", events.schema)
        jobs.ingest_stream(stream, f"{folder}/bronze", f"{folder}/checkpoint", "ts", "events")
    return spark.read.parquet(f"{folder}/bronze").select("event_id", "ts", "event_type", "value")


@query("str_02_late_rows_kept", """
    SELECT o_orderkey, o_orderdate AS event_time,
           o_orderstatus <> 'F' AND o_orderdate < (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')
             AS is_late_arriving FROM orders""")
def late_rows_kept(spark, sf_dir):
    """Delivered orders arrive first; of the others those older than the newest delivered one are late."""
    folder = new_folder(spark, "str-02")
    orders = bindings.table(spark, sf_dir, "orders")
    for arrival in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        orders.filter(arrival).write.mode("append").parquet(f"{folder}/landing")
        stream = jobs.file_stream(spark, f"{folder}/landing", orders.schema)
        jobs.ingest_stream(stream, f"{folder}/bronze", f"{folder}/checkpoint", "o_orderdate", "orders")
    return spark.read.parquet(f"{folder}/bronze").select("o_orderkey", "event_time", "is_late_arriving")


@query("str_03_streaming_upsert", with_ctes(
    """SELECT plant_id, o_orderkey, event_time, estimated_generation_gwh FROM readings
       QUALIFY row_number() OVER (PARTITION BY plant_id ORDER BY event_time DESC, o_orderkey DESC) = 1""", "readings"))
def streaming_upsert(spark, sf_dir):
    """Readings arrive by status; the table ends with the latest reading of every plant."""
    folder = new_folder(spark, "str-03")
    rows = bindings.readings(spark, sf_dir).select("plant_id", "o_orderkey", "event_time", "estimated_generation_gwh", "status")
    table = KeyedTable(spark, f"{folder}/table", "plant_id")
    for status in ("O", "F", "P"):
        rows.filter(F.col("status") == status).drop("status").write.mode("append").parquet(f"{folder}/landing")
        stream = jobs.file_stream(spark, f"{folder}/landing", rows.drop("status").schema)
        jobs.upsert_stream(stream, table, f"{folder}/checkpoint", order=("event_time", "o_orderkey"))
    return table.read()


@query("str_04_windowed_alerts", with_ctes(
    f"""SELECT 'dq_failures' AS alert, w AS window_start, w + INTERVAL 5 MINUTE AS window_end, v AS metric_value
        FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, {summed('metric_value')} AS v FROM metrics_log
              WHERE metric_name = 'dq_failure_count' GROUP BY 1)
        WHERE v > 0 AND w + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM metrics_log WHERE metric_name = 'dq_failure_count')
              - INTERVAL 1 HOUR""", "metrics_log"))
def windowed_alerts(spark, sf_dir):
    """Windows the watermark of the metric has passed when the log ends; later ones wait for more of it."""
    return _alerts_of_events(spark, sf_dir, alerts.RULES["dq_failures"])


@query("str_04_missing_windows", with_ctes(
    f"""SELECT 'no_ingest' AS alert, w AS window_start, w + INTERVAL 1 HOUR AS window_end, coalesce(v, 0.0::DOUBLE) AS metric_value
        FROM (SELECT unnest(generate_series(min(w), max(w) FILTER (w + INTERVAL 1 HOUR <= ends - INTERVAL 1 HOUR), INTERVAL 1 HOUR)) AS w
              FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, max(ts) OVER () AS ends FROM metrics_log))
        LEFT JOIN (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, {summed('metric_value')} AS v FROM metrics_log
                   WHERE metric_name = 'bronze_rows_ingested' GROUP BY 1) USING (w)
        WHERE coalesce(v, 0) <= 0""", "metrics_log"))
def missing_windows(spark, sf_dir):
    """Windows without an ingest, those without any row included, up to the last one of the log that the watermark has passed."""
    return _alerts_of_events(spark, sf_dir, alerts.RULES["no_ingest"])


def _alerts_of_events(spark, sf_dir, rule):
    folder = new_folder(spark, "str-04")
    schema = bindings.table(spark, sf_dir, "events").schema
    # A pattern, because the table may be one file or a folder of files.
    events = jobs.file_stream(spark, f"{sf_dir}/event[s].parquet", schema)
    utc = F.make_timestamp(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.minute("ts"),
                           F.extract(F.lit("SECOND"), "ts"), F.lit("UTC"))
    metrics = events.select(
        utc.alias("metric_timestamp"),
        lookup(bindings.METRIC_OF_EVENT, F.col("event_type")).alias("metric_name"),
        F.col("value").alias("metric_value"),
    )
    jobs.alert_stream(metrics, rule, f"{folder}/alerts", f"{folder}/checkpoint")
    found = spark.read.parquet(f"{folder}/alerts").select("alert", "window_start", "window_end", "metric_value")
    wall = lambda c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
    return found.withColumns({c: wall(c) for c in ("window_start", "window_end")})
