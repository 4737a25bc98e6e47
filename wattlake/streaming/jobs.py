"""The incremental steps as streams.

A checkpoint replaces the content-hash state: each file is read once, and a
batch that is repeated after a failure writes to the place of its first try.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.operators import alerts, ingest
from wattlake.operators.upsert import upsert
from wattlake.sources.readers import existing
from wattlake.sources.sinks import KeyedTable, VersionedTable


def file_stream(
    spark: SparkSession, path: str, schema: StructType | str, file_format: str = "parquet", files_per_batch: int | None = None, **options
) -> DataFrame:
    """New files of a folder as they arrive."""
    reader = spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(stream, checkpoint: str) -> None:
    """Process all there is, then stop."""
    query = stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingest_stream(
    rows: DataFrame, bronze: str, checkpoint: str, event_time_column: str | None = None, source_name: str = "stream"
) -> None:
    """Append every batch to bronze, flagging rows older than what came before.

    Late rows are kept. A streaming watermark would drop them, so the newest
    event time of every batch is kept beside bronze; no batch scans earlier ones. Batch numbers
    belong to the checkpoint: a new checkpoint needs a new bronze folder.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = existing(lambda: spark.read.schema("newest timestamp_ntz").json(f"{bronze}/_marks"))
        known = None if marks is None else marks.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        mark = None if known is None else F.lit(known)
        dated = ingest.annotate_events(batch, event_time_column, mark)
        provided = ingest.add_provenance(dated, source_name, F.current_timestamp().cast("timestamp_ntz"))
        folder = f"{bronze}/batch_id={batch_id}"
        provided.write.mode("overwrite").parquet(folder)
        newest = spark.read.schema("event_time timestamp_ntz").parquet(folder).agg(F.max("event_time").alias("newest"))
        newest.write.mode("overwrite").json(f"{bronze}/_marks/batch_id={batch_id}")

    run_available(rows.writeStream.foreachBatch(write), checkpoint)


def upsert_stream(
    rows: DataFrame, table: VersionedTable, checkpoint: str, key: str = "plant_id", order: tuple[str, ...] = ("event_time", "ingested_at")
) -> None:
    """Merge every batch into a table; in a ``KeyedTable`` a batch writes only the buckets of its keys.

    The table's log knows which version a batch of this checkpoint wrote, so a repeated batch changes nothing. A new
    checkpoint starts new batches on top of what is there.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        def merged(current: DataFrame | None) -> DataFrame:
            return upsert(current, batch, key, order)

        if isinstance(table, KeyedTable):
            table.change_keys(batch, merged, checkpoint, batch_id)
        else:
            table.change(merged, checkpoint, batch_id)

    run_available(rows.writeStream.foreachBatch(merge), checkpoint)


def alert_stream(metrics: DataFrame, rule: alerts.Rule, sink: str, checkpoint: str, lateness: str = "1 hour") -> None:
    """Append the windows that break a rule once the watermark has passed them.

    ``metrics`` has (metric_timestamp, metric_name, metric_value) with a zoned timestamp, which watermarks require. For a
    rule about missing values windows without rows count as well: those before a window of the log that the watermark has
    passed, which are known to stay empty.
    """
    watched = metrics.withWatermark("metric_timestamp", lateness)
    if rule.missing_breaches:
        _with_empty_windows(alerts.windowed(watched, rule, of_any=True), rule, sink, checkpoint)
        return
    broken = alerts.breaches(watched, rule)
    run_available(broken.writeStream.outputMode("append").format("parquet").option("path", sink), checkpoint)


def _with_empty_windows(seen: DataFrame, rule: alerts.Rule, sink: str, checkpoint: str) -> None:
    """Closed windows come in the order of time from batch to batch. Each batch is continued from the last window of those
    before it, which is kept beside the sink by batch, so a repeated batch gives the same again."""
    spark = seen.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = existing(lambda: spark.read.schema("last timestamp").json(f"{sink}/_marks"))
        before = None if marks is None else marks.filter(F.col("batch_id") < batch_id).agg(F.max("last")).first()[0]
        first, last = batch.agg(F.min("window_start"), F.max("window_start")).first()
        if last is None:
            return
        start = F.lit(first) if before is None else F.lit(before) + F.expr(f"interval {rule.period}")
        spine = alerts.every_window(spark.range(1).select(start.alias("from"), F.lit(last).alias("last")), rule.period)
        alerts.broken(alerts.filled(spine, batch), rule).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        spark.range(1).select(F.lit(last).alias("last")).write.mode("overwrite").json(f"{sink}/_marks/batch_id={batch_id}")

    run_available(seen.writeStream.outputMode("append").foreachBatch(write), checkpoint)
