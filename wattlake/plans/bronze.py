"""The ingest job: read each source, keep what changed, remember what was seen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from wattlake.constants import DROP_RATIO, SPIKE_RATIO
from wattlake.functions.times import at
from wattlake.operators import ingest
from wattlake.sources.hash_index import RowHashIndex
from wattlake.sources.readers import existing, file_listing, read_dataset
from wattlake.sources.registry import source_folder
from wattlake.sources.sinks import (
    VersionedTable,
    append_bronze,
    append_metrics,
    merge_state,
    metric_rows,
    remove,
    run_key,
    write_report,
)

STATE_SCHEMA = (
    "source_name string, last_file_hash string, last_ingested_at timestamp_ntz, last_rows long, last_changed_rows long, "
    "last_late_arriving_rows long, last_output_path string, last_status string, last_volume_ratio double, "
    "last_volume_spike_detected boolean, last_volume_drop_detected boolean, event_time_watermark timestamp_ntz, "
    "last_checked_at timestamp_ntz, last_error string, last_failed_at timestamp_ntz, last_listing string"
)
STATE_FIELDS = [part.split()[0] for part in STATE_SCHEMA.split(", ")]


def read_bronze(spark: SparkSession, bronze: str, source_name: str) -> DataFrame | None:
    """All rows of a source, or None before its first ingest."""
    folder = source_folder(bronze, source_name)
    return existing(lambda: spark.read.option("basePath", bronze).option("mergeSchema", True).parquet(folder))


def rows_of_run(rows: DataFrame, time: str) -> DataFrame:
    """Rows ingested at a time. The date columns of the layout keep the scan to that day's folders."""
    day = datetime.fromisoformat(time)
    layout = {"ingest_year": day.year, "ingest_month": day.month, "ingest_day": day.day}
    rows = rows.filter(F.col("ingested_at") == at(time))
    for column, value in layout.items():
        rows = rows.filter(F.col(column) == value)
    return rows


def live_rows(spark: SparkSession, root: str, source_name: str) -> RowHashIndex:
    """What the source's rows are at present, by their hash."""
    return RowHashIndex(spark, source_folder(f"{root}/audit/row_hashes", source_name))


def ingest_source(spark: SparkSession, source: Row, state: Row | None, root: str, base: str, as_of: str, force: bool) -> dict:
    """Ingest one source; the returned fields describe it for the reports and the state.

    A source whose files are as they were, by name, length and time, is not opened. Any other is scanned once: its rows
    are written with their hashes, and counted and fingerprinted while they are.

    The feed is compared with the source's live rows, to which what it changed is added after the batch is written: a run
    lost in between finds the same rows changed again. Run again for the same time it writes to the place of its first
    try. The batch is written before it is counted, so its plan runs once.
    """
    bronze, path = f"{root}/bronze", f"{base}/{source.path}"
    files = file_listing(spark, path)
    found = {"source_name": source.source_name, "last_checked_at": as_of, "last_listing": files}
    ingested_before = not force and state is not None and bool(state.last_output_path)
    if ingested_before and files is not None and state.last_listing == files:
        return found | {"last_status": "skipped", "last_rows": state.last_rows}

    staged = source_folder(f"{root}/staging/bronze", source.source_name)
    seen = Observation()
    hashed = ingest.with_row_hash(read_dataset(spark, path, source.format))
    hashed.observe(seen, *ingest.fingerprint_of_hashes(F.col("row_hash"))).write.mode("overwrite").parquet(staged)
    found |= {"last_rows": seen.get["row_count"], "last_file_hash": seen.get["content_hash"]}
    if ingested_before and state.last_file_hash == found["last_file_hash"]:
        return found | {"last_status": "skipped"}

    hashed = changed = spark.read.schema(hashed.schema).parquet(staged)
    live, key = live_rows(spark, root, source.source_name), source.primary_key
    keyed = bool(key) and key in hashed.columns
    if keyed and live.exists():
        changed = live.unseen(hashed)
    mark = state.event_time_watermark if state is not None else None
    dated = ingest.annotate_events(changed, source.event_time_column, at(str(mark)) if mark else None)
    append_bronze(ingest.add_provenance(dated, source.source_name, at(as_of)), bronze)

    written = read_bronze(spark, bronze, source.source_name)
    counts = ingest.batch_outcome(rows_of_run(written, as_of)).first() if written is not None else None
    if keyed:
        live.record(hashed.select("row_hash", F.col(key).cast("string").alias("key")))
    remove(spark, staged)
    if counts is None and not force:
        return found | {"last_status": "no_changes"}
    newest = counts.newest_event_time if counts else None
    return found | {
        "last_status": "ingested",
        "last_ingested_at": as_of,
        "last_changed_rows": counts.changed_rows if counts else 0,
        "last_late_arriving_rows": counts.late_arriving_rows if counts else 0,
        "last_output_path": source_folder(bronze, source.source_name),
        "event_time_watermark": str(max(t for t in (mark, newest) if t)) if mark or newest else None,
    }


def run_bronze(
    spark: SparkSession,
    registry: DataFrame,
    root: str,
    as_of: str,
    base: str = ".",
    force: bool = False,
    failed_only: bool = False,
) -> DataFrame:
    """Ingest all sources of a registry and write state, reports and metrics; returns the outcome rows.

    The loop is over configured sources, and a source that fails does not stop
    the others.
    """
    store = VersionedTable(spark, f"{root}/audit/source_state")
    state = store.read()
    if state is None:
        state = spark.createDataFrame([], STATE_SCHEMA)
    if "last_listing" not in state.columns:  # written before listings were kept
        state = state.withColumn("last_listing", F.lit(None).cast("string"))
    known = {r.source_name: r for r in state.collect()}
    found = []
    for source in registry.collect():
        name, last = source.source_name, known.get(source.source_name)
        if source.enabled is False:
            found.append({"source_name": name, "status": "disabled"})
            continue
        if failed_only and (last is None or last.last_status != "failed"):
            found.append({"source_name": name, "status": "not_failed"})
            continue
        try:
            fields = ingest_source(spark, source, last, root, base, as_of, force)
        except Exception as error:  # noqa: BLE001 - any failure of a source is that source's outcome
            fields = {"source_name": name, "last_status": "failed", "last_error": str(error), "last_failed_at": as_of}
        found.append(fields | {"status": fields["last_status"]})

    facts = spark.createDataFrame(
        [tuple(f.get(k) for k in ("status", *STATE_FIELDS)) for f in found],
        "status string, " + STATE_SCHEMA.replace("timestamp_ntz", "string"),
    )
    times = [c for c, t in state.dtypes if t == "timestamp_ntz"]
    facts = facts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})
    limits = registry.select(
        "source_name",
        F.coalesce("volume_spike_threshold_ratio", F.lit(SPIKE_RATIO)).alias("_spike"),
        F.coalesce("volume_drop_threshold_ratio", F.lit(DROP_RATIO)).alias("_drop"),
    )
    ingested = F.col("status") == "ingested"
    before = state.select("source_name", F.col("last_rows").alias("_before"))
    judged = ingest.volume_change(
        facts.join(limits, "source_name").join(before, "source_name", "left"),
        F.when(ingested, F.col("last_rows")),
        F.col("_before"),
        F.col("_spike"),
        F.col("_drop"),
    )
    moved = lambda c: F.when(ingested, F.col(c)).otherwise(F.lit(0)).cast("long")
    outcomes = judged.select(
        "source_name",
        "status",
        moved("last_changed_rows").alias("rows"),
        moved("last_changed_rows").alias("changed_rows"),
        moved("last_late_arriving_rows").alias("late_arriving_rows"),
        "volume_ratio",
        "volume_spike_detected",
        "volume_drop_detected",
        F.col("last_error").alias("error"),
    )
    new_state = judged.filter(F.col("last_status").isNotNull()).withColumns(
        {
            "last_volume_ratio": F.when(ingested, F.col("volume_ratio")),
            "last_volume_spike_detected": F.when(ingested, F.col("volume_spike_detected")),
            "last_volume_drop_detected": F.when(ingested, F.col("volume_drop_detected")),
        }
    )
    # Written once and read back: the reports must not look at a state that changes under them.
    write_report(outcomes, f"{root}/audit/bronze_run_report", as_of)
    report_path = f"{root}/audit/bronze_run_report/run={run_key(as_of)}"
    outcomes = spark.read.schema(outcomes.schema).option("header", True).csv(report_path)
    state = store.replace(merge_state(state, new_state.select(*STATE_FIELDS)))

    freshness = ingest.freshness_report(registry, state, outcomes, at(as_of))
    write_report(ingest.volume_report(outcomes), f"{root}/audit/volume_report", as_of)
    write_report(freshness, f"{root}/audit/freshness_report", as_of)
    write_report(
        ingest.reliability_report(registry, outcomes, freshness, at(as_of)), f"{root}/audit/dq_reliability_report", as_of
    )
    append_metrics(ingest.rollup_metrics(ingest.run_rollup(outcomes), at(as_of)), f"{root}/audit/metrics", f"bronze-{as_of}")
    totals = freshness.agg(F.count_if("missing_updates").alias("missing"), F.count_if("ingestion_delay_breached").alias("late"))
    late = metric_rows(
        spark,
        {
            "freshness_missing_updates_sources": F.col("missing"),
            "freshness_ingestion_delay_breached_sources": F.col("late"),
        },
        at(as_of),
        of=totals,
    )
    append_metrics(late, f"{root}/audit/metrics", f"freshness-{as_of}")
    return outcomes
