"""Incremental ingestion: fingerprints, changed rows, late rows, volume, freshness, outcomes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.constants import DROP_RATIO, SLA_HOURS, SPIKE_RATIO
from wattlake.functions.hashing import hash_weight, row_hash
from wattlake.functions.times import hours_between, parse_iso, year_start
from wattlake.operators.upsert import latest_per_key

ADDED_BY_INGEST = ("event_time", "is_late_arriving", "ingested_at", "source_name", "row_hash")
SKIPPED = ("skipped", "no_changes")


def business_columns(df: DataFrame) -> list[str]:
    """Columns of the source itself; those ingest adds or partitions by would make every row look new."""
    added = {*ADDED_BY_INGEST, "ingest_year", "ingest_month", "ingest_day"}
    return [c for c in df.columns if c not in added]


# --- fingerprints ------------------------------------------------------------


def content_fingerprint(df: DataFrame, by: Iterable[str | Column] = (), columns: Iterable[str] | None = None) -> DataFrame:
    """Row count and sum of row hashes: equal for equal content in any row order or file layout.

    A sum can be taken in parts, so a file of any size is hashed in parallel;
    a digest of the bytes would need one task to read the file from end to end.
    """
    digest = row_hash(columns or business_columns(df))
    rows = df.select(*by, digest.alias("_digest"))
    return rows.groupBy(*rows.columns[:-1]).agg(*fingerprint_of_hashes(F.col("_digest")))


def fingerprint_of_hashes(digest: Column) -> list[Column]:
    """The aggregates of ``content_fingerprint``, for rows that have their hashes."""
    weight = F.coalesce(F.sum(hash_weight(digest)), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("row_count"), weight.alias("content_hash")]


def file_fingerprints(df: DataFrame) -> DataFrame:
    """``content_fingerprint`` of each file a scan reads."""
    return content_fingerprint(df, by=[F.col("_metadata.file_path").alias("file_path")])


def needs_ingest(fingerprints: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """Sources whose content is not the content last ingested with an output that still exists."""
    known = state.select("source_name", "last_file_hash", "last_output_path")
    joined = fingerprints.join(known, "source_name", "left")
    same = F.col("content_hash").eqNullSafe(F.col("last_file_hash")) & F.col("last_output_path").isNotNull()
    return (joined if force else joined.filter(~same)).select(fingerprints.columns)


# --- changed rows ------------------------------------------------------------


def with_row_hash(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.withColumn("row_hash", row_hash(columns or business_columns(df)))


def unseen_rows(hashed: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose hash is not among the known ones.

    The hash covers the key, so a row is unchanged exactly when its hash is
    known. An anti join emits each row at most once, however often a key repeats
    on either side, and null keys need no care.
    """
    return hashed.join(known.select("row_hash").distinct(), "row_hash", "left_anti").select(hashed.columns)


def live_rows(hashed: DataFrame, key: str, known: DataFrame | None) -> DataFrame:
    """(key, row_hash) of the rows a feed stands for: all rows of the keys it holds, and what is known of other keys.

    A key may have any number of rows. Later feeds are compared with this, so no history is read.
    """
    now = hashed.select(F.col(key).cast("string").alias("key"), "row_hash").distinct()
    if known is None:
        return now
    held = now.select("key").distinct()
    return now.unionByName(known.select("key", "row_hash").join(held, "key", "left_anti"))


def changed_rows(
    current: DataFrame, previous: DataFrame | None, key: str | None, columns: Iterable[str] | None = None
) -> DataFrame:
    """Rows that are new or differ from the previous state; all rows without a key or a state."""
    if previous is None or not key or key not in current.columns or key not in previous.columns:
        return current
    chosen = {*columns, key} if columns else None
    return unseen_rows(with_row_hash(current, chosen), with_row_hash(previous, chosen)).drop("row_hash")


# --- event time and late rows --------------------------------------------------


def event_time_of(df: DataFrame, column: str) -> Column:
    """Time of the event: a number is a year, a timestamp is itself, text is ISO-8601."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return year_start(F.col(column))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.col(column).cast("timestamp_ntz")
    text = F.col(column)
    return F.coalesce(F.when(text.rlike(r"^\s*\d{4}(\.0*)?\s*$"), year_start(text.try_cast("double"))), parse_iso(text))


def is_late(event_time: Column, watermark: Column) -> Column:
    """Earlier than the watermark; without a time or a watermark nothing is late."""
    return F.coalesce(event_time < watermark, F.lit(False))


def annotate_events(df: DataFrame, event_time_column: str | None, watermark: Column | None) -> DataFrame:
    if not event_time_column or event_time_column not in df.columns:
        return df.withColumns({"event_time": F.lit(None).cast("timestamp_ntz"), "is_late_arriving": F.lit(False)})
    mark = F.lit(None).cast("timestamp_ntz") if watermark is None else watermark
    return df.withColumn("event_time", event_time_of(df, event_time_column)).withColumn(
        "is_late_arriving", is_late(F.col("event_time"), mark)
    )


def advanced_watermark(previous: Column, newest: Column) -> Column:
    """The later of the two; never moves back, and a null leaves the other."""
    return F.greatest(previous, newest)


def add_provenance(df: DataFrame, source_name: str, ingested_at: Column) -> DataFrame:
    return df.withColumns({"ingested_at": ingested_at, "source_name": F.lit(source_name)})


# --- volume --------------------------------------------------------------------


def volume_change(
    df: DataFrame, current: Column, previous: Column, spike: Column | float = SPIKE_RATIO, drop: Column | float = DROP_RATIO
) -> DataFrame:
    """Adds the ratio of the row counts and whether it is a spike or a drop."""
    quotient = F.when(previous > 0, current.cast("double") / previous.cast("double"))
    seen = F.col("volume_ratio")
    limit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.withColumn("volume_ratio", quotient).withColumns(
        {
            "volume_spike_detected": F.coalesce(seen >= limit(spike), F.lit(False)),
            "volume_drop_detected": F.coalesce(seen <= limit(drop), F.lit(False)),
        }
    )


def volume_report(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        "source_name",
        "status",
        "volume_ratio",
        F.coalesce("volume_spike_detected", F.lit(False)).alias("volume_spike_detected"),
        F.coalesce("volume_drop_detected", F.lit(False)).alias("volume_drop_detected"),
    )


# --- freshness -----------------------------------------------------------------


def freshness_report(sources: DataFrame, state: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """Per source: hours since the last update and between event and ingest, against their limits."""
    limits = {
        "update_sla_hours": "freshness_update_sla_hours",
        "ingestion_delay_sla_hours": "freshness_ingestion_delay_sla_hours",
    }
    with_limits = sources.select(
        "source_name",
        *[
            (F.coalesce(F.col(c).cast("double"), F.lit(SLA_HOURS)) if c in sources.columns else F.lit(SLA_HOURS)).alias(a)
            for a, c in limits.items()
        ],
    )
    joined = (
        with_limits.join(state.select("source_name", "last_ingested_at", "event_time_watermark"), "source_name", "left")
        .join(outcomes.select("source_name", F.col("status").alias("ingest_status")), "source_name", "left")
    )
    since = hours_between(F.col("last_ingested_at"), as_of)
    delay = F.when(
        F.col("last_ingested_at").isNotNull() & F.col("event_time_watermark").isNotNull(),
        F.greatest(F.lit(0.0), hours_between(F.col("event_time_watermark"), F.col("last_ingested_at"))),
    )
    return joined.select(
        as_of.alias("run_timestamp"),
        "source_name",
        F.coalesce("ingest_status", F.lit("unknown")).alias("ingest_status"),
        "last_ingested_at",
        "event_time_watermark",
        "update_sla_hours",
        F.round(since, 4).alias("hours_since_last_update"),
        F.coalesce(since > F.col("update_sla_hours"), F.lit(True)).alias("missing_updates"),
        "ingestion_delay_sla_hours",
        F.round(delay, 4).alias("ingestion_delay_hours"),
        F.coalesce(delay > F.col("ingestion_delay_sla_hours"), F.lit(False)).alias("ingestion_delay_breached"),
    )


# --- outcomes --------------------------------------------------------------------

OUTCOME_SCHEMA = (
    "source_name string, status string, rows long, changed_rows long, late_arriving_rows long, "
    "volume_ratio double, volume_spike_detected boolean, volume_drop_detected boolean, error string"
)


def planned_outcome(
    registry: DataFrame, state: DataFrame, fingerprints: DataFrame, force: bool = False, failed_only: bool = False
) -> DataFrame:
    """What a run will do with every source, decided before any row is moved.

    ``ingest`` for sources to read; ``skipped``, ``disabled`` and ``not_failed``
    are final.
    """
    wanted = [c for c in ("last_file_hash", "last_output_path", "last_status") if c in state.columns]
    joined = registry.join(state.select("source_name", *wanted), "source_name", "left").join(
        fingerprints.select("source_name", "row_count", "content_hash"), "source_name", "left"
    )
    same = F.col("content_hash").eqNullSafe(F.col("last_file_hash")) & F.col("last_output_path").isNotNull()
    status = F.when(~F.coalesce("enabled", F.lit(True)), "disabled")
    if failed_only:
        status = status.when(~F.col("last_status").eqNullSafe("failed"), "not_failed")
    if not force:
        status = status.when(same, "skipped")
    return joined.select("source_name", "row_count", "content_hash", status.otherwise("ingest").alias("status"))


def no_work_outcome(planned: DataFrame) -> DataFrame:
    """Outcome rows of the sources a run leaves alone."""
    zero = F.lit(0).cast("long")
    no = F.lit(False)
    return planned.filter(F.col("status") != "ingest").select(
        "source_name",
        "status",
        zero.alias("rows"),
        zero.alias("changed_rows"),
        zero.alias("late_arriving_rows"),
        F.lit(None).cast("double").alias("volume_ratio"),
        no.alias("volume_spike_detected"),
        no.alias("volume_drop_detected"),
        F.lit(None).cast("string").alias("error"),
    )


def batch_outcome(changed: DataFrame, by: Iterable[str] = ("source_name",)) -> DataFrame:
    """Counts of an annotated batch, per source."""
    return changed.groupBy(*by).agg(
        F.count("*").alias("changed_rows"),
        F.count_if("is_late_arriving").alias("late_arriving_rows"),
        F.max("event_time").alias("newest_event_time"),
    )


def run_rollup(outcomes: DataFrame) -> DataFrame:
    """One row of totals over the outcome rows of a run."""

    def added(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return outcomes.agg(
        added("rows").alias("bronze_rows_ingested"),
        added("changed_rows").alias("bronze_changed_rows"),
        added("late_arriving_rows").alias("bronze_late_arriving_rows"),
        F.count_if("volume_spike_detected").alias("volume_spike_detected_sources"),
        F.count_if("volume_drop_detected").alias("volume_drop_detected_sources"),
        F.count_if(F.col("status") == "failed").alias("bronze_failed_sources"),
        F.count_if(F.col("status").isin(*SKIPPED)).alias("bronze_idempotent_skips"),
    )


def rollup_metrics(rollup: DataFrame, as_of: Column) -> DataFrame:
    """The totals as metric rows."""
    names = rollup.columns
    return (
        rollup.select(*[F.col(c).cast("double").alias(c) for c in names])
        .unpivot([], names, "metric_name", "metric_value")
        .select(as_of.alias("metric_timestamp"), "metric_name", "metric_value")
    )


def reliability_report(registry: DataFrame, outcomes: DataFrame, freshness: DataFrame, as_of: Column) -> DataFrame:
    enabled = registry.select(F.count_if(F.coalesce("enabled", F.lit(True)))).scalar()
    late = freshness.select(F.count_if("missing_updates")).scalar()
    delayed = freshness.select(F.count_if("ingestion_delay_breached")).scalar()
    return run_rollup(outcomes).select(
        as_of.alias("run_timestamp"),
        enabled.alias("enabled_sources"),
        F.col("bronze_failed_sources").alias("failed_sources"),
        F.col("bronze_idempotent_skips").alias("idempotent_skips"),
        late.alias("freshness_missing_updates_sources"),
        delayed.alias("freshness_ingestion_delay_breached_sources"),
        "volume_spike_detected_sources",
        "volume_drop_detected_sources",
        F.lit(True).alias("retry_failed_ingestion_supported"),
        F.lit("failed_only").alias("retry_failed_ingestion_arg"),
    )


def union_outcomes(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
