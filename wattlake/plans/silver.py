"""The conforming job: all new batches of every source, gated, merged and reported."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.constants import MANDATORY_COLUMNS
from wattlake.functions.times import at
from wattlake.operators import quality
from wattlake.operators.conform import conform, event_period, union_by_name
from wattlake.operators.upsert import upsert
from wattlake.plans.bronze import read_bronze
from wattlake.plans.medallion import clean_feed
from wattlake.sources.readers import enabled_sources, existing
from wattlake.sources.sinks import KeyedTable, VersionedTable, append_metrics, append_quarantine, metric_rows, write_report

ADDED_BY_LAYOUT = ("row_hash", "ingest_year", "ingest_month", "ingest_day", "ingest_run")


#: Buckets of a new silver table.
BUCKETS = 64


def silver_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root}/silver/stg_power_plants", "plant_id", BUCKETS)


def merged_until(spark: SparkSession, root: str) -> VersionedTable:
    """(source_name, ingested_at): the newest ingest of each source that is in silver."""
    return VersionedTable(spark, f"{root}/audit/silver_merged_until")


def unmerged(bronze: DataFrame, mark: datetime | None) -> DataFrame:
    """Rows of all ingests after the mark; whole days before it are not scanned."""
    if mark is None:
        return bronze
    day = F.make_date(*(F.col(f"ingest_{part}").cast("int") for part in ("year", "month", "day")))
    return bronze.filter((F.col("ingested_at") > at(str(mark))) & (day >= F.lit(mark.date())))


def new_batches(spark: SparkSession, registry: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """All that enabled sources brought since silver last took them in, one cleaned batch; and the marks after it.

    Bronze holds what changed, so every ingest counts, not only the newest; one whose run was lost before it was
    reported counts as well.
    """
    done = merged_until(spark, root).read()
    marks = {} if done is None else {r.source_name: r.ingested_at for r in done.collect()}
    feeds, reached = [], dict(marks)
    for row in enabled_sources(registry).select("source_name").collect():
        bronze = read_bronze(spark, f"{root}/bronze", row.source_name)
        if bronze is None:
            continue
        rows = unmerged(bronze, marks.get(row.source_name))
        newest = rows.agg(F.max("ingested_at")).first()[0]
        reached[row.source_name] = newest or marks.get(row.source_name)
        feeds.append(clean_feed(rows.drop(*ADDED_BY_LAYOUT)))
    if not feeds:
        raise FileNotFoundError("no bronze data for any enabled source")
    return union_by_name(feeds), spark.createDataFrame(sorted(reached.items()), "source_name string, ingested_at timestamp_ntz")


def _report_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    return existing(lambda: spark.read.option("header", True).csv(path))


def _newest_run(report: DataFrame | None, run: str) -> DataFrame | None:
    """Reports are appended; what counts is the last one."""
    if report is None or run not in report.columns:
        return report
    return report.filter(F.col(run) == report.select(F.max(run)).scalar())


def run_silver(spark: SparkSession, registry: DataFrame, root: str, as_of: str, run_id: str, regate: bool = False) -> DataFrame:
    """Conform, gate, merge and report; returns the new silver table.

    The conformed batch and the merged rows are written before anything reads
    them twice: gates, counts and sinks then scan files instead of repeating the
    whole plan, and losing an executor costs one task, not the lineage.

    Only the buckets in which the batch has plants are merged, checked and written. All are when rows without an event
    time get another year, that of the run, and on ``regate``: after a change of the rules.
    """
    run_time, run_year = at(as_of), int(as_of[:4])
    staged = f"{root}/staging/{run_id}"
    taken, marks = new_batches(spark, registry, root)
    conform(quality.require_columns(taken)).write.mode("overwrite").parquet(f"{staged}/batch")
    batch = spark.read.parquet(f"{staged}/batch")

    table, good = silver_table(spark, root), quality.good_rows(batch).drop("raw_country", "raw_fuel")

    def merge(current: DataFrame | None) -> DataFrame:
        upsert(current, good).write.mode("overwrite").parquet(f"{staged}/merged")
        checked = event_period(quality.good_rows(spark.read.parquet(f"{staged}/merged")), run_year)
        quality.assert_unique(checked, "plant_id")
        return checked

    every = regate or table.remark() != str(run_year)
    silver = table.change_keys(None if every else good, merge, remark=str(run_year))
    merged = spark.read.parquet(f"{staged}/merged")
    merged_until(spark, root).replace(marks)

    quarantine = f"{root}/quarantine/stg_power_plants_malformed"
    malformed = quality.malformed_rows(batch).unionByName(quality.malformed_rows(merged), allowMissingColumns=True)
    append_quarantine(malformed, quarantine, run_id)

    drift_state = VersionedTable(spark, f"{root}/audit/silver_schema_state")
    before = drift_state.read()
    drift = quality.schema_drift(list(before.first().columns) if before is not None else [], sorted(silver.columns))
    drift_state.replace(spark.range(1).select(F.array(*map(F.lit, sorted(silver.columns))).alias("columns")))

    counts = quality.batch_counts(batch)
    sizes = silver.select(F.count("*")).scalar(), malformed.select(F.count("*")).scalar()
    counts = counts.withColumns({"_silver": sizes[0], "_malformed": sizes[1]})
    counts = spark.createDataFrame(counts.collect(), counts.schema)  # one row
    names = [r.source_name for r in enabled_sources(registry).select("source_name").collect()]
    report = quality.quality_report(
        counts, run_time, F.lit(",".join(sorted(names))), F.col("_silver"), F.col("_malformed"), drift=drift
    )
    audit = f"{root}/audit"
    write_report(report, f"{audit}/silver_quality_report", run_id)
    write_report(
        quality.checklist_report(report, table.path, quarantine), f"{audit}/dq_checklist_report", run_id
    )
    write_report(
        quality.transformation_report(counts, run_time, F.col("_silver")), f"{audit}/transformation_process_report", run_id
    )
    freshness = _newest_run(_report_or_none(spark, f"{audit}/freshness_report"), "run_timestamp")
    runs = _newest_run(_report_or_none(spark, f"{audit}/bronze_run_report"), "run")
    compliance = quality.compliance_report(report, freshness, runs, runs, quarantine)
    write_report(compliance, f"{audit}/dq_mandatory_compliance_report", run_id)
    append_metrics(silver_metrics(spark, report, counts, run_time), f"{audit}/metrics", f"silver-{run_id}")
    return silver


def silver_metrics(spark: SparkSession, report: DataFrame, counts: DataFrame, as_of) -> DataFrame:
    """The metrics of a run, all columns of its two one-row reports."""
    changes = counts.select("country_name_normalized_rows", "fuel_type_standardized_rows")
    row = report.select("*", *[changes.select(c).scalar().alias(c) for c in changes.columns])
    flag = lambda c: F.col(c).cast("int")
    values = {
        "silver_valid_rows": F.col("valid_rows"),
        "dq_failure_count": F.col("malformed_rows"),
        "silver_duplicate_rows_detected": F.col("duplicate_rows_detected"),
        "silver_unique_plant_id_ok": flag("unique_plant_id_ok"),
        "silver_duplicate_plant_id_count": F.col("duplicate_plant_id_count"),
        "silver_mandatory_null_validation_ok": flag("mandatory_null_validation_ok"),
        **{f"silver_null_{c}": F.col(f"null_{c}") for c in MANDATORY_COLUMNS},
        "silver_positive_capacity_ok": flag("positive_capacity_ok"),
        "silver_invalid_capacity_rows": F.col("invalid_capacity_rows"),
        "silver_valid_commissioning_year_ok": flag("valid_commissioning_year_ok"),
        "silver_invalid_commissioning_year_rows": F.col("invalid_commissioning_year_rows"),
        "silver_mandatory_fields_ok": flag("mandatory_fields_ok"),
        "silver_schema_drift_detected": flag("schema_drift_detected"),
        "silver_country_name_normalized_rows": F.col("country_name_normalized_rows"),
        "silver_fuel_type_standardized_rows": F.col("fuel_type_standardized_rows"),
        "dq_mandatory_compliance_report_generated": F.lit(1.0),
    }
    return metric_rows(spark, values, as_of, of=row)
