"""Data quality: contracts, counts, the good / quarantine split, drift, reports, objectives.

All counts of a batch come from one pass: rows are reduced per key first, which
also gives the duplicates, and the per-key rows are then reduced to the report.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.constants import (
    MANDATORY_COLUMNS,
    RANGE_RULES,
    REQUIRED_COLUMNS,
    SLO_LAG_HOURS,
    SLO_MANDATORY_NULL_RATE,
    SLO_QUARANTINE_RATIO,
)
from wattlake.functions.numbers import ratio

Ranges = Mapping[str, tuple[float, float]]


class QualityError(ValueError):
    """A batch breaks a rule that stops the run."""


# --- contracts ---------------------------------------------------------------


def missing_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise QualityError(f"missing required columns: {missing}")
    return df


# --- row rules ---------------------------------------------------------------


def out_of_range(value: Column, bounds: tuple[float, float]) -> Column:
    """Outside the closed interval; null is not a violation."""
    return F.coalesce(~value.between(*bounds), F.lit(False))


def broken_rules(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS, ranges: Ranges = RANGE_RULES) -> Column:
    """Names of the rules a row breaks."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in required if c in df.columns]
    checks += [F.when(out_of_range(F.col(c), b), F.lit(f"range_{c}")) for c, b in ranges.items() if c in df.columns]
    return F.array_compact(F.array(*checks))


def is_good(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS, ranges: Ranges = RANGE_RULES) -> Column:
    tests = [F.col(c).isNotNull() for c in required if c in df.columns]
    tests += [~out_of_range(F.col(c), b) for c, b in ranges.items() if c in df.columns]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def good_rows(
    df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS, ranges: Ranges = RANGE_RULES
) -> DataFrame:
    return df.filter(is_good(df, required, ranges))


def malformed_rows(
    df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS, ranges: Ranges = RANGE_RULES
) -> DataFrame:
    """Rows that break a rule, with the names of the rules they break."""
    return df.filter(~is_good(df, required, ranges)).withColumn("dq_reasons", broken_rules(df, required, ranges))


def split(
    df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS, ranges: Ranges = RANGE_RULES
) -> tuple[DataFrame, DataFrame]:
    return good_rows(df, required, ranges), malformed_rows(df, required, ranges)


# --- counts ------------------------------------------------------------------


def _counts(df: DataFrame, counters: Mapping[str, Column], label: str, count: str) -> DataFrame:
    if not counters:
        return df.sparkSession.createDataFrame([], f"{label} string, {count} long")
    one_row = df.agg(*[F.count_if(test).alias(name) for name, test in counters.items()])
    return one_row.unpivot([], list(counters), label, count).filter(F.col(count) > 0)


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, null_count) of the columns that hold nulls."""
    return _counts(df, {c: F.col(c).isNull() for c in columns if c in df.columns}, "column_name", "null_count")


def range_counts(df: DataFrame, ranges: Ranges = RANGE_RULES) -> DataFrame:
    """(column_name, invalid_count) of the columns that leave their range."""
    tests = {c: out_of_range(F.col(c), b) for c, b in ranges.items() if c in df.columns}
    return _counts(df, tests, "column_name", "invalid_count")


def uniqueness(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row: key_exists, duplicate_count (every member of a duplicate group), is_unique."""
    keys = [key] if isinstance(key, str) else key
    if missing_columns(df, keys):
        nothing = df.limit(0).agg(F.count("*"))
        return nothing.select(
            F.lit(False).alias("key_exists"), F.lit(0).cast("long").alias("duplicate_count"), F.lit(False).alias("is_unique")
        )
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    duplicates = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return groups.agg(duplicates.alias("duplicate_count")).select(
        F.lit(True).alias("key_exists"), "duplicate_count", (F.col("duplicate_count") == 0).alias("is_unique")
    )


def assert_unique(df: DataFrame, key: str | list[str]) -> None:
    found = uniqueness(df, key).first()
    if not found["is_unique"]:
        raise QualityError(f"{found['duplicate_count']} rows share a {key}")


# --- drift -------------------------------------------------------------------


def schema_drift(previous: list[str], current: list[str]) -> dict:
    """Columns that came and went; the first run has nothing to compare with."""
    new = sorted(set(current) - set(previous)) if previous else []
    removed = sorted(set(previous) - set(current)) if previous else []
    return {"schema_drift_detected": bool(new or removed), "schema_new_columns": new, "schema_removed_columns": removed}


def drift_between_runs(runs: DataFrame, run: str = "run", columns: str = "columns") -> DataFrame:
    """Drift of every run against the run before it. One row per run comes in."""
    before = F.lag(columns).over(Window.orderBy(run))
    empty = F.array().cast("array<string>")
    cur, prev = F.col(columns), F.col("_previous")
    new = F.when(prev.isNull(), empty).otherwise(F.array_sort(F.array_except(cur, prev)))
    gone = F.when(prev.isNull(), empty).otherwise(F.array_sort(F.array_except(prev, cur)))
    return (
        runs.withColumn("_previous", before)
        .select(run, new.alias("schema_new_columns"), gone.alias("schema_removed_columns"))
        .withColumn(
            "schema_drift_detected",
            (F.size("schema_new_columns") > 0) | (F.size("schema_removed_columns") > 0),
        )
    )


# --- reports -----------------------------------------------------------------

def batch_counts(
    batch: DataFrame,
    by: Iterable[str] = (),
    key: str = "plant_id",
    required: Iterable[str] = REQUIRED_COLUMNS,
    ranges: Ranges = RANGE_RULES,
) -> DataFrame:
    """All counts of a conformed batch, per run when ``by`` names run columns."""
    by = list(by)
    required = [c for c in required if c in batch.columns]
    ranges = {c: b for c, b in ranges.items() if c in batch.columns}
    tests = {f"null_{c}": F.col(c).isNull() for c in required}
    tests |= {f"range_{c}": out_of_range(F.col(c), b) for c, b in ranges.items()}
    if "raw_country" in batch.columns:
        tests["country_name_normalized_rows"] = F.col("raw_country") != F.col("country")
        tests["fuel_type_standardized_rows"] = F.col("raw_fuel") != F.col("primary_fuel")
    per_key = batch.groupBy(*by, key).agg(
        F.count("*").alias("input_rows"),
        F.count_if(is_good(batch, required, ranges)).alias("good_rows"),
        *[F.count_if(t).alias(n) for n, t in tests.items()],
    )

    def added(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return per_key.groupBy(*by).agg(
        added("input_rows"),
        added("good_rows"),
        F.count_if(F.col("good_rows") > 0).alias("good_keys"),
        F.coalesce(F.sum(F.when(F.col("good_rows") > 1, F.col("good_rows"))), F.lit(0)).alias("duplicate_rows_detected"),
        *[added(n) for n in tests],
    )


def _issues(prefix: str, columns: Iterable[str]) -> Column:
    """Column -> count of the columns with a count above 0, as JSON text."""
    pairs = F.map_from_entries(
        F.array_compact(
            F.array(
                *[
                    F.when(F.col(f"{prefix}_{c}") > 0, F.struct(F.lit(c).alias("key"), F.col(f"{prefix}_{c}").alias("value")))
                    for c in columns
                ]
            )
        )
    )
    return F.to_json(pairs)


def quality_report(
    counts: DataFrame,
    run_timestamp: Column,
    dataset: Column,
    valid_rows: Column | None = None,
    malformed_rows: Column | None = None,
    duplicate_keys: Column | None = None,
    drift: Mapping | None = None,
    by: Iterable[str] = (),
    required: Iterable[str] = REQUIRED_COLUMNS,
    ranges: Ranges = RANGE_RULES,
) -> DataFrame:
    """The 23-column report of a run from its ``batch_counts``.

    Without an existing table the valid rows are the distinct good keys and
    nothing can be left duplicated; a run that upserts passes its own columns.
    """
    drift = drift or schema_drift([], [])
    no_duplicates = F.lit(0).cast("long") if duplicate_keys is None else duplicate_keys
    no_nulls = reduce(lambda a, b: a & b, [F.col(f"null_{c}") == 0 for c in required])
    no_mandatory_nulls = reduce(lambda a, b: a & b, [F.col(f"null_{c}") == 0 for c in MANDATORY_COLUMNS])
    return counts.select(
        *by,
        run_timestamp.alias("run_timestamp"),
        dataset.alias("dataset"),
        "input_rows",
        (F.col("good_keys") if valid_rows is None else valid_rows).alias("valid_rows"),
        (F.col("input_rows") - F.col("good_rows") if malformed_rows is None else malformed_rows).alias("malformed_rows"),
        "duplicate_rows_detected",
        (no_duplicates == 0).alias("unique_plant_id_ok"),
        no_duplicates.alias("duplicate_plant_id_count"),
        no_nulls.alias("mandatory_fields_ok"),
        no_mandatory_nulls.alias("mandatory_null_validation_ok"),
        *[F.col(f"null_{c}").alias(f"null_{c}") for c in MANDATORY_COLUMNS],
        (F.col("range_capacity_mw") == 0).alias("positive_capacity_ok"),
        F.col("range_capacity_mw").alias("invalid_capacity_rows"),
        (F.col("range_commissioning_year") == 0).alias("valid_commissioning_year_ok"),
        F.col("range_commissioning_year").alias("invalid_commissioning_year_rows"),
        F.lit(drift["schema_drift_detected"]).alias("schema_drift_detected"),
        F.to_json(F.array(*map(F.lit, drift["schema_new_columns"])).cast("array<string>")).alias("schema_new_columns"),
        F.to_json(F.array(*map(F.lit, drift["schema_removed_columns"])).cast("array<string>")).alias("schema_removed_columns"),
        _issues("null", required).alias("null_issues"),
        _issues("range", ranges).alias("range_issues"),
    )


def checklist_report(quality: DataFrame, valid_output: str, malformed_output: str) -> DataFrame:
    return quality.select(
        "run_timestamp",
        F.col("mandatory_fields_ok").alias("schema_required_fields_valid"),
        "schema_drift_detected",
        F.col("unique_plant_id_ok").alias("duplicate_prevention_valid"),
        "duplicate_plant_id_count",
        F.col("mandatory_null_validation_ok").alias("null_checks_valid"),
        *[f"null_{c}" for c in MANDATORY_COLUMNS],
        F.col("positive_capacity_ok").alias("capacity_positive_valid"),
        F.col("valid_commissioning_year_ok").alias("commissioning_year_valid"),
        "invalid_capacity_rows",
        "invalid_commissioning_year_rows",
        F.lit(True).alias("idempotent_upsert_applied"),
        F.lit(True).alias("malformed_records_stored_separately"),
        F.lit(malformed_output).alias("malformed_records_output"),
        F.lit(valid_output).alias("valid_output"),
    )


def transformation_report(counts: DataFrame, run_timestamp: Column, valid_rows: Column | None = None) -> DataFrame:
    applied = F.lit(True)
    return counts.select(
        run_timestamp.alias("run_timestamp"),
        applied.alias("country_name_normalization_applied"),
        "country_name_normalized_rows",
        applied.alias("fuel_type_standardization_applied"),
        "fuel_type_standardized_rows",
        applied.alias("incremental_upsert_applied"),
        applied.alias("duplicate_detection_applied"),
        F.col("duplicate_rows_detected").alias("duplicate_rows_detected_pre_upsert"),
        F.lit(0).cast("long").alias("duplicate_rows_detected_post_upsert"),
        applied.alias("geo_enrichment_applied"),
        (F.col("good_keys") if valid_rows is None else valid_rows).alias("geo_enriched_rows"),
    )


def true_count(report: DataFrame | None, column: str) -> Column:
    """How many rows of a text report say true; 0 for text that says neither, or no report."""
    if report is None or column not in report.columns:
        return F.lit(0).cast("long")
    said = F.coalesce(F.col(column).cast("string").try_cast("boolean"), F.lit(False))
    return report.select(F.count_if(said)).scalar()


def status_count(report: DataFrame | None, *statuses: str) -> Column:
    if report is None or "status" not in report.columns:
        return F.lit(0).cast("long")
    return report.select(F.count_if(F.col("status").isin(*statuses))).scalar()


def compliance_report(
    quality: DataFrame,
    freshness: DataFrame | None,
    volume: DataFrame | None,
    bronze_runs: DataFrame | None,
    malformed_output: str,
) -> DataFrame:
    """The quality row widened by what the ingest reports of the same run say."""
    on = F.lit(True)
    return quality.select(
        "run_timestamp",
        F.col("mandatory_fields_ok").alias("schema_validation_mandatory_fields_valid"),
        on.alias("schema_drift_detection_enabled"),
        "schema_drift_detected",
        F.col("unique_plant_id_ok").alias("duplicate_prevention_no_duplicate_plant_id"),
        "duplicate_plant_id_count",
        on.alias("null_checks_enabled"),
        F.col("mandatory_null_validation_ok").alias("mandatory_null_checks_valid"),
        *[f"null_{c}" for c in MANDATORY_COLUMNS],
        on.alias("range_validation_enabled"),
        F.col("positive_capacity_ok").alias("capacity_values_positive"),
        "invalid_capacity_rows",
        F.col("valid_commissioning_year_ok").alias("commissioning_year_valid"),
        "invalid_commissioning_year_rows",
        F.lit(freshness is not None).alias("freshness_monitoring_enabled"),
        true_count(freshness, "missing_updates").alias("missing_periodic_updates_detected_sources"),
        true_count(freshness, "ingestion_delay_breached").alias("ingestion_delay_breached_sources"),
        F.lit(volume is not None).alias("volume_monitoring_enabled"),
        true_count(volume, "volume_spike_detected").alias("volume_spike_detected_sources"),
        true_count(volume, "volume_drop_detected").alias("volume_drop_detected_sources"),
        F.col("unique_plant_id_ok").alias("idempotency_reprocess_safe"),
        status_count(bronze_runs, "skipped", "no_changes").alias("idempotent_skip_events"),
        F.lit(bronze_runs is not None).alias("error_handling_retry_failed_ingestion_supported"),
        status_count(bronze_runs, "failed").alias("failed_ingestion_jobs"),
        on.alias("malformed_records_stored_separately"),
        F.col("malformed_rows").alias("malformed_records_count"),
        F.lit(malformed_output).alias("malformed_records_output"),
    )


# --- schema documentation, contract tests, objectives, row counts -------------


def schema_document(df: DataFrame, dataset: str) -> DataFrame:
    """One row per column: type, null count, nullable, and the size of the data set."""
    one_row = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return one_row.unpivot("_rows", df.columns, "name", "null_count").select(
        F.lit(dataset).alias("dataset"),
        F.col("_rows").alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        "name",
        F.element_at(types, F.col("name")).alias("dtype"),
        (F.col("null_count") > 0).alias("nullable"),
        "null_count",
    )


def schema_documentation(frames: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [schema_document(df, name) for name, df in frames.items()])


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def contract_outcome(failing: DataFrame, name: str) -> DataFrame:
    failures = F.count("*")
    return failing.agg(failures.alias("failures")).select(
        F.lit(name).alias("test"),
        "failures",
        (F.col("failures") != 0).alias("should_warn"),
        (F.col("failures") != 0).alias("should_error"),
    )


def contract_outcomes(models: Mapping[str, DataFrame], tests: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Outcomes of (test, model, column) contracts; all tests of a model share one pass.

    Not-null tests are counters of a single aggregate; a unique test needs its
    own grouping.
    """
    tests = list(tests)
    outcomes = []
    for model, df in models.items():
        nulls = {f"not_null_{model}_{c}": F.col(c).isNull() for t, m, c in tests if m == model and t == "not_null"}
        if nulls:
            counted = df.agg(*[F.count_if(x).alias(n) for n, x in nulls.items()])
            outcomes.append(counted.unpivot([], list(nulls), "test", "failures"))
        for t, m, c in tests:
            if m == model and t == "unique":
                outcomes.append(contract_outcome(failing_unique(df, c), f"unique_{model}_{c}").select("test", "failures"))
    found = reduce(DataFrame.unionByName, outcomes)
    return found.select(
        "test",
        "failures",
        (F.col("failures") != 0).alias("should_warn"),
        (F.col("failures") != 0).alias("should_error"),
    )


def objectives(quality: DataFrame, lag_hours: Column, by: Iterable[str] = ("run_timestamp",)) -> DataFrame:
    """One row per service level of every run: what was seen, the limit, kept or not."""
    nulls = reduce(lambda a, b: a + b, [F.col(f"null_{c}") for c in MANDATORY_COLUMNS])
    cells = F.col("input_rows") * len(MANDATORY_COLUMNS)
    seen = {
        "duplicate_keys": (F.col("duplicate_plant_id_count").cast("double"), 0.0),
        "mandatory_null_rate": (ratio(nulls.cast("double"), cells.cast("double")), SLO_MANDATORY_NULL_RATE),
        "freshness_lag_hours": (lag_hours.cast("double"), SLO_LAG_HOURS),
        "quarantine_ratio": (
            ratio(F.col("malformed_rows").cast("double"), F.col("input_rows").cast("double")),
            SLO_QUARANTINE_RATIO,
        ),
    }
    rows = [
        F.struct(F.lit(name).alias("objective"), value.alias("observed"), F.lit(limit).alias("limit_value"))
        for name, (value, limit) in seen.items()
    ]
    kept = F.when(F.col("objective") == "duplicate_keys", F.col("observed") <= F.col("limit_value")).otherwise(
        F.col("observed") < F.col("limit_value")
    )
    return (
        quality.select(*by, F.explode(F.array(*rows)).alias("_o"))
        .select(*by, "_o.*")
        .withColumn("objective_met", F.coalesce(kept, F.lit(False)))
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """(view_name, row_count) of every frame."""
    counts = [f.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("view_name"), "row_count") for n, f in frames.items()]
    return reduce(DataFrame.unionByName, counts)
