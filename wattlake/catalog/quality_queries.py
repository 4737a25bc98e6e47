"""Data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import GOOD, RUN, quoted, with_ctes
from wattlake.catalog.view_queries import MONTHLY
from wattlake.constants import METRIC_NAMES, METRIC_PREFIXES, REQUIRED_COLUMNS
from wattlake.operators import ingest, quality
from wattlake.sources import bindings
from wattlake.sources.sinks import metric_allowed

ORIGINAL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _issue_rows(column: str, tests: dict[str, str], count: str) -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS {column}, count(*) AS {count} FROM batch WHERE {t}) WHERE {count} > 0"
        for c, t in tests.items()
    )


NULL_TESTS = {c: f"{c} IS NULL" for c in REQUIRED_COLUMNS}
RANGE_TESTS = {
    "capacity_mw": "capacity_mw NOT BETWEEN 0.0001 AND 1000000",
    "commissioning_year": "commissioning_year NOT BETWEEN 1850 AND 2100",
}


@query("dq_01_required_columns", with_ctes("SELECT plant_id, plant_name, country, capacity_mw, primary_fuel FROM batch", "batch"))
def required_columns(spark, sf_dir):
    """The contract holds, so the rows come through; a missing column would stop here."""
    return quality.require_columns(shared.batch(spark, sf_dir)).select(*REQUIRED_COLUMNS)


@query("dq_02_null_counts", with_ctes(_issue_rows("column_name", NULL_TESTS, "null_count"), "batch"))
def null_counts(spark, sf_dir):
    return quality.null_counts(shared.batch(spark, sf_dir), REQUIRED_COLUMNS)


@query("dq_03_range_counts", with_ctes(_issue_rows("column_name", RANGE_TESTS, "invalid_count"), "batch"))
def range_counts(spark, sf_dir):
    return quality.range_counts(shared.batch(spark, sf_dir))


@query("dq_04_good_rows", with_ctes(f"SELECT plant_id, country, primary_fuel, capacity_mw FROM batch WHERE {GOOD}", "batch"))
def good_rows(spark, sf_dir):
    return quality.good_rows(shared.batch(spark, sf_dir)).select("plant_id", "country", "primary_fuel", "capacity_mw")


REASONS = ", ".join(
    [f"CASE WHEN {t} THEN 'null_{c}' END" for c, t in NULL_TESTS.items()]
    + [f"CASE WHEN {t} THEN 'range_{c}' END" for c, t in RANGE_TESTS.items()]
)


@query("dq_04_malformed_rows", with_ctes(
    f"SELECT plant_id, capacity_mw, concat_ws(',', {REASONS}) AS reasons FROM batch WHERE NOT coalesce({GOOD}, false)", "batch"))
def malformed_rows(spark, sf_dir):
    bad = quality.malformed_rows(shared.batch(spark, sf_dir))
    return bad.select("plant_id", "capacity_mw", F.array_join("dq_reasons", ",").alias("reasons"))


@query("dq_05_second_gate", with_ctes(
    f"""SELECT plant_id, capacity_mw, 'batch' AS found_in FROM batch WHERE NOT coalesce({GOOD}, false)
        UNION ALL SELECT plant_id, capacity_mw, 'merged' FROM batch
        WHERE coalesce({GOOD}, false) AND commissioning_year < 1960""", "batch"))
def second_gate(spark, sf_dir):
    """A table an older rule filled meets a stricter one after the merge; what fails joins the quarantine."""
    rows = shared.batch(spark, sf_dir)
    merged = quality.good_rows(rows)
    stricter = {"commissioning_year": (1960.0, 2100.0)}
    stale = quality.malformed_rows(merged, ranges=stricter).withColumn("found_in", F.lit("merged"))
    first = quality.malformed_rows(rows).withColumn("found_in", F.lit("batch"))
    return first.unionByName(stale, allowMissingColumns=True).select("plant_id", "capacity_mw", "found_in")


@query("dq_06_uniqueness", """
    SELECT true AS key_exists, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_count,
           coalesce(sum(n) FILTER (n > 1), 0) = 0 AS is_unique
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def uniqueness(spark, sf_dir):
    return quality.uniqueness(bindings.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_07_unique_after_upsert", with_ctes(
    "SELECT true AS key_exists, 0::BIGINT AS duplicate_count, count(*) = count(DISTINCT plant_id) AS is_unique FROM silver", "silver"))
def unique_after_upsert(spark, sf_dir):
    return quality.uniqueness(shared.tables(spark, sf_dir)["stg_power_plants"], "plant_id")


HOURLY_NAMES = {
    "hours": """SELECT date_trunc('hour', ts)::TIMESTAMP AS run, list_sort(list(DISTINCT metric_name)) AS names
                FROM metrics_log GROUP BY 1""",
    "steps": "SELECT *, lag(names) OVER (ORDER BY run) AS before FROM hours",
    "drifts": """SELECT run,
        CASE WHEN before IS NULL THEN [] ELSE list_filter(names, lambda x: NOT list_contains(before, x)) END AS came,
        CASE WHEN before IS NULL THEN [] ELSE list_filter(before, lambda x: NOT list_contains(names, x)) END AS went
        FROM steps""",
}


@query("dq_08_schema_drift", with_ctes(
    """SELECT run, array_to_string(came, ',') AS schema_new_columns, array_to_string(went, ',') AS schema_removed_columns,
              len(came) > 0 OR len(went) > 0 AS schema_drift_detected FROM drifts""", "metrics_log", **HOURLY_NAMES))
def schema_drift(spark, sf_dir):
    """Every hour of the log is a run, and the metrics it reports are its columns."""
    runs = (
        bindings.timed_metrics(spark, sf_dir)
        .groupBy(F.date_trunc("hour", "metric_timestamp").cast("timestamp_ntz").alias("run"))
        .agg(F.collect_set("metric_name").alias("columns"))
    )
    drift = quality.drift_between_runs(runs)
    return drift.withColumns(
        {c: F.array_join(c, ",") for c in ("schema_new_columns", "schema_removed_columns")}
    )


def _json(pairs: list[tuple[str, str]]) -> str:
    items = ", ".join(f"""CASE WHEN {v} > 0 THEN '"{k}":' || {v} END""" for k, v in pairs)
    return f"'{{' || concat_ws(',', {items}) || '}}'"


NULL_JSON = _json([("plant_name", "null_plant_name"), ("country", "null_country"), ("capacity_mw", "null_capacity_mw"),
                   ("primary_fuel", "null_primary_fuel")])
RANGE_JSON = _json([("capacity_mw", "invalid_capacity_rows"), ("commissioning_year", "invalid_commissioning_year_rows")])
NO_NULLS = "null_plant_name + null_country + null_primary_fuel + null_capacity_mw = 0"

DUPLICATES = """SELECT run, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows_detected FROM (
    SELECT date_trunc('month', r.event_time)::TIMESTAMP AS run, plant_id, count(*) FILTER (plant_id IN (SELECT plant_id FROM silver)) AS n
    FROM readings r GROUP BY 1, 2) GROUP BY 1"""
DRIFT_FREE = "false AS schema_drift_detected"
QUALITY = f"""
    SELECT run AS run_timestamp, 'readings' AS dataset, input_rows, valid_rows, malformed_rows, duplicate_rows_detected,
           true AS unique_plant_id_ok, 0::BIGINT AS duplicate_plant_id_count, {NO_NULLS} AS mandatory_fields_ok,
           {NO_NULLS} AS mandatory_null_validation_ok, null_plant_name, null_country, null_primary_fuel, null_capacity_mw,
           invalid_capacity_rows = 0 AS positive_capacity_ok, invalid_capacity_rows,
           invalid_commissioning_year_rows = 0 AS valid_commissioning_year_ok, invalid_commissioning_year_rows, {DRIFT_FREE},
           '[]' AS schema_new_columns, '[]' AS schema_removed_columns, {NULL_JSON} AS null_issues, {RANGE_JSON} AS range_issues
    FROM monthly JOIN duplicates USING (run)"""
QUALITY_CTES = {"monthly": MONTHLY, "duplicates": DUPLICATES}


def _with_quality(select: str) -> str:
    return with_ctes(select, "readings", "batch", "silver", **QUALITY_CTES, report=QUALITY)


@query("dq_09_quality_report", _with_quality("SELECT * FROM report"))
def quality_report(spark, sf_dir):
    return shared.monthly_quality(spark, sf_dir)


@query("dq_10_checklist_report", _with_quality(
    """SELECT run_timestamp, mandatory_fields_ok AS schema_required_fields_valid, schema_drift_detected,
              unique_plant_id_ok AS duplicate_prevention_valid, duplicate_plant_id_count,
              mandatory_null_validation_ok AS null_checks_valid, null_plant_name, null_country, null_primary_fuel, null_capacity_mw,
              positive_capacity_ok AS capacity_positive_valid, valid_commissioning_year_ok AS commissioning_year_valid,
              invalid_capacity_rows, invalid_commissioning_year_rows, true AS idempotent_upsert_applied,
              true AS malformed_records_stored_separately, 'quarantine' AS malformed_records_output, 'silver' AS valid_output
       FROM report"""))
def checklist_report(spark, sf_dir):
    return quality.checklist_report(shared.monthly_quality(spark, sf_dir), "silver", "quarantine")


@query("dq_11_transformation_report", with_ctes(
    f"""SELECT {RUN} AS run_timestamp, true AS country_name_normalization_applied,
               count(*) FILTER (raw_country <> country) AS country_name_normalized_rows,
               true AS fuel_type_standardization_applied,
               count(*) FILTER (raw_fuel <> primary_fuel) AS fuel_type_standardized_rows,
               true AS incremental_upsert_applied, true AS duplicate_detection_applied,
               0::BIGINT AS duplicate_rows_detected_pre_upsert, 0::BIGINT AS duplicate_rows_detected_post_upsert,
               true AS geo_enrichment_applied, (SELECT count(*) FROM silver) AS geo_enriched_rows
        FROM batch""", "batch", "silver"))
def transformation_report(spark, sf_dir):
    counts = quality.batch_counts(shared.batch(spark, sf_dir))
    return quality.transformation_report(counts, shared.as_of())


from wattlake.catalog.ingest_queries import FRESHNESS_CTES, OUTCOME_CTES  # noqa: E402

_INGEST = {**FRESHNESS_CTES, **OUTCOME_CTES}


@query("dq_12_compliance_report", with_ctes(
    """SELECT run_timestamp, mandatory_fields_ok AS schema_validation_mandatory_fields_valid,
              true AS schema_drift_detection_enabled, schema_drift_detected,
              unique_plant_id_ok AS duplicate_prevention_no_duplicate_plant_id, duplicate_plant_id_count,
              true AS null_checks_enabled, mandatory_null_validation_ok AS mandatory_null_checks_valid,
              null_plant_name, null_country, null_primary_fuel, null_capacity_mw, true AS range_validation_enabled,
              positive_capacity_ok AS capacity_values_positive, invalid_capacity_rows,
              valid_commissioning_year_ok AS commissioning_year_valid, invalid_commissioning_year_rows,
              true AS freshness_monitoring_enabled,
              (SELECT count(*) FROM freshness WHERE missing_updates) AS missing_periodic_updates_detected_sources,
              (SELECT count(*) FROM freshness WHERE ingestion_delay_breached) AS ingestion_delay_breached_sources,
              true AS volume_monitoring_enabled,
              (SELECT count(*) FROM outcomes WHERE volume_spike_detected) AS volume_spike_detected_sources,
              (SELECT count(*) FROM outcomes WHERE volume_drop_detected) AS volume_drop_detected_sources,
              unique_plant_id_ok AS idempotency_reprocess_safe,
              (SELECT count(*) FROM outcomes WHERE status = 'skipped') AS idempotent_skip_events,
              true AS error_handling_retry_failed_ingestion_supported,
              (SELECT count(*) FROM outcomes WHERE status = 'failed') AS failed_ingestion_jobs,
              true AS malformed_records_stored_separately, malformed_rows AS malformed_records_count,
              'quarantine' AS malformed_records_output
       FROM report""", "readings", "batch", "silver", "source_registry", "source_state", "source_outcomes",
    **QUALITY_CTES, report=QUALITY, **_INGEST))
def compliance_report(spark, sf_dir):
    """The ingest reports come as the text they are kept as."""
    as_text = lambda df: df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    outcomes = shared.outcomes(spark, sf_dir)
    return quality.compliance_report(
        shared.monthly_quality(spark, sf_dir),
        as_text(shared.freshness(spark, sf_dir)),
        as_text(ingest.volume_report(outcomes)),
        as_text(outcomes),
        "quarantine",
    )


DOCUMENTED = {
    "silver.stg_power_plants": "silver",
    "gold.dim_plant": "dim_plant",
    "gold.dim_country": "dim_country",
    "gold.dim_fuel_type": "dim_fuel_type",
    "gold.fact_plant_capacity": "fact_plant_capacity",
    "gold.fact_power_generation": "fact_power_generation",
    "gold.fact_power_generation_time": "fact_power_generation_time",
    "gold.fact_capacity_geo": "fact_capacity_geo",
}
# Column -> type, per documented table.
COLUMN_TYPES = {
    "silver": "plant_id string plant_name string country string capacity_mw double primary_fuel string "
    "commissioning_year double latitude double longitude double owner string estimated_generation_gwh double "
    "continent string sub_region string event_time timestamp_ntz ingested_at string event_year bigint event_month bigint",
    "dim_plant": "plant_id string plant_name string country string capacity_mw double primary_fuel string "
    "commissioning_year double latitude double longitude double owner_masked string",
    "dim_country": "country string country_id int",
    "dim_fuel_type": "primary_fuel string fuel_type_id int is_renewable boolean",
    "fact_plant_capacity": "country string primary_fuel string total_capacity_mw double renewable_capacity_mw double",
    "fact_power_generation": "country string primary_fuel string year bigint total_generation_gwh double",
    "fact_power_generation_time": "year bigint month bigint total_generation_gwh double",
    "fact_capacity_geo": "continent string sub_region string total_capacity_mw double",
}


def _documentation_sql() -> str:
    parts = []
    for dataset, table in DOCUMENTED.items():
        words = COLUMN_TYPES[table].split()
        columns = list(zip(words[::2], words[1::2]))
        counts = ", ".join(f"count(*) FILTER ({c} IS NULL) AS n_{c}" for c, _ in columns)
        for c, kind in columns:
            parts.append(
                f"SELECT '{dataset}' AS dataset, r AS row_count, {len(columns)} AS column_count, '{c}' AS name, "
                f"'{kind}' AS dtype, n_{c} > 0 AS nullable, n_{c} AS null_count FROM counts_{table}"
            )
        CTE_COUNTS[f"counts_{table}"] = f"SELECT count(*) AS r, {counts} FROM {table}"
    return " UNION ALL ".join(parts)


CTE_COUNTS: dict[str, str] = {}
_DOCUMENTATION = _documentation_sql()


@query("dq_13_schema_documentation", with_ctes(_DOCUMENTATION, *DOCUMENTED.values(), **CTE_COUNTS))
def schema_documentation(spark, sf_dir):
    t = shared.tables(spark, sf_dir)
    frames = {dataset: t["stg_power_plants" if name == "silver" else name] for dataset, name in DOCUMENTED.items()}
    frames["silver.stg_power_plants"] = frames["silver.stg_power_plants"].drop("region_name", "source_name")
    return quality.schema_documentation(frames)


CONTRACTS = [("unique", "stg_power_plants", "plant_id")]
CONTRACTS += [("not_null", "stg_power_plants", c) for c in ("plant_id", "plant_name", "country", "primary_fuel", "capacity_mw")]
CONTRACTS += [("not_null", "fact_plant_capacity", c) for c in ("country", "primary_fuel", "total_capacity_mw")]
CONTRACTS += [("not_null", "fact_power_generation", c) for c in ("country", "primary_fuel", "total_generation_gwh")]


@query("dq_14_not_null_failures", with_ctes("SELECT plant_id, country FROM batch WHERE country IS NULL", "batch"))
def not_null_failures(spark, sf_dir):
    return quality.failing_not_null(shared.batch(spark, sf_dir), "country").select("plant_id", "country")


@query("dq_15_unique_failures", """
    SELECT l_partkey AS unique_field, count(*) AS n_records FROM lineitem
    WHERE l_partkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def unique_failures(spark, sf_dir):
    return quality.failing_unique(bindings.table(spark, sf_dir, "lineitem"), "l_partkey")


def _contract_sql() -> str:
    parts = []
    for kind, model, column in CONTRACTS:
        source = "batch" if model == "stg_power_plants" else model
        if kind == "not_null":
            failing = f"SELECT 1 FROM {source} WHERE {column} IS NULL"
        else:
            failing = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
        parts.append(f"SELECT '{kind}_{model}_{column}' AS test, (SELECT count(*) FROM ({failing})) AS failures")
    return f"SELECT *, failures <> 0 AS should_warn, failures <> 0 AS should_error FROM ({' UNION ALL '.join(parts)})"


@query("dq_16_contract_outcomes", with_ctes(_contract_sql(), "batch", "fact_plant_capacity", "fact_power_generation"))
def contract_outcomes(spark, sf_dir):
    """All twelve contracts; the staging ones over the batch before the gate, where they have something to find."""
    t = shared.tables(spark, sf_dir)
    models = {"stg_power_plants": t["batch"]} | {m: t[m] for m in ("fact_plant_capacity", "fact_power_generation")}
    return quality.contract_outcomes(models, CONTRACTS)


PREFIX_TEST = " OR ".join(f"starts_with(event_type, '{p}')" for p in METRIC_PREFIXES)


@query("dq_17_metric_policy", f"""
    SELECT event_type AS metric_name, coalesce(event_type IN ({quoted(METRIC_NAMES)}) OR {PREFIX_TEST}, false)
           AND value IS NOT NULL AND isfinite(value) AS allowed, count(*) AS metric_rows
    FROM (SELECT event_type, value FROM events UNION ALL
          SELECT CASE event_type WHEN 'error' THEN 'dq_failure_count' ELSE 'bronze_' || event_type END, value FROM events)
    GROUP BY ALL""")
def metric_policy(spark, sf_dir):
    events = bindings.table(spark, sf_dir, "events").select(F.col("event_type").alias("metric_name"), "value")
    error = F.col("metric_name") == "error"
    renamed = events.withColumn(
        "metric_name", F.when(error, "dq_failure_count").otherwise(F.concat(F.lit("bronze_"), "metric_name")))
    rows = events.unionByName(renamed)
    return rows.groupBy("metric_name", metric_allowed(F.col("metric_name"), F.col("value")).alias("allowed")).agg(
        F.count("*").alias("metric_rows"))


@query("dq_18_objectives", with_ctes(
    f"""SELECT run_timestamp, o.objective, o.observed, o.limit_value,
               coalesce(CASE WHEN o.objective = 'duplicate_keys' THEN o.observed <= o.limit_value
                             ELSE o.observed < o.limit_value END, false) AS objective_met
        FROM (SELECT run_timestamp, unnest([
            {{'objective': 'duplicate_keys', 'observed': duplicate_plant_id_count::DOUBLE, 'limit_value': 0.0::DOUBLE}},
            {{'objective': 'mandatory_null_rate', 'observed': (null_plant_name + null_country + null_primary_fuel
              + null_capacity_mw)::DOUBLE / (input_rows * 4)::DOUBLE, 'limit_value': 0.005::DOUBLE}},
            {{'objective': 'freshness_lag_hours', 'observed': date_sub('hour', run_timestamp, {RUN})::DOUBLE,
              'limit_value': 24.0::DOUBLE}},
            {{'objective': 'quarantine_ratio', 'observed': malformed_rows::DOUBLE / input_rows::DOUBLE,
              'limit_value': 0.02::DOUBLE}}]) AS o FROM report)""",
    "readings", "batch", "silver", **QUALITY_CTES, report=QUALITY))
def objectives(spark, sf_dir):
    report = shared.monthly_quality(spark, sf_dir)
    return quality.objectives(report, F.timestamp_diff("HOUR", F.col("run_timestamp"), shared.as_of()))


@query("dq_19_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS view_name, count(*) AS row_count FROM {t}" for t in ORIGINAL_TABLES))
def row_counts(spark, sf_dir):
    return quality.row_counts({t: bindings.table(spark, sf_dir, t) for t in ORIGINAL_TABLES})


