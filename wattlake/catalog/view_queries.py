"""Dashboard, monitoring and quarantine views."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import AGE, RUN, has_text, iso, known, mean, present, ratio, total, with_ctes, year_text
from wattlake.functions.times import at, iso_text
from wattlake.plans.views import geo, monitor, plant, power, sustain
from wattlake.sources import bindings

GWH = "total_generation_gwh"
CLEAN = f"sum(CASE WHEN is_renewable THEN CAST({GWH} AS DECIMAL(28,6)) ELSE 0 END)"
DIRTY = f"sum(CASE WHEN is_renewable THEN 0 ELSE CAST({GWH} AS DECIMAL(28,6)) END)"


def _as_double(x: str) -> str:
    return f"coalesce(CAST({x} AS DOUBLE), 0.0::DOUBLE)"


@query("vg_01_country_capacity", with_ctes(
    f"""SELECT country, {total('total_capacity_mw')} AS total_capacity_mw,
               {total('renewable_capacity_mw')} AS renewable_capacity_mw,
               {total('total_capacity_mw')} - {total('renewable_capacity_mw')} AS non_renewable_capacity_mw
        FROM fact_plant_capacity WHERE {has_text('country')} GROUP BY country""", "fact_plant_capacity"))
def country_capacity(spark, sf_dir):
    return power.country_capacity(shared.tables(spark, sf_dir))


@query("vg_02_fuel_distribution", with_ctes(
    f"""SELECT country, primary_fuel, {total(GWH)} AS total_generation_gwh FROM fact_power_generation
        WHERE {has_text('country', 'primary_fuel')} AND {known('country', 'primary_fuel')} GROUP BY ALL""",
    "fact_power_generation"))
def fuel_distribution(spark, sf_dir):
    return power.fuel_distribution(shared.tables(spark, sf_dir))


@query("vg_03_renewable_trend", with_ctes(
    f"""SELECT {year_text('year')} AS year, country, {_as_double(CLEAN)} AS renewable_generation_gwh,
               {_as_double(DIRTY)} AS non_renewable_generation_gwh,
               {ratio(_as_double(CLEAN), total(GWH))} AS renewable_generation_ratio
        FROM generation_flagged WHERE year IS NOT NULL AND {has_text('country', 'primary_fuel')} GROUP BY 1, 2""",
    "generation_flagged"))
def renewable_trend(spark, sf_dir):
    return power.renewable_trend(shared.tables(spark, sf_dir))


@query("vg_04_global_fuel_dominance", with_ctes(
    f"""SELECT primary_fuel, gwh AS total_generation_gwh,
               {ratio('gwh', "sum(gwh) OVER ()")} AS fuel_share_ratio,
               CAST(rank() OVER (ORDER BY gwh DESC) AS INTEGER) AS fuel_rank
        FROM (SELECT primary_fuel, {total(GWH)} AS gwh
              FROM fact_power_generation WHERE {has_text('primary_fuel')} AND {known('primary_fuel')} GROUP BY 1)""",
    "fact_power_generation"))
def global_fuel_dominance(spark, sf_dir):
    return power.global_fuel_dominance(shared.tables(spark, sf_dir))


@query("vg_05_annual_generation_trends", with_ctes(
    f"SELECT {year_text('year')} AS year, {total(GWH)} AS total_generation_gwh FROM fact_power_generation "
    "WHERE year IS NOT NULL GROUP BY 1", "fact_power_generation"))
def annual_generation_trends(spark, sf_dir):
    return power.annual_generation_trends(shared.tables(spark, sf_dir))


@query("vg_06_kpi_summary", with_ctes(
    f"""SELECT mw AS total_generation_capacity_mw, {ratio('clean', 'mw')} AS renewable_energy_ratio,
               (SELECT coalesce({mean('capacity_mw')}, 0.0::DOUBLE) FROM dim_plant) AS average_plant_capacity_mw
        FROM (SELECT {total('total_capacity_mw')} AS mw, {total('renewable_capacity_mw')} AS clean
              FROM fact_plant_capacity)""", "fact_plant_capacity", "dim_plant"))
def kpi_summary(spark, sf_dir):
    return power.kpi_summary(shared.tables(spark, sf_dir))


COMPLETE = (
    f"{has_text('plant_id', 'plant_name', 'country', 'primary_fuel')} AND {present('latitude', 'longitude', 'capacity_mw')}"
)


@query("vp_01_largest_plants", with_ctes(
    f"""SELECT plant_id, plant_name, country, primary_fuel, capacity_mw,
               {year_text('commissioning_year')} AS commissioning_year, latitude, longitude
        FROM dim_plant WHERE {COMPLETE} AND commissioning_year IS NOT NULL""", "dim_plant"))
def largest_plants(spark, sf_dir):
    return plant.largest_plants(shared.tables(spark, sf_dir))


def _aging_sql(table: str, a: str, b: str) -> str:
    older = lambda n: f"count(*) FILTER (commissioning_year < year({AGE}) - {n})"
    return with_ctes(
        f"""SELECT {a}, {b}, count(*) AS plant_count,
                   CAST(round({mean('commissioning_year')}) AS INTEGER) AS avg_commissioning_year,
                   {older(30)} AS aging_30_plus_count, {older(40)} AS aging_40_plus_count
            FROM {table} WHERE {has_text(a, b)} AND commissioning_year IS NOT NULL GROUP BY ALL""", table)


@query("vp_02_aging_infrastructure", _aging_sql("dim_plant", "country", "primary_fuel"))
def aging_infrastructure(spark, sf_dir):
    return plant.aging_infrastructure(shared.tables(spark, sf_dir), at(bindings.AGE_AS_OF))


@query("vp_03_capacity_utilization", with_ctes(
    f"""SELECT {year_text('year')} AS year, country, primary_fuel, total_capacity_mw, total_generation_gwh,
               total_capacity_mw * 8.76::DOUBLE AS theoretical_max_generation_gwh,
               CASE WHEN total_capacity_mw <= 0 THEN 0.0::DOUBLE
                    ELSE total_generation_gwh / (total_capacity_mw * 8.76::DOUBLE) END AS utilization_ratio
        FROM fact_power_generation JOIN fact_plant_capacity USING (country, primary_fuel)
        WHERE {has_text('country', 'primary_fuel')}""", "fact_power_generation", "fact_plant_capacity"))
def capacity_utilization(spark, sf_dir):
    return plant.capacity_utilization(shared.tables(spark, sf_dir))


@query("vp_04_underutilized_plants", with_ctes(
    """SELECT plant_id, plant_name, country, primary_fuel, capacity_mw, estimated_generation_gwh, full_gwh
              AS theoretical_generation_gwh, estimated_generation_gwh / full_gwh AS utilization_ratio
       FROM (SELECT *, capacity_mw * 8.76::DOUBLE AS full_gwh FROM silver)
       WHERE capacity_mw > 0 AND estimated_generation_gwh / full_gwh < 0.40::DOUBLE""", "silver"))
def underutilized_plants(spark, sf_dir):
    return plant.underutilized_plants(shared.tables(spark, sf_dir))


@query("vp_05_aging_by_region", _aging_sql("silver", "continent", "sub_region"))
def aging_by_region(spark, sf_dir):
    return plant.aging_by_region(shared.tables(spark, sf_dir), at(bindings.AGE_AS_OF))


HEATMAP = with_ctes(
    f"""SELECT plant_id, plant_name, country, latitude, longitude, capacity_mw, primary_fuel
        FROM dim_plant WHERE {COMPLETE}""", "dim_plant")


@query("vs_01_sustainability_heatmap", HEATMAP)
def sustainability_heatmap(spark, sf_dir):
    return sustain.heatmap(shared.tables(spark, sf_dir))


def _by_country(count: str) -> str:
    return with_ctes(
        f"""SELECT country, {count} AS plant_count, {total('capacity_mw')} AS total_capacity_mw,
                   {mean('capacity_mw')} AS avg_capacity_mw
            FROM dim_plant WHERE {has_text('country')} AND capacity_mw IS NOT NULL GROUP BY 1""", "dim_plant")


@query("vs_02_country_distribution", _by_country("count(*)"))
def country_distribution(spark, sf_dir):
    return sustain.country_distribution(shared.tables(spark, sf_dir))


REGIONAL = f"""
    SELECT continent, sub_region, {total('total_capacity_mw')} AS total_capacity_mw FROM regions GROUP BY ALL
    UNION ALL
    SELECT 'Fallback', country, {total('capacity_mw')} FROM dim_plant
    WHERE (SELECT count(*) FROM regions) = 0 AND {has_text('country')} GROUP BY ALL"""


@query("vs_03_regional_density", with_ctes(
    REGIONAL, "fact_capacity_geo", "dim_plant",
    regions=f"SELECT * FROM fact_capacity_geo WHERE {has_text('continent', 'sub_region')}"))
def regional_density(spark, sf_dir):
    return sustain.regional_density(shared.tables(spark, sf_dir))


@query("vs_03_regional_density_fallback", with_ctes(
    REGIONAL, "fact_capacity_geo", "dim_plant", regions="SELECT * FROM fact_capacity_geo WHERE total_capacity_mw IS NULL"))
def regional_density_fallback(spark, sf_dir):
    """The second branch: no region holds a total."""
    t = shared.tables(spark, sf_dir)
    unknown = t["fact_capacity_geo"].withColumn("total_capacity_mw", F.lit(None).cast("double"))
    return sustain.regional_density(t.but(fact_capacity_geo=unknown))


COAL_MW = total("CASE WHEN primary_fuel = 'Coal' THEN capacity_mw ELSE 0 END")


@query("vs_04_coal_dependency", with_ctes(
    f"""SELECT continent, sub_region, {COAL_MW} AS coal_capacity_mw, {total('capacity_mw')} AS total_capacity_mw,
               {ratio(COAL_MW, total('capacity_mw'))} AS coal_capacity_ratio
        FROM silver WHERE {has_text('continent', 'sub_region', 'primary_fuel')} GROUP BY ALL""", "silver"))
def coal_dependency(spark, sf_dir):
    return sustain.coal_dependency(shared.tables(spark, sf_dir))


COAL_GWH = total(f"CASE WHEN primary_fuel = 'Coal' THEN {GWH} ELSE 0 END")


@query("vs_05_coal_dependency_by_country", with_ctes(
    f"""SELECT country, {COAL_GWH} AS coal_generation_gwh, {total(GWH)} AS total_generation_gwh,
               {ratio(COAL_GWH, total(GWH))} AS coal_dependency_ratio
        FROM fact_power_generation GROUP BY 1""", "fact_power_generation"))
def coal_dependency_by_country(spark, sf_dir):
    return sustain.coal_dependency_by_country(shared.tables(spark, sf_dir))


@query("vs_06_clean_energy_growth", with_ctes(
    f"""SELECT {year_text('year')} AS year, continent, sub_region, country,
               {_as_double(CLEAN)} AS renewable_generation_gwh, {_as_double(DIRTY)} AS non_renewable_generation_gwh
        FROM generation_flagged JOIN region_of USING (country)
        WHERE {has_text('country', 'primary_fuel')} GROUP BY 1, 2, 3, 4""", "generation_flagged", "silver",
    region_of=f"""SELECT country, max(continent) AS continent, max(sub_region) AS sub_region FROM silver
                  WHERE {has_text('country', 'continent', 'sub_region')} GROUP BY 1"""))
def clean_energy_growth(spark, sf_dir):
    return sustain.clean_energy_growth(shared.tables(spark, sf_dir))


@query("vx_01_plant_distribution_by_country", _by_country("count(*)"))
def plant_distribution_by_country(spark, sf_dir):
    return geo.plant_distribution_by_country(shared.tables(spark, sf_dir))


@query("vx_02_plant_distribution_by_region", with_ctes(
    f"""SELECT continent, sub_region, count(*) AS plant_count,
               {total('capacity_mw')} AS total_capacity_mw
        FROM silver WHERE {has_text('continent', 'sub_region')} GROUP BY ALL""", "silver"))
def plant_distribution_by_region(spark, sf_dir):
    return geo.plant_distribution_by_region(shared.tables(spark, sf_dir))


@query("vx_03_generation_density", with_ctes(
    f"""SELECT country, count(DISTINCT plant_id) AS plant_count, {total('capacity_mw')} AS total_capacity_mw,
               {total(GWH)} AS total_generation_gwh, {total(GWH)} / count(DISTINCT plant_id) AS generation_per_plant_gwh
        FROM dim_plant JOIN fact_power_generation USING (country, primary_fuel)
        WHERE {has_text('country', 'plant_id', 'primary_fuel')} GROUP BY 1""", "dim_plant", "fact_power_generation"))
def generation_density(spark, sf_dir):
    return geo.generation_density(shared.tables(spark, sf_dir))


@query("vx_03_generation_density_no_fanout", with_ctes(
    f"""SELECT country, plant_count, total_capacity_mw, total_generation_gwh,
               total_generation_gwh / plant_count AS generation_per_plant_gwh
        FROM (SELECT country, count(DISTINCT plant_id) AS plant_count, {total('capacity_mw')} AS total_capacity_mw
              FROM dim_plant WHERE (country, primary_fuel) IN (SELECT country, primary_fuel FROM fact_power_generation)
              GROUP BY 1)
        JOIN (SELECT country, {total(GWH)} AS total_generation_gwh FROM fact_power_generation
              WHERE (country, primary_fuel) IN (SELECT country, primary_fuel FROM dim_plant) GROUP BY 1) USING (country)""",
    "dim_plant", "fact_power_generation"))
def generation_density_no_fanout(spark, sf_dir):
    return geo.generation_density_no_fanout(shared.tables(spark, sf_dir))


@query("vx_04_heatmap_points", HEATMAP)
def heatmap_points(spark, sf_dir):
    return geo.heatmap_points(shared.tables(spark, sf_dir))


@query("vx_05_country_infrastructure_density", with_ctes(
    f"""SELECT country, count(*) AS plant_count, {total('capacity_mw')} AS total_capacity_mw,
               {ratio("count(*)::DOUBLE", f"({total('capacity_mw')} / 1000.0::DOUBLE)")} AS plants_per_1000_mw
        FROM silver WHERE {has_text('country')} GROUP BY 1""", "silver"))
def country_infrastructure_density(spark, sf_dir):
    return geo.country_infrastructure_density(shared.tables(spark, sf_dir))


# --- monitoring ---------------------------------------------------------------------

MONTHLY = f"""
    SELECT run, count(*) AS input_rows, count(DISTINCT plant_id) FILTER (good) AS valid_rows,
           count(*) FILTER (NOT good) AS malformed_rows, count(*) FILTER (plant_name IS NULL) AS null_plant_name,
           count(*) FILTER (country IS NULL) AS null_country, count(*) FILTER (primary_fuel IS NULL) AS null_primary_fuel,
           count(*) FILTER (capacity_mw IS NULL) AS null_capacity_mw,
           count(*) FILTER (capacity_mw NOT BETWEEN 0.0001 AND 1000000) AS invalid_capacity_rows,
           count(*) FILTER (commissioning_year NOT BETWEEN 1850 AND 2100) AS invalid_commissioning_year_rows
    FROM (SELECT b.*, date_trunc('month', r.event_time)::TIMESTAMP AS run,
                 b.plant_name IS NOT NULL AND b.country IS NOT NULL AND b.primary_fuel IS NOT NULL
                 AND b.capacity_mw BETWEEN 0.0001 AND 1000000
                 AND coalesce(b.commissioning_year BETWEEN 1850 AND 2100, true) AS good
          FROM readings r JOIN batch b USING (plant_id)) GROUP BY run"""
NULLS = "null_plant_name + null_country + null_primary_fuel + null_capacity_mw"
RANGES = "invalid_capacity_rows + invalid_commissioning_year_rows"


def _ints(*names: str) -> str:
    return ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)


@query("vm_01_data_quality", with_ctes(
    f"""SELECT run AS run_timestamp, 'readings' AS dataset, {_ints('input_rows', 'valid_rows', 'malformed_rows')},
               CAST({NULLS} AS BIGINT) AS null_issues, CAST({RANGES} AS BIGINT) AS range_issues,
               valid_rows::DOUBLE / input_rows AS valid_ratio FROM monthly""", "readings", "batch", monthly=MONTHLY))
def data_quality(spark, sf_dir):
    return monitor.data_quality({"audit_silver_quality_report": shared.quality_text(spark, sf_dir)})


BREAKDOWN = f"""
    SELECT run AS run_timestamp, 'readings' AS dataset, {_ints('input_rows', 'valid_rows')},
           CAST(greatest(input_rows - valid_rows, 0) AS BIGINT) AS distinct_failed_records,
           {_ints('malformed_rows', 'null_plant_name', 'null_country', 'null_primary_fuel', 'null_capacity_mw',
                  'invalid_capacity_rows', 'invalid_commissioning_year_rows')},
           CAST({NULLS} AS BIGINT) AS null_issue_points, CAST({RANGES} AS BIGINT) AS range_issue_points,
           CAST(malformed_rows + {NULLS} + {RANGES} AS BIGINT) AS total_issue_points,
           greatest(input_rows - valid_rows, 0)::DOUBLE / input_rows AS distinct_failure_ratio
    FROM monthly"""


@query("vm_02_dq_failure_breakdown", with_ctes(BREAKDOWN, "readings", "batch", monthly=MONTHLY))
def dq_failure_breakdown(spark, sf_dir):
    return monitor.dq_failure_breakdown({"audit_silver_quality_report": shared.quality_text(spark, sf_dir)})


@query("vm_03_dq_failure_breakdown_latest", with_ctes(
    f"{BREAKDOWN} ORDER BY run DESC LIMIT 1", "readings", "batch", monthly=MONTHLY))
def dq_failure_breakdown_latest(spark, sf_dir):
    return monitor.dq_failure_breakdown_latest({"audit_silver_quality_report": shared.quality_text(spark, sf_dir)})


FRESHNESS = with_ctes(
    f"""SELECT source_name, last_ingested_at AS latest_ingested_at,
               CAST(date_sub('hour', last_ingested_at, {RUN}) AS INTEGER) AS lag_hours
        FROM source_registry LEFT JOIN source_state USING (source_name)""", "source_registry", "source_state")


def _freshness_text(spark, sf_dir):
    report = shared.freshness(spark, sf_dir)
    times = ("run_timestamp", "last_ingested_at", "event_time_watermark")
    report = report.withColumns({c: iso_text(F.col(c)) for c in times})
    return {"audit_freshness_report": report.select([F.col(c).cast("string").alias(c) for c in report.columns])}


@query("vm_04_freshness", FRESHNESS)
def freshness(spark, sf_dir):
    return monitor.freshness(_freshness_text(spark, sf_dir), shared.as_of())


@query("vm_05_pipeline_freshness", FRESHNESS)
def pipeline_freshness(spark, sf_dir):
    return monitor.pipeline_freshness(_freshness_text(spark, sf_dir), shared.as_of())


def _metrics(spark, sf_dir):
    log = bindings.metrics_log(spark, sf_dir)
    return {"audit_metrics": log.withColumn("metric_value", F.col("metric_value").cast("string"))}


@query("vm_06_failed_jobs", with_ctes(
    """SELECT ts AS metric_date, metric_name, metric_value AS failure_count FROM metrics_log
       WHERE metric_name LIKE '%fail%' OR metric_name LIKE '%error%'
       QUALIFY row_number() OVER (PARTITION BY metric_name ORDER BY ts DESC, metric_value DESC) = 1""", "metrics_log"))
def failed_jobs(spark, sf_dir):
    return monitor.failed_jobs(_metrics(spark, sf_dir))


@query("vm_07_pipeline_metrics", with_ctes(
    "SELECT ts AS metric_timestamp, metric_name, metric_value FROM metrics_log", "metrics_log"))
def pipeline_metrics(spark, sf_dir):
    return monitor.pipeline_metrics(_metrics(spark, sf_dir))


# Runs as a state machine over the log sorted by time: last bronze so far, then the
# first silver, gold and chart time that follow inside the run.
RUNS = {
    "runs": """
        SELECT *, max(CASE WHEN metric_name = 'bronze_rows_ingested' THEN ts END)
                  OVER (ORDER BY ts, (metric_name <> 'bronze_rows_ingested')::INT ROWS UNBOUNDED PRECEDING) AS bronze_ts
        FROM metrics_log""",
    "s": """SELECT bronze_ts, min(ts) AS silver_ts FROM runs WHERE metric_name = 'silver_valid_rows'
            AND bronze_ts IS NOT NULL GROUP BY 1""",
    "g": """SELECT s.*, min(ts) AS gold_ts FROM s JOIN runs USING (bronze_ts)
            WHERE metric_name = 'gold_rows_fact_capacity' AND ts >= silver_ts GROUP BY ALL""",
    "v": """SELECT g.*, min(ts) AS viz_ts FROM g JOIN runs USING (bronze_ts)
            WHERE metric_name = 'visualizations_generated' AND ts >= gold_ts GROUP BY ALL""",
}


def _minutes(a: str, b: str) -> str:
    return f"CAST(greatest(0, ceil(date_sub('second', {a}, {b}) / 60.0)) AS INTEGER)"


LATENCY = with_ctes(
    f"""SELECT bronze_ts AS bronze_completed_at, silver_ts AS silver_completed_at, gold_ts AS gold_completed_at,
               viz_ts AS visualizations_completed_at, {_minutes('bronze_ts', 'silver_ts')} AS bronze_to_silver_minutes,
               {_minutes('silver_ts', 'gold_ts')} AS silver_to_gold_minutes,
               {_minutes('gold_ts', 'viz_ts')} AS gold_to_viz_minutes
        FROM v ORDER BY bronze_ts DESC LIMIT 1""", "metrics_log", **RUNS)


@query("vm_08_processing_latency", LATENCY)
def processing_latency(spark, sf_dir):
    return monitor.processing_latency(_metrics(spark, sf_dir))


@query("vm_08_pipeline_runs", with_ctes(
    """SELECT b.bronze_ts, s.silver_ts, g.gold_ts, v.viz_ts
       FROM (SELECT DISTINCT ts AS bronze_ts FROM metrics_log WHERE metric_name = 'bronze_rows_ingested') b
       LEFT JOIN s USING (bronze_ts) LEFT JOIN g USING (bronze_ts) LEFT JOIN v USING (bronze_ts)""", "metrics_log", **RUNS))
def pipeline_runs(spark, sf_dir):
    return monitor.pipeline_runs(_metrics(spark, sf_dir)["audit_metrics"])


@query("vm_09_latency", LATENCY)
def latency(spark, sf_dir):
    return monitor.latency(_metrics(spark, sf_dir))


@query("vm_11_duplicate_plants", with_ctes(
    f"""SELECT plant_id, count(*) AS duplicate_count, max({iso('ingested_at')}) AS latest_ingested_at
        FROM readings GROUP BY 1 HAVING count(*) > 1""", "readings"))
def duplicate_plants(spark, sf_dir):
    """Over the readings, where a plant occurs once per reading."""
    rows = bindings.readings(spark, sf_dir)
    return monitor.duplicate_plants({"stg_power_plants": rows.withColumn("ingested_at", iso_text(F.col("ingested_at")))})


@query("vm_12_missing_or_inconsistent_generation", with_ctes(
    """SELECT plant_id, coalesce(plant_name, 'Unknown') AS plant_name, coalesce(country, 'Unknown') AS country,
              coalesce(primary_fuel, 'Unknown') AS primary_fuel, coalesce(capacity_mw, 0) AS capacity_mw,
              coalesce(estimated_generation_gwh, 0) AS estimated_generation_gwh,
              CASE WHEN coalesce(capacity_mw, 0) <= 0 THEN 0.0::DOUBLE ELSE used END AS utilization_ratio,
              CASE WHEN estimated_generation_gwh IS NULL THEN 'missing_generation'
                   WHEN coalesce(capacity_mw, 0) <= 0 THEN 'invalid_capacity'
                   WHEN used > 1 THEN 'inconsistent_above_theoretical' ELSE 'inconsistent_negative_generation' END AS issue_type
       FROM (SELECT *, estimated_generation_gwh / nullif(capacity_mw * 8.76::DOUBLE, 0) AS used FROM batch)
       WHERE estimated_generation_gwh IS NULL OR coalesce(capacity_mw, 0) <= 0 OR used > 1 OR used < 0""", "batch"))
def missing_or_inconsistent_generation(spark, sf_dir):
    """Over the conformed batch before the gate, which still holds the rows the rules are about."""
    return monitor.missing_or_inconsistent_generation({"stg_power_plants": shared.batch(spark, sf_dir)})


def _first_missing(table: str, source: str, key: str, columns: list[str], text: set[str]) -> str:
    lacks = {c: f"coalesce(NOT {has_text(c)}, true)" if c in text else f"{c} IS NULL" for c in columns}
    reason = "CASE " + " ".join(f"WHEN {test} THEN 'missing_{c}'" for c, test in lacks.items()) + " END"
    return f"""SELECT '{table}' AS source_table, {key} AS record_key, {reason} AS quarantine_reason,
                      {RUN} AS quarantined_at FROM {source} WHERE {' OR '.join(lacks.values())}"""


_TEXT = {"plant_id", "plant_name", "country", "primary_fuel", "continent", "sub_region"}
_PLANT = ["plant_id", "plant_name", "country", "primary_fuel", "capacity_mw", "commissioning_year"]
NULL_RECORDS = " UNION ALL ".join([
    _first_missing("dim_plant", "raw_dim", "coalesce(plant_id, '')", [*_PLANT, "latitude", "longitude"], _TEXT),
    _first_missing("silver_stg_power_plants", "batch", "coalesce(plant_id, '')", [*_PLANT, "continent", "sub_region"], _TEXT),
    _first_missing("fact_power_generation", "raw_generation",
                   "concat_ws(':', coalesce(country, ''), coalesce(primary_fuel, ''), coalesce(year::VARCHAR, ''))",
                   ["country", "primary_fuel", "year", "total_generation_gwh"], _TEXT),
    _first_missing("fact_plant_capacity", "raw_capacity", "coalesce(country, '')",
                   ["country", "total_capacity_mw", "renewable_capacity_mw"], _TEXT),
])
RAW_GOLD = {
    "raw_dim": "SELECT * FROM batch",
    "raw_generation": f"""SELECT country, primary_fuel, year(event_time) AS year, {total('estimated_generation_gwh')} AS
                          total_generation_gwh FROM batch GROUP BY ALL""",
    "raw_capacity": f"""SELECT country, primary_fuel, {total('capacity_mw')} AS total_capacity_mw,
                        0 AS renewable_capacity_mw FROM batch GROUP BY ALL""",
}


def _ungated(spark, sf_dir):
    """Gold built without the gate, so that the quarantine views have something to find."""
    from wattlake.operators import gold

    rows = shared.batch(spark, sf_dir)
    dated = rows.withColumn("event_year", F.year("event_time"))
    return {
        "stg_power_plants": rows,
        "dim_plant": gold.dim_plant(rows),
        "fact_power_generation": gold.fact_power_generation(dated),
        "fact_plant_capacity": gold.fact_plant_capacity(rows),
    }


@query("vm_13_quarantine_null_records", with_ctes(NULL_RECORDS, "batch", **RAW_GOLD))
def quarantine_null_records(spark, sf_dir):
    return monitor.quarantine_null_records(_ungated(spark, sf_dir), shared.as_of())


@query("vm_14_quarantine_null_summary", with_ctes(
    f"""SELECT source_table, quarantine_reason, count(*) AS quarantined_records
        FROM ({NULL_RECORDS}) GROUP BY ALL""", "batch", **RAW_GOLD))
def quarantine_null_summary(spark, sf_dir):
    return monitor.quarantine_null_summary(_ungated(spark, sf_dir), shared.as_of())
