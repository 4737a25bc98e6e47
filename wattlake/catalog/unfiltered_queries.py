"""The older view forms, over tables built without the gate so that their nulls show."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import AGE, CTES, RUN, summed, iso, mean, ratio, with_ctes
from wattlake.catalog.view_queries import MONTHLY
from wattlake.catalog.quality_queries import NULL_JSON, RANGE_JSON
from wattlake.functions.times import at
from wattlake.plans.medallion import gold_layer
from wattlake.plans.views import unfiltered
from wattlake.sources import bindings

GWH = "total_generation_gwh"


def _tables(spark, sf_dir):
    """Gold straight from the conformed batch; generation stays null where a plant reported none."""
    rows = shared.batch(spark, sf_dir).withColumns({"event_year": F.year("event_time"), "event_month": F.month("event_time")})
    return gold_layer(rows, shared.as_of())


# The gold CTEs again, reading the batch where they read silver.
_BATCH_AS_SILVER = "SELECT *, year(event_time) AS event_year, month(event_time) AS event_month FROM batch"


def _sql(select: str, **extra: str) -> str:
    names = ("dim_plant", "dim_fuel_type", "fact_plant_capacity", "fact_power_generation")
    ungated = {"silver": _BATCH_AS_SILVER} | {n: CTES[n][1] for n in names}
    return with_ctes(select, "batch", **ungated, **extra)


FLAGGED = "SELECT g.*, f.is_renewable FROM fact_power_generation g LEFT JOIN dim_fuel_type f ON g.primary_fuel = f.primary_fuel"
CLEAN = summed(f"CASE WHEN is_renewable THEN {GWH} ELSE 0 END")
DIRTY = summed(f"CASE WHEN NOT is_renewable THEN {GWH} ELSE 0 END")


@query("vg_01_country_capacity_unfiltered", _sql(
    f"""SELECT country, {summed('total_capacity_mw')} AS total_capacity_mw, {summed('renewable_capacity_mw')} AS renewable_capacity_mw,
               {summed('total_capacity_mw')} - {summed('renewable_capacity_mw')} AS non_renewable_capacity_mw
        FROM fact_plant_capacity GROUP BY 1"""))
def country_capacity(spark, sf_dir):
    return unfiltered.country_capacity(_tables(spark, sf_dir))


@query("vg_02_fuel_distribution_unfiltered", _sql(
    f"SELECT country, primary_fuel, {summed(GWH)} AS {GWH} FROM fact_power_generation GROUP BY ALL"))
def fuel_distribution(spark, sf_dir):
    return unfiltered.fuel_distribution(_tables(spark, sf_dir))


@query("vg_03_renewable_trend_unfiltered", _sql(
    f"""SELECT year, country, {CLEAN} AS renewable_generation_gwh, {DIRTY} AS non_renewable_generation_gwh,
               {ratio(CLEAN, summed(GWH))} AS renewable_generation_ratio FROM flagged GROUP BY ALL""", flagged=FLAGGED))
def renewable_trend(spark, sf_dir):
    return unfiltered.renewable_trend(_tables(spark, sf_dir)).withColumn("year", F.col("year").cast("bigint"))


@query("vs_08_renewable_adoption_trend", _sql(
    f"""SELECT year, country, {CLEAN} AS renewable_generation_gwh, {summed(GWH)} AS {GWH},
               {ratio(CLEAN, summed(GWH))} AS renewable_adoption_ratio FROM flagged GROUP BY ALL""", flagged=FLAGGED))
def renewable_adoption_trend(spark, sf_dir):
    return unfiltered.renewable_adoption_trend(_tables(spark, sf_dir)).withColumn("year", F.col("year").cast("bigint"))


@query("vs_07_clean_energy_growth_yearly", _sql(
    """SELECT *, renewable_generation_gwh - lag(renewable_generation_gwh) OVER (PARTITION BY country ORDER BY year NULLS LAST)
              AS renewable_generation_growth_gwh FROM yearly""", flagged=FLAGGED,
    yearly=f"SELECT year, country, {CLEAN} AS renewable_generation_gwh FROM flagged GROUP BY ALL"))
def clean_energy_growth(spark, sf_dir):
    return unfiltered.clean_energy_growth(_tables(spark, sf_dir)).withColumn("year", F.col("year").cast("bigint"))


@query("vp_01_largest_plants_unfiltered", _sql("SELECT * EXCLUDE (owner_masked) FROM dim_plant"))
def largest_plants(spark, sf_dir):
    return unfiltered.largest_plants(_tables(spark, sf_dir))


@query("vp_02_aging_infrastructure_unfiltered", _sql(
    f"""SELECT country, primary_fuel, count(*) AS plant_count, {mean('commissioning_year')} AS avg_commissioning_year,
               count(*) FILTER (commissioning_year < year({AGE}) - 30) AS aging_30_plus_count,
               count(*) FILTER (commissioning_year < year({AGE}) - 40) AS aging_40_plus_count
        FROM dim_plant GROUP BY ALL"""))
def aging_infrastructure(spark, sf_dir):
    return unfiltered.aging_infrastructure(_tables(spark, sf_dir), at(bindings.AGE_AS_OF))


@query("vp_03_capacity_utilization_unfiltered", _sql(
    f"""SELECT year, country, primary_fuel, total_capacity_mw, {GWH}, total_capacity_mw * 8.76::DOUBLE AS theoretical_max_generation_gwh,
               CASE WHEN total_capacity_mw <= 0 THEN 0.0::DOUBLE ELSE {GWH} / (total_capacity_mw * 8.76::DOUBLE) END AS utilization_ratio
        FROM fact_power_generation JOIN fact_plant_capacity USING (country, primary_fuel)"""))
def capacity_utilization(spark, sf_dir):
    return unfiltered.capacity_utilization(_tables(spark, sf_dir)).withColumn("year", F.col("year").cast("bigint"))


@query("vx_01_plant_distribution_unfiltered", _sql(
    f"""SELECT country, count(*) AS plant_count, {summed('capacity_mw')} AS total_capacity_mw, {mean('capacity_mw')} AS avg_capacity_mw
        FROM dim_plant GROUP BY 1"""))
def plant_distribution(spark, sf_dir):
    return unfiltered.plant_distribution(_tables(spark, sf_dir))


@query("vx_03_generation_density_unfiltered", _sql(
    f"""SELECT p.country, count(DISTINCT plant_id) AS plant_count, {summed('capacity_mw')} AS total_capacity_mw,
               {summed(GWH)} AS {GWH}, {summed(GWH)} / count(DISTINCT plant_id) AS generation_per_plant_gwh
        FROM dim_plant p LEFT JOIN fact_power_generation g ON p.country = g.country AND p.primary_fuel = g.primary_fuel GROUP BY 1"""))
def generation_density(spark, sf_dir):
    return unfiltered.generation_density(_tables(spark, sf_dir))


@query("vx_04_heatmap_points_unfiltered", _sql(
    """SELECT plant_id, plant_name, country, latitude, longitude, capacity_mw, primary_fuel FROM dim_plant
       WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""))
def heatmap_points(spark, sf_dir):
    return unfiltered.heatmap_points(_tables(spark, sf_dir))


@query("vm_01_data_quality_text_issues", with_ctes(
    f"""SELECT {iso('run')} AS run_timestamp, 'readings' AS dataset, input_rows, valid_rows, malformed_rows,
               {NULL_JSON} AS null_issues, {RANGE_JSON} AS range_issues, valid_rows::DOUBLE / input_rows AS valid_ratio
        FROM monthly""", "readings", "batch", monthly=MONTHLY))
def data_quality(spark, sf_dir):
    return unfiltered.data_quality({"audit_silver_quality_report": shared.quality_text(spark, sf_dir)})


@query("vm_04_freshness_of_silver", with_ctes(
    f"""SELECT source_name, max({iso('ingested_at')}) AS latest_ingested_at, date_sub('hour', max(ingested_at), {RUN}) AS lag_hours
        FROM readings GROUP BY 1""", "readings"))
def freshness(spark, sf_dir):
    from wattlake.functions.times import iso_text

    rows = bindings.readings(spark, sf_dir).withColumn("ingested_at", iso_text(F.col("ingested_at")))
    return unfiltered.freshness({"stg_power_plants": rows}, shared.as_of())


@query("vm_07_pipeline_metrics_text_times", with_ctes(
    "SELECT metric_timestamp, metric_name, metric_value FROM metrics_log", "metrics_log"))
def pipeline_metrics(spark, sf_dir):
    log = bindings.metrics_log(spark, sf_dir)
    return unfiltered.pipeline_metrics({"audit_metrics": log.withColumn("metric_value", F.col("metric_value").cast("string"))})


def _newest(metric: str) -> str:
    return f"max(ts) FILTER (metric_name = '{metric}')"


@query("vm_10_processing_latency_newest", with_ctes(
    """SELECT *, date_sub('minute', bronze_completed_at, silver_completed_at) AS bronze_to_silver_minutes,
              date_sub('minute', silver_completed_at, gold_completed_at) AS silver_to_gold_minutes,
              date_sub('minute', gold_completed_at, visualizations_completed_at) AS gold_to_viz_minutes FROM newest""",
    "metrics_log", newest=f"""
        SELECT {_newest('bronze_rows_ingested')} AS bronze_completed_at, {_newest('silver_valid_rows')} AS silver_completed_at,
               {_newest('gold_rows_fact_capacity')} AS gold_completed_at,
               {_newest('visualizations_generated')} AS visualizations_completed_at FROM metrics_log"""))
def processing_latency(spark, sf_dir):
    return unfiltered.processing_latency({"audit_metrics": bindings.metrics_log(spark, sf_dir)})


