"""The older forms of the views: no row filters, nulls kept, sums null where nothing is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.constants import STAGE_METRICS
from wattlake.functions.numbers import ratio, to_double
from wattlake.functions.times import parse_iso, whole_units_between
from wattlake.plans.views.common import Tables, theoretical_gwh, utilisation, values, with_fuel_flag

GWH = "total_generation_gwh"


def country_capacity(t: Tables, as_of: Column | None = None) -> DataFrame:
    everything, renewable = F.sum(F.col("total_capacity_mw")), F.sum(F.col("renewable_capacity_mw"))
    return t["fact_plant_capacity"].groupBy("country").agg(
        everything.alias("total_capacity_mw"),
        renewable.alias("renewable_capacity_mw"),
        (everything - renewable).alias("non_renewable_capacity_mw"),
    )


def fuel_distribution(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["fact_power_generation"].groupBy("country", "primary_fuel").agg(F.sum(F.col(GWH)).alias(GWH))


def _part(flag: Column) -> Column:
    return F.sum(F.when(flag, F.col(GWH)).otherwise(F.lit(0.0)))


def renewable_trend(t: Tables, as_of: Column | None = None) -> DataFrame:
    """A fuel the dimension does not know counts on neither side but in the whole."""
    flag = F.col("is_renewable")
    return with_fuel_flag(t, t["fact_power_generation"]).groupBy("year", "country").agg(
        _part(flag).alias("renewable_generation_gwh"),
        _part(~flag).alias("non_renewable_generation_gwh"),
        ratio(_part(flag), F.sum(F.col(GWH))).alias("renewable_generation_ratio"),
    )


def renewable_adoption_trend(t: Tables, as_of: Column | None = None) -> DataFrame:
    flag = F.col("is_renewable")
    return with_fuel_flag(t, t["fact_power_generation"]).groupBy("year", "country").agg(
        _part(flag).alias("renewable_generation_gwh"),
        F.sum(F.col(GWH)).alias(GWH),
        ratio(_part(flag), F.sum(F.col(GWH))).alias("renewable_adoption_ratio"),
    )


def clean_energy_growth(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Change against the year before. The window sees one row per country and year."""
    yearly = with_fuel_flag(t, t["fact_power_generation"]).groupBy("year", "country").agg(
        _part(F.col("is_renewable")).alias("renewable_generation_gwh")
    )
    before = F.lag("renewable_generation_gwh").over(Window.partitionBy("country").orderBy(F.col("year").asc_nulls_last()))
    return yearly.withColumn("renewable_generation_growth_gwh", F.col("renewable_generation_gwh") - before)


def largest_plants(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["dim_plant"].select(
        "plant_id", "plant_name", "country", "primary_fuel", "capacity_mw", "commissioning_year", "latitude", "longitude"
    )


def aging_infrastructure(t: Tables, as_of: Column) -> DataFrame:
    older_than = lambda years: F.count_if(F.col("commissioning_year") < F.year(as_of) - years)
    return t["dim_plant"].groupBy("country", "primary_fuel").agg(
        F.count("*").alias("plant_count"),
        F.avg(F.col("commissioning_year")).alias("avg_commissioning_year"),
        older_than(30).alias("aging_30_plus_count"),
        older_than(40).alias("aging_40_plus_count"),
    )


def capacity_utilization(t: Tables, as_of: Column | None = None) -> DataFrame:
    generated = (
        t["fact_power_generation"].groupBy("country", "primary_fuel", "year").agg(F.sum(F.col(GWH)).alias(GWH))
    )
    installed = (
        t["fact_plant_capacity"]
        .groupBy("country", "primary_fuel")
        .agg(F.sum(F.col("total_capacity_mw")).alias("total_capacity_mw"))
    )
    capacity = F.col("total_capacity_mw")
    return generated.join(installed, ["country", "primary_fuel"]).select(
        "year",
        "country",
        "primary_fuel",
        "total_capacity_mw",
        GWH,
        theoretical_gwh(capacity).alias("theoretical_max_generation_gwh"),
        utilisation(F.col(GWH), capacity).alias("utilization_ratio"),
    )


def plant_distribution(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["dim_plant"].groupBy("country").agg(
        F.count("*").alias("plant_count"),
        F.sum(F.col("capacity_mw")).alias("total_capacity_mw"),
        F.avg(F.col("capacity_mw")).alias("avg_capacity_mw"),
    )


def generation_density(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Plants without facts stay. Totals as of a plant-by-fact join, from one row per plant and per pair."""
    plants = t["dim_plant"].groupBy("country", "primary_fuel", "plant_id").agg(
        F.count("*").alias("_rows"), F.sum(F.col("capacity_mw")).alias("_capacity")
    )
    facts = t["fact_power_generation"].groupBy("country", "primary_fuel").agg(
        F.count("*").alias("_facts"), F.sum(F.col(GWH)).alias("_generation")
    )
    count = F.count_distinct("plant_id")
    generation = F.sum(F.col("_generation") * F.col("_rows"))
    return plants.join(facts, ["country", "primary_fuel"], "left").groupBy("country").agg(
        count.alias("plant_count"),
        F.sum(F.col("_capacity") * F.coalesce("_facts", F.lit(1))).alias("total_capacity_mw"),
        generation.alias(GWH),
        ratio(generation, count).alias("generation_per_plant_gwh"),
    )


def heatmap_points(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["dim_plant"].filter(values("latitude", "longitude")).select(
        "plant_id", "plant_name", "country", "latitude", "longitude", "capacity_mw", "primary_fuel"
    )


def data_quality(t: Tables, as_of: Column | None = None) -> DataFrame:
    report = t["audit_silver_quality_report"]
    rows = to_double(F.col("input_rows"))
    return report.select(
        "run_timestamp",
        "dataset",
        *[F.col(c).try_cast("bigint").alias(c) for c in ("input_rows", "valid_rows", "malformed_rows")],
        "null_issues",
        "range_issues",
        ratio(to_double(F.col("valid_rows")), rows).alias("valid_ratio"),
    )


def freshness(t: Tables, as_of: Column) -> DataFrame:
    """From the silver rows themselves."""
    newest = F.max(parse_iso(F.col("ingested_at")))
    return t["stg_power_plants"].groupBy("source_name").agg(
        F.max("ingested_at").alias("latest_ingested_at"), whole_units_between("HOUR", newest, as_of).alias("lag_hours")
    )


def pipeline_metrics(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["audit_metrics"].select("metric_timestamp", "metric_name", to_double(F.col("metric_value")).alias("metric_value"))


def processing_latency(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Newest time of every stage, whatever run it belongs to, in one pass over the log."""
    ts = parse_iso(F.col("metric_timestamp"))
    rows = t["audit_metrics"].filter(F.col("metric_name").isin(*STAGE_METRICS.values()))
    newest = rows.agg(*[F.max(F.when(F.col("metric_name") == m, ts)).alias(f"{s}_completed_at") for s, m in STAGE_METRICS.items()])
    minutes = lambda a, b: whole_units_between("MINUTE", F.col(f"{a}_completed_at"), F.col(f"{b}_completed_at"))
    return newest.withColumns(
        {
            "bronze_to_silver_minutes": minutes("bronze", "silver"),
            "silver_to_gold_minutes": minutes("silver", "gold"),
            "gold_to_viz_minutes": minutes("gold", "visualizations"),
        }
    )
