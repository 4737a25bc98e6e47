"""All views by the names dashboards query, over a lake or any set of tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession

from wattlake.plans.gold import TABLES, gold_table
from wattlake.plans.medallion import Layers
from wattlake.plans.silver import silver_table
from wattlake.plans.views import geo, monitor, plant, power, sustain
from wattlake.sources.readers import register_views

# The view names.
VIEWS: dict[str, Callable[..., DataFrame]] = {
    "vw_power_generation_country_capacity": power.country_capacity,
    "vw_power_generation_fuel_distribution": power.fuel_distribution,
    "vw_power_generation_renewable_trend": power.renewable_trend,
    "vw_power_generation_global_fuel_dominance": power.global_fuel_dominance,
    "vw_power_generation_annual_generation_trends": power.annual_generation_trends,
    "vw_power_generation_kpi_summary": power.kpi_summary,
    "vw_plant_operations_largest_plants": plant.largest_plants,
    "vw_plant_operations_aging_infrastructure": plant.aging_infrastructure,
    "vw_plant_operations_capacity_utilization": plant.capacity_utilization,
    "vw_plant_operations_underutilized_plants": plant.underutilized_plants,
    "vw_plant_operations_aging_by_region": plant.aging_by_region,
    "vw_sustainability_heatmap": sustain.heatmap,
    "vw_sustainability_country_distribution": sustain.country_distribution,
    "vw_sustainability_regional_density": sustain.regional_density,
    "vw_sustainability_coal_dependency": sustain.coal_dependency,
    "vw_sustainability_clean_energy_growth": sustain.clean_energy_growth,
    "vw_geographic_plant_distribution": geo.plant_distribution_by_country,
    "vw_geographic_plant_distribution_by_region": geo.plant_distribution_by_region,
    "vw_geographic_generation_density": geo.generation_density,
    "vw_geographic_heatmap_points": geo.heatmap_points,
    "vw_geographic_country_infrastructure_density": geo.country_infrastructure_density,
    "vw_monitoring_data_quality": monitor.data_quality,
    "vw_monitoring_dq_failure_breakdown": monitor.dq_failure_breakdown,
    "vw_monitoring_dq_failure_breakdown_latest": monitor.dq_failure_breakdown_latest,
    "vw_monitoring_freshness": monitor.freshness,
    "vw_monitoring_pipeline_freshness": monitor.pipeline_freshness,
    "vw_monitoring_failed_jobs": monitor.failed_jobs,
    "vw_monitoring_pipeline_metrics": monitor.pipeline_metrics,
    "vw_monitoring_processing_latency": monitor.processing_latency,
    "vw_monitoring_latency": monitor.latency,
    "vw_monitoring_duplicate_plants": monitor.duplicate_plants,
    "vw_monitoring_missing_or_inconsistent_generation": monitor.missing_or_inconsistent_generation,
    "vw_quarantine_null_records": monitor.quarantine_null_records,
    "vw_quarantine_null_summary": monitor.quarantine_null_summary,
}

REPORTS = {
    "audit_silver_quality_report": "silver_quality_report",
    "audit_freshness_report": "freshness_report",
    "audit_bronze_run_report": "bronze_run_report",
}


def open_lake(spark: SparkSession, root: str) -> Layers:
    """Current silver and gold tables and the audit logs of a lake, opened when asked for."""

    def report(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.option("header", True).csv(f"{root}/audit/{name}")

    builders: dict[str, Callable[[], DataFrame]] = {n: gold_table(spark, root, n).read for n in TABLES}
    builders |= {table: report(name) for table, name in REPORTS.items()}
    builders["stg_power_plants"] = silver_table(spark, root).read
    builders["audit_metrics"] = lambda: spark.read.parquet(f"{root}/audit/metrics")
    return Layers(builders)


def register_all(tables: Layers, as_of: Column, names: Iterable[str] = tuple(VIEWS)) -> None:
    """Create or replace the named temporary views, all of them by default.

    ``as_of`` stands for the current time: the caller decides whether a session
    looks at now or at the time of a run.
    """
    register_views({name: VIEWS[name](tables, as_of) for name in names})
