"""The gold job: star schema, KPI tables, governance documents and chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.times import at
from wattlake.operators import gold, quality
from wattlake.plans.incremental import GoldSums
from wattlake.plans.medallion import gold_layer
from wattlake.plans.silver import silver_table
from wattlake.sources.sinks import VersionedTable, append_metrics, metric_rows, write_document

TABLES = (
    "dim_plant", "dim_country", "dim_fuel_type", "dim_time", "fact_plant_capacity", "fact_power_generation",
    "fact_power_generation_time", "fact_capacity_geo",
)


def gold_table(spark: SparkSession, root: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/gold/{name}")


def run_gold(spark: SparkSession, root: str, as_of: str) -> dict[str, DataFrame]:
    """Build and write all gold tables; later steps read what was written, not the plans.

    Facts and the dimensions of names come from sums by silver bucket, of which only changed ones are taken anew.
    """
    run_time = at(as_of)
    table = silver_table(spark, root)
    silver = table.read()
    if silver is None:
        raise FileNotFoundError("no silver table yet")
    sums = GoldSums(spark, table, f"{root}/gold/sums_by_bucket").refresh()
    plans = gold_layer(sums, run_time).but(dim_plant=gold.dim_plant(silver))
    written = {name: gold_table(spark, root, name).replace(plans[name]) for name in TABLES}
    generation = written["fact_power_generation"]
    for name, frame in (
        ("country_fuel_distribution", gold.country_fuel_distribution(generation)),
        ("annual_generation_trends", gold.annual_generation_trends(generation)),
    ):
        written[name] = gold_table(spark, root, name).replace(frame)

    governance = f"{root}/audit/governance"
    nodes = {"silver.stg_power_plants": silver} | {f"gold.{n}": written[n] for n in TABLES}
    generated = run_time.alias("generated_at")
    write_document(quality.schema_documentation(nodes).select(generated, "*"), f"{governance}/schema_documentation")
    write_document(gold.lineage(nodes).select(generated, "*"), f"{governance}/data_lineage")
    aggregations = gold.aggregation_report(
        written["fact_plant_capacity"], written["fact_power_generation_time"], written["fact_capacity_geo"]
    )
    write_document(aggregations.select(generated, "*"), f"{governance}/transformation_aggregation_report")

    kpi_path = f"{root}/audit/mandatory_kpi_report"
    kpis = gold.kpi_report(written["fact_plant_capacity"], written["dim_plant"], generation, run_time)
    write_document(kpis, kpi_path)
    kpis = spark.read.schema(kpis.schema).json(kpi_path)
    sizes = quality.row_counts({n: written[n] for n in ("fact_plant_capacity", "fact_power_generation_time", "fact_capacity_geo")})
    rows = sizes.select(F.map_from_entries(F.collect_list(F.struct("view_name", "row_count")))).scalar()
    row = kpis.withColumn("_rows", rows)
    values = {
        "gold_rows_fact_capacity": F.col("_rows.fact_plant_capacity"),
        "renewable_energy_ratio": F.col("renewable_energy_ratio"),
        "gold_capacity_aggregation_rows": F.col("_rows.fact_plant_capacity"),
        "gold_time_aggregation_rows": F.col("_rows.fact_power_generation_time"),
        "gold_geo_aggregation_rows": F.col("_rows.fact_capacity_geo"),
        "gold_total_generation_capacity_mw": F.col("total_generation_capacity_mw"),
        "gold_average_plant_capacity_mw": F.col("average_plant_capacity_mw"),
        "gold_country_wise_fuel_distribution_rows": F.col("country_wise_fuel_distribution_rows"),
        "gold_annual_generation_trends_rows": F.col("annual_generation_trends_rows"),
    }
    append_metrics(metric_rows(spark, values, run_time, of=row), f"{root}/audit/metrics", f"gold-{as_of}")
    return written


def run_charts(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """Write the data behind each chart and the manifest; returns the manifest."""
    capacity = gold_table(spark, root, "fact_plant_capacity").read()
    generation = gold_table(spark, root, "fact_power_generation").read()
    charts = {
        "capacity_by_country": gold.top_capacity(capacity, "country"),
        "fuel_mix_capacity": gold.top_capacity(capacity, "primary_fuel"),
        "generation_trend": gold.generation_trend(generation),
    }
    written = {n: VersionedTable(spark, f"{root}/visualizations/{n}").replace(f) for n, f in charts.items()}
    manifest = gold.chart_manifest(written)
    write_document(manifest, f"{root}/visualizations/manifest")
    metrics = metric_rows(spark, {"visualizations_generated": F.col("count")}, at(as_of), of=manifest)
    append_metrics(metrics, f"{root}/audit/metrics", f"charts-{as_of}")
    return manifest
