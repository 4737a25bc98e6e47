"""Dimensions, facts, KPIs, lineage and chart data of the gold layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.hashing import owner_mask, owner_prefix_mask
from wattlake.functions.numbers import ratio, total
from wattlake.operators.conform import is_renewable
from wattlake.operators.ranking import numbered

PLANT_COLUMNS = (
    "plant_id", "plant_name", "country", "capacity_mw", "primary_fuel",
    "commissioning_year", "latitude", "longitude",
)

# Schemas of facts whose input columns are missing.
FACT_SCHEMAS = {
    "fact_power_generation": "country string, primary_fuel string, year long, total_generation_gwh double",
    "fact_power_generation_time": "year long, month long, total_generation_gwh double",
    "fact_capacity_geo": "continent string, sub_region string, total_capacity_mw double",
}


def dim_plant(silver: DataFrame) -> DataFrame:
    return silver.select(*PLANT_COLUMNS, owner_mask(F.col("owner")).alias("owner_masked"))


def _numbered(values: DataFrame, column: str, id_column: str) -> DataFrame:
    """Ids 1..n in value order, nulls last, however many names there are and however alike they begin."""
    placed = numbered(values, (), [F.col(column).asc_nulls_last()], "_position")
    return placed.select(*values.columns, (F.col("_position") + 1).cast("int").alias(id_column))


def dim_country(silver: DataFrame) -> DataFrame:
    return _numbered(silver.select("country").distinct(), "country", "country_id")


def fuel_flags(silver: DataFrame) -> DataFrame:
    """The fuels, and whether each is renewable: the dimension without its ids."""
    return silver.select("primary_fuel").distinct().withColumn("is_renewable", is_renewable(F.col("primary_fuel")))


def dim_fuel_type(silver: DataFrame) -> DataFrame:
    fuels = _numbered(fuel_flags(silver), "primary_fuel", "fuel_type_id")
    return fuels.select("primary_fuel", "fuel_type_id", "is_renewable")


def dim_time(spark: SparkSession, run_date: Column) -> DataFrame:
    return spark.range(1).select(*_calendar(run_date))


def _calendar(day: Column) -> list[Column]:
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
    ]


def calendar(times: DataFrame, column: str) -> DataFrame:
    """One row per day from the first to the last time in a table."""
    span = times.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = F.sequence(F.col("first").cast("date"), F.col("last").cast("date"), F.expr("interval 1 day"))
    return span.select(F.explode(days).alias("_day")).select(*_calendar(F.col("_day")))


def fact_plant_capacity(silver: DataFrame) -> DataFrame:
    facts = silver.groupBy("country", "primary_fuel").agg(total(F.col("capacity_mw")).alias("total_capacity_mw"))
    renewable = F.when(is_renewable(F.col("primary_fuel")), F.col("total_capacity_mw")).otherwise(F.lit(0.0))
    return facts.withColumn("renewable_capacity_mw", renewable)


def fact_power_generation(silver: DataFrame) -> DataFrame:
    if "estimated_generation_gwh" not in silver.columns:
        return empty_fact(silver, "fact_power_generation")
    return silver.groupBy("country", "primary_fuel", F.col("event_year").alias("year")).agg(
        total(F.col("estimated_generation_gwh")).alias("total_generation_gwh")
    )


def fact_power_generation_time(silver: DataFrame) -> DataFrame:
    if not {"estimated_generation_gwh", "event_month"} <= set(silver.columns):
        return empty_fact(silver, "fact_power_generation_time")
    return silver.groupBy(F.col("event_year").alias("year"), F.col("event_month").alias("month")).agg(
        total(F.col("estimated_generation_gwh")).alias("total_generation_gwh")
    )


def fact_capacity_geo(silver: DataFrame) -> DataFrame:
    if not {"continent", "sub_region"} <= set(silver.columns):
        return empty_fact(silver, "fact_capacity_geo")
    return silver.groupBy("continent", "sub_region").agg(total(F.col("capacity_mw")).alias("total_capacity_mw"))


def empty_fact(silver: DataFrame, name: str) -> DataFrame:
    return silver.sparkSession.createDataFrame([], FACT_SCHEMAS[name])


def country_fuel_distribution(generation: DataFrame) -> DataFrame:
    return (
        generation.groupBy("country", "primary_fuel")
        .agg(total(F.col("total_generation_gwh")).alias("total_generation_gwh"))
        .orderBy("country", "primary_fuel")
    )


def annual_generation_trends(generation: DataFrame) -> DataFrame:
    return (
        generation.groupBy("year").agg(total(F.col("total_generation_gwh")).alias("total_generation_gwh")).orderBy("year")
    )


def kpi_report(capacity: DataFrame, plants: DataFrame, generation: DataFrame, as_of: Column) -> DataFrame:
    """The mandatory KPIs as one row. Each part is an aggregate of its own table."""
    mean = plants.select(F.coalesce(F.avg(F.col("capacity_mw")), F.lit(0.0))).scalar()
    pairs = generation.select("country", "primary_fuel").distinct().select(F.count("*")).scalar()
    years = generation.select("year").distinct().select(F.count("*")).scalar()
    totals = capacity.agg(
        total(F.col("total_capacity_mw")).alias("_total"), total(F.col("renewable_capacity_mw")).alias("_renewable")
    )
    return totals.select(
        as_of.alias("generated_at"),
        F.col("_total").alias("total_generation_capacity_mw"),
        ratio(F.col("_renewable"), F.col("_total")).alias("renewable_energy_ratio"),
        mean.alias("average_plant_capacity_mw"),
        pairs.alias("country_wise_fuel_distribution_rows"),
        years.alias("annual_generation_trends_rows"),
    )


# --- governance ------------------------------------------------------------------

# The edges of the lineage report.
LINEAGE = (
    ("bronze.plants", "silver.stg_power_plants", "canonical_mapping + quality_validation + normalization + upsert"),
    ("silver.stg_power_plants", "gold.dim_plant", "dimension_projection"),
    ("silver.stg_power_plants", "gold.dim_country", "distinct_country"),
    ("silver.stg_power_plants", "gold.dim_fuel_type", "distinct_fuel + renewable_flag"),
    ("silver.stg_power_plants", "gold.dim_time", "execution_time_dimension"),
    ("silver.stg_power_plants", "gold.fact_plant_capacity", "aggregate_capacity_by_country_fuel"),
    ("silver.stg_power_plants", "gold.fact_power_generation", "aggregate_generation_by_country_fuel_year"),
    ("silver.stg_power_plants", "gold.fact_power_generation_time", "aggregate_generation_by_year_month"),
    ("silver.stg_power_plants", "gold.fact_capacity_geo", "aggregate_capacity_by_continent_sub_region"),
)


def lineage(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Edges between the data sets with the rows seen at their ends."""
    spark = next(iter(frames.values())).sparkSession
    edges = spark.createDataFrame(LINEAGE, "from_dataset string, to_dataset string, transformation string")
    sizes = reduce(
        DataFrame.unionByName,
        [f.agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n, f in frames.items()],
    )
    size_map = sizes.select(F.map_from_entries(F.collect_list(F.struct("dataset", "rows")))).scalar()
    return edges.withColumn("_sizes", size_map).select(
        "from_dataset",
        "to_dataset",
        "transformation",
        F.element_at("_sizes", F.col("from_dataset")).alias("from_rows"),
        F.element_at("_sizes", F.col("to_dataset")).alias("to_rows"),
    )


def aggregation_report(capacity: DataFrame, by_time: DataFrame, by_region: DataFrame) -> DataFrame:
    parts = (
        ("capacity_aggregation", capacity, ("country", "primary_fuel")),
        ("time_based_aggregation", by_time, ("event_year", "event_month")),
        ("geo_based_aggregation", by_region, ("continent", "sub_region")),
    )
    rows = [
        facts.agg(F.count("*").alias("output_rows")).select(
            F.lit(name).alias("aggregation"),
            F.lit(True).alias("applied"),
            "output_rows",
            F.lit("silver.stg_power_plants").alias("source"),
            F.array(*map(F.lit, keys)).alias("group_by"),
        )
        for name, facts, keys in parts
    ]
    return reduce(DataFrame.unionByName, rows)


# --- contract models ----------------------------------------------------------------


def staging_model(silver: DataFrame) -> DataFrame:
    masked = owner_prefix_mask(F.col("owner")).alias("owner_masked")
    return silver.select(*PLANT_COLUMNS, masked, "event_year", "event_month")


def capacity_model(capacity: DataFrame) -> DataFrame:
    return capacity.select("country", "primary_fuel", "total_capacity_mw", "renewable_capacity_mw")


def generation_model(generation: DataFrame) -> DataFrame:
    return generation.select("country", "primary_fuel", "year", "total_generation_gwh")


# --- chart data -----------------------------------------------------------------------


def top_capacity(capacity: DataFrame, by: str, n: int = 10) -> DataFrame:
    """The n greatest groups; equal totals are ordered by name."""
    return (
        capacity.groupBy(by)
        .agg(total(F.col("total_capacity_mw")).alias("total_capacity_mw"))
        .orderBy(F.col("total_capacity_mw").desc(), F.col(by).asc_nulls_last())
        .limit(n)
    )


def generation_trend(generation: DataFrame) -> DataFrame:
    return annual_generation_trends(generation)


def chart_manifest(charts: Mapping[str, DataFrame]) -> DataFrame:
    """Names of the charts that have data, and how many they are."""
    seen = [
        f.agg(F.count("*").alias("points")).select(F.lit(n).alias("chart"), "points") for n, f in charts.items()
    ]
    drawn = reduce(DataFrame.unionByName, seen).filter(F.col("points") > 0)
    return drawn.agg(
        F.array_join(F.array_sort(F.collect_list("chart")), ",").alias("visualizations"), F.count("*").alias("count")
    )
