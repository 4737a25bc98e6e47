"""Sustainability views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numbers import ratio, total, whole_year_text
from wattlake.plans.views.common import (
    Tables,
    other_part,
    renewable_part,
    texts,
    values,
    with_fuel_flag,
)


def heatmap(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["dim_plant"].filter(
        texts("plant_id", "plant_name", "country", "primary_fuel") & values("latitude", "longitude", "capacity_mw")
    )
    return rows.select("plant_id", "plant_name", "country", "latitude", "longitude", "capacity_mw", "primary_fuel")


def _per_country(plants: DataFrame) -> DataFrame:
    return plants.filter(texts("country") & values("capacity_mw")).groupBy("country").agg(
        F.count("*").alias("plant_count"),
        total(F.col("capacity_mw")).alias("total_capacity_mw"),
        F.avg(F.col("capacity_mw")).alias("avg_capacity_mw"),
    )


def country_distribution(t: Tables, as_of: Column | None = None) -> DataFrame:
    return _per_country(t["dim_plant"])


def regional_density(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Capacity per region; per country instead when no region is known at all."""
    regions = (
        t["fact_capacity_geo"]
        .filter(texts("continent", "sub_region") & values("total_capacity_mw"))
        .groupBy("continent", "sub_region")
        .agg(total(F.col("total_capacity_mw")).alias("total_capacity_mw"))
    )
    countries = _per_country(t["dim_plant"]).select(
        F.lit("Fallback").alias("continent"), F.col("country").alias("sub_region"), "total_capacity_mw"
    )
    return regions.unionByName(countries.filter(~regions.exists()))


def coal_dependency(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["stg_power_plants"].filter(texts("continent", "sub_region", "primary_fuel") & values("capacity_mw"))
    coal = total(F.when(F.lower("primary_fuel") == "coal", F.col("capacity_mw")).otherwise(F.lit(0.0)))
    everything = total(F.col("capacity_mw"))
    return rows.groupBy("continent", "sub_region").agg(
        coal.alias("coal_capacity_mw"),
        everything.alias("total_capacity_mw"),
        ratio(coal, everything).alias("coal_capacity_ratio"),
    )


def coal_dependency_by_country(t: Tables, as_of: Column | None = None) -> DataFrame:
    """On generation instead of capacity, without row filters."""
    coal = total(F.when(F.lower("primary_fuel") == "coal", F.col("total_generation_gwh")).otherwise(F.lit(0.0)))
    everything = total(F.col("total_generation_gwh"))
    return t["fact_power_generation"].groupBy("country").agg(
        coal.alias("coal_generation_gwh"),
        everything.alias("total_generation_gwh"),
        ratio(coal, everything).alias("coal_dependency_ratio"),
    )


def clean_energy_growth(t: Tables, as_of: Column | None = None) -> DataFrame:
    region_of = (
        t["stg_power_plants"]
        .filter(texts("country", "continent", "sub_region"))
        .groupBy("country")
        .agg(F.max("continent").alias("continent"), F.max("sub_region").alias("sub_region"))
    )
    facts = t["fact_power_generation"].filter(
        values("year", "total_generation_gwh") & texts("country", "primary_fuel")
    )
    rows = with_fuel_flag(t, facts).join(region_of, "country")
    return rows.groupBy(whole_year_text(F.col("year")).alias("year"), "continent", "sub_region", "country").agg(
        renewable_part("total_generation_gwh").alias("renewable_generation_gwh"),
        other_part("total_generation_gwh").alias("non_renewable_generation_gwh"),
    )
