"""Plant operations views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.constants import UNDERUTILISED_BELOW
from wattlake.functions.numbers import to_double, whole_year_text
from wattlake.plans.views.common import Tables, texts, theoretical_gwh, utilisation, values


def _or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("Unknown")).alias(name)


def largest_plants(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Complete plant rows; the reader orders by capacity and takes as many as it shows."""
    rows = t["dim_plant"].filter(
        texts("plant_id", "plant_name", "country", "primary_fuel")
        & values("capacity_mw", "commissioning_year", "latitude", "longitude")
    )
    return rows.select(
        *[F.col(c).cast("string").alias(c) for c in ("plant_id", "plant_name", "country", "primary_fuel")],
        F.col("capacity_mw").cast("double").alias("capacity_mw"),
        whole_year_text(F.col("commissioning_year")).alias("commissioning_year"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )


def _aging(rows: DataFrame, by: tuple[str, ...], as_of: Column) -> DataFrame:
    year = to_double(F.col("commissioning_year"))
    older_than = lambda years: F.count_if(F.col("commissioning_year") < F.year(as_of) - years)
    return rows.groupBy(*by).agg(
        F.count("*").alias("plant_count"),
        F.round(F.avg(year)).cast("int").alias("avg_commissioning_year"),
        older_than(30).alias("aging_30_plus_count"),
        older_than(40).alias("aging_40_plus_count"),
    )


def aging_infrastructure(t: Tables, as_of: Column) -> DataFrame:
    rows = t["dim_plant"].filter(texts("country", "primary_fuel") & values("commissioning_year"))
    return _aging(rows, ("country", "primary_fuel"), as_of)


def aging_by_region(t: Tables, as_of: Column) -> DataFrame:
    rows = t["stg_power_plants"].filter(texts("continent", "sub_region") & values("commissioning_year"))
    return _aging(rows, ("continent", "sub_region"), as_of)


def capacity_utilization(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Both sides are one row per key before they meet, so the join cannot fan out."""
    generated = (
        t["fact_power_generation"]
        .filter(values("year") & texts("country", "primary_fuel"))
        .groupBy("country", "primary_fuel", "year")
        .agg(F.sum(F.col("total_generation_gwh")).alias("total_generation_gwh"))
    )
    installed = (
        t["fact_plant_capacity"]
        .filter(texts("country", "primary_fuel"))
        .groupBy("country", "primary_fuel")
        .agg(F.sum(F.col("total_capacity_mw")).alias("total_capacity_mw"))
    )
    both = generated.join(installed, ["country", "primary_fuel"]).filter(values("total_generation_gwh", "total_capacity_mw"))
    return both.select(
        whole_year_text(F.col("year")).alias("year"),
        "country",
        "primary_fuel",
        "total_capacity_mw",
        "total_generation_gwh",
        theoretical_gwh(F.col("total_capacity_mw")).alias("theoretical_max_generation_gwh"),
        utilisation(F.col("total_generation_gwh"), F.col("total_capacity_mw")).alias("utilization_ratio"),
    )


def underutilized_plants(t: Tables, as_of: Column | None = None) -> DataFrame:
    capacity, generation = F.col("capacity_mw"), F.col("estimated_generation_gwh")
    share = utilisation(generation, capacity)
    rows = t["stg_power_plants"].filter(
        values("capacity_mw", "estimated_generation_gwh") & (capacity > 0) & (share < UNDERUTILISED_BELOW)
    )
    return rows.select(
        *[_or_unknown(c) for c in ("plant_id", "plant_name", "country", "primary_fuel")],
        capacity.cast("double").alias("capacity_mw"),
        generation.cast("double").alias("estimated_generation_gwh"),
        theoretical_gwh(capacity).alias("theoretical_generation_gwh"),
        share.alias("utilization_ratio"),
    )
