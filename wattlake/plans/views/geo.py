"""Geographic views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numbers import ratio, total
from wattlake.plans.views import sustain
from wattlake.plans.views.common import Tables, texts, values


def plant_distribution_by_country(t: Tables, as_of: Column | None = None) -> DataFrame:
    return sustain._per_country(t["dim_plant"])


def plant_distribution_by_region(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["stg_power_plants"].filter(texts("continent", "sub_region") & values("capacity_mw"))
    return rows.groupBy("continent", "sub_region").agg(
        F.count("*").alias("plant_count"), total(F.col("capacity_mw")).alias("total_capacity_mw")
    )


def _complete_plants(t: Tables) -> DataFrame:
    return t["dim_plant"].filter(texts("country", "plant_id", "primary_fuel") & values("capacity_mw"))


def _density(per_plant: DataFrame, how: str, facts: DataFrame) -> DataFrame:
    """Totals of plants joined to their facts, every plant once per fact of its country and fuel.

    Joining plant rows to fact rows multiplies both. The same totals come from
    one row per pair: capacity counts once per fact, generation once per plant
    row, so what is joined stays as small as the aggregates.
    """
    joined = per_plant.join(facts, ["country", "primary_fuel"], how)
    matches = F.coalesce("_facts", F.lit(1)) if how == "left" else F.col("_facts")
    plants = F.count_distinct("plant_id")
    generation = total(F.col("_generation") * F.col("_rows"))
    return joined.groupBy("country").agg(
        plants.alias("plant_count"),
        total(F.col("_capacity") * matches).alias("total_capacity_mw"),
        generation.alias("total_generation_gwh"),
        ratio(generation, plants).alias("generation_per_plant_gwh"),
    )


def _per_plant(plants: DataFrame) -> DataFrame:
    return plants.groupBy("country", "primary_fuel", "plant_id").agg(
        F.count("*").alias("_rows"), total(F.col("capacity_mw")).alias("_capacity")
    )


def _per_pair(facts: DataFrame) -> DataFrame:
    return facts.groupBy("country", "primary_fuel").agg(
        F.count("*").alias("_facts"), total(F.col("total_generation_gwh")).alias("_generation")
    )


def generation_density(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Counts a plant's capacity once for every year of facts, as dashboards built on it expect."""
    facts = _per_pair(t["fact_power_generation"].filter(values("total_generation_gwh")))
    return _density(_per_plant(_complete_plants(t)), "inner", facts)


def generation_density_no_fanout(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Every plant's capacity and every fact once."""
    facts = _per_pair(t["fact_power_generation"].filter(values("total_generation_gwh")))
    plants = _complete_plants(t).join(facts.select("country", "primary_fuel"), ["country", "primary_fuel"], "left_semi")
    per_country = plants.groupBy("country").agg(
        F.count_distinct("plant_id").alias("plant_count"), total(F.col("capacity_mw")).alias("total_capacity_mw")
    )
    pairs = plants.select("country", "primary_fuel").distinct()
    generated = (
        facts.join(pairs, ["country", "primary_fuel"], "left_semi")
        .groupBy("country")
        .agg(total(F.col("_generation")).alias("total_generation_gwh"))
    )
    return per_country.join(generated, "country").withColumn(
        "generation_per_plant_gwh", ratio(F.col("total_generation_gwh"), F.col("plant_count"))
    )


def heatmap_points(t: Tables, as_of: Column | None = None) -> DataFrame:
    return sustain.heatmap(t)


def country_infrastructure_density(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["stg_power_plants"].filter(texts("country") & values("capacity_mw"))
    capacity = total(F.col("capacity_mw"))
    return rows.groupBy("country").agg(
        F.count("*").alias("plant_count"),
        capacity.alias("total_capacity_mw"),
        ratio(F.count("*").cast("double"), capacity / 1000.0).alias("plants_per_1000_mw"),
    )
