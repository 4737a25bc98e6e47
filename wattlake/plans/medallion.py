"""The three layers as one set of lazy tables over a raw plant feed."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.times import iso_text
from wattlake.operators import gold, quality
from wattlake.operators.conform import canonical_columns, coerce_numbers, conform, conform_names, event_period, trim_text, union_by_name
from wattlake.operators.upsert import add_to_quarantine, upsert


def clean_feed(raw: DataFrame) -> DataFrame:
    """Names, text and numbers of one feed; what it calls otherwise gets its canonical name before feeds are unioned."""
    return canonical_columns(coerce_numbers(trim_text(conform_names(raw))))


def conformed_batch(*raw: DataFrame) -> DataFrame:
    """One batch of any number of feeds."""
    return conform(quality.require_columns(union_by_name(map(clean_feed, raw))))


def _merged(batch: DataFrame, current: DataFrame | None) -> DataFrame:
    return upsert(current, quality.good_rows(batch).drop("raw_country", "raw_fuel"))


def silver_rows(batch: DataFrame, current: DataFrame | None, run_year: int) -> DataFrame:
    """Good rows of a conformed batch merged into the current table.

    The gate runs again after the merge, so that rows an older rule let in do
    not stay.
    """
    merged = _merged(batch, current)
    if current is not None:
        merged = quality.good_rows(merged)
    return event_period(merged, run_year)


def quarantine_rows(batch: DataFrame, current: DataFrame | None) -> DataFrame:
    """Malformed rows of the batch, and of the merged table when there was one before."""
    malformed = quality.malformed_rows(batch)
    if current is not None:
        malformed = add_to_quarantine(malformed, quality.malformed_rows(_merged(batch, current)))
    return malformed


#: Dimensions that are written when they are built, to be numbered; they are built anew whenever they are asked for.
NUMBERED = frozenset({"dim_country", "dim_fuel_type"})


class Layers(dict):
    """Tables by name, each built when first asked for. Kept are plans, never rows."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]], **ready: DataFrame):
        super().__init__(ready)
        self.builders = builders

    def __missing__(self, name: str) -> DataFrame:
        if name in NUMBERED:
            return self.builders[name]()
        self[name] = self.builders[name]()
        return self[name]

    def but(self, **other: DataFrame) -> Layers:
        """The same tables with some replaced."""
        return Layers(self.builders, **{**self, **other})


GOLD_TABLES = {
    "dim_plant": gold.dim_plant,
    "dim_country": gold.dim_country,
    "dim_fuel_type": gold.dim_fuel_type,
    "fuel_flags": gold.fuel_flags,
    "fact_plant_capacity": gold.fact_plant_capacity,
    "fact_power_generation": gold.fact_power_generation,
    "fact_power_generation_time": gold.fact_power_generation_time,
    "fact_capacity_geo": gold.fact_capacity_geo,
}


def gold_layer(silver: DataFrame, run_date: Column) -> Layers:
    builders: dict[str, Callable[[], DataFrame]] = {n: partial(build, silver) for n, build in GOLD_TABLES.items()}
    builders["dim_time"] = lambda: gold.dim_time(silver.sparkSession, run_date)
    return Layers(builders, stg_power_plants=silver)


def layers(raw: DataFrame, run_date: Column, run_year: int, source_name: str = "plants") -> Layers:
    """All tables of a first run over a raw feed, nothing written."""
    if "ingested_at" not in raw.columns:
        raw = raw.withColumn("ingested_at", iso_text(F.coalesce("event_time", run_date)))
    batch = conformed_batch(raw.withColumn("source_name", F.lit(source_name)))
    tables = gold_layer(silver_rows(batch, None, run_year), run_date)
    tables.builders["quarantine"] = lambda: quarantine_rows(batch, None)
    return tables.but(batch=batch)
