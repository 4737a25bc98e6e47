"""Names, text, numbers, units, countries, fuels and regions brought to one form."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.constants import (
    COUNTRY_ALIASES,
    COUNTRY_REGIONS,
    FUEL_ALIASES,
    OTHER_REGION,
    RAW_NUMERIC_COLUMNS,
    RENEWABLE_FUELS,
    TEXT_COLUMNS,
    YEARLY_GENERATION_PREFIX,
)
from wattlake.functions.numbers import to_double
from wattlake.functions.text import canonical, empty_to_null, lookup, placeholder_to_null, strip
from wattlake.functions.times import parse_iso


def column_name(raw: str) -> str:
    return re.sub("[^a-z0-9]+", "_", raw.strip().lower()).strip("_")


def conform_names(df: DataFrame) -> DataFrame:
    names = [column_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns get the same name: {clashes}")
    return df.toDF(*names)


def trim_text(df: DataFrame) -> DataFrame:
    """Trim every text column; empty becomes null."""
    return df.withColumns({c: empty_to_null(F.col(c)) for c, t in df.dtypes if t == "string"})


def coerce_numbers(df: DataFrame, columns: Iterable[str] = RAW_NUMERIC_COLUMNS) -> DataFrame:
    """Named columns and all yearly generation columns as doubles; bad values become null."""
    wanted = set(columns)
    chosen = [c for c in df.columns if c in wanted or c.startswith(YEARLY_GENERATION_PREFIX)]
    return df.withColumns({c: to_double(F.col(c)) for c in chosen})


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Canonical column -> names other feeds use for it, best first. Fixed values.
OTHER_NAMES = {"plant_id": ("gppd_idnr", "wepp_id"), "plant_name": ("name",)}


def canonical_columns(df: DataFrame) -> DataFrame:
    """Fill the canonical columns of one feed from the other names it may use, row by row."""
    yearly = sorted((c for c in df.columns if c.startswith(YEARLY_GENERATION_PREFIX)), reverse=True)
    names = OTHER_NAMES | {"estimated_generation_gwh": tuple(yearly)}
    filled = {}
    for column, others in names.items():
        known = [c for c in (column, *others) if c in df.columns]
        if known and known != [column]:
            filled[column] = latest_known(known)
    if {"country", "country_long"} <= set(df.columns):
        filled["country"] = country_from_code(F.col("country"), F.col("country_long"))
    return df.withColumns(filled)


def country_from_code(country: Column, long_name: Column) -> Column:
    return F.when(F.length(country) == 3, long_name).otherwise(country)


def latest_known(newest_first: Iterable[str]) -> Column:
    return F.coalesce(*[F.col(c) for c in newest_first])


def null_placeholders(df: DataFrame, columns: Iterable[str] = TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: placeholder_to_null(F.col(c).cast("string")) for c in columns if c in df.columns})


def capacity_in_mw(capacity: Column, unit: Column) -> Column:
    unit = strip(F.lower(unit))
    return F.when(unit == "kw", capacity / 1000.0).when(unit == "gw", capacity * 1000.0).otherwise(capacity)


def standardise_units(df: DataFrame) -> DataFrame:
    """Capacity in MW from whichever of the unit, kW and GW columns are there."""
    have = set(df.columns)
    candidates = []
    if "capacity_mw" in have:
        mw = to_double(F.col("capacity_mw"))
        candidates.append(capacity_in_mw(mw, F.col("capacity_unit")) if "capacity_unit" in have else mw)
    if "capacity_kw" in have:
        candidates.append(to_double(F.col("capacity_kw")) / 1000.0)
    if "capacity_gw" in have:
        candidates.append(to_double(F.col("capacity_gw")) * 1000.0)
    return df.withColumn("capacity_mw", F.coalesce(*candidates)) if candidates else df


def canonical_country(country: Column) -> Column:
    return canonical(country, COUNTRY_ALIASES)


def canonical_fuel(fuel: Column) -> Column:
    return canonical(fuel, FUEL_ALIASES)


def normalise_country_and_fuel(df: DataFrame) -> DataFrame:
    """Canonical values beside the raw ones, which the change counts need."""
    return df.withColumns({"raw_country": F.col("country"), "raw_fuel": F.col("primary_fuel")}).withColumns(
        {"country": canonical_country(F.col("country")), "primary_fuel": canonical_fuel(F.col("primary_fuel"))}
    )


def changed_by_normalising(df: DataFrame) -> DataFrame:
    """How many countries and fuels changed; a null on either side does not count."""
    return df.agg(
        F.count_if(F.col("raw_country") != F.col("country")).alias("country_name_normalized_rows"),
        F.count_if(F.col("raw_fuel") != F.col("primary_fuel")).alias("fuel_type_standardized_rows"),
    )


def enrich_geography(df: DataFrame) -> DataFrame:
    """Continent and sub-region of the known countries. The list is fixed and short, so no join."""
    continents = {k: v[0] for k, v in COUNTRY_REGIONS.items()}
    sub_regions = {k: v[1] for k, v in COUNTRY_REGIONS.items()}
    other = F.lit(OTHER_REGION)
    return df.withColumns(
        {
            "continent": F.coalesce(lookup(continents, F.col("country")), other),
            "sub_region": F.coalesce(lookup(sub_regions, F.col("country")), other),
        }
    )


def event_period(df: DataFrame, run_year: int) -> DataFrame:
    """Year and month of the event, or of the last update where the feed has no event time."""
    if "event_time" in df.columns:
        time = F.col("event_time").cast("timestamp_ntz")
    elif "last_updated_at" in df.columns:
        time = parse_iso(F.col("last_updated_at"))
    else:
        time = F.lit(None).cast("timestamp_ntz")
    return df.withColumns(
        {
            "event_year": F.coalesce(F.year(time), F.lit(run_year)).cast("bigint"),
            "event_month": F.coalesce(F.month(time), F.lit(1)).cast("bigint"),
        }
    )


def is_renewable(fuel: Column) -> Column:
    """Null fuel is not renewable."""
    return F.coalesce(fuel.isin(*RENEWABLE_FUELS), F.lit(False))


def conform(df: DataFrame) -> DataFrame:
    """All steps from canonical raw columns to a conformed batch."""
    df = standardise_units(null_placeholders(df))
    return enrich_geography(normalise_country_and_fuel(df))
