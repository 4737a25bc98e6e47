"""Power generation views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.numbers import ratio, total, whole_year_text
from wattlake.operators.ranking import ranked
from wattlake.plans.views.common import (
    Tables,
    known,
    other_part,
    renewable_part,
    texts,
    values,
    with_fuel_flag,
)


def country_capacity(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["fact_plant_capacity"].filter(texts("country") & values("total_capacity_mw", "renewable_capacity_mw"))
    all_mw, renewable_mw = total(F.col("total_capacity_mw")), total(F.col("renewable_capacity_mw"))
    return rows.groupBy("country").agg(
        all_mw.alias("total_capacity_mw"),
        renewable_mw.alias("renewable_capacity_mw"),
        (all_mw - renewable_mw).alias("non_renewable_capacity_mw"),
    )


def fuel_distribution(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["fact_power_generation"].filter(
        texts("country", "primary_fuel") & known("country", "primary_fuel") & values("total_generation_gwh")
    )
    return rows.groupBy("country", "primary_fuel").agg(total(F.col("total_generation_gwh")).alias("total_generation_gwh"))


def renewable_trend(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = with_fuel_flag(
        t, t["fact_power_generation"].filter(values("year", "total_generation_gwh") & texts("country", "primary_fuel"))
    )
    gwh = "total_generation_gwh"
    return rows.groupBy(whole_year_text(F.col("year")).alias("year"), "country").agg(
        renewable_part(gwh).alias("renewable_generation_gwh"),
        other_part(gwh).alias("non_renewable_generation_gwh"),
        ratio(renewable_part(gwh), total(F.col(gwh))).alias("renewable_generation_ratio"),
    )


def global_fuel_dominance(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Share of every fuel.

    The grand total is a scalar subquery over the per-fuel rows: no join, and both
    read the same shuffle. The rank is over one row per fuel, by ranges of the totals.
    """
    rows = t["fact_power_generation"].filter(
        texts("primary_fuel") & known("primary_fuel") & values("total_generation_gwh")
    )
    by_fuel = rows.groupBy("primary_fuel").agg(total(F.col("total_generation_gwh")).alias("total_generation_gwh"))
    everything = by_fuel.select(total(F.col("total_generation_gwh"))).scalar()
    shares = by_fuel.select(
        "primary_fuel",
        "total_generation_gwh",
        ratio(F.col("total_generation_gwh"), everything).alias("fuel_share_ratio"),
    )
    return ranked(shares, "total_generation_gwh", out="fuel_rank")


def annual_generation_trends(t: Tables, as_of: Column | None = None) -> DataFrame:
    rows = t["fact_power_generation"].filter(values("year", "total_generation_gwh"))
    return rows.groupBy(whole_year_text(F.col("year")).alias("year")).agg(
        total(F.col("total_generation_gwh")).alias("total_generation_gwh")
    )


def kpi_summary(t: Tables, as_of: Column | None = None) -> DataFrame:
    mean = t["dim_plant"].filter(values("capacity_mw")).select(F.coalesce(F.avg(F.col("capacity_mw")), F.lit(0.0))).scalar()
    totals = t["fact_plant_capacity"].agg(
        total(F.col("total_capacity_mw")).alias("total_generation_capacity_mw"),
        total(F.col("renewable_capacity_mw")).alias("_renewable"),
    )
    return totals.select(
        "total_generation_capacity_mw",
        ratio(F.col("_renewable"), F.col("total_generation_capacity_mw")).alias("renewable_energy_ratio"),
        mean.alias("average_plant_capacity_mw"),
    )
