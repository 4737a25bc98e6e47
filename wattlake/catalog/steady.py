"""Doubles as the checks compare them.

Sums of doubles depend on the order of addition in their last digits. Operators give them as they are; the registered
queries and their SQL both round the finished result, to nine significant digits (differences, which may cancel, to
three decimals), so that equal results compare equal at any size of the values. Values that are decimal numbers may end
just between two rounded ones; a shift far above the noise and far below the last digit decides them alike on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Query -> columns that are, or come from, sums of doubles.
SUMS: dict[str, tuple[str, ...]] = {
    "vg_01_country_capacity": ("total_capacity_mw", "renewable_capacity_mw", "non_renewable_capacity_mw"),
    "vg_02_fuel_distribution": ("total_generation_gwh",),
    "vg_03_renewable_trend": ("renewable_generation_gwh", "non_renewable_generation_gwh", "renewable_generation_ratio"),
    "vg_04_global_fuel_dominance": ("total_generation_gwh", "fuel_share_ratio"),
    "vg_05_annual_generation_trends": ("total_generation_gwh",),
    "vg_06_kpi_summary": ("total_generation_capacity_mw", "renewable_energy_ratio", "average_plant_capacity_mw"),
    "vp_03_capacity_utilization": ("total_capacity_mw", "total_generation_gwh", "theoretical_max_generation_gwh", "utilization_ratio"),
    "vs_02_country_distribution": ("total_capacity_mw", "avg_capacity_mw"),
    "vs_03_regional_density": ("total_capacity_mw",),
    "vs_03_regional_density_fallback": ("total_capacity_mw",),
    "vs_04_coal_dependency": ("coal_capacity_mw", "total_capacity_mw", "coal_capacity_ratio"),
    "vs_05_coal_dependency_by_country": ("coal_generation_gwh", "total_generation_gwh", "coal_dependency_ratio"),
    "vs_06_clean_energy_growth": ("renewable_generation_gwh", "non_renewable_generation_gwh"),
    "vx_01_plant_distribution_by_country": ("total_capacity_mw", "avg_capacity_mw"),
    "vx_02_plant_distribution_by_region": ("total_capacity_mw",),
    "vx_03_generation_density": ("total_capacity_mw", "total_generation_gwh", "generation_per_plant_gwh"),
    "vx_03_generation_density_no_fanout": ("total_capacity_mw", "total_generation_gwh", "generation_per_plant_gwh"),
    "vx_05_country_infrastructure_density": ("total_capacity_mw", "plants_per_1000_mw"),
    "gld_05_fact_plant_capacity": ("total_capacity_mw", "renewable_capacity_mw"),
    "gld_05_incremental_capacity": ("total_capacity_mw", "renewable_capacity_mw"),
    "gld_06_fact_power_generation": ("total_generation_gwh",),
    "gld_06_incremental_generation": ("total_generation_gwh",),
    "gld_07_fact_power_generation_time": ("total_generation_gwh",),
    "gld_08_fact_capacity_geo": ("total_capacity_mw",),
    "gld_10_kpi_report": ("total_generation_capacity_mw", "renewable_energy_ratio", "average_plant_capacity_mw"),
    "gld_11_country_fuel_distribution": ("total_generation_gwh",),
    "gld_12_annual_generation_trends": ("total_generation_gwh",),
    "gld_15_capacity_model": ("total_capacity_mw", "renewable_capacity_mw"),
    "gld_15_generation_model": ("total_generation_gwh",),
    "viz_01_top_countries": ("total_capacity_mw",),
    "viz_02_top_fuels": ("total_capacity_mw",),
    "viz_03_generation_trend": ("total_generation_gwh",),
    "vg_01_country_capacity_unfiltered": ("total_capacity_mw", "renewable_capacity_mw", "non_renewable_capacity_mw"),
    "vg_02_fuel_distribution_unfiltered": ("total_generation_gwh",),
    "vg_03_renewable_trend_unfiltered": ("renewable_generation_gwh", "non_renewable_generation_gwh", "renewable_generation_ratio"),
    "vs_08_renewable_adoption_trend": ("renewable_generation_gwh", "total_generation_gwh", "renewable_adoption_ratio"),
    "vs_07_clean_energy_growth_yearly": ("renewable_generation_gwh", "renewable_generation_growth_gwh"),
    "vp_02_aging_infrastructure_unfiltered": ("avg_commissioning_year",),
    "vp_03_capacity_utilization_unfiltered": ("total_capacity_mw", "total_generation_gwh", "theoretical_max_generation_gwh", "utilization_ratio"),
    "vx_01_plant_distribution_unfiltered": ("total_capacity_mw", "avg_capacity_mw"),
    "vx_03_generation_density_unfiltered": ("total_capacity_mw", "total_generation_gwh", "generation_per_plant_gwh"),
    "alr_01_dq_failures": ("metric_value",),
    "alr_03_no_ingest": ("metric_value",),
    "str_04_windowed_alerts": ("metric_value",),
    "str_04_missing_windows": ("metric_value",),
}
DIFFERENCES = frozenset({"non_renewable_capacity_mw", "renewable_generation_growth_gwh"})


def _steady(name: str) -> Column:
    c = F.col(name)
    if name in DIFFERENCES:
        return F.round(c + 1e-7, 3)
    return F.when(c.isNotNull(), F.format_string("%.8e", c * (1 + 3e-12)).cast("double"))


def steady_rows(df: DataFrame, name: str) -> DataFrame:
    return df.withColumns({c: _steady(c) for c in SUMS.get(name, ())})


def steady_sql(sql: str, name: str) -> str:
    if name not in SUMS:
        return sql
    rounded = [f"round({c} + 1e-7::DOUBLE, 3) AS {c}" if c in DIFFERENCES else f"CAST(printf('%.8e', {c} * (1 + 3e-12::DOUBLE)) AS DOUBLE) AS {c}" for c in SUMS[name]]
    return f"SELECT * REPLACE ({', '.join(rounded)}) FROM ({sql})"
