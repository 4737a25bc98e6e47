"""Row filters and measures the views share."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.constants import GWH_PER_MW_YEAR, PLACEHOLDERS
from wattlake.functions.numbers import total
from wattlake.functions.text import has_text, is_placeholder

Tables = Mapping[str, DataFrame]

NOTHING_KNOWN = [p for p in PLACEHOLDERS if p]


def all_of(*tests: Column) -> Column:
    return reduce(lambda a, b: a & b, tests)


def texts(*names: str) -> Column:
    """Every named column holds text that is not blank."""
    return all_of(*[has_text(F.col(n)) for n in names])


def values(*names: str) -> Column:
    """No named column is null."""
    return all_of(*[F.col(n).isNotNull() for n in names])


def known(*names: str) -> Column:
    """No named column holds a placeholder."""
    return all_of(*[~is_placeholder(F.col(n).cast("string"), NOTHING_KNOWN) for n in names])


def theoretical_gwh(capacity: Column) -> Column:
    return capacity * GWH_PER_MW_YEAR


def utilisation(generation: Column, capacity: Column) -> Column:
    """Share of what the capacity could generate; 0 where there is no capacity."""
    return F.when(capacity <= 0, F.lit(0.0)).otherwise(generation / theoretical_gwh(capacity))


def renewable_part(measure: str, flag: str = "is_renewable") -> Column:
    """Sum of the measure over rows whose fuel is renewable; an unknown fuel is not."""
    return total(F.when(F.coalesce(F.col(flag), F.lit(False)), F.col(measure)).otherwise(F.lit(0.0)))


def other_part(measure: str, flag: str = "is_renewable") -> Column:
    return total(F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col(measure)).otherwise(F.lit(0.0)))


def with_fuel_flag(t: Tables, facts: DataFrame) -> DataFrame:
    """Facts with the flag of their fuel. Where tables are built on demand, that needs no numbered dimension."""
    on_demand = "dim_fuel_type" not in t and "fuel_flags" in getattr(t, "builders", ())
    flags = t["fuel_flags" if on_demand else "dim_fuel_type"].select("primary_fuel", "is_renewable")
    return facts.join(flags, "primary_fuel", "left")
