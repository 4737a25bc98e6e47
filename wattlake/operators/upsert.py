"""Latest record per key, within a batch and against the current table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.operators.conform import null_placeholders


def latest_per_key(df: DataFrame, key: str | Iterable[str], order: Iterable[str], nulls_win: bool = False) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by the other columns.

    An aggregate, not a window: each task first reduces its own rows, so a key
    that holds a large part of the table never gathers in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order)
    others = sorted(c for c in df.columns if c not in keys and c not in order)
    fields = []
    for c in order:
        if nulls_win:  # null sorts lowest in a struct; the flag in front turns that round
            fields.append(F.col(c).isNull().alias(f"_{c}_is_null"))
        fields.append(F.col(c))
    picked = df.groupBy(*keys).agg(F.max(F.struct(*fields, *others)).alias("_best"))
    return picked.select(*[c if c in keys else f"_best.{c}" for c in df.columns])


def upsert(
    current: DataFrame | None,
    batch: DataFrame,
    key: str = "plant_id",
    order: tuple[str, ...] = ("event_time", "ingested_at"),
    nulls_win: bool = False,
) -> DataFrame:
    """The current table with a batch merged in; the batch wins where the times are equal."""
    both = batch.withColumn("_batch", F.lit(1))
    if current is not None:
        old = null_placeholders(current).withColumn("_batch", F.lit(0))
        both = old.unionByName(both, allowMissingColumns=True)
    present = [c for c in order if c in both.columns]
    return latest_per_key(both, key, [*present, "_batch"], nulls_win).drop("_batch")


def add_to_quarantine(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second, allowMissingColumns=True)
