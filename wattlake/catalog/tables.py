"""Tables the queries share, built lazily from the given ones."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.times import at
from wattlake.operators import ingest, quality
from wattlake.plans.medallion import Layers, conformed_batch, layers
from wattlake.sources import bindings

RUN_YEAR = 2001


def as_of():
    return at(bindings.AS_OF)


@lru_cache(maxsize=4)
def tables(spark: SparkSession, sf_dir: str) -> Layers:
    """Every layer of a run over the raw plants. Kept are the plans, never rows."""
    return layers(bindings.plants_raw(spark, sf_dir), as_of(), RUN_YEAR)


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir)["batch"]


def monthly_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality report of every month of readings: each month is one run."""
    rows = conformed_batch(bindings.readings(spark, sf_dir)).withColumn("run", bindings.run_month())
    counts = quality.batch_counts(rows, by=["run"])
    return quality.quality_report(counts, F.col("run"), F.lit("readings"))


def quality_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly reports as the audit table keeps them: all text."""
    from wattlake.functions.times import iso_text

    report = monthly_quality(spark, sf_dir)
    report = report.withColumn("run_timestamp", iso_text(F.col("run_timestamp")))
    return report.select([F.col(c).cast("string").alias(c) for c in report.columns])


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = bindings.ingest_registry(spark, sf_dir)
    state = bindings.source_state(spark, sf_dir)
    outcomes = bindings.source_outcomes(spark, sf_dir)
    return ingest.freshness_report(registry, state, outcomes, as_of())


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome rows of every source, with the volume checked against a first delivery month."""
    rows = bindings.source_outcomes(spark, sf_dir)
    moved = F.col("status") == "ingested"
    zero = F.lit(0).cast("long")
    shaped = rows.select(
        "source_name",
        "status",
        F.when(moved, F.col("rows")).otherwise(zero).alias("rows"),
        F.when(moved, F.col("rows")).otherwise(zero).alias("changed_rows"),
        F.when(moved, F.col("late_arriving_rows")).otherwise(zero).alias("late_arriving_rows"),
        F.when(moved, F.col("accepted")).alias("_current"),
        F.when(moved, F.col("returned")).alias("_previous"),
    )
    checked = ingest.volume_change(shaped, F.col("_current"), F.col("_previous"), spike=1.05, drop=0.95)
    return checked.drop("_current", "_previous")
