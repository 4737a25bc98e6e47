"""Domain tables made from the star-schema tables the queries are given.

Plants are customers with their nation and region, generation is what they
ordered, the metrics log is the event log, and a run is a month of orders. The
recoding puts dirty text and out-of-range values into known rows; every row of
the given tables takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.functions.text import lookup
from wattlake.functions.times import at, iso_text

AS_OF = "2001-08-02 00:00:00"
AGE_AS_OF = "2025-01-01 00:00:00"

# Event type -> metric name.
METRIC_OF_EVENT = {
    "signup": "bronze_rows_ingested",
    "view": "silver_valid_rows",
    "click": "gold_rows_fact_capacity",
    "purchase": "visualizations_generated",
    "error": "dq_failure_count",
}

# Order status -> ingest status.
STATUS_OF_ORDER = {"F": "failed", "O": "ingested", "P": "skipped"}

FUEL_OF_SEGMENT = {
    "BUILDING": "coal",
    "AUTOMOBILE": "Natural  Gas",
    "MACHINERY": "hydroelectric",
    "HOUSEHOLD": " WIND",
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once; later scans start without that job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def plant_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw plant row per customer."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    country = (
        F.when(_every("c_custkey", 17), " n/a ")
        .when(_every("c_custkey", 19), "usa")
        .when(_every("c_custkey", 23), " UK")
        .otherwise(F.lower("n_name"))
    )
    fuel = F.when(_every("c_custkey", 29), "unknown")
    for segment, name in FUEL_OF_SEGMENT.items():
        fuel = fuel.when(F.col("c_mktsegment") == segment, name)
    year = (
        F.when(_every("c_custkey", 31), F.lit(None).cast("double"))
        .when(_every("c_custkey", 37), F.lit(1700.0))
        .otherwise((1950 + F.col("c_custkey") % 75).cast("double"))
    )
    return rows.select(
        F.col("c_custkey").cast("string").alias("plant_id"),
        F.col("c_name").alias("plant_name"),
        country.alias("country"),
        F.col("r_name").alias("region_name"),
        fuel.otherwise("tidal").alias("primary_fuel"),
        F.col("c_acctbal").alias("capacity_mw"),
        year.alias("commissioning_year"),
        ((F.col("c_custkey") % 180).cast("double") - 90).alias("latitude"),
        F.when(~_every("c_custkey", 41), (F.col("c_custkey") % 360).cast("double") - 180).alias("longitude"),
        F.when(_every("c_custkey", 43), " ").otherwise(F.col("c_name")).alias("owner"),
    )


def plants_raw(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Plants with all they generated; ``until`` gives the feed as it stood at that time."""
    orders = table(spark, sf_dir, "orders")
    if until:
        orders = orders.filter(F.col("o_orderdate") < at(until))
    generated = orders.groupBy(F.col("o_custkey").cast("string").alias("plant_id")).agg(
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / 1000).alias("estimated_generation_gwh"),
        F.max("o_orderdate").alias("event_time"),
    )
    return plant_attributes(spark, sf_dir).join(generated, "plant_id", "inner" if until else "left")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per order: the reading a plant sent at a time, in batches by order key."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("plant_id"),
        "o_orderkey",
        (F.col("o_totalprice").cast("decimal(18,2)").cast("double") / 1000).alias("estimated_generation_gwh"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderdate").alias("ingested_at"),
        F.col("o_orderpriority").alias("source_name"),
        F.col("o_orderstatus").alias("status"),
    )
    return orders.join(plant_attributes(spark, sf_dir), "plant_id")


def run_month() -> Column:
    return F.date_trunc("month", F.col("event_time")).cast("timestamp_ntz")


def metrics_log(spark: SparkSession, sf_dir: str, raw_names: bool = False) -> DataFrame:
    """(metric_timestamp text, metric_name, metric_value) rows of the event log."""
    name = F.col("event_type")
    if not raw_names:
        name = lookup(METRIC_OF_EVENT, name)
    return table(spark, sf_dir, "events").select(
        iso_text(F.col("ts")).alias("metric_timestamp"), name.alias("metric_name"), F.col("value").alias("metric_value")
    )


def timed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics log with real times, as alert rules read it."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp_ntz").alias("metric_timestamp"),
        lookup(METRIC_OF_EVENT, F.col("event_type")).alias("metric_name"),
        F.col("value").alias("metric_value"),
    )


def ingest_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source per supplier; those in debt are off and those with nothing say nothing."""
    balance = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("source_name"),
        F.when(balance > 0, True).when(balance < 0, False).alias("enabled"),
        F.when(balance > 5000, 48.0).alias("freshness_update_sla_hours"),
        F.col("s_suppkey"),
    )


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows each source (supplier) delivered."""
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("source_name"))
    return table(spark, sf_dir, "lineitem").join(supplier, "l_suppkey")


def source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of every source after its deliveries: per supplier from line items."""
    log = ingest_log(spark, sf_dir)
    fulfilled = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    return log.groupBy("source_name").agg(
        F.max("l_shipdate").alias("last_ingested_at"),
        F.max(fulfilled).alias("event_time_watermark"),
        F.count("*").alias("last_rows"),
    )


def source_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of the last run per source (supplier), from the return flags of its deliveries."""
    log = ingest_log(spark, sf_dir)
    returned = F.count_if(F.col("l_returnflag") == "R")
    counts = log.groupBy("source_name").agg(
        F.count("*").alias("rows"),
        returned.alias("returned"),
        F.count_if(F.col("l_linestatus") == "F").alias("late_arriving_rows"),
        F.count_if(F.col("l_returnflag") == "A").alias("accepted"),
    )
    status = (
        F.when(F.col("returned") * 30 > F.col("rows") * 11, "failed")
        .when(F.col("accepted") * 30 > F.col("rows") * 11, "skipped")
        .otherwise("ingested")
    )
    return counts.withColumn("status", status)
