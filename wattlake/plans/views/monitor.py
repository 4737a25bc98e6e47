"""Monitoring and quarantine views over the audit tables and the layers themselves."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.constants import STAGE_METRICS
from wattlake.functions.numbers import to_double, to_long
from wattlake.functions.text import lacks_text
from wattlake.functions.times import parse_iso, whole_units_between
from wattlake.operators.ranking import ranges
from wattlake.plans.views.common import Tables, theoretical_gwh, utilisation

NULL_COUNTS = ("null_plant_name", "null_country", "null_primary_fuel", "null_capacity_mw")
RANGE_COUNTS = ("invalid_capacity_rows", "invalid_commissioning_year_rows")


def _whole(name: str) -> Column:
    return F.coalesce(to_long(F.col(name)), F.lit(0).cast("bigint"))


def _added(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a + b, [_whole(n) for n in names])


def _share_of_input(part: Column) -> Column:
    rows = F.coalesce(to_double(F.col("input_rows")), F.lit(0.0))
    return F.when(rows == 0, F.lit(0.0)).otherwise(part / rows)


def _report_head() -> list[Column]:
    return [
        parse_iso(F.col("run_timestamp")).alias("run_timestamp"),
        F.coalesce("dataset", F.lit("Unknown")).alias("dataset"),
        _whole("input_rows").alias("input_rows"),
        _whole("valid_rows").alias("valid_rows"),
    ]


def data_quality(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["audit_silver_quality_report"].select(
        *_report_head(),
        _whole("malformed_rows").alias("malformed_rows"),
        _added(NULL_COUNTS).alias("null_issues"),
        _added(RANGE_COUNTS).alias("range_issues"),
        _share_of_input(F.coalesce(to_double(F.col("valid_rows")), F.lit(0.0))).alias("valid_ratio"),
    )


def dq_failure_breakdown(t: Tables, as_of: Column | None = None) -> DataFrame:
    failed = F.greatest(_whole("input_rows") - _whole("valid_rows"), F.lit(0))
    return t["audit_silver_quality_report"].select(
        *_report_head(),
        failed.alias("distinct_failed_records"),
        _whole("malformed_rows").alias("malformed_rows"),
        *[_whole(n).alias(n) for n in (*NULL_COUNTS, *RANGE_COUNTS)],
        _added(NULL_COUNTS).alias("null_issue_points"),
        _added(RANGE_COUNTS).alias("range_issue_points"),
        _added(("malformed_rows", *NULL_COUNTS, *RANGE_COUNTS)).alias("total_issue_points"),
        _share_of_input(failed.cast("double")).alias("distinct_failure_ratio"),
    )


def dq_failure_breakdown_latest(t: Tables, as_of: Column | None = None) -> DataFrame:
    newest_first = [F.col("run_timestamp").desc_nulls_last(), F.col("dataset")]
    return dq_failure_breakdown(t).orderBy(*newest_first).limit(1)


def freshness(t: Tables, as_of: Column) -> DataFrame:
    newest = F.max(parse_iso(F.col("last_ingested_at")))
    return (
        t["audit_freshness_report"]
        .groupBy("source_name")
        .agg(newest.alias("latest_ingested_at"))
        .withColumn("lag_hours", whole_units_between("HOUR", F.col("latest_ingested_at"), as_of).cast("int"))
    )


def pipeline_freshness(t: Tables, as_of: Column) -> DataFrame:
    return freshness(t, as_of).select("source_name", "latest_ingested_at", "lag_hours")


def pipeline_metrics(t: Tables, as_of: Column | None = None) -> DataFrame:
    return t["audit_metrics"].select(
        parse_iso(F.col("metric_timestamp")).alias("metric_timestamp"),
        F.coalesce("metric_name", F.lit("unknown_metric")).alias("metric_name"),
        F.coalesce(to_double(F.col("metric_value")), F.lit(0.0)).alias("metric_value"),
    )


def failed_jobs(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Newest value of every failure metric; at equal times the greater value.

    A max over (time, value) instead of a row number: tasks reduce their own
    rows first, so one noisy metric does not gather in one task.
    """
    name = F.lower("metric_name")
    rows = pipeline_metrics({"audit_metrics": t["audit_metrics"].filter(name.like("%fail%") | name.like("%error%"))})
    newest = F.max(F.struct("metric_timestamp", "metric_value")).alias("_newest")
    return rows.groupBy("metric_name").agg(newest).select(
        F.col("_newest.metric_timestamp").alias("metric_date"),
        "metric_name",
        F.col("_newest.metric_value").alias("failure_count"),
    )


# --- processing latency ---------------------------------------------------------


def _stage_log(metrics: DataFrame) -> DataFrame:
    """Distinct (ts, stage) of the four stage metrics: all that latency depends on."""
    stage_of = F.element_at(
        F.create_map(*[F.lit(x) for stage, name in STAGE_METRICS.items() for x in (name, stage)]), F.col("metric_name")
    )
    return (
        metrics.filter(F.col("metric_name").isin(*STAGE_METRICS.values()))
        .select(parse_iso(F.col("metric_timestamp")).alias("ts"), stage_of.alias("stage"))
        .filter(F.col("ts").isNotNull())
        .distinct()
    )


def _next_of_each_stage(log: DataFrame, pieces: int | None = None) -> DataFrame:
    """For every log row the next time of each later stage, at or after it (strictly after for bronze).

    A running minimum over the whole log would be one task, and one over an hour of it would be one task where all rows
    are of one hour. The log is cut into pieces of equal size in the order of time; each piece runs its own window, and
    what follows a piece comes from a window over one row per piece. Rows are distinct in (ts, stage).
    """
    # Latest time first and, at one time, the last stage first: what precedes a row
    # is all that may follow it in a run. One order serves all four minima.
    stages = list(STAGE_METRICS)
    depth = F.array_position(F.array(*map(F.lit, stages)), F.col("stage"))
    log = ranges(log, [F.col("ts").desc(), depth.desc()], pieces)

    def of(stage: str) -> Column:
        return F.when(F.col("stage") == stage, F.col("ts"))

    first_in_piece = log.groupBy("_part").agg(*[F.min(of(s)).alias(f"_first_{s}") for s in stages])
    pieces_before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = first_in_piece.select("_part", *[F.min(f"_first_{s}").over(pieces_before).alias(f"_carry_{s}") for s in stages])
    order = Window.partitionBy("_part").orderBy("_row")
    here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    nexts = [
        F.coalesce(F.min(of(s)).over(before if s == "bronze" else here), F.col(f"_carry_{s}")).alias(f"next_{s}")
        for s in stages
    ]
    return log.join(carried, "_part").select("ts", "stage", *nexts)


def pipeline_runs(metrics: DataFrame, pieces: int | None = None) -> DataFrame:
    """One row per bronze time: the first silver, gold and chart times that follow before the next run.

    A stage time lies between one bronze time and the next, so each belongs to
    one run and the two look-ups by time meet one row on either side.
    """
    log = _next_of_each_stage(_stage_log(metrics), pieces)

    def within_run(time: str) -> Column:
        inside = F.col("next_bronze_ts").isNull() | (F.col(time) < F.col("next_bronze_ts"))
        return F.when(inside, F.col(time))

    runs = log.filter(F.col("stage") == "bronze").select(
        F.col("ts").alias("bronze_ts"), F.col("next_bronze").alias("next_bronze_ts"), F.col("next_silver").alias("silver_ts")
    )
    runs = runs.withColumn("silver_ts", within_run("silver_ts"))
    after_silver = log.filter(F.col("stage") == "silver").select(F.col("ts").alias("silver_ts"), F.col("next_gold").alias("gold_ts"))
    runs = runs.join(after_silver, "silver_ts", "left").withColumn("gold_ts", within_run("gold_ts"))
    after_gold = log.filter(F.col("stage") == "gold").select(F.col("ts").alias("gold_ts"), F.col("next_visualizations").alias("viz_ts"))
    runs = runs.join(after_gold, "gold_ts", "left").withColumn("viz_ts", within_run("viz_ts"))
    return runs.select("bronze_ts", "silver_ts", "gold_ts", "viz_ts")


def _minutes_up(start: str, end: str) -> Column:
    seconds = whole_units_between("SECOND", F.col(start), F.col(end))
    return F.greatest(F.lit(0), F.ceil(seconds.cast("double") / 60.0)).cast("int")


def processing_latency(t: Tables, as_of: Column | None = None) -> DataFrame:
    """Times and minutes between stages of the newest run that finished all of them."""
    complete = pipeline_runs(t["audit_metrics"]).dropna(subset=["silver_ts", "gold_ts", "viz_ts"])
    newest = complete.orderBy(F.col("bronze_ts").desc()).limit(1)
    return newest.select(
        F.col("bronze_ts").alias("bronze_completed_at"),
        F.col("silver_ts").alias("silver_completed_at"),
        F.col("gold_ts").alias("gold_completed_at"),
        F.col("viz_ts").alias("visualizations_completed_at"),
        _minutes_up("bronze_ts", "silver_ts").alias("bronze_to_silver_minutes"),
        _minutes_up("silver_ts", "gold_ts").alias("silver_to_gold_minutes"),
        _minutes_up("gold_ts", "viz_ts").alias("gold_to_viz_minutes"),
    )


def latency(t: Tables, as_of: Column | None = None) -> DataFrame:
    return processing_latency(t)


# --- plants -----------------------------------------------------------------------


def duplicate_plants(t: Tables, as_of: Column | None = None) -> DataFrame:
    groups = t["stg_power_plants"].groupBy(F.coalesce(F.col("plant_id").cast("string"), F.lit("Unknown")).alias("plant_id"))
    newest = F.coalesce(F.max("ingested_at").cast("string"), F.lit("Unknown"))
    return groups.agg(F.count("*").alias("duplicate_count"), newest.alias("latest_ingested_at")).filter(
        F.col("duplicate_count") > 1
    )


def missing_or_inconsistent_generation(t: Tables, as_of: Column | None = None) -> DataFrame:
    capacity, generation = F.col("capacity_mw"), F.col("estimated_generation_gwh")
    no_capacity = capacity.isNull() | (capacity <= 0)
    share = F.try_divide(generation, F.nullif(theoretical_gwh(capacity), F.lit(0.0)))
    issue = (
        F.when(generation.isNull(), "missing_generation")
        .when(no_capacity, "invalid_capacity")
        .when(share > 1.0, "inconsistent_above_theoretical")
        .when(share < 0, "inconsistent_negative_generation")
        .otherwise("ok")
    )
    rows = t["stg_power_plants"].filter(generation.isNull() | no_capacity | (share > 1.0) | (share < 0))
    return rows.select(
        *[F.coalesce(F.col(c), F.lit("Unknown")).alias(c) for c in ("plant_id", "plant_name", "country", "primary_fuel")],
        F.coalesce(capacity, F.lit(0.0)).alias("capacity_mw"),
        F.coalesce(generation, F.lit(0.0)).alias("estimated_generation_gwh"),
        F.when(capacity.isNull(), F.lit(0.0)).otherwise(utilisation(generation, capacity)).alias("utilization_ratio"),
        issue.alias("issue_type"),
    )


# --- null quarantine -----------------------------------------------------------------

_PLANT_TEXTS = ("plant_id", "plant_name", "country", "primary_fuel")

# Table -> (columns that make the record key, mandatory columns in the order they are judged).
NULL_RULES = {
    "dim_plant": (
        ("plant_id",),
        (*_PLANT_TEXTS, "capacity_mw", "commissioning_year", "latitude", "longitude"),
    ),
    "silver_stg_power_plants": (
        ("plant_id",),
        (*_PLANT_TEXTS, "capacity_mw", "commissioning_year", "continent", "sub_region"),
    ),
    "fact_power_generation": (
        ("country", "primary_fuel", "year"),
        ("country", "primary_fuel", "year", "total_generation_gwh"),
    ),
    "fact_plant_capacity": (
        ("country",),
        ("country", "total_capacity_mw", "renewable_capacity_mw"),
    ),
}


def _records_with_nulls(df: DataFrame, table: str, as_of: Column) -> DataFrame:
    key, mandatory = NULL_RULES[table]
    kinds = dict(df.dtypes)
    reasons = [
        F.when(lacks_text(F.col(c)) if kinds[c] == "string" else F.col(c).isNull(), F.lit(f"missing_{c}"))
        for c in mandatory
    ]
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return df.select(
        F.lit(table).alias("source_table"),
        F.concat_ws(":", *parts).alias("record_key"),
        F.coalesce(*reasons).alias("quarantine_reason"),
        as_of.alias("quarantined_at"),
    ).filter(F.col("quarantine_reason").isNotNull())


def quarantine_null_records(t: Tables, as_of: Column) -> DataFrame:
    """Rows lacking a mandatory value, with the first value they lack."""
    names = {"silver_stg_power_plants": "stg_power_plants"}
    found = [_records_with_nulls(t[names.get(table, table)], table, as_of) for table in NULL_RULES]
    return reduce(DataFrame.unionByName, found)


def quarantine_null_summary(t: Tables, as_of: Column) -> DataFrame:
    return (
        quarantine_null_records(t, as_of)
        .groupBy("source_table", "quarantine_reason")
        .agg(F.count("*").alias("quarantined_records"))
    )
