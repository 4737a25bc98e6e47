"""Alert rules as aggregates over time windows of the metrics log.

The same rule runs on a table or, given a watermark, on a stream; only rules
that treat a missing value as a breach need a table, because a stream does not
know which windows stay empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Rule:
    name: str
    metric: str
    statistic: str  # "sum" or "max"
    period: str
    comparison: str  # ">" or "<="
    threshold: float
    missing_breaches: bool = False


# The rules in force.
RULES = {
    "dq_failures": Rule("dq_failures", "dq_failure_count", "sum", "5 minutes", ">", 0.0),
    "freshness_lag": Rule("freshness_lag", "freshness_lag_hours", "max", "1 hour", ">", 24.0),
    "no_ingest": Rule("no_ingest", "bronze_rows_ingested", "sum", "1 hour", "<=", 0.0, missing_breaches=True),
    "failed_runs": Rule("failed_runs", "failed_runs", "sum", "5 minutes", ">", 0.0),
    "slow_runs": Rule("slow_runs", "run_minutes", "max", "5 minutes", ">", 60.0),
}


def _breach(value: Column, rule: Rule) -> Column:
    return value > rule.threshold if rule.comparison == ">" else value <= rule.threshold


def _statistic(rule: Rule) -> Column:
    value = F.col("metric_value")
    return F.sum(value) if rule.statistic == "sum" else F.max(value)


def windowed(metrics: DataFrame, rule: Rule, of_any: bool = False) -> DataFrame:
    """The rule's statistic for every window that holds the metric, or ``of_any`` metric, then null where it lacks the rule's."""
    mine = F.col("metric_name") == rule.metric
    rows = metrics.withColumn("metric_value", F.when(mine, F.col("metric_value"))) if of_any else metrics.filter(mine)
    return (
        rows.groupBy(F.window("metric_timestamp", rule.period).alias("_w"))
        .agg(_statistic(rule).alias("metric_value"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "metric_value")
    )


#: Windows that one row makes.
TOGETHER = 1000


def every_window(spans: DataFrame, period: str) -> DataFrame:
    """Every window that begins from ``from`` to ``last``, in steps of many windows that tasks share."""
    step, stride = F.expr(f"interval {period}"), F.expr(f"interval {period} * {TOGETHER}")
    strides = spans.filter(F.col("from").isNotNull()).select("last", F.explode(F.sequence(F.col("from"), F.col("last"), stride)).alias("from"))
    until = F.least(F.col("last"), F.col("from") + F.expr(f"interval {period} * {TOGETHER - 1}"))
    return strides.repartition("from").select(F.explode(F.sequence(F.col("from"), until, step)).alias("window_start")).withColumn(
        "window_end", F.col("window_start") + step)


def all_windows(metrics: DataFrame, period: str) -> DataFrame:
    """Every window from the first to the last entry of the whole log, empty ones too."""
    span = metrics.agg(F.min("metric_timestamp").alias("first"), F.max("metric_timestamp").alias("last"))
    return every_window(span.select(F.window("first", period)["start"].alias("from"), "last"), period)


def breaches(metrics: DataFrame, rule: Rule) -> DataFrame:
    """Windows that break the rule, as (alert, window_start, window_end, metric_value)."""
    seen = windowed(metrics, rule)
    if rule.missing_breaches:
        seen = filled(all_windows(metrics, rule.period), seen)
    return broken(seen, rule)


def filled(spine: DataFrame, seen: DataFrame) -> DataFrame:
    """The windows of ``spine`` with what was seen in them, or 0."""
    values = seen.select("window_start", "metric_value")
    return spine.join(values, "window_start", "left").withColumn("metric_value", F.coalesce("metric_value", F.lit(0.0)))


def broken(seen: DataFrame, rule: Rule) -> DataFrame:
    return seen.filter(_breach(F.col("metric_value"), rule)).select(
        F.lit(rule.name).alias("alert"), "window_start", "window_end", "metric_value"
    )


def run_metrics(runs: DataFrame, finished: str, stage: str, status: str, minutes: str) -> DataFrame:
    """Run rows as the metrics the run alerts watch, for all stages together and for each stage."""
    failed = F.struct(F.lit("failed_runs").alias("metric_name"), (F.col(status) == "failed").cast("double").alias("metric_value"))
    took = F.struct(F.lit("run_minutes").alias("metric_name"), F.col(minutes).cast("double").alias("metric_value"))
    return runs.select(
        F.col(finished).alias("metric_timestamp"),
        F.explode(F.array(F.lit("pipeline"), F.col(stage))).alias("stage"),
        F.array(failed, took).alias("_m"),
    ).select("metric_timestamp", "stage", F.explode("_m").alias("_m")).select("metric_timestamp", "stage", "_m.*")


def stage_breaches(metrics: DataFrame, rule: Rule) -> DataFrame:
    """As ``breaches`` for metrics that carry a stage, one series per stage."""
    rows = metrics.filter(F.col("metric_name") == rule.metric)
    seen = rows.groupBy("stage", F.window("metric_timestamp", rule.period).alias("_w")).agg(
        _statistic(rule).alias("metric_value")
    )
    return seen.filter(_breach(F.col("metric_value"), rule)).select(
        F.lit(rule.name).alias("alert"),
        "stage",
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        "metric_value",
    )
