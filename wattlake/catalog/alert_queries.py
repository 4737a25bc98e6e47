"""Alert rules over the metrics log and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog.registry import query
from wattlake.catalog.sql import summed, with_ctes
from wattlake.operators import alerts
from wattlake.sources import bindings


def _windows(rule: alerts.Rule, metric: str, test: str) -> str:
    statistic = summed("metric_value") if rule.statistic == "sum" else "max(metric_value)"
    return with_ctes(
        f"""SELECT '{rule.name}' AS alert, w AS window_start, w + INTERVAL {rule.period} AS window_end, v AS metric_value
            FROM (SELECT time_bucket(INTERVAL {rule.period}, ts) AS w, {statistic} AS v FROM metrics_log
                  WHERE metric_name = '{metric}' GROUP BY 1) WHERE {test}""", "metrics_log")


@query("alr_01_dq_failures", _windows(alerts.RULES["dq_failures"], "dq_failure_count", "v > 0"))
def dq_failures(spark, sf_dir):
    return alerts.breaches(bindings.timed_metrics(spark, sf_dir), alerts.RULES["dq_failures"])


def _lag_log(spark, sf_dir):
    """Values of chart events read as hours of lag."""
    log = bindings.timed_metrics(spark, sf_dir)
    lag = F.col("metric_name") == "visualizations_generated"
    return log.withColumn("metric_name", F.when(lag, "freshness_lag_hours").otherwise(F.col("metric_name")))


@query("alr_02_freshness_lag", _windows(alerts.RULES["freshness_lag"], "visualizations_generated", "v > 24"))
def freshness_lag(spark, sf_dir):
    return alerts.breaches(_lag_log(spark, sf_dir), alerts.RULES["freshness_lag"])


@query("alr_03_no_ingest", with_ctes(
    f"""SELECT 'no_ingest' AS alert, w AS window_start, w + INTERVAL 1 HOUR AS window_end, coalesce(v, 0.0::DOUBLE) AS metric_value
        FROM (SELECT unnest(generate_series(time_bucket(INTERVAL 1 HOUR, min(ts)), max(ts), INTERVAL 1 HOUR)) AS w FROM metrics_log)
        LEFT JOIN (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, {summed('metric_value')} AS v FROM metrics_log
                   WHERE metric_name = 'bronze_rows_ingested' GROUP BY 1) USING (w)
        WHERE coalesce(v, 0) <= 0""", "metrics_log"))
def no_ingest(spark, sf_dir):
    return alerts.breaches(bindings.timed_metrics(spark, sf_dir), alerts.RULES["no_ingest"])


def _runs(spark, sf_dir):
    """Orders as runs: status, stage (priority) and minutes (thousands paid)."""
    return bindings.table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("finished"),
        F.col("o_orderpriority").alias("stage"),
        F.element_at(F.create_map(*[F.lit(x) for p in bindings.STATUS_OF_ORDER.items() for x in p]), F.col("o_orderstatus")).alias("status"),
        (F.col("o_totalprice") / 1000).alias("minutes"),
    )


STAGED = """SELECT unnest(['pipeline', o_orderpriority]) AS stage, time_bucket(INTERVAL 5 MINUTE, o_orderdate) AS w,
                   (o_orderstatus = 'F')::INT AS failed, o_totalprice / 1000 AS minutes FROM orders"""


@query("alr_04_failed_runs", f"""
    SELECT 'failed_runs' AS alert, stage, w AS window_start, w + INTERVAL 5 MINUTE AS window_end,
           CAST(sum(failed) AS DOUBLE) AS metric_value FROM ({STAGED}) GROUP BY ALL HAVING sum(failed) > 0""")
def failed_runs(spark, sf_dir):
    metrics = alerts.run_metrics(_runs(spark, sf_dir), "finished", "stage", "status", "minutes")
    return alerts.stage_breaches(metrics, alerts.RULES["failed_runs"])


@query("alr_04_slow_runs", f"""
    SELECT 'slow_runs' AS alert, stage, w AS window_start, w + INTERVAL 5 MINUTE AS window_end,
           max(minutes) AS metric_value FROM ({STAGED}) GROUP BY ALL HAVING max(minutes) > 60""")
def slow_runs(spark, sf_dir):
    metrics = alerts.run_metrics(_runs(spark, sf_dir), "finished", "stage", "status", "minutes")
    return alerts.stage_breaches(metrics, alerts.RULES["slow_runs"])
