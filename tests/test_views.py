"""Views against brute force and against their direct, unscalable statements."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.functions.numbers import total
from wattlake.operators import alerts, gold, ranking
from wattlake.plans.views import geo, monitor, sustain

STAGES = ["bronze_rows_ingested", "silver_valid_rows", "gold_rows_fact_capacity", "visualizations_generated"]


def brute_runs(log):
    times = {s: sorted({t for t, n in log if n == s}) for s in STAGES}
    bronze = times[STAGES[0]]
    runs = []
    for i, b in enumerate(bronze):
        end = bronze[i + 1] if i + 1 < len(bronze) else None
        row, since = [b], b
        for stage in STAGES[1:]:
            found = None if since is None else next((t for t in times[stage] if t >= since and (end is None or t < end)), None)
            row.append(found)
            since = found
        runs.append(tuple(row))
    return sorted(runs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pipeline_runs_against_brute_force(spark, seed):
    """Times collide on purpose: stages at the time of the next run, of each other, and repeated."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    log = [(start + dt.timedelta(minutes=rng.randrange(60 * seed * seed)), rng.choice([*STAGES, "other"])) for _ in range(120)]
    df = spark.createDataFrame([(t.isoformat() + "+00:00", n, 1.0) for t, n in log], "metric_timestamp string, metric_name string, metric_value double")
    got = monitor.pipeline_runs(df).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == brute_runs(log)


def test_a_log_of_one_hour_is_cut_into_equal_pieces(spark):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    log = [(start + dt.timedelta(microseconds=rng.randrange(3_600_000_000)), rng.choice(STAGES)) for _ in range(6000)]
    df = spark.createDataFrame([(t.isoformat() + "+00:00", n, 1.0) for t, n in log], "metric_timestamp string, metric_name string, metric_value double")
    stages = monitor._stage_log(df)
    sizes = [r["count"] for r in ranking.ranges(stages, [F.col("ts").desc(), F.col("stage")], 16).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * sorted(sizes)[8]
    got = monitor.pipeline_runs(df, 16).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == brute_runs(log)


def test_numbers_and_ranks_against_sorting(spark):
    """One common beginning, ties, nulls and a group with most rows."""
    rng = random.Random(8)
    rows = [(rng.choice(["g", "g", "g", None, "h"]), f"same beginning {rng.randrange(300):05d}" if k % 50 else None, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, name string, k int")
    got = ranking.numbered(df, ["g"], [F.col("name").asc_nulls_last(), F.col("k").desc()], "at")
    want = {}
    for g in ("g", "h", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] or "", -r[2]))
        want |= {r[2]: at for at, r in enumerate(own)}
    assert {r.k: r["at"] for r in got.collect()} == want
    for down in (True, False):
        names = sorted({r[1] for r in rows if r[1]}, reverse=down)
        before, ranks = 0, {}
        for name in [*names, None]:
            ranks[name] = before + 1
            before += sum(r[1] == name for r in rows)
        assert {r.k: r["rank"] for r in ranking.ranked(df, "name", down).collect()} == {k: ranks[n] for _, n, k in rows}
    assert ranking.numbered(df.limit(0), [], ["k"]).count() == 0 and ranking.ranked(df.limit(0), "k").count() == 0


def test_ids_follow_one_common_beginning(spark):
    """No window sees all names, however alike they begin."""
    names = [f"Republic of {k:04d}" for k in range(500)]
    silver = spark.createDataFrame([(n,) for n in names[::-1]] + [(None,)], "country string")
    assert [(r.country, r.country_id) for r in gold.dim_country(silver).orderBy("country_id").collect()] == [
        *((n, k) for k, n in enumerate(names, 1)), (None, 501)]


def test_latency_of_no_complete_run_is_empty(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00+00:00", STAGES[0], 1.0)], "metric_timestamp string, metric_name string, metric_value double")
    assert monitor.processing_latency({"audit_metrics": df}).count() == 0


def test_generation_density_equals_the_fan_out_join(spark, small):
    t = shared.tables(spark, small)
    p, g = t["dim_plant"].alias("p"), t["fact_power_generation"].alias("g")
    direct = p.join(g, (F.col("p.country") == F.col("g.country")) & (F.col("p.primary_fuel") == F.col("g.primary_fuel"))).groupBy("p.country").agg(
        F.count_distinct("plant_id").alias("plant_count"), total(F.col("capacity_mw")).alias("total_capacity_mw"),
        total(F.col("total_generation_gwh")).alias("total_generation_gwh"))
    ours = geo.generation_density(t).drop("generation_per_plant_gwh")
    want = {r.country: r for r in direct.collect()}
    got = {r.country: r for r in ours.collect()}
    assert set(got) == set(want)
    for country, r in got.items():
        assert r.plant_count == want[country].plant_count
        assert r.total_capacity_mw == pytest.approx(want[country].total_capacity_mw, rel=1e-12)
        assert r.total_generation_gwh == pytest.approx(want[country].total_generation_gwh, rel=1e-12)


def test_regional_density_falls_back_only_when_no_region_is_known(spark):
    plants = spark.createDataFrame([("India", 5.0)], "country string, capacity_mw double")
    schema = "continent string, sub_region string, total_capacity_mw double"
    known = spark.createDataFrame([("Asia", "Southern Asia", 1.0)], schema)
    blank = spark.createDataFrame([(" ", "Southern Asia", 1.0)], schema)
    view = lambda geo_facts: [tuple(r) for r in sustain.regional_density({"fact_capacity_geo": geo_facts, "dim_plant": plants}).collect()]
    assert view(known) == [("Asia", "Southern Asia", 1.0)]
    assert view(blank) == [("Fallback", "India", 5.0)]


def test_issue_types(spark):
    rows = [("a", None, 1.0), ("b", 5.0, None), ("c", 5.0, 0.0), ("d", 100.0, 1.0), ("e", -1.0, 1.0), ("f", 1.0, 1.0)]
    df = spark.createDataFrame([(k, "n", "c", "f", c, g) for k, g, c in rows], "plant_id string, plant_name string, country string, primary_fuel string, capacity_mw double, estimated_generation_gwh double")
    got = {r.plant_id: r.issue_type for r in monitor.missing_or_inconsistent_generation({"stg_power_plants": df}).collect()}
    assert got == {"a": "missing_generation", "b": "invalid_capacity", "c": "invalid_capacity", "d": "inconsistent_above_theoretical", "e": "inconsistent_negative_generation"}


def test_empty_windows_breach_only_where_the_rule_says_so(spark):
    hour = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    rows = [(hour(0), "bronze_rows_ingested", 5.0), (hour(3, 30), "bronze_rows_ingested", 0.0), (hour(4), "dq_failure_count", 2.0)]
    log = spark.createDataFrame(rows, "metric_timestamp timestamp_ntz, metric_name string, metric_value double")
    idle = alerts.breaches(log, alerts.RULES["no_ingest"]).collect()
    assert sorted(r.window_start.hour for r in idle) == [1, 2, 3, 4]
    assert [r.window_start for r in alerts.breaches(log, alerts.RULES["dq_failures"]).collect()] == [hour(4)]
