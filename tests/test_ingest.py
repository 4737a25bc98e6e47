import datetime as dt
import random

from pyspark.sql import functions as F

from wattlake.functions.times import at
from wattlake.operators import ingest
from wattlake.operators.upsert import latest_per_key, upsert


def test_fingerprint_ignores_order_and_layout(spark):
    rows = [(i, f"n{i}", None if i % 3 else 1.5) for i in range(50)]
    schema = "id int, name string, x double"
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame(rows[::-1], "id int, name string, x double").repartition(7).select("x", "name", "id")
    changed = spark.createDataFrame([*rows[:-1], (49, "n49", 2.0)], schema)
    prints = [ingest.content_fingerprint(df).first() for df in (a, b, changed)]
    assert prints[0] == prints[1] != prints[2]
    assert tuple(ingest.content_fingerprint(a.limit(0)).first()) == (0, "0")


def test_file_fingerprints_are_per_file(spark, tmp_path):
    for name, text in (("a", "id\n1\n2\n"), ("b", "id\n2\n1\n"), ("c", "id\n3\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    files = spark.read.option("header", True).csv(str(tmp_path))
    prints = {r.file_path.rsplit("/", 1)[-1]: r.content_hash for r in ingest.file_fingerprints(files).collect()}
    assert prints["a.csv"] == prints["b.csv"] != prints["c.csv"]


def test_changed_rows(spark):
    before = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 3, "z")], "k string, v int, source_name string")
    now = spark.createDataFrame([("a", 1), ("b", 5), (None, 3), ("c", None), ("a", 1)], "k string, v int")
    changed = ingest.changed_rows(now, before, "k").collect()
    assert sorted(map(tuple, changed)) == [("b", 5), ("c", None)]
    assert ingest.changed_rows(now, None, "k").count() == 5
    assert ingest.changed_rows(now, before, None).count() == 5


def test_added_columns_make_rows_changed(spark):
    before = spark.createDataFrame([("a", 1)], "k string, v int")
    same = spark.createDataFrame([("a", 1, None)], "k string, v int, w string")
    more = spark.createDataFrame([("a", 1, "new")], "k string, v int, w string")
    assert ingest.changed_rows(same, before, "k").count() == 0
    assert ingest.changed_rows(more, before, "k").count() == 1


def test_event_times(spark):
    df = spark.createDataFrame([(2018.0, "2018", "2026-01-01T00:00:00+00:00"), (None, "soon", None)], "y double, t string, u string")
    got = df.select(*[ingest.event_time_of(df, c).alias(c) for c in "ytu"]).collect()
    assert tuple(got[0]) == (dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 1), dt.datetime(2026, 1, 1))
    assert tuple(got[1]) == (None, None, None)


def test_late_rows_and_watermark(spark):
    df = spark.createDataFrame([("2020",), ("2010",), (None,)], "y string")
    late = ingest.annotate_events(df, "y", at("2015-01-01 00:00:00")).collect()
    assert [r.is_late_arriving for r in late] == [False, True, False]
    assert not any(r.is_late_arriving for r in ingest.annotate_events(df, "y", None).collect())
    assert not any(r.is_late_arriving or r.event_time for r in ingest.annotate_events(df, "absent", None).collect())
    mark = ingest.advanced_watermark(at("2020-01-01 00:00:00"), F.lit(None).cast("timestamp_ntz"))
    assert spark.range(1).select(mark).first()[0] == dt.datetime(2020, 1, 1)


def test_volume_change(spark):
    df = spark.createDataFrame([(0, 200, 100), (1, 50, 100), (2, 5, None), (3, 5, 0), (4, 101, 100)], "i int, c long, p long")
    got = ingest.volume_change(df, F.col("c"), F.col("p")).orderBy("i").collect()
    assert [(r.volume_ratio, r.volume_spike_detected, r.volume_drop_detected) for r in got] == [
        (2.0, True, False), (0.5, False, True), (None, False, False), (None, False, False), (1.01, False, False)]


def test_freshness_limits(spark):
    sources = spark.createDataFrame([("a", None), ("b", 48.0), ("c", None)], "source_name string, freshness_update_sla_hours double")
    day = dt.datetime(2026, 1, 1)
    state = spark.createDataFrame(
        [("a", day, day - dt.timedelta(hours=30)), ("b", day, day + dt.timedelta(hours=1))],
        "source_name string, last_ingested_at timestamp_ntz, event_time_watermark timestamp_ntz")
    outcomes = spark.createDataFrame([("a", "ingested")], "source_name string, status string")
    got = {r.source_name: r for r in ingest.freshness_report(sources, state, outcomes, at("2026-01-02 12:00:00")).collect()}
    assert len(got["a"]) == 11
    assert (got["a"].hours_since_last_update, got["a"].missing_updates, got["a"].ingestion_delay_hours, got["a"].ingestion_delay_breached) == (36.0, True, 30.0, True)
    assert (got["b"].missing_updates, got["b"].ingestion_delay_hours, got["b"].ingest_status) == (False, 0.0, "unknown")
    assert (got["c"].missing_updates, got["c"].hours_since_last_update, got["c"].ingestion_delay_breached) == (True, None, False)


def brute_latest(rows, nulls_win):
    best = {}
    for k, t, s in rows:
        rank = ((t is None) == nulls_win if t is None else not nulls_win, t or 0, s)
        if t is not None:
            rank = (not nulls_win, t, s)
        else:
            rank = (nulls_win, 0, s)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, s))
    return sorted(v for _, v in best.values())


def test_latest_per_key_against_brute_force(spark):
    """One key holds a third of the rows; times repeat and are sometimes missing."""
    rng = random.Random(7)
    rows = [(0 if rng.random() < 0.34 else rng.randrange(1, 30), rng.choice([None, *range(5)]), i) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, s int").repartition(5)
    for nulls_win in (False, True):
        got = latest_per_key(df, "k", ["t", "s"], nulls_win=nulls_win).collect()
        assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == brute_latest(rows, nulls_win)


def test_latest_per_key_reduces_before_the_shuffle(spark):
    plan = latest_per_key(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_upsert_batch_wins_ties_and_repeats_are_harmless(spark):
    schema = "plant_id string, country string, event_time int, ingested_at int"
    old = spark.createDataFrame([("a", "n/a", 1, 1), ("b", "India", 2, 1)], schema)
    new = spark.createDataFrame([("a", "Brazil", 1, 1), ("b", "France", 1, 9)], schema)
    once = upsert(old, new)
    assert sorted(map(tuple, once.collect())) == [("a", "Brazil", 1, 1), ("b", "India", 2, 1)]
    assert sorted(map(tuple, upsert(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_rows_without_a_time_win_only_when_asked(spark):
    schema = "plant_id string, event_time int, ingested_at int"
    old, new = spark.createDataFrame([("a", None, 1)], schema), spark.createDataFrame([("a", 5, 0)], schema)
    assert upsert(old, new).first().event_time == 5
    assert upsert(old, new, nulls_win=True).first().event_time is None
