"""Incremental ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattlake.catalog import tables as shared
from wattlake.catalog.registry import query
from wattlake.catalog.sql import RUN, hash_sum, iso, row_hash, with_ctes
from wattlake.functions.times import at, iso_text, parse_iso
from wattlake.operators import ingest
from wattlake.operators.upsert import latest_per_key
from wattlake.session import freed_shuffles, new_folder
from wattlake.sources import bindings
from wattlake.sources.hash_index import RowHashIndex

LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
ORDER = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("ing_01_source_fingerprint", f"""
    SELECT s_name AS source_name, count(*) AS row_count, {hash_sum(row_hash(*LINE))} AS content_hash
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def source_fingerprint(spark, sf_dir):
    return ingest.content_fingerprint(bindings.ingest_log(spark, sf_dir), by=["source_name"], columns=LINE)


@query("ing_02_dataset_fingerprint", f"SELECT count(*) AS row_count, {hash_sum(row_hash(*ORDER))} AS content_hash FROM orders")
def dataset_fingerprint(spark, sf_dir):
    return ingest.content_fingerprint(bindings.table(spark, sf_dir, "orders"))


# State of the sources after an earlier run: the content of the deliveries of some
# sources was different then, and some sources have no output.
PRINTS = {
    "prints": f"""SELECT source_name, count(*) AS row_count, {hash_sum(row_hash(*LINE))} AS content_hash
                  FROM source_log GROUP BY 1""",
    "known": """SELECT source_name, CASE WHEN status <> 'failed' THEN content_hash ELSE 'old' END AS last_file_hash,
                       CASE WHEN enabled IS NOT false THEN 'bronze' END AS last_output_path, status AS last_status
                FROM prints JOIN source_outcomes USING (source_name) JOIN source_registry USING (source_name)""",
}


def _prints_and_state(spark, sf_dir):
    prints = ingest.content_fingerprint(bindings.ingest_log(spark, sf_dir), by=["source_name"], columns=LINE)
    registry = bindings.ingest_registry(spark, sf_dir)
    outcomes = bindings.source_outcomes(spark, sf_dir).select("source_name", "status")
    state = prints.join(outcomes, "source_name").join(registry.select("source_name", "enabled"), "source_name").select(
        "source_name",
        F.when(F.col("status") != "failed", F.col("content_hash")).otherwise("old").alias("last_file_hash"),
        F.when(F.coalesce("enabled", F.lit(True)), "bronze").alias("last_output_path"),
        F.col("status").alias("last_status"),
    )
    return registry, prints, state


@query("ing_03_needs_ingest", with_ctes(
    """SELECT source_name, row_count, content_hash FROM prints JOIN known USING (source_name)
       WHERE NOT (content_hash IS NOT DISTINCT FROM last_file_hash AND last_output_path IS NOT NULL)""",
    "source_outcomes", "source_registry", **PRINTS))
def needs_ingest(spark, sf_dir):
    _, prints, state = _prints_and_state(spark, sf_dir)
    return ingest.needs_ingest(prints, state)


@query("ing_04_row_hash", f"SELECT l_orderkey, l_linenumber, {row_hash(*LINE)} AS row_hash FROM lineitem")
def hashed_rows(spark, sf_dir):
    from wattlake.functions.hashing import row_hash as spark_row_hash

    return bindings.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", spark_row_hash(LINE).alias("row_hash"))


CUT = "2001-01-01 00:00:00"
PLANT = ("plant_id", "plant_name", "country", "estimated_generation_gwh", "event_time")


@query("ing_05_changed_rows", with_ctes(
    f"""SELECT plant_id, plant_name, country, estimated_generation_gwh, event_time FROM plants_raw p
        WHERE NOT EXISTS (SELECT 1 FROM earlier e WHERE e.plant_id = p.plant_id
                          AND e.estimated_generation_gwh IS NOT DISTINCT FROM p.estimated_generation_gwh)""",
    "plants_raw",
    earlier=f"""SELECT CAST(o_custkey AS VARCHAR) AS plant_id,
                       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000 AS estimated_generation_gwh
                FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' GROUP BY 1"""))
def changed_rows(spark, sf_dir):
    """Plants as they are now against plants as they stood at an earlier time."""
    now = bindings.plants_raw(spark, sf_dir).select(*PLANT)
    before = bindings.plants_raw(spark, sf_dir, until=CUT).select(*PLANT)
    return ingest.changed_rows(now, before, "plant_id", [c for c in PLANT if c != "event_time"])


@query("ing_05_changed_against_all_bronze", with_ctes(
    """SELECT plant_id, estimated_generation_gwh, o_orderkey FROM readings r WHERE status = 'F'
       AND NOT EXISTS (SELECT 1 FROM last l WHERE l.plant_id = r.plant_id AND l.o_orderkey = r.o_orderkey
                       AND l.estimated_generation_gwh = r.estimated_generation_gwh)""", "readings",
    last="""SELECT * FROM readings QUALIFY row_number() OVER (
            PARTITION BY plant_id ORDER BY event_time DESC, o_orderkey DESC) = 1"""))
def changed_against_all_bronze(spark, sf_dir):
    """A batch of failed readings against the latest record of every plant over all of bronze."""
    columns = ["plant_id", "estimated_generation_gwh", "o_orderkey"]
    rows = bindings.readings(spark, sf_dir).select(*columns, "event_time", "status")
    known = latest_per_key(rows, "plant_id", ["event_time", "o_orderkey"]).select(*columns)
    return ingest.changed_rows(rows.filter(F.col("status") == "F").select(*columns), known, "plant_id")


@query("ing_05_repeated_keys", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'A'""")
def repeated_keys(spark, sf_dir):
    """Keys with several rows: only the rows that changed since the live rows come back."""
    before = bindings.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    live = ingest.live_rows(ingest.with_row_hash(before.drop("l_returnflag")), "l_orderkey", None)
    changed = F.when(F.col("l_returnflag") == "A", F.col("l_quantity") + 0.5).otherwise(F.col("l_quantity"))
    now = ingest.with_row_hash(before.withColumn("l_quantity", changed).drop("l_returnflag"))
    return ingest.unseen_rows(now, live).select("l_orderkey", "l_linenumber", (F.col("l_quantity") - 0.5).alias("l_quantity"))


@query("ing_05_hash_index", """
    SELECT l_orderkey, l_linenumber, l_quantity + 0.5 AS l_quantity, 2 AS ingest FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, 3 FROM lineitem a WHERE l_returnflag = 'A' AND NOT EXISTS (
        SELECT 1 FROM lineitem b WHERE b.l_returnflag <> 'A' AND b.l_orderkey = a.l_orderkey
        AND b.l_linenumber = a.l_linenumber AND b.l_quantity = a.l_quantity)""")
def hash_index(spark, sf_dir):
    """Three ingests against an index of row hashes: all rows, some changed, and the first feed of those once more.

    What comes back then is seen as changed again, unless a row that did not change is the same."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity"]
    rows = bindings.table(spark, sf_dir, "lineitem").select(*columns, "l_returnflag")
    returned = F.col("l_returnflag") == "A"
    changed = F.when(returned, F.col("l_quantity") + 0.5).otherwise(F.col("l_quantity"))
    folder = new_folder(spark, "ing-05")
    index = RowHashIndex(spark, f"{folder}/index")
    found = []
    for k, feed in enumerate((rows, rows.withColumn("l_quantity", changed), rows.filter(returned)), 1):
        hashed = ingest.with_row_hash(feed.select(*columns))
        if k > 1:
            new = f"{folder}/changed-{k}"
            with freed_shuffles(spark):
                index.unseen(hashed).select(*columns).write.parquet(new)
            found.append(spark.read.parquet(new).withColumn("ingest", F.lit(k)))
        index.record(hashed.select("row_hash", F.col("l_orderkey").cast("string").alias("key")), k)
    return found[0].unionByName(found[1])


@query("ing_06_no_change", """
    SELECT o_orderpriority, count(*) FILTER (o_orderpriority LIKE '1%') AS changed_rows,
           CASE WHEN o_orderpriority LIKE '1%' THEN 'ingested' ELSE 'no_changes' END AS status
    FROM orders GROUP BY o_orderpriority""")
def no_change(spark, sf_dir):
    """Feeds by priority, of which one has new prices: the others change nothing."""
    before = bindings.table(spark, sf_dir, "orders")
    dearer = F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    changed = ingest.changed_rows(before.withColumn("o_totalprice", dearer), before, "o_orderkey")
    counts = changed.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    rows = F.coalesce("n", F.lit(0)).alias("changed_rows")
    status = F.when(F.col("n") > 0, "ingested").otherwise("no_changes").alias("status")
    return before.select("o_orderpriority").distinct().join(counts, "o_orderpriority", "left").select("o_orderpriority", rows, status)


@query("ing_07_event_time_from_year", with_ctes(
    """SELECT plant_id, make_timestamp(CAST(commissioning_year AS BIGINT), 1, 1, 0, 0, 0) AS event_time, false AS is_late_arriving
       FROM plant_attributes""", "plant_attributes"))
def event_time_from_year(spark, sf_dir):
    rows = bindings.plant_attributes(spark, sf_dir).select("plant_id", "commissioning_year")
    return ingest.annotate_events(rows, "commissioning_year", None).drop("commissioning_year")


# Batch 1 is what was delivered, batch 2 what is still open; the watermark is the newest
# delivered order of the first five years.
MARK = "2000-01-01 00:00:00"
WATERMARK = f"(SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{MARK}')"


def _watermark(spark, sf_dir):
    delivered = bindings.table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < at(MARK)))
    return delivered.select(F.max("o_orderdate")).scalar()


@query("ing_08_late_rows", f"""
    SELECT o_orderkey, o_orderdate AS event_time, o_orderdate < {WATERMARK} AS is_late_arriving
    FROM orders WHERE o_orderstatus <> 'F'""")
def late_rows(spark, sf_dir):
    batch = bindings.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F")
    return ingest.annotate_events(batch, "o_orderdate", _watermark(spark, sf_dir)).select("o_orderkey", "event_time", "is_late_arriving")


@query("ing_09_watermark", with_ctes(
    """SELECT source_name, greatest(event_time_watermark, newest) AS event_time_watermark FROM source_state
       JOIN (SELECT source_name, max(l_shipdate) AS newest FROM source_log WHERE l_returnflag = 'R' GROUP BY 1) USING (source_name)""",
    "source_log", "source_state"))
def watermark(spark, sf_dir):
    state = bindings.source_state(spark, sf_dir)
    batch = bindings.ingest_log(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    newest = batch.groupBy("source_name").agg(F.max("l_shipdate").alias("_newest"))
    mark = ingest.advanced_watermark(F.col("event_time_watermark"), F.col("_newest")).alias("event_time_watermark")
    return state.join(newest, "source_name").select("source_name", mark)


@query("ing_10_provenance", f"SELECT o_orderkey, {RUN} AS ingested_at, 'orders' AS source_name FROM orders")
def provenance(spark, sf_dir):
    rows = bindings.table(spark, sf_dir, "orders").select("o_orderkey")
    return ingest.add_provenance(rows, "orders", shared.as_of())


MONTHS = """SELECT run, n AS current_rows, lag(n) OVER (ORDER BY run) AS previous_rows
            FROM (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS run, count(*) AS n FROM orders GROUP BY 1)"""


@query("ing_11_volume_change", f"""
    SELECT run, current_rows, previous_rows, current_rows::DOUBLE / previous_rows AS volume_ratio,
           coalesce(current_rows::DOUBLE / previous_rows >= 2, false) AS volume_spike_detected,
           coalesce(current_rows::DOUBLE / previous_rows <= 0.5, false) AS volume_drop_detected FROM ({MONTHS})""")
def volume_change(spark, sf_dir):
    """Rows of every month against the month before. The window sees one row per month."""
    from pyspark.sql import Window

    months = bindings.table(spark, sf_dir, "orders").groupBy(
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("run")).agg(F.count("*").alias("current_rows"))
    months = months.withColumn("previous_rows", F.lag("current_rows").over(Window.orderBy("run")))
    return ingest.volume_change(months, F.col("current_rows"), F.col("previous_rows"))


FRESHNESS_CTES = {
    "ages": f"""
        SELECT r.source_name, coalesce(o.status, 'unknown') AS ingest_status, last_ingested_at, event_time_watermark,
               coalesce(r.freshness_update_sla_hours, 24.0::DOUBLE) AS update_sla_hours,
               date_sub('microsecond', last_ingested_at, {RUN}) / 3.6e9::DOUBLE AS since,
               greatest(0.0::DOUBLE, date_sub('microsecond', event_time_watermark, last_ingested_at) / 3.6e9::DOUBLE) AS delay
        FROM source_registry r LEFT JOIN source_state USING (source_name) LEFT JOIN source_outcomes o USING (source_name)""",
    "freshness": f"""
        SELECT {RUN} AS run_timestamp, source_name, ingest_status, last_ingested_at, event_time_watermark, update_sla_hours,
               round(since, 4) AS hours_since_last_update, coalesce(since > update_sla_hours, true) AS missing_updates,
               24.0::DOUBLE AS ingestion_delay_sla_hours,
               CASE WHEN event_time_watermark IS NOT NULL THEN round(delay, 4) END AS ingestion_delay_hours,
               coalesce(event_time_watermark IS NOT NULL AND delay > 24, false) AS ingestion_delay_breached FROM ages""",
}


@query("ing_12_freshness_report", with_ctes(
    "SELECT * FROM freshness", "source_registry", "source_state", "source_outcomes", **FRESHNESS_CTES))
def freshness_report(spark, sf_dir):
    return shared.freshness(spark, sf_dir)


@query("ing_13_parse_times", f"""
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('day', ts)::TIMESTAMP
                     WHEN 'click' THEN date_trunc('second', ts)::TIMESTAMP - INTERVAL 90 MINUTE ELSE ts END AS parsed
    FROM events WHERE {iso('ts')} IS NOT NULL""")
def parse_times(spark, sf_dir):
    """Full times, dates, times with an offset and text that is no time."""
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "error", F.concat(F.lit("at "), F.col("props")))
        .when(kind == "view", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "click", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:30")))
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise(iso_text(ts))
    )
    return bindings.table(spark, sf_dir, "events").select("event_id", parse_iso(text).alias("parsed"))


@query("ing_14_planned_outcomes", with_ctes(
    """SELECT source_name, row_count, content_hash,
              CASE WHEN enabled IS false THEN 'disabled'
                   WHEN content_hash IS NOT DISTINCT FROM last_file_hash AND last_output_path IS NOT NULL THEN 'skipped'
                   ELSE 'ingest' END AS status
       FROM source_registry LEFT JOIN prints USING (source_name) LEFT JOIN known USING (source_name)""",
    "source_outcomes", "source_registry", **PRINTS))
def planned_outcomes(spark, sf_dir):
    registry, prints, state = _prints_and_state(spark, sf_dir)
    return ingest.planned_outcome(registry, state, prints)


@query("ing_14_no_work_rows", with_ctes(
    """SELECT source_name, CASE WHEN enabled IS false THEN 'disabled' ELSE 'skipped' END AS status, 0::BIGINT AS rows,
              0::BIGINT AS changed_rows, 0::BIGINT AS late_arriving_rows, NULL::DOUBLE AS volume_ratio,
              false AS volume_spike_detected, false AS volume_drop_detected, NULL::VARCHAR AS error
       FROM source_registry LEFT JOIN prints USING (source_name) LEFT JOIN known USING (source_name)
       WHERE enabled IS false OR (content_hash IS NOT DISTINCT FROM last_file_hash AND last_output_path IS NOT NULL)""",
    "source_outcomes", "source_registry", **PRINTS))
def no_work_rows(spark, sf_dir):
    registry, prints, state = _prints_and_state(spark, sf_dir)
    return ingest.no_work_outcome(ingest.planned_outcome(registry, state, prints))


@query("ing_15_replay_failed_only", with_ctes(
    """SELECT source_name, row_count, content_hash, CASE WHEN enabled IS false THEN 'disabled'
              WHEN last_status IS DISTINCT FROM 'failed' THEN 'not_failed' ELSE 'ingest' END AS status
       FROM source_registry LEFT JOIN prints USING (source_name) LEFT JOIN known USING (source_name)""",
    "source_outcomes", "source_registry", **PRINTS))
def replay_failed_only(spark, sf_dir):
    registry, prints, state = _prints_and_state(spark, sf_dir)
    return ingest.planned_outcome(registry, state, prints, force=True, failed_only=True)


OUTCOME_CTES = {
    "outcomes": """
        SELECT source_name, status, CASE WHEN m THEN rows ELSE 0 END AS rows, CASE WHEN m THEN rows ELSE 0 END AS changed_rows,
               CASE WHEN m THEN late_arriving_rows ELSE 0 END AS late_arriving_rows, q AS volume_ratio,
               coalesce(q >= 1.05::DOUBLE, false) AS volume_spike_detected, coalesce(q <= 0.95::DOUBLE, false) AS volume_drop_detected
        FROM (SELECT *, status = 'ingested' AS m,
                     CASE WHEN status = 'ingested' AND returned > 0 THEN accepted::DOUBLE / returned END AS q FROM source_outcomes)""",
}


@query("ing_14_outcomes", with_ctes("SELECT * FROM outcomes", "source_outcomes", **OUTCOME_CTES))
def outcomes(spark, sf_dir):
    return shared.outcomes(spark, sf_dir)


ROLLUP = """
    SELECT CAST(coalesce(sum(rows), 0) AS BIGINT) AS bronze_rows_ingested,
           CAST(coalesce(sum(changed_rows), 0) AS BIGINT) AS bronze_changed_rows,
           CAST(coalesce(sum(late_arriving_rows), 0) AS BIGINT) AS bronze_late_arriving_rows,
           count(*) FILTER (volume_spike_detected) AS volume_spike_detected_sources,
           count(*) FILTER (volume_drop_detected) AS volume_drop_detected_sources,
           count(*) FILTER (status = 'failed') AS bronze_failed_sources,
           count(*) FILTER (status IN ('skipped', 'no_changes')) AS bronze_idempotent_skips FROM outcomes"""


@query("ing_16_run_rollup", with_ctes(ROLLUP, "source_outcomes", **OUTCOME_CTES))
def run_rollup(spark, sf_dir):
    return ingest.run_rollup(shared.outcomes(spark, sf_dir))


@query("ing_16_rollup_metrics", with_ctes(
    f"""SELECT {RUN} AS metric_timestamp, metric_name, CAST(metric_value AS DOUBLE) AS metric_value
        FROM (UNPIVOT rollup ON COLUMNS(*) INTO NAME metric_name VALUE metric_value)""",
    "source_outcomes", **OUTCOME_CTES, rollup=ROLLUP))
def rollup_metrics(spark, sf_dir):
    return ingest.rollup_metrics(ingest.run_rollup(shared.outcomes(spark, sf_dir)), shared.as_of())


@query("ing_17_volume_report", with_ctes(
    "SELECT source_name, status, volume_ratio, volume_spike_detected, volume_drop_detected FROM outcomes",
    "source_outcomes", **OUTCOME_CTES))
def volume_report(spark, sf_dir):
    return ingest.volume_report(shared.outcomes(spark, sf_dir))


@query("ing_18_reliability_report", with_ctes(
    f"""SELECT {RUN} AS run_timestamp, (SELECT count(*) FROM source_registry WHERE enabled IS NOT false) AS enabled_sources,
               bronze_failed_sources AS failed_sources, bronze_idempotent_skips AS idempotent_skips,
               (SELECT count(*) FROM freshness WHERE missing_updates) AS freshness_missing_updates_sources,
               (SELECT count(*) FROM freshness WHERE ingestion_delay_breached) AS freshness_ingestion_delay_breached_sources,
               volume_spike_detected_sources, volume_drop_detected_sources, true AS retry_failed_ingestion_supported,
               'failed_only' AS retry_failed_ingestion_arg FROM rollup""",
    "source_registry", "source_state", "source_outcomes", **FRESHNESS_CTES, **OUTCOME_CTES, rollup=ROLLUP))
def reliability_report(spark, sf_dir):
    return ingest.reliability_report(
        bindings.ingest_registry(spark, sf_dir), shared.outcomes(spark, sf_dir), shared.freshness(spark, sf_dir), shared.as_of())
