"""Two-window replay through all three jobs, with values worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from wattlake.plans.bronze import run_bronze
from wattlake.plans.gold import run_charts, run_gold
from wattlake.plans.silver import run_silver, silver_table
from wattlake.functions.times import at
from wattlake.operators.quality import row_counts
from wattlake.plans.views import plant
from wattlake.plans.views.registry import VIEWS, open_lake, register_all
from wattlake.sources.registry import registry_of

HEADER = (
    "Plant ID,plant_name,country,primary_fuel,capacity_mw,commissioning_year,latitude,longitude,"
    "estimated_generation_gwh,owner,last_updated_at"
)
BASE = [
    "SIM-001,Alpha Solar One,India,Solar,120,2018,23.5937,78.9629,210,Sample Utility,2026-01-01T00:00:00+00:00",
    "SIM-002,Beta Hydro Station,Brazil,Hydro,310,2012,-14.2350,-51.9253,980,Grid Operator,2026-01-01T00:00:00+00:00",
]
INCREMENT = [
    "SIM-001,Alpha Solar One,India,Solar,125,2018,23.5937,78.9629,225,Sample Utility,2026-02-01T00:00:00+00:00",
    "SIM-003,Gamma Wind Farm,United States,Wind,200,2020,37.0902,-95.7129,450,Regional Energy,2026-02-01T00:00:00+00:00",
]
SOURCES = [
    {"source_name": "plants_v2", "format": "csv", "path": "plants.csv", "primary_key": "Plant ID", "event_time_column": "commissioning_year"},
    {"source_name": "plants_off", "enabled": False, "format": "csv", "path": "none.csv"},
    {"source_name": "plants", "format": "csv", "path": "missing.csv", "primary_key": "plant_id"},
]


def write_feed(folder, rows):
    (folder / "plants.csv").write_text("\n".join([HEADER, *rows]) + "\n")


def by_source(outcomes):
    return {r.source_name: r for r in outcomes.collect()}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    root = str(folder / "lake")
    registry = registry_of(spark, SOURCES)
    seen = {}

    def run(name, rows, as_of, **options):
        write_feed(folder, rows)
        seen[name] = by_source(run_bronze(spark, registry, root, as_of, base=str(folder), **options))

    run("base", BASE, "2026-01-02 00:00:00")
    seen["silver_base"] = run_silver(spark, registry, root, "2026-01-02 00:00:00", "r1").collect()
    run("increment", INCREMENT, "2026-02-02 00:00:00")
    seen["silver"] = {r.plant_id: r for r in run_silver(spark, registry, root, "2026-02-02 00:00:00", "r2").collect()}
    run("again", INCREMENT, "2026-02-03 00:00:00")
    run("failed_only", INCREMENT, "2026-02-04 00:00:00", failed_only=True)
    run("reordered", INCREMENT[::-1], "2026-02-05 00:00:00")
    run("old_version", BASE[:1], "2026-02-06 00:00:00")
    seen["gold"] = run_gold(spark, root, "2026-02-02 00:00:00")
    seen["manifest"] = run_charts(spark, root, "2026-02-02 00:00:00").collect()
    seen["root"], seen["folder"], seen["registry"] = root, folder, registry
    return seen


def test_first_run_ingests_everything_and_isolates_failures(lake):
    first = lake["base"]
    assert (first["plants_v2"].status, first["plants_v2"].changed_rows, first["plants_v2"].volume_ratio) == ("ingested", 2, None)
    assert first["plants_off"].status == "disabled"
    assert first["plants"].status == "failed" and first["plants"].error
    assert len(lake["silver_base"]) == 2


def test_increment_counts(lake):
    r = lake["increment"]["plants_v2"]
    assert (r.changed_rows, r.late_arriving_rows, r.volume_ratio) == (2, 0, 1.0)
    assert not r.volume_spike_detected and not r.volume_drop_detected


def test_same_content_is_skipped_in_any_row_order(lake):
    assert lake["again"]["plants_v2"].status == "skipped"
    assert lake["reordered"]["plants_v2"].status == "skipped"
    assert lake["failed_only"]["plants_v2"].status == "not_failed"
    assert lake["failed_only"]["plants"].status == "failed"


def test_older_version_of_a_row_is_a_change_and_a_volume_drop(lake):
    r = lake["old_version"]["plants_v2"]
    assert (r.status, r.changed_rows, r.volume_ratio, r.volume_drop_detected) == ("ingested", 1, 0.5, True)
    assert r.late_arriving_rows == 1  # 2018 is before the 2020 already seen


def test_silver_merges_and_enriches(lake):
    silver = lake["silver"]
    assert set(silver) == {"SIM-001", "SIM-002", "SIM-003"}
    assert (silver["SIM-001"].capacity_mw, silver["SIM-001"].estimated_generation_gwh) == (125.0, 225.0)
    regions = {k: (r.continent, r.sub_region) for k, r in silver.items()}
    assert regions == {
        "SIM-001": ("Asia", "Southern Asia"),
        "SIM-002": ("South America", "South America"),
        "SIM-003": ("North America", "Northern America"),
    }
    assert {k: r.event_year for k, r in silver.items()} == {"SIM-001": 2018, "SIM-002": 2012, "SIM-003": 2020}


def test_gold_values(lake, spark):
    gold = lake["gold"]
    capacity = {(r.country, r.primary_fuel): (r.total_capacity_mw, r.renewable_capacity_mw) for r in gold["fact_plant_capacity"].collect()}
    assert capacity == {("India", "Solar"): (125, 125), ("Brazil", "Hydro"): (310, 310), ("United States", "Wind"): (200, 200)}
    assert gold["fact_power_generation"].agg(F.sum("total_generation_gwh")).first()[0] == 1655
    kpi = spark.read.json(f"{lake['root']}/audit/mandatory_kpi_report").first()
    assert (kpi.total_generation_capacity_mw, kpi.renewable_energy_ratio) == (635, 1.0)
    assert round(kpi.average_plant_capacity_mw, 4) == 211.6667
    masks = {r.plant_id: r.owner_masked for r in gold["dim_plant"].collect()}
    assert masks["SIM-001"] == "OWNER_ede182a129"
    assert lake["manifest"][0]["count"] == 3


def test_utilisation_of_the_fixture(lake, spark):
    silver = silver_table(spark, lake["root"]).read()
    seen = {r.plant_id: round(r.utilization_ratio, 5) for r in plant.underutilized_plants({"stg_power_plants": silver}).collect()}
    assert seen == {"SIM-001": 0.20548, "SIM-002": 0.36088, "SIM-003": 0.25685}


def test_reports_are_kept_per_run(lake, spark):
    audit = f"{lake['root']}/audit"
    quality = spark.read.option("header", True).csv(f"{audit}/silver_quality_report").orderBy("run_timestamp").collect()
    assert [(r.input_rows, r.valid_rows, r.malformed_rows) for r in quality] == [("2", "2", "0"), ("2", "3", "0")]
    assert quality[0].dataset == "plants,plants_v2"
    compliance = spark.read.option("header", True).csv(f"{audit}/dq_mandatory_compliance_report").drop("run").collect()
    assert len(compliance) == 2 and len(compliance[0]) == 30
    assert {r.failed_ingestion_jobs for r in compliance} == {"1"}


def test_every_stage_reports_its_metrics(lake, spark):
    names = {r.metric_name for r in spark.read.parquet(f"{lake['root']}/audit/metrics").select("metric_name").distinct().collect()}
    assert len(names) == 38
    assert {"bronze_rows_ingested", "silver_valid_rows", "gold_rows_fact_capacity", "visualizations_generated"} <= names


def test_every_view_answers_over_the_lake(lake, spark):
    tables = open_lake(spark, lake["root"])
    register_all(tables, at("2026-02-03 00:00:00"))
    counts = row_counts({name: spark.table(name) for name in VIEWS})
    found = {r.view_name: r.row_count for r in counts.collect()}
    assert set(found) == set(VIEWS)
    assert found["vw_power_generation_country_capacity"] == 3 and found["vw_monitoring_dq_failure_breakdown"] == 2
    kpi = spark.sql("SELECT total_generation_capacity_mw, renewable_energy_ratio FROM vw_power_generation_kpi_summary").first()
    assert tuple(kpi) == (635.0, 1.0)
    assert spark.sql("SELECT lag_hours FROM vw_monitoring_freshness WHERE source_name = 'plants'").first().lag_hours is None


def test_silver_is_the_same_when_run_again(lake, spark):
    """The newest bronze batch is the old version of one plant: merging it twice changes nothing more."""
    root, registry = lake["root"], lake["registry"]
    once = run_silver(spark, registry, root, "2026-02-07 00:00:00", "r3")
    rows = sorted(map(str, once.drop("ingested_at").collect()))
    twice = run_silver(spark, registry, root, "2026-02-07 00:00:00", "r4")
    assert sorted(map(str, twice.drop("ingested_at").collect())) == rows


def test_governance_documents(lake, spark):
    docs = spark.read.json(f"{lake['root']}/audit/governance/schema_documentation")
    assert docs.select("dataset").distinct().count() == 9
    edges = [json.loads(x) for x in spark.read.json(f"{lake['root']}/audit/governance/data_lineage").toJSON().collect()]
    assert len(edges) == 9 and all(e["to_rows"] > 0 for e in edges)


@pytest.fixture
def feeds(spark, tmp_path):
    """A lake of one source, with jobs that run at a given day."""
    registry, root = registry_of(spark, [dict(SOURCES[0], primary_key="Plant ID")]), str(tmp_path / "lake")

    def bronze(day, rows):
        write_feed(tmp_path, rows)
        return by_source(run_bronze(spark, registry, root, f"2026-03-{day:02d} 00:00:00", base=str(tmp_path)))["plants_v2"]

    def silver(day, run_id=None):
        return {r.plant_id for r in run_silver(spark, registry, root, f"2026-03-{day:02d} 00:00:00", run_id or f"s{day}").collect()}

    return bronze, silver, root


def test_silver_takes_every_ingest_since_its_last_run(feeds, spark):
    bronze, silver, root = feeds
    bronze(1, BASE)
    bronze(2, [*BASE, INCREMENT[1]])
    assert silver(3) == {"SIM-001", "SIM-002", "SIM-003"}
    assert silver(3) == {"SIM-001", "SIM-002", "SIM-003"}  # the same run again
    report = spark.read.option("header", True).csv(f"{root}/audit/silver_quality_report").collect()
    metrics = spark.read.parquet(f"{root}/audit/metrics").filter("run = 'silver-s3'")
    assert len(report) == 1 and metrics.groupBy("metric_name").count().filter("count > 1").count() == 0


def test_a_run_lost_after_its_write_loses_nothing(feeds, spark, monkeypatch):
    bronze, silver, root = feeds
    bronze(1, BASE)
    assert silver(1) == {"SIM-001", "SIM-002"}
    with monkeypatch.context() as lost:
        lost.setattr("wattlake.plans.bronze.ingest.batch_outcome", lambda rows: 1 / 0)
        assert bronze(2, [*BASE, INCREMENT[1]]).status == "failed"
    again = bronze(2, [*BASE, INCREMENT[1]])
    assert (again.status, again.changed_rows) == ("ingested", 1)
    stored = spark.read.parquet(f"{root}/bronze").filter("`Plant ID` = 'SIM-003'")
    assert stored.count() == 1 and silver(3) == {"SIM-001", "SIM-002", "SIM-003"}


def test_repeated_keys_bring_only_what_changed(feeds):
    bronze, _, _ = feeds
    twin = BASE[0].replace("Alpha", "Omega")
    assert bronze(1, [*BASE, twin]).changed_rows == 3
    assert bronze(2, [*BASE, twin, INCREMENT[1]]).changed_rows == 1
    assert bronze(3, [BASE[1], BASE[0], twin.replace("Omega", "Other"), INCREMENT[1]]).changed_rows == 1


def test_silver_writes_only_the_buckets_of_a_batch(feeds, spark):
    bronze, silver, root = feeds
    many = [BASE[0].replace("SIM-001", f"SIM-{k}").replace("Alpha", f"Alpha{k}") for k in range(100, 400)]
    bronze(1, [*BASE, *many])
    silver(1)
    table = silver_table(spark, root)
    places = lambda: table._manifest(table._entry(table.current_version()).folder)
    before = places()
    bronze(2, [*BASE, *many, INCREMENT[1]])
    assert len(silver(2)) == 303
    after = places()
    assert sum(after[b] != before.get(b) for b in after) == 1 and len(before) > 40
    run_silver(spark, registry_of(spark, [dict(SOURCES[0], primary_key="Plant ID")]), root, "2027-01-01 00:00:00", "next-year")
    assert all(places()[b] != f for b, f in after.items())  # rows without a time are of the year of the run
