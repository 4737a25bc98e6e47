import pytest
from pyspark.sql import functions as F

from wattlake.operators import quality as q
from wattlake.sources.sinks import append_metrics, metric_allowed

ROWS = [
    ("P1", "A", "X", "Coal", 100.0, 2000.0),
    ("P2", None, "Y", "Gas", 200.0, None),
    ("P3", "C", "Z", "Solar", -1.0, 1700.0),
]
SCHEMA = "plant_id string, plant_name string, country string, primary_fuel string, capacity_mw double, commissioning_year double"


@pytest.fixture
def plants(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_split(plants):
    good, bad = q.split(plants)
    assert [r.plant_id for r in good.collect()] == ["P1"]
    assert {r.plant_id: r.dq_reasons for r in bad.collect()} == {
        "P2": ["null_plant_name"],
        "P3": ["range_capacity_mw", "range_commissioning_year"],
    }


def test_bounds_are_inclusive_and_null_passes(spark):
    df = spark.createDataFrame([(0.0001,), (1000000.0,), (0.0,), (None,)], "capacity_mw double")
    assert [r.x for r in df.select(q.out_of_range(F.col("capacity_mw"), (0.0001, 1000000.0)).alias("x")).collect()] == [False, False, True, False]


def test_counts(plants):
    assert {tuple(r) for r in q.null_counts(plants, ["plant_id", "plant_name", "absent"]).collect()} == {("plant_name", 1)}
    assert {tuple(r) for r in q.range_counts(plants).collect()} == {("capacity_mw", 1), ("commissioning_year", 1)}


def test_uniqueness_counts_every_member(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "k string")
    assert tuple(q.uniqueness(df, "k").first()) == (True, 3, False)
    assert tuple(q.uniqueness(df, "other").first()) == (False, 0, False)
    with pytest.raises(q.QualityError):
        q.assert_unique(df, "k")


def test_required_columns(plants):
    assert q.missing_columns(plants.drop("country")) == ["country"]
    with pytest.raises(q.QualityError):
        q.require_columns(plants.drop("country"))


def test_drift():
    assert q.schema_drift([], ["a"])["schema_drift_detected"] is False
    assert q.schema_drift(["a", "b"], ["b", "c"]) == {
        "schema_drift_detected": True, "schema_new_columns": ["c"], "schema_removed_columns": ["a"]}


def test_report_has_the_contract_columns(spark, plants):
    twice = plants.unionByName(plants.filter("plant_id = 'P1'"))
    counts = q.batch_counts(twice)
    report = q.quality_report(counts, F.lit("t"), F.lit("d"))
    row = report.first()
    assert len(report.columns) == 23
    assert (row.input_rows, row.valid_rows, row.malformed_rows, row.duplicate_rows_detected) == (4, 1, 2, 2)
    assert (row.null_issues, row.range_issues) == ('{"plant_name":1}', '{"capacity_mw":1,"commissioning_year":1}')
    assert not row.mandatory_fields_ok and not row.positive_capacity_ok
    assert len(q.checklist_report(report, "a", "b").columns) == 18
    assert len(q.compliance_report(report, None, None, None, "b").columns) == 30


def test_text_flags_are_counted_like_booleans(spark):
    report = spark.createDataFrame([("True",), ("false",), ("maybe",), (None,)], "missing_updates string")
    assert spark.range(1).select(q.true_count(report, "missing_updates")).first()[0] == 1


def test_metric_policy(spark, root):
    rows = [("bronze_x", 1.0), ("renewable_energy_ratio", 0.5), ("other", 1.0), ("gold_y", float("nan")), ("gold_z", float("inf")), (None, 1.0)]
    df = spark.createDataFrame(rows, "metric_name string, metric_value double")
    got = [r.x for r in df.select(metric_allowed(F.col("metric_name"), F.col("metric_value")).alias("x")).collect()]
    assert got == [True, True, False, False, False, False]
    with pytest.raises(Exception, match="metric not allowed"):
        append_metrics(df.withColumn("metric_timestamp", F.lit("t")), root, "run-1")


def test_contract_outcomes(spark, plants):
    tests = [("not_null", "p", "plant_name"), ("not_null", "p", "country"), ("unique", "p", "primary_fuel")]
    got = {r.test: (r.failures, r.should_error) for r in q.contract_outcomes({"p": plants}, tests).collect()}
    assert got == {"not_null_p_plant_name": (1, True), "not_null_p_country": (0, False), "unique_p_primary_fuel": (0, False)}


def test_objectives(spark, plants):
    report = q.quality_report(q.batch_counts(plants), F.lit("t"), F.lit("d"))
    got = {r.objective: r.objective_met for r in q.objectives(report, F.lit(3)).collect()}
    assert got == {"duplicate_keys": True, "mandatory_null_rate": False, "freshness_lag_hours": True, "quarantine_ratio": False}
