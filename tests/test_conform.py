import pytest
from pyspark.sql import functions as F

from wattlake.operators import conform as c
from wattlake.plans.medallion import conformed_batch


def column(df, name, by="i"):
    return [r[name] for r in df.orderBy(by).collect()]


def texts(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")


def test_country_and_fuel_aliases(spark):
    df = texts(spark, ["usa", "UK", "guinea-bissau", "\tn/a ", "0", None, "Cote  d'ivoire"])
    got = column(df.select("i", c.canonical_country(F.col("v")).alias("x")), "x")
    assert got == ["United States", "United Kingdom", "Guinea-Bissau", None, None, None, "Cote  D'Ivoire"]
    fuels = texts(spark, ["natural gas", "Natural \t Gas", "hydroelectric", "tidal", "--"])
    got = column(fuels.select("i", c.canonical_fuel(F.col("v")).alias("x")), "x")
    assert got == ["Gas", "Gas", "Hydro", "Tidal", None]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Plant  ID!", "--Capacity (MW)--"])
    assert c.conform_names(df).columns == ["plant_id", "capacity_mw"]
    with pytest.raises(ValueError):
        c.conform_names(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))


def test_numbers_never_raise(spark):
    df = spark.createDataFrame([("12.5", "x", "7")], "capacity_mw string, latitude string, estimated_generation_gwh_2014 string")
    assert tuple(c.coerce_numbers(df).first()) == (12.5, None, 7.0)


def test_units(spark):
    rows = [(0, 5000.0, "kW "), (1, 2.0, "GW"), (2, 3.0, "MW"), (3, None, None)]
    df = spark.createDataFrame(rows, "i int, capacity_mw double, capacity_unit string")
    df = df.withColumns({"capacity_kw": F.lit("900"), "capacity_gw": F.lit(1.0)})
    assert column(c.standardise_units(df), "capacity_mw") == [5.0, 2000.0, 3.0, 0.9]
    only_gw = spark.createDataFrame([(0, "0.5")], "i int, capacity_gw string")
    assert column(c.standardise_units(only_gw), "capacity_mw") == [500.0]


def test_canonical_columns(spark):
    df = spark.createDataFrame(
        [("G1", "W1", "Alpha", "IND", "India", 1.0, None, 3.0)],
        "gppd_idnr string, wepp_id string, name string, country string, country_long string, "
        "estimated_generation_gwh_2013 double, estimated_generation_gwh_2017 double, estimated_generation_gwh_2015 double",
    )
    row = c.canonical_columns(df).first()
    assert (row.plant_id, row.plant_name, row.country, row.estimated_generation_gwh) == ("G1", "Alpha", "India", 3.0)


def test_each_feed_of_a_batch_may_name_its_columns_otherwise(spark):
    public = spark.createDataFrame([("G1", "Alpha", "IND", "India", "5", "Wind", "2001", "1", "2")],
                                   "gppd_idnr string, name string, country string, country_long string, capacity_mw string, "
                                   "primary_fuel string, commissioning_year string, latitude string, longitude string")
    own = spark.createDataFrame([("P1", "Beta", "Peru", "7", "Hydro", "2002", "3", "4")],
                                "plant_id string, plant_name string, country string, capacity_mw string, primary_fuel string, "
                                "commissioning_year string, latitude string, longitude string")
    got = conformed_batch(public, own).select("plant_id", "plant_name", "country", "capacity_mw").collect()
    assert sorted(map(tuple, got)) == [("G1", "Alpha", "India", 5.0), ("P1", "Beta", "Peru", 7.0)]


def test_geography_defaults_to_other(spark):
    df = spark.createDataFrame([(0, "India"), (1, "Atlantis"), (2, None)], "i int, country string")
    out = c.enrich_geography(df)
    assert column(out, "continent") == ["Asia", "Other", "Other"]
    assert column(out, "sub_region") == ["Southern Asia", "Other", "Other"]


def test_changed_counts_ignore_nulls(spark):
    df = spark.createDataFrame(
        [("usa", "United States", None, "Coal"), ("India", "India", "gas", "Gas"), ("n/a", None, "Oil", "Oil")],
        "raw_country string, country string, raw_fuel string, primary_fuel string",
    )
    assert tuple(c.changed_by_normalising(df).first()) == (1, 1)


def test_event_period_falls_back(spark):
    df = spark.createDataFrame([(0, "2026-02-01T00:00:00+00:00"), (1, "soon")], "i int, last_updated_at string")
    out = c.event_period(df, 2030)
    assert (column(out, "event_year"), column(out, "event_month")) == ([2026, 2030], [2, 1])


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert {tuple(r) for r in c.union_by_name([a, b]).collect()} == {(1, None), (None, "q")}
