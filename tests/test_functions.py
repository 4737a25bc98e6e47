import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattlake.functions import hashing, numbers, text, times


def one(spark, column, **values):
    names = list(values)
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names)) if names else spark.range(1)
    return frame.select(column.alias("x")).first().x


def many(spark, make, rows):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r.x for r in frame.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


WORDS = ["guinea-bissau", "cote d'ivoire", "US", "3m plant", "ßtrasse", "ünter den linden", "a b", "", "o'NEIL-x2y"]


def test_strip_and_clean_know_every_blank(spark):
    rows = ["\tn/a ", " x　", " a \t\n b ", "\x1fy\x85", ""]
    assert many(spark, text.strip, rows) == [r.strip() for r in rows]
    assert many(spark, text.clean_text, rows) == [" ".join(r.strip().lower().split()) for r in rows]


def test_title_case_is_pythons(spark):
    assert many(spark, text.title_case, WORDS) == [w.title() for w in WORDS]


def test_placeholders(spark):
    rows = ["\tN/A ", "0", "--", "Unknown", " ok ", None, "none of them"]
    assert many(spark, text.placeholder_to_null, rows) == [None, None, None, None, "ok", None, "none of them"]


def test_has_text_and_lacks_text(spark):
    rows = ["x", "  ", "", None]
    assert many(spark, text.has_text, rows) == [True, False, False, None]
    assert many(spark, text.lacks_text, rows) == [False, True, True, True]


def test_small_values_are_summed_whole(spark):
    df = spark.createDataFrame([(4e-7,)] * 1000 + [(None,)], "x double")
    assert abs(df.agg(numbers.total(F.col("x"))).first()[0] - 4e-4) < 1e-15


def test_immense_values_are_summed(spark):
    for rows, expected in (([1.0, float("inf")], float("inf")), ([1e30, 1e30], 2e30), ([1.0, None], 1.0)):
        df = spark.createDataFrame([(r,) for r in rows], "x double")
        assert df.agg(numbers.total(F.col("x"))).first()[0] == expected


def test_counts_of_any_size(spark):
    assert many(spark, numbers.to_long, ["3000000000", "3e9", "9007199254740993", "x", None]) == [
        3_000_000_000, 3_000_000_000, 9_007_199_254_740_993, None, None]


def test_nan_is_no_number(spark):
    assert many(spark, numbers.to_double, ["NaN", "1.5", "x", None]) == [None, 1.5, None, None]


def test_sums_of_nothing(spark):
    nulls = spark.createDataFrame([(None,)], "x double")
    assert nulls.agg(numbers.total(F.col("x"))).first()[0] == 0.0


def test_numbers_from_text(spark):
    assert many(spark, numbers.to_int, ["2018", "2018.0", "x", None, "1e400"]) == [2018, 2018, None, None, None]
    assert many(spark, numbers.whole_year_text, ["2018.0", "1999.6", "y"]) == ["2018", "2000", None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_times_do_not_depend_on_the_session_zone(spark, zone):
    rows = ["2026-01-01T00:00:00+00:00", "2026-01-01T01:30:00+01:30", "2026-01-01T00:00:00Z", "2026-01-01 00:00:00", "2026-01-01", "then", None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert many(spark, times.parse_iso, rows) == [dt.datetime(2026, 1, 1)] * 5 + [None, None]
        gap = times.whole_units_between("HOUR", times.at("2026-03-08 00:00:00"), times.at("2026-03-09 00:00:00"))
        assert one(spark, gap) == 24  # a day on which New York clocks change
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_iso_text_round_trip(spark):
    assert one(spark, times.iso_text(times.parse_iso(F.col("v"))), v="2024-01-01T00:00:07.179575+00:00") == "2024-01-01T00:00:07.179575+00:00"


def test_year_start(spark):
    frame = spark.createDataFrame([(2018.0,), (99.0,), (None,)], "y double").select(times.year_start(F.col("y")).alias("x"))
    assert [r.x for r in frame.collect()] == [dt.datetime(2018, 1, 1), None, None]


def test_owner_mask(spark):
    assert many(spark, hashing.owner_mask, [" Sample Utility ", " ", None]) == ["OWNER_ede182a129", "UNKNOWN", "UNKNOWN"]


def test_row_hash(spark):
    frame = spark.createDataFrame([(None, "a", None), ("a", None, "")], "p string, q string, r string")
    a, b = [r.h for r in frame.select(hashing.row_hash(["q", "p"]).alias("h")).collect()]
    assert a == hashlib.sha256(b"q=a").hexdigest() and b == hashlib.sha256(b"p=a").hexdigest()
    wider = [r.h for r in frame.select(hashing.row_hash(["q", "p", "r"]).alias("h")).collect()]
    assert wider == [a, b]  # columns that hold nothing do not count


#: Latin letters that the engine's version of Unicode gives another case than Python's.
OTHER_CASE = {"\u019b": "\ua7dc"}


def test_title_case_beyond_pythons_unicode(spark):
    assert many(spark, text.title_case, list(OTHER_CASE)) == list(OTHER_CASE.values())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(
    max_codepoint=0x24F, exclude_categories=["Cs", "Cc", "Lm", "Lt"], exclude_characters=[*OTHER_CASE]), max_size=12), min_size=20, max_size=40))
def test_title_case_on_latin_text(spark, rows):
    assert many(spark, text.title_case, rows) == [_python_title(r) for r in rows]


def _python_title(value):
    """Python capitalises after every uncased character; the engine after every non-letter."""
    import regex

    pieces = regex.findall(r"\p{L}+|[^\p{L}]+", value.lower())
    return "".join(p[:1].title() + p[1:] for p in pieces)
