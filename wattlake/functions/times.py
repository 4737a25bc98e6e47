"""Time expressions, all on TIMESTAMP_NTZ in UTC so that no session setting matters."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT")
_HAS_ZONE = r"(?i)(Z|[+-]\d{2}:?\d{2})$"


def _session_is_utc() -> bool:
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def parse_iso(text: Column) -> Column:
    """UTC time of an ISO-8601 text; text without a zone is UTC; bad text gives null."""
    text = text.cast("string")
    if _session_is_utc():
        return text.try_cast("timestamp").cast("timestamp_ntz")  # the cast itself reads unzoned text as UTC
    zoned = (
        F.when(F.regexp_like(text, F.lit(_HAS_ZONE)), text)
        .when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )
    instant = zoned.try_cast("timestamp")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def iso_text(time: Column) -> Column:
    return F.concat(F.date_format(time.cast("timestamp_ntz"), ISO_FORMAT), F.lit("+00:00"))


def year_start(year: Column) -> Column:
    """1 January of a four-digit year given as a number; anything else gives null."""
    whole = year.cast("double").try_cast("int")
    return F.when(
        whole.between(1000, 9999),
        F.make_timestamp_ntz(whole, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
    )


def at(time: str) -> Column:
    """A point in time from a literal such as ``2025-01-01 00:00:00``."""
    return F.lit(time).cast("timestamp_ntz")


def instant(time: Column) -> Column:
    """The point in time a UTC wall time names, whatever the zone of the session."""
    if not _session_is_utc():
        time = F.convert_timezone(F.lit("UTC"), F.current_timezone(), time)
    return time.cast("timestamp")


def whole_units_between(unit: str, start: Column, end: Column) -> Column:
    """Whole units between two wall times; Spark compares them as such in any session zone."""
    return F.timestamp_diff(unit, start, end)


def hours_between(start: Column, end: Column) -> Column:
    """Hours as a fraction."""
    return whole_units_between("MICROSECOND", start, end) / F.lit(3.6e9)
