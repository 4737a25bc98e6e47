"""Content hashes of rows and of whole tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.functions.text import has_text, strip

SEPARATOR = "\u0001"


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over ``name=value`` of the columns in name order; nulls and empty texts are left out.

    A column added later hashes like one that was always there and empty, so
    stored hashes stay comparable while feeds grow columns.
    """
    pairs = []
    for c in sorted(columns):
        value = F.col(f"`{c}`").cast("string")
        pairs.append(F.when(value != "", F.concat(F.lit(f"{c}="), value)))
    return F.sha2(F.concat_ws(SEPARATOR, *pairs), 256)


def hash_weight(digest: Column) -> Column:
    """The first 60 bits of a hex digest as a number that can be summed in any order."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")


def owner_mask(owner: Column) -> Column:
    digest = F.substring(F.sha2(strip(owner), 256), 1, 10)
    return F.when(has_text(owner), F.concat(F.lit("OWNER_"), digest)).otherwise(F.lit("UNKNOWN"))


def owner_prefix_mask(owner: Column) -> Column:
    return F.concat(F.substring(owner, 1, 3), F.lit("***"))
