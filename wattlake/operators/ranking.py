"""Numbers and ranks of rows in an order, found by range partitions instead of one window over everything.

Rows are dealt to partitions by ranges of the order and sorted there. How many rows every partition has before a row, and
how many the partitions before it have, give the row's position. So a group with all the rows, or values with one common
beginning, are as many tasks as their rows need; what is summed over partitions is one row per partition and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import new_folder

_PLACE = 33  # bits of monotonically_increasing_id below the number of the partition


def ranges(df: DataFrame, order: Sequence[Column | str], pieces: int | None = None) -> DataFrame:
    """``df`` in ``order``, cut into pieces of about equal size: ``_part`` is a row's piece, ``_row`` grows within it.

    Rows that ``order`` does not tell apart lie in one piece. The pieces are a table, so they are the same to all readers.
    """
    path = new_folder(df.sparkSession, "ranges")
    dealt = (df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path)
    return placed.select(
        *df.columns, F.shiftright("_at", _PLACE).alias("_part"), F.col("_at").bitwiseAND((1 << _PLACE) - 1).alias("_row"))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str = "position") -> DataFrame:
    """``df`` with each row's position (from 0) among the rows with its values of ``by``, in ``order``.

    Rows that ``order`` does not tell apart lie in one partition; where there may be many of them, end it with a column
    that tells them apart. Nulls in ``by`` are a value like others.
    """
    names = df.columns
    placed = ranges(df, [*(F.col(c).asc_nulls_first() for c in by), *order])
    spans = placed.groupBy("_part", *by).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select(
        F.col("_part").alias("_of_part"), *(F.col(c).alias(f"_of_{k}") for k, c in enumerate(by)),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    same = F.col("_part") == F.col("_of_part")
    for k, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_of_{k}"))
    return placed.join(offsets, same).select(*names, (F.col("_row") + F.col("_offset")).alias(out))


def ranked(df: DataFrame, value: str, descending: bool = True, out: str = "rank") -> DataFrame:
    """``df`` with the rank of each row's ``value``: one more than the rows before it, equal values alike, nulls last.

    Rows of one value become one row before they are put in order, so ties meet in no task; the rows before a piece come
    from a window over one row per piece. ``df`` is written first, so its plan runs once.
    """
    path = new_folder(df.sparkSession, "ranked")
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    values = rows.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    placed = ranges(values, [F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_last()])
    within = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    pieces = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(F.col("_part").alias("_of")).agg(F.sum("_n").alias("_sum"))
    sums = sums.select("_of", F.coalesce(F.sum("_sum").over(pieces), F.lit(0)).alias("_offset"))
    own = placed.select("_value", "_part", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_within"))
    ranks = own.join(sums, F.col("_part") == F.col("_of")).select(
        "_value", (F.col("_offset") + F.col("_within") + 1).cast("int").alias(out))
    return rows.join(ranks, rows[value].eqNullSafe(ranks["_value"])).select(*df.columns, out)
