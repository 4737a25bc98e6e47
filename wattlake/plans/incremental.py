"""Gold facts kept up from what changed in silver.

Kept are, for every bucket of the silver table, the sums of its plants by all that facts group by. After a change of
silver the sums of the buckets that it wrote are taken anew, from these buckets alone, and replace the old ones; facts are
sums over these sums. Nothing is subtracted, so a total has no rounding left of rows that have gone, infinite values do
no harm, and a group without plants is there no more.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.numbers import total
from wattlake.sources.sinks import KeyedTable

#: What any fact or dimension groups by, and what it adds up.
GROUPS = ("country", "primary_fuel", "event_year", "event_month", "continent", "sub_region")
SUMS = ("capacity_mw", "estimated_generation_gwh")


def partial_sums(silver: DataFrame, *by: str) -> DataFrame:
    """Sums under the names of what they add up, so a fact of sums is stated like a fact of plants."""
    groups = [c for c in GROUPS if c in silver.columns]
    sums = [total(F.col(c)).alias(c) for c in SUMS if c in silver.columns]
    return silver.groupBy(*by, *groups).agg(*sums, F.count("*").alias("plants"))


class GoldSums:
    """The sums of every silver bucket, as (bucket, groups, sums, plants)."""

    def __init__(self, spark: SparkSession, silver: KeyedTable, path: str, buckets: int = 64):
        self.spark, self.silver = spark, silver
        self.table = KeyedTable(spark, path, "bucket", buckets)

    def stale(self) -> list[int]:
        """Silver buckets written or gone since the sums were last taken."""
        now, then = self.silver.places(), self._taken()
        return sorted(b for b in now.keys() | then.keys() if now.get(b) != then.get(b))

    def _taken(self) -> dict[int, str]:
        remark = self.table.remark()
        return {int(b): f for b, f in json.loads(remark).items()} if remark else {}

    def refresh(self) -> DataFrame:
        """The sums as silver stands, of which only stale buckets are read."""
        now, stale = self.silver.places(), self.stale()
        if stale or self.table.current_version() is None:
            keys = self.spark.createDataFrame([(b,) for b in stale], "bucket int")
            rows = self.silver.rows_in([b for b in stale if b in now])
            anew = partial_sums(rows.withColumn("bucket", self.silver.bucket_of_rows()), "bucket")

            def replaced(old: DataFrame | None) -> DataFrame:
                return anew if old is None else old.join(keys, "bucket", "left_anti").unionByName(anew, allowMissingColumns=True)

            self.table.change_keys(keys, replaced, remark=json.dumps(now))
        return self.table.read()
