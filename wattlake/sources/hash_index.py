"""What rows a source has at present, found by their hash, without moving what is known.

One row per sighting: a row hash with its key, when it was seen, and whether the row lives or is gone. The table is
bucketed and sorted by the hash, so comparing a feed with it shuffles the feed alone, and an ingest adds the sightings of
the rows that it changed, never the others. ``compact`` makes one file per bucket of what lives. Hashes move between
tasks as 32 bytes, not as the 64 digits that they are in tables, once a comparison, and what moved goes with its write.

The catalogue of a session may forget the table; its files and the number of buckets, which is part of the path, say all.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import FREES_SHUFFLES, settings
from wattlake.sources.sinks import VersionedTable, listed


#: Digits of hashes take half their length in files.
WRITES = {FREES_SHUFFLES: "true", "spark.sql.parquet.compression.codec": "zstd"}


class RowHashIndex:
    SIGHTING = "row_hash STRING, key STRING, seen BIGINT, live BOOLEAN"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _folder(self) -> str:
        """Where the sightings are: a new place after each compaction."""
        current = VersionedTable(self.spark, f"{self.path}/compacted").read()
        return f"{self.path}/{'first' if current is None else current.first().place}-{self.buckets}"

    def _table(self, folder: str) -> str:
        name = f"row_hashes_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self.SIGHTING}) USING parquet "
            f"CLUSTERED BY (row_hash) SORTED BY (row_hash) INTO {self.buckets} BUCKETS LOCATION '{folder}'")
        self.spark.catalog.refreshTable(name)
        return name

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` in the buckets of their hashes."""
        digits = F.lower(F.hex("row_hash"))
        return rows.withColumn("row_hash", F.unhex("row_hash")).repartition(self.buckets, digits).withColumn("row_hash", digits)

    def _add(self, sightings: DataFrame, folder: str) -> None:
        """``sightings`` are dealt already: a task has rows of one bucket."""
        rows = sightings.select("row_hash", "key", F.col("seen").cast("long").alias("seen"), "live")
        name = self._table(folder)
        with settings(self.spark, WRITES):
            rows.write.mode("append").bucketBy(self.buckets, "row_hash").sortBy("row_hash").option("path", folder).saveAsTable(name)

    def exists(self) -> bool:
        return bool(listed(self.spark, self._folder()))

    def live(self) -> DataFrame:
        """(row_hash, key) of the rows that are there at present. The last sighting counts; no shuffle is needed."""
        rows = self.spark.table(self._table(self._folder()))
        last = rows.groupBy("row_hash", "key").agg(F.max(F.struct("seen", "live"))["live"].alias("live"))
        return last.where("live").select("row_hash", "key")

    def unseen(self, hashed: DataFrame) -> DataFrame:
        """Rows of a feed whose hash is not among the living. The hash covers the key, so keys need no look."""
        return self._dealt(hashed).join(self.live().select("row_hash").distinct().hint("merge"), "row_hash", "left_anti").select(hashed.columns)

    def record(self, feed: DataFrame, seen: int | None = None) -> None:
        """Add what a feed (row_hash, key) changes: rows that are new to its keys, and rows that its keys have no more.

        Rows of keys that the feed does not have live on. A feed stands for all rows of its keys, of which there may be any
        number. Recorded twice it adds nothing the second time. Of two feeds the one with the greater ``seen`` came later; by
        default that is the clock's microseconds. ``feed`` is read twice: a table.
        """
        seen = time.time_ns() // 1000 if seen is None else seen
        now = self._dealt(feed.select("row_hash", "key")).distinct()
        if not self.exists():
            self._add(now.select("*", F.lit(seen).alias("seen"), F.lit(True).alias("live")), self._folder())
            return
        known = self.live().select(F.col("row_hash").alias("known_hash"), F.col("key").alias("known_key")).hint("merge")
        both = now.join(known, F.col("row_hash") == F.col("known_hash"), "full_outer")
        new = both.where("known_hash IS NULL").select("row_hash", "key", F.lit(True).alias("live"))
        left = both.where("row_hash IS NULL").select(F.col("known_hash").alias("row_hash"), F.col("known_key").alias("key"))
        # what of the known the feed lacks is little for a whole feed; for a small one its keys are few and are sent to it
        keys = feed.select(F.col("key").alias("of_feed")).distinct()
        gone = left.join(keys, F.col("key") == F.col("of_feed"), "left_semi").select("row_hash", "key", F.lit(False).alias("live"))
        self._add(new.unionByName(self._dealt(gone)).withColumn("seen", F.lit(seen)), self._folder())

    def compact(self) -> None:
        """Leave one sorted file per bucket with what lives; readers of the former files are not disturbed."""
        place = VersionedTable(self.spark, f"{self.path}/compacted")
        name = f"v{(place.current_version() or 0) + 1}"
        if self.exists():
            self._add(self._dealt(self.live()).select("*", F.lit(0).alias("seen"), F.lit(True).alias("live")), f"{self.path}/{name}-{self.buckets}")
            place.replace(self.spark.createDataFrame([(name,)], "place string"))
