"""Exact dedup by a persistent digest index: bucketed and sorted by digest, grown by sort-merge anti-joins.

DataFrame operations only. Two texts are equal when their UTF-8 bytes are; a null text counts as empty. A batch is
added in turns, the larger ids first: what a turn brings is compared with all that the index has, that of earlier turns
included, by a sort-merge anti-join whose one side is bucketed and sorted already, and what is new is appended.

- Of equal texts in one batch the row with the largest id stays. A text the index already holds stays with the id
  it was indexed under, and every row of the new batch goes.
- Null ids come before all others; among rows of one id and text exactly one stays.
- An empty batch gives an empty result and leaves the index as it is. Other columns are never looked at.
- Appending one batch twice adds nothing the second time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm.common import free_name, id_and_text, text_of, written
from wattlake.session import new_folder

#: A digest with at least one row in so many counts as hot, so there are at most that many hot digests.
HOT_SHARE = 1000
#: Buckets of an index, at least, and the rows for which it has one.
BUCKETS = 64
BUCKET_ROWS = 1_000_000
#: Turns in which a batch is added.
TURNS = 2


class DigestIndex:
    """One row per distinct text: ``digest``, ``doc_id`` it is kept under, ``batch`` that brought it."""

    SCHEMA = "digest string, doc_id long, batch string"

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    @classmethod
    def temporary(cls, spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
        """An index of its own in the shared folder."""
        name = f"digest_index_{uuid.uuid4().hex[:12]}"
        return cls(spark, name, new_folder(spark, name), buckets)

    @classmethod
    def sized(cls, docs: DataFrame) -> DigestIndex:
        """A temporary index with buckets for as many texts as ``docs`` has rows."""
        return cls.temporary(docs.sparkSession, max(BUCKETS, -(-docs.count() // BUCKET_ROWS)))

    def forget(self) -> None:
        """Take the table out of the catalogue; its files stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name) if self.exists() else self.spark.createDataFrame([], self.SCHEMA)

    def append(self, entries: DataFrame) -> None:
        """Add those entries whose digest the index lacks."""
        new = entries.select("digest", "doc_id", "batch")
        if self.exists():
            known = self.spark.table(self.name).select("digest").hint("merge")
            new = new.join(known, "digest", "left_anti")
        # by the number of the bucket, so that each is one file in however many tasks
        dealt = new.repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets)))
        writer = dealt.write.bucketBy(self.buckets, "digest").sortBy("digest")
        (writer.option("path", self.path) if self.path else writer).mode("append").saveAsTable(self.name)


def _turns(digests: DataFrame, turns: int) -> list[Column]:
    """Conditions that deal rows by their ids to turns of about equal size, the largest ids first and nulls last."""
    cuts = digests.agg(F.percentile_approx("doc_id", [k / turns for k in range(turns - 1, 0, -1)])).first()[0] or []
    found, above = [], None
    for cut in dict.fromkeys(cuts):
        here = F.col("doc_id") >= cut
        found.append(here if above is None else here & (F.col("doc_id") < above))
        above = cut
    return [*found, F.lit(True) if above is None else F.col("doc_id").isNull() | (F.col("doc_id") < above)]


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", turns: int = TURNS) -> DataFrame:
    """Every row's decision, as (doc_id, keep_id, group_size, kept, text_sha256); the index grows by the new texts.

    ``group_size`` counts the rows of the batch with that text. The result does not read the index again.
    """
    batch = uuid.uuid4().hex
    plain = id_and_text(docs, id_col, text_col).select("doc_id", F.sha2("text", 256).alias("digest"))
    digests = written(plain.withColumn("tag", F.monotonically_increasing_id()), "digests")
    groups = digests.groupBy("digest").agg(F.max(F.struct("doc_id", "tag")).alias("last"), F.count("*").alias("n"))
    for turn in _turns(digests, turns):
        index.append(digests.where(turn).groupBy("digest").agg(F.max("doc_id").alias("doc_id")).withColumn("batch", F.lit(batch)))
    held = index.rows().select("digest", F.col("doc_id").alias("keep_id"), (F.col("batch") == batch).alias("is_new"))
    known = groups.join(held.hint("merge"), "digest").select(
        "digest", "keep_id", F.col("n").alias("group_size"), F.when(F.col("is_new"), F.col("last.tag")).alias("keep_tag")
    )
    return _to_rows(digests, written(known, "digest-groups")).select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("tag") == F.col("keep_tag"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _to_rows(digests: DataFrame, groups: DataFrame) -> DataFrame:
    """The group of every row. Hot digests are few by definition and broadcast; the others are sort-merged."""
    total = digests.count()
    is_hot = F.col("group_size") * HOT_SHARE >= F.lit(total)
    hot, cold = F.broadcast(groups.where(is_hot & (F.col("group_size") > 1))), groups.where(~(is_hot & (F.col("group_size") > 1)))
    rest = digests.join(hot.select("digest"), "digest", "left_anti")
    return digests.join(hot, "digest").unionByName(rest.join(cold.hint("merge"), "digest"))


def survivors(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    own_id, own_digest = (free_name(docs, c) for c in ("id", "digest"))
    stay = decisions.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"))
    repeated = decisions.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("__n"), F.max("kept").alias("__kept"))
    repeated = repeated.where("__n > 1 AND __kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"))
    tagged = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_digest, F.sha2(text_of(F.col(text_col)), 256))
    same = tagged[own_id].eqNullSafe(stay["__id"]) & (tagged[own_digest] == stay["__digest"])
    kept = tagged.join(stay, same, "left_semi")
    twice = kept[own_id].eqNullSafe(repeated["__id"]) & (kept[own_digest] == repeated["__digest"])
    once = kept.join(repeated, twice, "left_anti")
    more = kept.join(repeated, twice, "left_semi").dropDuplicates([own_id, own_digest])
    return once.unionByName(more).drop(own_id, own_digest)
