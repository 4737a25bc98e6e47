"""From raw documents to packed sequences; every stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import exact, near, packing, pii, quality
from wattlake.llm.common import read, written
from wattlake.llm.queries import ACCEPTED, quality_model


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    return quality.accepted(docs, quality_model(docs, read(spark, sf_dir, "labels")), ACCEPTED)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact.survivors(docs, exact.deduplicate(docs, exact.DigestIndex.temporary(spark)))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that hang together by five-word shingles of similarity 0.8 or more the one with the smallest id."""
    return near.survivors(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and lengths to match."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("near-dedup", without_near_duplicates),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: No SQL states the learned scores, the fingerprints and the tokens; a test holds the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
