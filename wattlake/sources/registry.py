"""The list of sources a run reads, kept as a JSON file Spark can open anywhere."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

REGISTRY_SCHEMA = (
    "source_name string, enabled boolean, format string, path string, primary_key string, event_time_column string, "
    "volume_spike_threshold_ratio double, volume_drop_threshold_ratio double, "
    "freshness_update_sla_hours double, freshness_ingestion_delay_sla_hours double"
)
_NAME = re.compile(r"[A-Za-z0-9_.-]+")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per source. A registry that cannot be read is an error, not an empty run."""
    return spark.read.schema(REGISTRY_SCHEMA).json(path)


def registry_of(spark: SparkSession, sources: list[dict]) -> DataFrame:
    names = [part.split()[0] for part in REGISTRY_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(s.get(n) for n in names) for s in sources], REGISTRY_SCHEMA)


def source_folder(bronze: str, source_name: str) -> str:
    if not _NAME.fullmatch(source_name):
        raise ValueError(f"source name {source_name!r} cannot be a folder name")
    return f"{bronze}/source_name={source_name}"
