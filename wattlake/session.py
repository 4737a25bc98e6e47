"""Session settings and the shared folder for tables a job must read back."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


#: Whether the shuffle files of a query go as soon as it ends, not when the driver happens to collect its garbage.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs expect; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName("wattlake")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a single-machine session may go without it; there every reader is on
    the same machine and a temporary folder is as good as a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = os.environ.get("WATTLAKE_LOCAL_DIR") or tempfile.mkdtemp(prefix="wattlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, so repeated runs never meet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what runs inside; those that were there before hold again after it."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """What is written inside leaves no shuffle files behind."""
    return settings(spark, {FREES_SHUFFLES: "true"})
