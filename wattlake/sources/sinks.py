"""Writes: partitioned appends, versioned tables, reports, documents and metrics."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlake.constants import METRIC_NAMES, METRIC_PREFIXES
from wattlake.sources.readers import existing

PARTITIONS = ("source_name", "ingest_year", "ingest_month", "ingest_day", "ingest_run")


def append_bronze(rows: DataFrame, path: str, ingested_at: Column | None = None) -> None:
    """Write a batch below its source, ingest date and ingest time; a repeated run takes the place of its first try."""
    time = F.col("ingested_at") if ingested_at is None else ingested_at
    (
        rows.withColumn("ingest_year", F.date_format(time, "yyyy"))
        .withColumn("ingest_month", F.date_format(time, "MM"))
        .withColumn("ingest_day", F.date_format(time, "dd"))
        .withColumn("ingest_run", F.date_format(time, "HHmmssSSSSSS"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def claim(spark: SparkSession, path: str, line: str) -> bool:
    """Give a small file a name that must not exist yet; of several writers one succeeds, where the store renames atomically.

    The file is complete before it has the name, so no reader sees half of it and a lost writer takes no name.
    """
    files, target = _hadoop(spark, path)
    fs = spark._jvm.org.apache.hadoop.fs
    draft = fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(line.encode()))
    out.close()
    context = fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0))
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def listed(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder with their times of change in milliseconds; empty where there is no folder."""
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return {}
    return {f.getPath().getName(): f.getModificationTime() for f in files.listStatus(target)}


def remove(spark: SparkSession, path: str) -> None:
    files, target = _hadoop(spark, path)
    files.delete(target, True)


class Conflict(RuntimeError):
    """Other writers were faster, as often as was tried."""


class VersionedTable:
    """A table replaced as a whole while it is being read.

    The rows of a write go to a folder of their own. What makes them the next version is its entry in the log, a file
    named by the number, which must not exist yet; a job lost half way leaves the old version current. Of two writers of
    the same version one comes second and makes its change again, on top of the other's, so none is lost. Any number of
    readers go on with the version that they began with, until it is expired.
    """

    LOG_SCHEMA = "version long, writer string, batch long, folder string, note string"
    TRIES = 20

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def log(self, version: int | None = None) -> DataFrame | None:
        """What each version is made of, or one version."""
        path = f"{self.path}/log" if version is None else f"{self.path}/log/{version:012d}.json"
        return existing(lambda: self.spark.read.schema(self.LOG_SCHEMA).json(path))

    def _entry(self, version: int | None):
        log = self.log(version) if version else None
        return None if log is None else log.first()

    def current_version(self) -> int | None:
        return max((int(n[:12]) for n in listed(self.spark, f"{self.path}/log") if n.endswith(".json")), default=None)

    def done(self, writer: str, batch: int | None) -> int | None:
        """The version that a stream batch has written."""
        log = self.log() if batch is not None else None
        if log is None:
            return None
        return log.filter((F.col("writer") == writer) & (F.col("batch") == batch)).agg(F.max("version")).first()[0]

    def version_of(self, writer: str, batch: int) -> int:
        """The version a stream batch has written, or the next one if it has not."""
        return self.done(writer, batch) or (self.current_version() or 0) + 1

    def version(self, version: int) -> DataFrame | None:
        """A given version; None for version 0, which is before the first."""
        entry = self._entry(version)
        return None if entry is None else self._rows(entry.folder)

    def _rows(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def read(self) -> DataFrame | None:
        return self.version(self.current_version() or 0)

    def _commit(self, version: int, folder: str, writer: str, batch: int | None, note: str | None = None) -> bool:
        entry = {"version": version, "writer": writer, "batch": batch, "folder": folder, "note": note}
        return claim(self.spark, f"{self.path}/log/{version:012d}.json", json.dumps(entry))

    def change(self, make: Callable[[DataFrame | None], DataFrame], writer: str = "job", batch: int | None = None) -> DataFrame:
        """``make`` of the current rows becomes the next version. A stream batch that has its version is not repeated."""
        for _ in range(self.TRIES):
            if done := self.done(writer, batch):
                return self.version(done)
            before = self.current_version() or 0
            folder = f"rows-{uuid.uuid4().hex}"
            make(self.version(before)).write.parquet(f"{self.path}/{folder}")
            if self._commit(before + 1, folder, writer, batch):
                return self._rows(folder)
            remove(self.spark, f"{self.path}/{folder}")
        raise Conflict(self.path)

    def replace(self, rows: DataFrame) -> DataFrame:
        """``rows`` instead of whatever there is."""
        return self.change(lambda _: rows)

    def _folders(self, entries: list) -> set[str]:
        """Folders that versions need."""
        return {e.folder for e in entries}

    def expire(self, keep: int = 5, hours: float = 24) -> int:
        """Remove all but the newest ``keep`` versions, and what lost writers left, if older than ``hours``; how many folders went.

        A reader of a version must be through before it is old. Log entries of stream batches stay as long as their versions.
        """
        now = self.spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
        old = {n for n, t in listed(self.spark, f"{self.path}/log").items() if n.endswith(".json") and now - t >= hours * 3_600_000}
        newest = self.current_version() or 0
        gone = {v for v in (int(n[:12]) for n in old) if v <= newest - keep}
        log = self.log()
        entries = [e for e in log.collect() if e.version not in gone] if log is not None else []
        needed = self._folders(entries)
        for version in gone:
            remove(self.spark, f"{self.path}/log/{version:012d}.json")
        left = [n for n, t in listed(self.spark, self.path).items() if n != "log" and n not in needed and now - t >= hours * 3_600_000]
        for name in left:
            remove(self.spark, f"{self.path}/{name}")
        return len(left)


class KeyedTable(VersionedTable):
    """A table of one row per key whose versions share what a change leaves alone.

    Rows lie in buckets by the hash of their key. A change reads and writes only the buckets in which it has keys; a
    version is a manifest that names, for every bucket, the write that holds it. The number of buckets is fixed with the
    first version: take so many that one is a few tasks' work.
    """

    MANIFEST = "bucket int, folder string"

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        super().__init__(spark, path)
        self.key, self.buckets = key, buckets

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _manifest(self, folder: str) -> dict[int, str]:
        """Where each bucket is: one row per bucket, however large the table."""
        return {r.bucket: r.folder for r in self.spark.read.schema(self.MANIFEST).parquet(f"{self.path}/{folder}").collect()}

    def _about(self, entry) -> dict:
        return json.loads(entry.note)

    def _read(self, schema: StructType, places: dict[int, str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{folder}/_bucket={b}" for b, folder in sorted(places.items())))

    def version(self, version: int) -> DataFrame | None:
        entry = self._entry(version)
        if entry is None:
            return None
        return self._read(StructType.fromJson(self._about(entry)["schema"]), self._manifest(entry.folder))

    def places(self) -> dict[int, str]:
        """The write that holds each bucket of the current version."""
        entry = self._entry(self.current_version())
        return {} if entry is None else self._manifest(entry.folder)

    def rows_in(self, buckets: Iterable[int]) -> DataFrame:
        """Rows of some buckets of the current version; the files of others are not opened."""
        entry, chosen = self._entry(self.current_version()), set(buckets)
        if entry is None:
            raise FileNotFoundError(f"no version of {self.path} yet")
        places = {b: f for b, f in self._manifest(entry.folder).items() if b in chosen}
        return self._read(StructType.fromJson(self._about(entry)["schema"]), places)

    def bucket_of_rows(self) -> Column:
        """The bucket of a row, from its key."""
        entry = self._entry(self.current_version())
        return self._bucket(self._about(entry)["buckets"] if entry else self.buckets)

    def remark(self) -> str | None:
        """What the last change said of itself."""
        entry = self._entry(self.current_version())
        return None if entry is None else self._about(entry)["remark"]

    def change_keys(
        self, keys: DataFrame | None, make: Callable[[DataFrame | None], DataFrame], writer: str = "job", batch: int | None = None,
        remark: str | None = None,
    ) -> DataFrame:
        """``make`` of the current rows in the buckets of ``keys`` takes their place; without ``keys`` that of all rows.

        ``make`` gets rows of other keys in these buckets too and must give them back. A key that it gives must belong to
        one of these buckets.
        """
        for _ in range(self.TRIES):
            if done := self.done(writer, batch):
                return self.version(done)
            before = self.current_version() or 0
            entry = self._entry(before)
            about = self._about(entry) if entry else {"buckets": self.buckets, "schema": None}
            places = self._manifest(entry.folder) if entry else {}
            bucket = self._bucket(about["buckets"])
            touched = None if keys is None else {r[0] for r in keys.select(bucket).distinct().collect()}
            old = StructType.fromJson(about["schema"]) if about["schema"] else None
            mine = places if touched is None else {b: f for b, f in places.items() if b in touched}
            made = make(self._read(old, mine) if mine else None if old is None else self.spark.createDataFrame([], old))
            schema = made.schema if old is None else StructType([*old, *(f for f in made.schema if f.name not in old.names)])
            folder, manifest = f"rows-{uuid.uuid4().hex}", f"manifest-{uuid.uuid4().hex}"
            made.withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            written = {int(n[8:]) for n in listed(self.spark, f"{self.path}/{folder}") if n.startswith("_bucket=")}
            if touched is not None and written - touched:
                raise ValueError("a change made rows of keys that it did not name")
            now = {b: f for b, f in places.items() if b not in mine} | dict.fromkeys(written, folder)
            self.spark.createDataFrame(sorted(now.items()), self.MANIFEST).coalesce(1).write.parquet(f"{self.path}/{manifest}")
            note = {"buckets": about["buckets"], "schema": schema.jsonValue(), "remark": remark}
            if self._commit(before + 1, manifest, writer, batch, json.dumps(note)):
                return self.version(before + 1)
            remove(self.spark, f"{self.path}/{folder}")
            remove(self.spark, f"{self.path}/{manifest}")
        raise Conflict(self.path)

    def change(self, make: Callable[[DataFrame | None], DataFrame], writer: str = "job", batch: int | None = None) -> DataFrame:
        return self.change_keys(None, make, writer, batch)

    def _folders(self, entries: list) -> set[str]:
        return {f for e in entries for f in (e.folder, *self._manifest(e.folder).values())}


def append_quarantine(rows: DataFrame, path: str, run_id: str) -> None:
    """Keep the rows of a run; the same run again replaces them."""
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")


def run_key(text: str) -> str:
    """A run's name as a folder name."""
    return re.sub("[^A-Za-z0-9_.-]+", "-", text)


def write_report(report: DataFrame, path: str, run: str) -> None:
    """CSV with a header, one folder per run, which the same run replaces. Nested values are written as JSON text."""
    flat = [
        F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c)
        for c, t in report.dtypes
    ]
    report.select(*flat).write.mode("overwrite").option("header", True).csv(f"{path}/run={run_key(run)}")


def write_document(document: DataFrame, path: str) -> None:
    document.write.mode("overwrite").json(path)


def metric_allowed(name: Column, value: Column) -> Column:
    """Name on the list or under a known prefix, and a finite value."""
    known = name.isin(*METRIC_NAMES) | name.rlike("^(" + "|".join(METRIC_PREFIXES) + ")")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.coalesce(known & finite, F.lit(False))


def metric_rows(spark: SparkSession, values: Mapping[str, Column | float], as_of: Column, of: DataFrame | None = None) -> DataFrame:
    """Metrics of a run as (metric_timestamp, metric_name, metric_value) rows.

    ``values`` are numbers, or aggregates over the one-row frame ``of``.
    """
    of = spark.range(1) if of is None else of
    columns = [(v if isinstance(v, Column) else F.lit(v)).cast("double").alias(k) for k, v in values.items()]
    return (
        of.select(*columns)
        .unpivot([], list(values), "metric_name", "metric_value")
        .select(as_of.alias("metric_timestamp"), "metric_name", "metric_value")
    )


def append_metrics(metrics: DataFrame, path: str, run: str) -> None:
    """Keep the metric rows of a run, replacing what it wrote before; a name or value outside the policy fails the job."""
    checked = metrics.select(
        "metric_timestamp",
        "metric_name",
        F.when(metric_allowed(F.col("metric_name"), F.col("metric_value")), F.col("metric_value"))
        .otherwise(F.raise_error(F.concat(F.lit("metric not allowed: "), F.coalesce("metric_name", F.lit("null")))))
        .alias("metric_value"),
    )
    checked.write.mode("overwrite").parquet(f"{path}/run={run_key(run)}")


def merge_state(old: DataFrame, new: DataFrame, key: str = "source_name") -> DataFrame:
    """New fields over old ones; a field the new rows leave null keeps its old value."""
    fields = [c for c in old.columns if c != key] + [c for c in new.columns if c not in old.columns]
    both = old.alias("o").join(new.alias("n"), key, "full_outer")

    def merged(name: str) -> Column:
        sides = [F.col(f"{a}.{name}") for a, f in (("n", new), ("o", old)) if name in f.columns]
        return F.coalesce(*sides).alias(name)

    return both.select(key, *[merged(f) for f in fields])
