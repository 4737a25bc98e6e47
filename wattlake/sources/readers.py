"""Scans: files of the supported formats, payload texts, latest snapshots, external tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet")


def detect_format(path: str) -> str:
    suffix = path.lower().rstrip("/").rsplit(".", 1)[-1]
    if suffix not in FORMATS:
        raise ValueError(f"no reader for {path}")
    return suffix


def read_dataset(
    spark: SparkSession,
    path: str,
    file_format: str | None = None,
    schema: T.StructType | str | None = None,
    json_lines: bool = False,
    quoted_lines: bool = False,
) -> DataFrame:
    """Scan one data set.

    CSV columns come as text unless a schema is given: guessing types would be a
    second pass over the data, and conforming coerces them anyway. A JSON
    document spanning lines is one task per file; large feeds should be JSON
    lines, which split. The same goes for CSV whose quoted values hold line ends.
    """
    file_format = (file_format or detect_format(path)).lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if file_format == "csv":
        return reader.options(header=True, escape='"', multiLine=quoted_lines).csv(path)
    if file_format == "json":
        return reader.option("multiLine", not json_lines).json(path)
    if file_format == "parquet":
        return reader.parquet(path)
    raise ValueError(f"no reader for format {file_format}")


def read_directory(spark: SparkSession, path: str, file_format: str, **options) -> DataFrame:
    """Every file of one format at any depth below a folder."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{file_format}")
    if file_format == "csv":
        reader = reader.option("header", True).option("escape", '"')
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.format(file_format).load(path)


def existing(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` opens, or None where its path is not there. Any other error is one."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def first_file_of(files: DataFrame, read: Callable[[str], DataFrame]) -> DataFrame:
    """The file that sorts first, for feeds that ship one file among others. Only that file is scanned."""
    return read(min(files.inputFiles()))


def _suffixes(spark: SparkSession, path: str) -> set[str]:
    """Suffixes of the files at any depth below a folder, markers and hidden files aside."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    found = set()
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            found.add(name.rsplit(".", 1)[-1].lower() if "." in name else "")
    return found


def file_listing(spark: SparkSession, path: str) -> str | None:
    """Digest of the names, lengths and times of change of the files at or below a path, none of which is opened; None where
    there are none, or the path is a pattern."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return None
    files, found = system.listFiles(folder, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest() if found else None


def read_mixed(spark: SparkSession, path: str, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """A folder holding one or several formats, each read by its suffix and unioned by name; others are an error."""
    found = _suffixes(spark, path)
    if other := sorted(found - set(formats)):
        raise ValueError(f"no reader for {other} below {path}")
    if not found:
        raise FileNotFoundError(f"no data below {path}")
    frames = [read_directory(spark, path, f) for f in formats if f in found]
    result = frames[0]
    for more in frames[1:]:
        result = result.unionByName(more, allowMissingColumns=True)
    return result


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet", **options
) -> DataFrame:
    """The data set, or no rows of the same schema when it does not exist or holds no readable file.

    Text formats read a bad file as rows of nulls. A Parquet file's footer tells, so that is opened here; a folder of
    which some files are bad gives the rows of the others.
    """
    rows = existing(lambda: spark.read.schema(schema).options(**options).format(file_format).load(path))
    if rows is None:
        return spark.createDataFrame([], schema)
    if file_format != "parquet":
        return rows
    return spark.read.schema(schema).options(**{"ignoreCorruptFiles": True, **options}).parquet(path)


def read_report_csv(spark: SparkSession, path: str, columns: list[str], header: bool) -> DataFrame:
    """An audit table kept as quoted CSV: every column is text, names come from the contract."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .options(sep=",", quote='"', escape="\\", header=header)
        .csv(path)
    )


# --- payload texts -----------------------------------------------------------


def json_path(text: Column, dotted: str) -> Column:
    """Part of a JSON text under a dotted path; a path that is not there is an error."""
    missing = F.raise_error(F.concat(F.lit(f"path {dotted} not found in payload: "), F.coalesce(text, F.lit("null"))))
    return F.coalesce(F.get_json_object(text, f"$.{dotted}"), missing)


def payload_rows(
    payloads: DataFrame, text_column: str, row_schema: str, data_path: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of JSON payloads: an object is one row, an array one row per element."""
    text = F.col(text_column)
    if data_path:
        text = json_path(text, data_path)
    body = F.col("_body")
    rows = (
        F.when(body.startswith("["), F.from_json(body, f"array<struct<{row_schema}>>"))
        .when(body.startswith("{"), F.array(F.from_json(body, f"struct<{row_schema}>")))
        .otherwise(F.raise_error(F.lit("a payload must hold an object or an array")))
    )
    return (
        payloads.select(*keep, F.ltrim(text).alias("_body"))
        .select(*keep, F.explode(rows).alias("_row"))
        .select(*keep, "_row.*")
    )


# --- snapshots and registries -----------------------------------------------


def latest_snapshot(bronze: DataFrame, by: str = "source_name", time: str = "ingested_at") -> DataFrame:
    """Rows of the newest ingest of every source, matched by the source's own name."""
    newest = bronze.groupBy(by).agg(F.max(time).alias(time))
    return bronze.join(newest, [by, time], "left_semi")


def enabled_sources(registry: DataFrame) -> DataFrame:
    """Sources switched on; a source that says nothing is on."""
    enabled = F.coalesce(F.col("enabled"), F.lit(True)) if "enabled" in registry.columns else F.lit(True)
    return registry.filter(enabled & F.col("source_name").isNotNull())


def register_tables(spark: SparkSession, paths: Mapping[str, tuple[str, str]]) -> None:
    """Name external Parquet folders so that SQL can query them: name -> (path, schema)."""
    for name, (path, schema) in paths.items():
        spark.read.schema(schema).parquet(path).createOrReplaceTempView(name)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Create or replace one temporary view per frame."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
