"""Reads that lose nothing in silence: what cannot be read is given beside what can, with its file and the reason."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.session import new_folder
from wattlake.sources.readers import FORMATS, existing

REJECT = "path string, reason string, record string"
BAD_RECORD, BAD_FILE = "malformed record", "unreadable file"


def read_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType | str, file_format: str = "parquet", **options
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a data set; both are empty where there is none.

    Rejects are (path, reason, record): records of a text format that do not fit the schema, as they are written, and
    Parquet files without a readable footer. A Parquet file whose footer is good but whose pages are not is an error when
    it is read. A file of text that is no text is a file of malformed records.
    """
    if file_format not in FORMATS:
        raise ValueError(f"no reader for format {file_format}")
    if existing(lambda: spark.read.format("binaryFile").load(path)) is None:
        return spark.createDataFrame([], schema), spark.createDataFrame([], REJECT)
    return (_parquet if file_format == "parquet" else _text)(spark, path, schema, file_format, options)


def _text(spark: SparkSession, path: str, schema: T.StructType | str, file_format: str, options: dict) -> tuple[DataFrame, DataFrame]:
    wanted = spark.createDataFrame([], schema).schema
    whole = T.StructType([*wanted, T.StructField("_unread", T.StringType())])
    # a parser that skips columns does not see what is wrong in them
    reader = spark.read.schema(whole).options(**{"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread", "columnPruning": False, **options})
    parsed = new_folder(spark, "parsed")  # parsed once for both results
    reader.format(file_format).load(path).select("*", F.col("_metadata.file_path").alias("_path")).write.parquet(parsed)
    read = spark.read.parquet(parsed)
    rejects = read.filter(F.col("_unread").isNotNull()).select(
        F.col("_path").alias("path"), F.lit(BAD_RECORD).alias("reason"), F.col("_unread").alias("record"))
    return read.filter(F.col("_unread").isNull()).select(*wanted.names), rejects


def _parquet(spark: SparkSession, path: str, schema: T.StructType | str, _: str, options: dict) -> tuple[DataFrame, DataFrame]:
    """Counting rows without columns reads footers only, in parallel; files that give none are looked at one by one."""
    reader = spark.read.schema(schema).options(**options)
    counted = reader.option("ignoreCorruptFiles", True).parquet(path).select("_metadata.file_path").groupBy("file_path").agg(F.count("*").alias("n"))
    listing = spark.read.format("binaryFile").options(**{k: v for k, v in options.items() if k == "recursiveFileLookup"}).load(path)
    names = listing.inputFiles()  # a scan leaves out files without a byte
    files = spark.createDataFrame([(f,) for f in names], "file string")
    silent = files.join(counted, _plain("file") == _plain("file_path"), "left_anti")
    bad = [(f, reason) for f in (r.file for r in silent.collect()) if (reason := _footer_fault(spark, f))]
    rejects = spark.createDataFrame([(f, f"{BAD_FILE}: {reason}", None) for f, reason in bad], REJECT)
    if not bad:
        return reader.parquet(path), rejects
    gone = {f for f, _ in bad}
    good = [f for f in names if f not in gone]
    return (reader.option("basePath", path).parquet(*good) if good else spark.createDataFrame([], schema)), rejects


def _plain(column: str):
    """Listings and scans spell the beginning of a path differently."""
    return F.regexp_replace(column, "^([a-z0-9]+):/+", "$1:/")


def _footer_fault(spark: SparkSession, file: str) -> str | None:
    try:
        spark.read.option("ignoreCorruptFiles", False).parquet(file).schema  # noqa: B018 - opens the footer
    except PySparkException as error:
        return (error.getCondition() or type(error).__name__).lower()
    except Exception as error:  # noqa: BLE001 - whatever the reader says of a file that is none
        return type(error).__name__
    return None


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(reason, files, records): how much each reason has cost."""
    return rejects.groupBy("reason").agg(F.count_distinct("path").alias("files"), F.count("record").alias("records"))
