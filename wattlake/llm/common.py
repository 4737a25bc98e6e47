"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import freed_shuffles, new_folder

#: Rows turned into Python objects at a time; Arrow batches are bounded in bytes by Spark.
SLICE = 256


#: Rows in an Arrow batch. The default of 10,000 long texts is held several times over by an executor and its worker.
ARROW_ROWS = 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table, in a session that hands Python small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text counts as empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(df[text_col]).alias("text"))


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"__{name}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken)


def written(df: DataFrame, name: str, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, and a lost executor loses nothing of it. The shuffles behind it go."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    schema = df.schema
    with freed_shuffles(spark):
        (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as Python values, a bounded slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def batches_of(made: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in made:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def byte_names() -> list[str]:
    """The printable stand-in of every byte: itself where printable, else the next code point from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    moved = {b: 256 + k for k, b in enumerate(rest)}
    return [chr(moved.get(b, b)) for b in range(256)]
