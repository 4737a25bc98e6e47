"""The index of row hashes, and what an ingest reads of a source."""

import random
import time

import pytest
from pyspark.sql import functions as F
from test_jobs import BASE, INCREMENT, SOURCES, by_source, write_feed

from wattlake.operators import ingest
from wattlake.plans import bronze
from wattlake.sources.hash_index import RowHashIndex
from wattlake.sources.registry import registry_of


def feed(spark, rows):
    return ingest.with_row_hash(spark.createDataFrame(rows, "k string, v int"))


def keyed(hashed):
    return hashed.select("row_hash", F.col("k").alias("key"))


def rows_of(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=str)


def test_what_a_feed_changes_is_seen_again_when_it_comes_back(spark, root):
    index = RowHashIndex(spark, root, 4)
    assert not index.exists()
    first = feed(spark, [("a", 1), ("a", 2), ("b", 1), (None, 1), ("b", 1)])
    index.record(keyed(first))
    assert index.live().count() == 4
    second = feed(spark, [("a", 1), ("a", 3), (None, 1)])  # a's second row is another, b is not in this feed
    assert rows_of(index.unseen(second)) == [("a", 3)]
    index.record(keyed(second))
    assert rows_of(index.unseen(first)) == [("a", 2)]
    index.record(keyed(first))
    assert rows_of(index.unseen(second)) == [("a", 3)]
    before = spark.read.parquet(index._folder()).count()
    index.record(keyed(first))  # nothing new
    assert spark.read.parquet(index._folder()).count() == before


def test_the_known_side_is_not_shuffled(spark, root):
    index = RowHashIndex(spark, root, 8)
    for k in range(3):
        index.record(keyed(feed(spark, [(f"k{i}", i + (k if i % 10 == 0 else 0)) for i in range(300)])))
    plan = index.unseen(feed(spark, [("k1", 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_an_ingest_writes_the_changes_only_and_compaction_keeps_what_lives(spark, root):
    index = RowHashIndex(spark, root, 4)
    index.record(keyed(feed(spark, [(f"k{i}", i) for i in range(1000)])))
    index.record(keyed(feed(spark, [(f"k{i}", i + (i < 7)) for i in range(1000)])))
    assert spark.read.parquet(index._folder()).count() == 1000 + 7 + 7
    live, old = sorted(map(tuple, index.live().collect())), index._folder()
    index.compact()
    assert index._folder() != old and spark.read.parquet(index._folder()).count() == 1000
    assert sorted(map(tuple, index.live().collect())) == live
    assert len(spark.read.parquet(index._folder()).inputFiles()) == 4
    index.record(keyed(feed(spark, [("k5", 99)])))
    assert rows_of(index.unseen(feed(spark, [("k5", 6), ("k5", 99), ("k6", 7)]))) == [("k5", 6)]


def test_a_feed_moves_once_and_packed(spark, root, monkeypatch):
    """Hashes are shuffled as bytes, a first feed once, and what moved does not stay on disk."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    index, plans, add = RowHashIndex(spark, root, 4), [], RowHashIndex._add
    monkeypatch.setattr(RowHashIndex, "_add", lambda self, rows, folder: (
        plans.append(rows._jdf.queryExecution().executedPlan().toString()), add(self, rows, folder)))
    first, before = feed(spark, [(f"k{i}", i) for i in range(500)]), shuffled()
    index.record(keyed(first))
    index.record(keyed(feed(spark, [(f"k{i}", i + (i < 9)) for i in range(500)])))
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert all(p.count("Exchange hashpartitioning(lower(hex(row_hash") == n for p, n in zip(plans, (1, 3), strict=True)), plans
    for _ in range(50):
        if left := shuffled() - before:
            time.sleep(0.2)
    assert not left
    parts = [spark.read.parquet(f).selectExpr(f"pmod(hash(row_hash), {index.buckets})").distinct().count()
             for f in spark.read.parquet(index._folder()).inputFiles()]
    assert set(parts) == {1} and len(parts) <= 3 * index.buckets


def test_against_a_plain_model(spark, root):
    """Feeds of all rows of some keys, in any order, against sets."""
    rng, live, index = random.Random(3), set(), RowHashIndex(spark, root, 4)
    for step in range(5):
        keys = [rng.choice([None, *"abcdefgh"]) for _ in range(6)]
        rows = [(k, rng.randrange(4)) for k in keys for _ in range(rng.randrange(1, 4))]
        hashed = feed(spark, rows)
        if index.exists():
            assert rows_of(index.unseen(hashed)) == sorted((r for r in rows if r not in live), key=str)
        index.record(keyed(hashed))
        named = {k for k, _ in rows if k is not None}
        live = {r for r in live if r[0] not in named} | set(rows)


@pytest.fixture
def source(spark, tmp_path):
    registry, root = registry_of(spark, [dict(SOURCES[0], primary_key="Plant ID")]), str(tmp_path / "lake")

    def run(day):
        return by_source(bronze.run_bronze(spark, registry, root, f"2026-03-{day:02d} 00:00:00", base=str(tmp_path)))["plants_v2"]

    return run, tmp_path


def test_an_unchanged_source_is_not_opened(source, monkeypatch):
    run, folder = source
    write_feed(folder, BASE)
    assert run(1).changed_rows == 2
    with monkeypatch.context() as watched:
        watched.setattr(bronze, "read_dataset", lambda *a, **k: pytest.fail("it was opened"))
        assert run(2).status == "skipped"
    write_feed(folder, BASE)  # the same content, written again
    assert run(3).status == "skipped"
    write_feed(folder, [*BASE, INCREMENT[1]])
    assert (run(4).status, run(4).status) == ("ingested", "skipped")


def test_a_changed_source_is_scanned_once(spark, source, monkeypatch):
    run, folder = source
    seen = spark.sparkContext.accumulator(0)
    read = bronze.read_dataset

    def counted(*args, **kwargs):
        df = read(*args, **kwargs)

        def each(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return df.mapInArrow(each, df.schema)

    monkeypatch.setattr(bronze, "read_dataset", counted)
    write_feed(folder, BASE)
    run(1)
    assert seen.value == 2
    write_feed(folder, [*BASE, INCREMENT[1]])
    assert run(2).changed_rows == 1 and seen.value == 5
