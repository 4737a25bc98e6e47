import random

import pytest
from pyspark.sql import functions as F

from wattlake.operators import upsert
from wattlake.sources import readers, registry, sinks


def test_formats_are_told_by_suffix():
    assert readers.detect_format("s3a://x/Y.CSV") == "csv"
    with pytest.raises(ValueError):
        readers.detect_format("x.xlsx")


def test_unknown_format_is_an_error(spark):
    with pytest.raises(ValueError):
        readers.read_dataset(spark, "x", "xlsx")


def test_payloads(spark):
    rows = [(1, '{"data": {"items": [{"a": 1}, {"a": 2}]}}'), (2, '{"data": {"items": {"a": 3}}}')]
    df = spark.createDataFrame(rows, "id int, body string")
    got = readers.payload_rows(df, "body", "a int", "data.items", keep=("id",)).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (1, 2), (2, 3)]
    for bad, message in (('{"other": 1}', "not found"), ('{"data": {"items": 5}}', "object or an array")):
        with pytest.raises(Exception, match=message):
            readers.payload_rows(spark.createDataFrame([(3, bad)], "id int, body string"), "body", "a int", "data.items").collect()


def test_tolerant_read(spark, root):
    assert readers.read_or_empty(spark, f"{root}/none", "a int").count() == 0
    spark.createDataFrame([("no parquet",)], "value string").write.text(f"{root}/bad")
    assert readers.read_or_empty(spark, f"{root}/bad", "a int").count() == 0
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        readers.existing(lambda: spark.range(1).select("no_such_column"))


def test_mixed_formats(spark, root):
    with pytest.raises(Exception):
        readers.read_mixed(spark, f"{root}/none")
    spark.createDataFrame([(1,)], "a int").write.json(f"{root}/j")
    assert [r.a for r in readers.read_mixed(spark, root).collect()] == [1]
    spark.createDataFrame([("x",)], "value string").write.text(f"{root}/t")
    with pytest.raises(ValueError, match="txt"):
        readers.read_mixed(spark, root)


def test_snapshot_matches_whole_names(spark):
    rows = [("plants", 1, "a"), ("plants", 2, "b"), ("plants_v2", 5, "c")]
    df = spark.createDataFrame(rows, "source_name string, ingested_at int, v string")
    assert sorted(r.v for r in readers.latest_snapshot(df).collect()) == ["b", "c"]


def test_registry(spark, tmp_path):
    (tmp_path / "sources.json").write_text('{"source_name": "a"}\n{"source_name": "b", "enabled": false}\n{"path": "nameless"}\n')
    on = readers.enabled_sources(registry.read_registry(spark, str(tmp_path / "sources.json")))
    assert [r.source_name for r in on.collect()] == ["a"]
    with pytest.raises(ValueError):
        registry.source_folder("bronze", "../a")


def test_versioned_table_is_unchanged_by_a_write_without_its_log_row(spark, root):
    table = sinks.VersionedTable(spark, f"{root}/t")
    assert table.read() is None
    table.replace(spark.range(3))
    spark.range(99).write.parquet(f"{root}/t/v2")  # a job lost before it logged its version
    assert table.read().count() == 3
    table.replace(table.read().filter("id > 0"))
    assert (table.current_version(), table.read().count()) == (2, 2)


def test_two_writers_lose_nothing(spark, root):
    """The second writer finds its version taken and makes its change again on top of the first's."""
    table, other = sinks.VersionedTable(spark, f"{root}/t"), sinks.VersionedTable(spark, f"{root}/t")
    table.replace(spark.range(3))
    seen = []

    def slow(current):
        seen.append(current.count())
        if len(seen) == 1:
            other.change(lambda rows: rows.union(spark.range(100, 102)))
        return current.union(spark.range(200, 201))

    table.change(slow)
    assert seen == [3, 5] and table.current_version() == 3
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2, 100, 101, 200]
    assert sorted(r.id for r in table.version(2).collect()) == [0, 1, 2, 100, 101]
    names = [n for n in sinks.listed(spark, f"{root}/t") if n != "log"]
    assert len(names) == 3  # the lost try is removed


def test_expiry_keeps_what_versions_need(spark, root):
    table = sinks.VersionedTable(spark, f"{root}/t")
    for k in range(6):
        table.replace(spark.range(k))
    spark.range(9).write.parquet(f"{root}/t/rows-lost")
    assert table.expire(keep=2, hours=24) == 0
    assert table.expire(keep=2, hours=0) == 5
    assert table.read().count() == 5 and table.version(5).count() == 4 and table.version(4) is None
    table.replace(spark.range(7))
    assert (table.current_version(), table.read().count()) == (7, 7)


KEYED = "id long, v string"


def keyed(spark, root, buckets=16):
    table = sinks.KeyedTable(spark, f"{root}/k", "id", buckets)
    put = lambda rows: (lambda now: upsert.upsert(now, rows, "id", ("v",)))
    return table, lambda rows: table.change_keys(rows, put(rows))


def places(table, version=None):
    return table._manifest(table._entry(version or table.current_version()).folder)


def test_a_keyed_change_writes_only_its_buckets(spark, root):
    table, merge = keyed(spark, root, 200)
    assert table.read() is None
    first = merge(spark.range(10_000).select("id", F.lit("a").alias("v")))
    assert first.count() == 10_000 and len(places(table)) == 200
    batch = spark.range(0, 100, 50).select("id", F.lit("b").alias("v"))  # two keys
    merge(batch)
    changed = {b for b, f in places(table).items() if places(table, 1)[b] != f}
    assert len(changed) == 2
    got = table.read()
    assert got.count() == 10_000 and sorted(r.id for r in got.where("v = 'b'").collect()) == [0, 50]
    assert table.version(1).where("v = 'b'").count() == 0  # readers of the old version see nothing of it
    read = {f.split("_bucket=")[1].split("/")[0] for f in got.inputFiles() if places(table, 1)[int(f.split("_bucket=")[1].split("/")[0])] not in f}
    assert {int(b) for b in read} == changed


def test_keyed_table_against_plain_upserts(spark, root):
    table, merge = keyed(spark, root)
    want = {}
    rng = random.Random(5)
    for k in range(4):
        rows = {rng.choice([None, *range(60)]): f"{rng.choice('abc')}{k}" for _ in range(25)}
        merge(spark.createDataFrame(list(rows.items()), KEYED))
        want |= {i: max(v, want.get(i, v)) for i, v in rows.items()}
    assert {r.id: r.v for r in table.read().collect()} == want
    wider = spark.createDataFrame([(1, "z", 7)], KEYED + ", w int")
    table.change_keys(wider, lambda now: now.where("id <> 1").unionByName(wider, allowMissingColumns=True))
    assert {(r.v, r.w) for r in table.read().where("id = 1").collect()} == {("z", 7)}
    assert table.read().where("w IS NULL").count() == len(want) - 1
    table.change_keys(wider, lambda now: now.where("id <> 1"))  # removed
    assert table.read().where("id = 1").count() == 0
    with pytest.raises(ValueError):
        table.change_keys(wider, lambda now: spark.createDataFrame([(k, "x", 1) for k in range(50)], KEYED + ", w int"))
    table.expire(keep=1, hours=0)
    assert {r.id: r.v for r in table.read().collect()} == {i: v for i, v in want.items() if i != 1}


def test_two_keyed_writers_lose_nothing(spark, root):
    table, merge = keyed(spark, root)
    merge(spark.createDataFrame([(1, "a"), (2, "a")], KEYED))
    rows = spark.createDataFrame([(1, "b")], KEYED)
    tries = []

    def slow(now):
        tries.append(1)
        if len(tries) == 1:
            keyed(spark, root)[1](spark.createDataFrame([(1, "c"), (3, "c")], KEYED))
        return upsert.upsert(now, rows, "id", ("v",))

    table.change_keys(rows, slow)
    assert len(tries) == 2 and {r.id: r.v for r in table.read().collect()} == {1: "c", 2: "a", 3: "c"}


def test_state_merge_keeps_what_new_rows_do_not_say(spark):
    old = spark.createDataFrame([("a", "h1", "ok"), ("b", "h2", "ok")], "source_name string, hash string, status string")
    new = spark.createDataFrame([("a", None, "failed", "boom"), ("c", "h3", "ok", None)], "source_name string, hash string, status string, error string")
    got = {r.source_name: (r.hash, r.status, r.error) for r in sinks.merge_state(old, new).collect()}
    assert got == {"a": ("h1", "failed", "boom"), "b": ("h2", "ok", None), "c": ("h3", "ok", None)}


def test_reports_flatten_nested_values(spark, root):
    df = spark.range(1).select(F.array(F.lit("x")).alias("a"), F.lit(1).alias("b"))
    for _ in range(2):  # a repeated run replaces its report
        sinks.write_report(df, root, "2024-01-01 00:00:00")
    assert [tuple(r) for r in spark.read.option("header", True).csv(root).drop("run").collect()] == [('["x"]', "1")]


def test_bronze_append_prunes_by_source_and_day(spark, root):
    df = spark.createDataFrame([("a", "2024-05-06 10:00:00", 1)], "source_name string, ingested_at string, v int")
    sinks.append_bronze(df.withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")), root)
    back = spark.read.parquet(root).filter("source_name = 'a' AND ingest_month = 5")
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(source_name" in back._jdf.queryExecution().executedPlan().toString()
