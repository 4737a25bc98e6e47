"""Gold facts from sums by bucket against recomputation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from wattlake.operators import gold
from wattlake.plans.incremental import GoldSums
from wattlake.sources.sinks import KeyedTable

SCHEMA = ("plant_id string, country string, primary_fuel string, capacity_mw double, estimated_generation_gwh double, "
          "event_year long, event_month long, continent string, sub_region string")
FACTS = (gold.fact_plant_capacity, gold.fact_power_generation, gold.fact_power_generation_time, gold.fact_capacity_geo)


def plant(rng, k):
    return (f"p{k}", rng.choice(["A", "B", None, f"rare{k}"]), rng.choice(["Solar", "Coal", None]), rng.choice([None, 0.1, 2.5, 1e9]),
            rng.choice([None, 3.25, 0.7]), rng.choice([2000, 2001]), rng.choice([1, 2]), rng.choice(["Asia", None]), "S")


def rounded(df):
    return sorted([tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in df.collect()], key=str)


def test_three_mixed_batches_equal_a_recomputation(spark, root, monkeypatch):
    rng = random.Random(2)
    silver = KeyedTable(spark, f"{root}/silver", "plant_id", 32)
    sums = GoldSums(spark, silver, f"{root}/sums", 4)
    read = []
    rows_in = KeyedTable.rows_in
    monkeypatch.setattr(KeyedTable, "rows_in", lambda table, buckets: read.append(set(buckets)) or rows_in(table, buckets))
    known, batches = {}, [range(200), [*range(0, 200, 60), 300, 301], [5, 301]]
    gone = [(), (3, 4), (301,)]
    for new, old in zip(batches, gone, strict=True):
        rows = {f"p{k}": plant(rng, k) for k in new}
        known = {k: r for k, r in {**known, **rows}.items() if k not in {f"p{o}" for o in old}}
        keys = spark.createDataFrame([(k,) for k in {*rows, *(f"p{o}" for o in old)}], "plant_id string")
        added = spark.createDataFrame([r for k, r in rows.items() if k in known], SCHEMA)
        before = silver.places()
        silver.change_keys(keys, lambda now: added if now is None else now.join(keys, "plant_id", "left_anti").unionByName(added))
        after = silver.places()
        changed = {b for b in before.keys() | after.keys() if before.get(b) != after.get(b)}
        assert set(sums.stale()) == changed
        read.clear()
        taken = sums.refresh()
        assert read == [changed & after.keys()] and sums.stale() == []
        whole = spark.createDataFrame(list(known.values()), SCHEMA)
        for fact in FACTS:
            assert rounded(fact(taken)) == rounded(fact(whole)), fact
        assert rounded(gold.dim_country(taken)) == rounded(gold.dim_country(whole))
        assert taken.agg(F.sum("plants")).first()[0] == len(known)
    assert len(changed) <= 2


def test_infinite_values_go_without_a_trace(spark, root):
    silver = KeyedTable(spark, f"{root}/silver", "plant_id", 4)
    sums = GoldSums(spark, silver, f"{root}/sums", 4)
    put = lambda *rows: spark.createDataFrame([(k, "A", "Coal", v, 1.0, 2000, 1, "Asia", "S") for k, v in rows], SCHEMA)
    for rows, want in (([("a", math.inf), ("b", 1.0)], math.inf), ([("a", 2.0)], 3.0)):
        batch = put(*rows)
        silver.change_keys(batch, lambda now, batch=batch: batch if now is None else now.join(batch, "plant_id", "left_anti").unionByName(batch))
        assert gold.fact_plant_capacity(sums.refresh()).first().total_capacity_mw == want


def test_no_silver_gives_no_sums(spark, root):
    silver = KeyedTable(spark, f"{root}/silver", "plant_id", 4)
    with pytest.raises(FileNotFoundError):
        GoldSums(spark, silver, f"{root}/sums").refresh()
