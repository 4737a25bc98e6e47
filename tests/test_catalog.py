"""Every registered query against its SQL, and what its plan must not hold."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402

from wattlake import catalog  # noqa: E402

catalog.load()
QUERIES, SQL = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    rows = [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert compare(rows, df.columns, result.fetchall(), columns) is None


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "total_capacity_mw", "renewable_capacity_mw", "non_renewable_capacity_mw"]
    assert df.count() > 0


def test_filters_and_columns_reach_the_scan(spark, small):
    plan = QUERIES["src_03_parquet_scan"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity" in plan and "l_extendedprice" not in plan
