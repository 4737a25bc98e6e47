"""Every query of the package against its SQL, and how the package hangs on the rest."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_oracle import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from wattlake.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    df = QUERIES[name](spark, small)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert compare([tuple(r) for r in df.collect()], df.columns, result.fetchall(), columns) is None


def test_all_are_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2] / "wattlake"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "wattlake.llm" not in path.read_text()


@pytest.mark.parametrize("name", ["op8_digest_index", "op12_voted_rules"])
def test_native_query_runs_no_python(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
