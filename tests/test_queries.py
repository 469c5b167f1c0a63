"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as E  # noqa: E402
from check_queries import compare  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert rows and max(r["rank"] for r in rows) == 3


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, duck, name):
    got = E.queries()[name](spark, str(SF)).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is not None:
        assert compare(got, duck.execute(sql).fetch_df()) == "ok"
