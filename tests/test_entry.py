"""The driver contract: entry() runs; every registered query equals its DuckDB
oracle on the smallest driver tables (the driver itself checks sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import TABLES, canon  # noqa: E402

from conftest import SF001  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "item_id", "cnt", "rank"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.catalog.ORACLES) == set(E.catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


def check(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, res.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not n.endswith("_stream")))
def test_query_matches_oracle(spark, duck, name):
    check(spark, duck, name)
