"""Every registered query against its SQL on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as registry
from terravia.plans.fixtures import TABLES
from terravia.plans.registry import ORACLES, QUERIES
from tools.check import table_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    mine = table_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(registry.oracle_sql()[name])
    assert mine == table_of([c[0] for c in found.description], found.fetchall())


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns == ["gid", "x", "y", "_cei", "_district"]
    assert df.count() == 150
