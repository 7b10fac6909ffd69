"""The driver's contract: every query runs on the smallest tables, and agrees with its SQL there."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from lodestone.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    return f"{v:.8g}" if isinstance(v, float) else str(list(map(plain, v))) if isinstance(v, list | tuple) else str(v)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries()) and set(registry.QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, oracle, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted([plain(v) for v in r] for r in df.select(*cols).collect())
    if name in registry.ORACLES:
        want = oracle.sql(registry.ORACLES[name])
        assert sorted(want.columns) == cols
        assert got == sorted([plain(v) for v in r] for r in want.select(", ".join(cols)).fetchall())
