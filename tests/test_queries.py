"""Every registered query against its SQL check, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from feedlens.plans.oracles import ORACLES
from feedlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def plain(x):
    return round(x, 9) if isinstance(x, float) and math.isfinite(x) else x


def bag(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and len(df.columns) == 7


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert bag(df.select([f"`{c}`" for c in columns]).collect()) == bag(want)
