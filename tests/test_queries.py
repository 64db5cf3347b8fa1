"""Every registered query against its SQL form on the smallest tables."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from stocklens.plans import registry
from stocklens.plans.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
SLOW = {"stockout_scores", "stockout_model_metrics", "stockout_feature_importance", "stockout_cross_validation", "pipeline_outputs"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(os.listdir(FOLDER)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return str(v) if isinstance(v, decimal.Decimal) else v


def ordered(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, duck):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [[r[names.index(c)] for c in columns] for r in cursor.fetchall()]
    assert ordered(df.select(columns).collect()) == ordered(expected)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(ORACLE) - SLOW))
def test_query_runs(name, spark):
    assert not entry.queries()[name](spark, FOLDER).isEmpty()


def test_every_query_is_an_entry():
    assert set(registry.QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
