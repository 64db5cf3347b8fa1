"""Every text query that has an SQL form against it, on the smallest tables."""

import os

import duckdb
import pytest

from stocklens.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(name, spark):
    con = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert sorted(map(tuple, df.select(columns).collect()), key=str) == sorted(expected, key=str)
