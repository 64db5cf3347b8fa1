import datetime as dt

import pytest
from pyspark.sql import functions as F

from stocklens.operators import quality
from stocklens.schemas import PRIMARY_KEYS, TABLES, apply_defaults, conform
from stocklens.sources.calendar import dim_date


def test_unique_foreign_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k INT, v STRING")
    assert [tuple(r) for r in quality.check_unique(df, ["k", "v"]).collect()] == [(1, "a", 2)]
    dim = spark.createDataFrame([(1,), (2,)], "k INT")
    assert [tuple(r) for r in quality.check_foreign_key(df, "k", dim).collect()] == [(3, 1)]
    assert {tuple(r) for r in quality.check_not_null(df, ["k", "v"]).collect()} == {("k", 0), ("v", 2)}


def test_rules_let_nulls_pass(spark):
    df = spark.createDataFrame([(4.5,), (6.0,), (None,)], "rating DOUBLE")
    assert [r["rating"] for r in quality.check_predicate(df, quality.TABLE_RULES["dim_suppliers"]["rating_0_5"]).collect()] == [6.0]
    assert quality.check_rules(df, quality.TABLE_RULES["dim_suppliers"]).collect() == [("rating_0_5", 1)]
    with pytest.raises(ValueError, match="Missing required columns"):
        quality.require_columns(df, ["rating", "other"])


def test_defaults_and_conform(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, "Closed")], "part_id INT, qty_received INT, po_status STRING")
    assert [tuple(r) for r in apply_defaults(df, "fact_purchase_orders").orderBy("part_id").collect()] == [(1, 0, "Open"), (2, 5, "Closed")]
    shaped = conform(df, "fact_purchase_orders")
    assert shaped.schema.names == TABLES["fact_purchase_orders"].names and set(PRIMARY_KEYS) == set(TABLES)


def test_upsert(spark):
    day = dt.datetime(2024, 1, 1)
    current = spark.createDataFrame([(1, "a", day), (2, "b", day), (3, "c", day)], "id INT, name STRING, updated_at TIMESTAMP")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "b", 1), (4, "n", 1), (4, None, 2)], "id INT, name STRING, seq INT")
    now = dt.datetime(2024, 5, 5)
    got = {r["id"]: (r["name"], r["updated_at"]) for r in quality.upsert_latest(current, updates, ["id"], "seq", now=now).collect()}
    assert got == {1: ("y", now), 2: ("b", day), 3: ("c", day), 4: (None, now)}


def test_dim_date(spark):
    days = dim_date(spark, "2023-12-30", "2024-03-01")
    assert days.count() == 63 and days.where("date = '2024-02-29'").first()["year_month"] == "2024-02"
    assert days.where(F.col("date") == "2024-01-01").first()["day_of_week"] == 0
