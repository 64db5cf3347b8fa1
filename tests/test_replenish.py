import pytest
from pyspark.sql import functions as F

from stocklens.functions.scalar import bands, clip, month_diff, num_round, order_quantity, reorder_point, safe_divide, safety_stock
from stocklens.operators.replenish import demand_stats, lead_time_stats, reorder_policies
from stocklens.schemas import policy_table
from stocklens.sources.files import empty_purchase_orders


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def lit(x):
    return F.lit(x).cast("double")


def test_safety_stock_golden(spark):
    # 1.645 * sqrt(10 * 4 + 25 * 1) = 13.26
    assert value(spark, safety_stock(lit(1.645), lit(10), lit(1), lit(5), lit(2))) == 14
    assert value(spark, safety_stock(lit(1.645), lit(10), lit(0), lit(5), lit(0))) == 0
    assert value(spark, reorder_point(lit(5), lit(10), lit(14))) == 64
    assert value(spark, reorder_point(lit(0), lit(10), lit(0))) == 1


@pytest.mark.parametrize("demand, holding, expected", [(1000, 5.0, 100), (0, 5.0, 1), (10, 0.0, 1), (0.125, 1.0, 2), (0.001, 50.0, 1)])
def test_order_quantity(spark, demand, holding, expected):
    # sqrt(2 * 0.125 * 25) = 2.5 rounds to even
    assert value(spark, order_quantity(lit(demand), lit(holding), 25.0)) == expected


def test_scalars(spark):
    assert value(spark, num_round(lit(2.675), 2)) == 2.68
    assert value(spark, safe_divide(lit(1), lit(0))) is None and value(spark, safe_divide(lit(1), lit(0), 7)) == 7.0
    assert value(spark, clip(F.lit(None).cast("double"), 0, 100)) is None
    assert [value(spark, clip(lit(x), 0, 100)) for x in (-1, 50, 101)] == [0, 50, 100]
    assert [value(spark, bands(lit(x), [(0.25, "L"), (0.5, "M")], "H")) for x in (0.25, 0.26, 0.51)] == ["L", "M", "H"]
    d = lambda t: F.lit(t).cast("date")
    assert value(spark, month_diff(d("2024-01-31"), d("2024-02-01"))) == 1


SALES = "d STRING, part_id INT, dealer_id INT, qty_sold INT"
PO = "part_id INT, r STRING, lead_time_actual INT"


def frames(spark):
    sales = spark.createDataFrame(
        [("2024-01-01", 1, 1, 2), ("2024-01-01", 1, 1, 2), ("2024-01-05", 1, 1, 8), ("2024-01-02", 2, 1, 3), ("2024-01-02", 3, 1, 3)], SALES
    ).withColumn("transaction_date", F.to_date("d"))
    po = spark.createDataFrame([(1, "x", 10), (1, "x", 14), (1, None, 99), (1, "x", -1), (2, "x", 5)], PO).withColumn("actual_receipt_date", F.col("r"))
    return sales, po


def test_statistics(spark):
    sales, po = frames(spark)
    demand = {r["part_id"]: (r["avg_daily_demand"], r["demand_std_daily"]) for r in demand_stats(sales).collect()}
    assert demand[1] == (6.0, pytest.approx(8**0.5)) and demand[2] == (3.0, 0.0)
    lead = {r["part_id"]: (r["avg_lead_time_days"], r["lead_time_std_dev"]) for r in lead_time_stats(po).collect()}
    assert lead == {1: (12.0, pytest.approx(8**0.5)), 2: (5.0, 3.0)}


def test_policies(spark):
    sales, po = frames(spark)
    abc = spark.createDataFrame([(1, 1, "A"), (2, 1, "C")], "part_id INT, dealer_id INT, abc_class STRING")
    parts = spark.createDataFrame([(1, False, 20.0), (2, True, None)], "part_id INT, is_critical BOOLEAN, standard_cost DOUBLE")
    got = {r["part_id"]: r for r in reorder_policies(sales, po, abc, parts).collect()}
    assert [got[i]["service_level_z"] for i in (1, 2, 3)] == [2.054, 2.054, 1.645]
    assert (got[3]["avg_lead_time_days"], got[3]["lead_time_std_dev"]) == (21.0, 7.0)
    assert got[1]["safety_stock_qty"] == 41  # 2.054 * sqrt(12 * 8 + 36 * 8) = 40.25
    assert got[1]["reorder_point"] == 113 and got[1]["economic_order_qty"] == 148
    assert got[1]["max_stock_level"] == 261
    assert got[2]["economic_order_qty"] == round((2 * 3 * 365 * 25 / 12.5) ** 0.5)
    assert got[3]["demand_cov"] == 0 and got[3]["days_of_safety_stock"] == pytest.approx(got[3]["safety_stock_qty"] / 3)
    plain = reorder_policies(sales, empty_purchase_orders(spark))
    assert {r["service_level_z"] for r in plain.collect()} == {1.645}
    stored = policy_table(plain, "2024-02-01")
    assert "demand_std_dev" in stored.columns and stored.where("effective_date = '2024-02-01'").count() == 3
