import datetime as dt


import pytest
from pyspark.sql import functions as F

from stocklens.operators import kpi, measures
from stocklens.plans import dashboards
from stocklens.schemas import derive_inventory, derive_purchase_orders, derive_sales

AS_OF = "2024-12-31"


def dated(df, *cols):
    return df.withColumns({c: F.to_date(c) for c in cols})


@pytest.fixture(scope="module")
def star(spark):
    parts = spark.createDataFrame(
        [(1, "P-1", "pad", "Brakes", "Own", 10.0, True, True), (2, "P-2", "belt", "Engine", "Own", 4.0, False, True),
         (3, "P-3", "oil", "Engine", "Own", 2.0, False, False)],
        "part_id INT, part_number STRING, part_name STRING, category STRING, brand STRING, standard_cost DOUBLE, is_critical BOOLEAN, is_active BOOLEAN")
    dealers = spark.createDataFrame([(1, "North", "N"), (2, "South", "S")], "dealer_id INT, dealer_name STRING, region STRING")
    sales = dated(spark.createDataFrame(
        [("2024-12-30", 1, 1, 9, 20.0, 0.0, True, 0), ("2024-12-30", 1, 1, 1, 20.0, 50.0, False, 1), ("2024-11-15", 2, 1, 18, 10.0, 0.0, True, 0),
         ("2024-01-10", 2, 2, 4, 10.0, 0.0, True, 0), ("2023-12-30", 1, 1, 5, 20.0, 0.0, True, 0)],
        "transaction_date STRING, part_id INT, dealer_id INT, qty_sold INT, unit_price DOUBLE, discount_pct DOUBLE, was_fulfilled BOOLEAN, backorder_qty INT"), "transaction_date")
    sales = derive_sales(sales.withColumns({"unit_price": F.col("unit_price").cast("decimal(12,2)"), "discount_pct": F.col("discount_pct").cast("decimal(5,2)")}), parts)
    inventory = derive_inventory(dated(spark.createDataFrame(
        [("2024-11-30", 1, 1, 90, 0, 0, 10.0, "2024-11-01"), ("2024-12-31", 1, 1, 12, 2, 5, 10.0, "2024-12-30"), ("2024-12-31", 2, 1, 60, 0, 0, 4.0, "2024-11-15"),
         ("2024-12-31", 2, 2, 7, 7, 0, 4.0, "2024-12-01"), ("2024-12-31", 3, 1, 40, 0, 0, 2.0, "2023-11-01"), ("2024-12-31", 3, 2, 0, 0, 0, 2.0, "2020-01-01")],
        "snapshot_date STRING, part_id INT, dealer_id INT, qty_on_hand INT, qty_reserved INT, qty_in_transit INT, avg_unit_cost DOUBLE, last_movement_date STRING"),
        "snapshot_date", "last_movement_date"))
    po = derive_purchase_orders(dated(spark.createDataFrame(
        [(1, "2024-10-01", "2024-10-15", "2024-10-16"), (1, "2024-10-05", "2024-10-12", "2024-10-17"), (1, "2024-11-01", "2024-11-15", "2024-11-14"), (2, "2024-11-01", "2024-11-15", None)],
        "supplier_id INT, order_date STRING, promised_date STRING, actual_receipt_date STRING"), "order_date", "promised_date", "actual_receipt_date")
        .withColumns({"qty_ordered": F.lit(10), "unit_cost": F.lit(8.5), "part_id": F.lit(1), "po_status": F.when(F.col("actual_receipt_date").isNull(), "Open").otherwise("Closed")}))
    suppliers = spark.createDataFrame([(1, "Alpha", "OEM", "X", 14), (2, "Beta", "OES", "Y", 7)], "supplier_id INT, supplier_name STRING, supplier_type STRING, country STRING, lead_time_days INT")
    policy = dated(spark.createDataFrame(
        [("2024-06-01", 1, 1, 99, 99, 1.0, 10.0, 5), ("2024-12-01", 1, 1, 11, 40, 2.0, 10.0, 30), ("2024-12-01", 2, 1, 10, 50, 2.0, 10.0, 20), ("2024-12-01", 2, 2, 3, 5, 0.0, 10.0, 9)],
        "effective_date STRING, part_id INT, dealer_id INT, safety_stock_qty INT, reorder_point INT, avg_daily_demand DOUBLE, avg_lead_time_days DOUBLE, economic_order_qty INT"), "effective_date")
    return dict(parts=parts, dealers=dealers, sales=sales, inventory=inventory, po=po, suppliers=suppliers, policy=policy)


def test_fill_rate(star):
    rows = {r["dealer_name"]: r for r in kpi.fill_rate(star["sales"], star["dealers"], AS_OF).collect()}
    assert set(rows) == {"North"}
    assert (rows["North"]["total_order_lines"], rows["North"]["fill_rate_pct"], rows["North"]["total_backorder_qty"]) == (3, 66.67, 1)


def test_turnover(star):
    rows = {r["category"]: r for r in kpi.inventory_turnover(star["sales"], star["inventory"], star["parts"], AS_OF).collect()}
    assert (rows["Brakes"]["annual_cogs"], rows["Brakes"]["avg_inventory_value"]) == (100.0, 510.0)
    assert rows["Engine"]["annual_cogs"] == 88.0 and rows["Engine"]["avg_inventory_value"] == 87.0
    assert rows["Engine"]["inventory_turnover"] == 1.01 and rows["Engine"]["days_on_hand"] == 360.9


def test_dead_stock_last_sale_wins(star):
    rows = {(r["part_number"], r["dealer_name"]): r for r in kpi.dead_stock(star["inventory"], star["sales"], star["parts"], star["dealers"], AS_OF).collect()}
    assert rows[("P-2", "South")]["stock_status"] == "Slow Moving"  # sold in January, moved in December
    assert rows[("P-3", "North")]["stock_status"] == "Dead Stock"
    assert set(rows) == {("P-2", "South"), ("P-3", "North")}


def test_stock_health(star):
    rows = {(r["part_number"], r["dealer_name"]): r for r in kpi.stock_health(star["inventory"], star["sales"], star["parts"], star["dealers"], AS_OF).collect()}
    assert rows[("P-1", "North")]["avg_daily_demand"] == 0.1111 and rows[("P-1", "North")]["stock_health"] == "High Stock"
    assert rows[("P-2", "North")]["days_of_stock"] == 300 and rows[("P-2", "North")]["stock_health"] == "Overstock"
    assert rows[("P-3", "North")]["days_of_stock"] == 9999 and rows[("P-3", "North")]["stock_health"] == "No Demand"


def test_supplier_lead_time_needs_three_orders(star):
    rows = kpi.supplier_lead_time(star["po"], star["suppliers"]).collect()
    assert [r["supplier_name"] for r in rows] == ["Alpha"]
    r = rows[0]
    assert (r["po_count"], r["avg_actual_lead_time"], r["avg_delay_days"], r["late_deliveries"], r["on_time_pct"]) == (3, 13.3, 1.7, 1, 33.3)
    assert r["lead_time_std_dev"] == 1.53 and r["avg_po_value"] == 85.0


def test_stockout_ladder_and_view(star, spark):
    frames = {k: star[k] for k in ("inventory", "policy", "parts", "dealers")}
    kpi.create_stockout_view("risk_view", **frames)
    rows = spark.sql("SELECT part_number, dealer_name, risk_level, days_of_stock_remaining AS d, reorder_point AS r FROM risk_view").collect()
    assert {(r["part_number"], r["dealer_name"]): (r["risk_level"], r["d"], r["r"]) for r in rows} == {
        ("P-1", "North"): ("CRITICAL", 5.0, 40), ("P-2", "North"): ("WATCH" if 60 < 50 * 1.2 else "OK", 30.0, 50), ("P-2", "South"): ("STOCKOUT", None, 5),
        ("P-3", "North"): ("OK", None, None), ("P-3", "South"): ("STOCKOUT", None, None)}
    order = [r["risk_level"] for r in kpi.stockout_risk(**frames).collect()]
    assert order == sorted(order, key=["STOCKOUT", "CRITICAL", "ORDER NOW", "WATCH", "OK"].index)
    old = kpi.stockout_risk(**frames, as_of="2024-11-30").collect()
    assert [(r["part_number"], r["reorder_point"]) for r in old] == [("P-1", 99)]


def test_trend_growth_uses_previous_observed_month(star):
    rows = [(r["month"], r["total_qty"], r["prev_month_qty"], r["mom_growth_pct"]) for r in kpi.monthly_trend(star["sales"], star["parts"]).where("category = 'Brakes'").collect()]
    assert rows == [("2023-12", 5, None, None), ("2024-12", 10, 5, 100.0)]


def test_service_level(star):
    rows = {r["dealer_id"]: r for r in kpi.service_level(star["sales"]).collect()}
    assert (rows[1]["demand_events"], rows[1]["stockout_events"], rows[1]["service_level_pct"]) == (3, 1, 66.67)


def test_measures(star):
    one = lambda df: df.first()[-1]
    s, inv, pol, parts = star["sales"], star["inventory"], star["policy"].where("effective_date = '2024-12-01'"), star["parts"]
    stock = inv.where("snapshot_date = '2024-12-31'")
    assert one(measures.total_revenue(s)) == 180 + 10 + 180 + 40 + 100
    prior = measures.revenue_vs_prior(s, AS_OF).first()
    assert (prior["current_revenue"], prior["prior_revenue"], prior["revenue_vs_prior"]) == (410.0, 100.0, 3.1)
    assert one(measures.fill_rate_pct(s)) == 80 and one(measures.fill_rate_pct(s.limit(0))) == 100
    assert one(measures.backorder_rate_pct(s)) == 20
    assert one(measures.active_sku_count(inv, parts)) == 2
    assert one(measures.total_inventory_value(stock)) == 120 + 240 + 28 + 80
    assert one(measures.dead_stock_value(stock, AS_OF)) == 80
    assert one(measures.parts_at_risk(stock, pol)) == 2
    assert one(measures.recommended_order_qty(stock, pol)) == 39
    assert one(measures.replenishment_cost(stock, pol, parts)) == 30 * 10 + 9 * 4
    assert one(measures.avg_monthly_demand_per_part(s)) == num(37 / (2 * 12))
    assert one(measures.demand_mom_growth_pct(s, AS_OF)) == num((10 - 18) / 18 * 100)
    assert one(measures.lead_time_std(star["po"])) == num(((15 - 40 / 3) ** 2 + (12 - 40 / 3) ** 2 + (13 - 40 / 3) ** 2) ** 0.5 / 3**0.5)
    assert one(measures.avg_delay_days(star["po"])) == 3.0
    assert one(measures.on_time_pct(star["po"])) == num(100 / 3)
    score = one(measures.urgency_score(stock, s, pol, parts, AS_OF))
    assert score == pytest.approx(0.6 * 0 + 0.4 * 100, abs=1e-3)


def num(x):
    return pytest.approx(x, abs=1e-4)


def test_dashboard_lists(star):
    top = dashboards.top_parts(star["sales"], star["parts"], 1).collect()
    assert [(r["part_number"], r["revenue"]) for r in top] == [("P-1", 290.0)]
    ages = {r["age_band"]: r["stock_value"] for r in dashboards.stock_by_age(star["inventory"], star["sales"], AS_OF).collect()}
    assert ages == {"Active <30d": 120.0, "Watch 30-90d": 240.0, "Slow >90d": 28.0, "Dead >365d": 80.0}
    assert dashboards.dead_stock_priority(star["inventory"], star["sales"], star["parts"], star["dealers"], AS_OF, n=1).first()["part_number"] == "P-3"
    abc = star["parts"].select("part_id", F.lit(1).alias("dealer_id"), F.lit("AX").alias("combined_class"))
    scores = star["parts"].select("part_id", F.lit(1).alias("dealer_id"), F.lit(0.9).alias("stockout_probability"))
    acts = dashboards.action_list(star["inventory"], star["policy"], star["parts"], abc, scores).collect()
    assert [(r["part_number"], r["dealer_id"], r["stockout_probability"]) for r in acts] == [("P-1", 1, 0.9), ("P-2", 2, None)]


def test_rows_after_as_of_are_not_seen(spark):
    day = lambda text: dt.date.fromisoformat(text)
    sales = spark.createDataFrame(
        [(1, 1, day("2024-01-10"), 5, True, 0), (1, 1, day("2024-06-01"), 500, False, 500)],
        "part_id INT, dealer_id INT, transaction_date DATE, qty_sold INT, was_fulfilled BOOLEAN, backorder_qty INT",
    )
    stock = spark.createDataFrame(
        [(1, 1, day("2024-01-01"), 3, 30.0, day("2023-12-01")), (1, 1, day("2024-07-01"), 9, 90.0, day("2024-06-01"))],
        "part_id INT, dealer_id INT, snapshot_date DATE, qty_on_hand INT, total_stock_value DOUBLE, last_movement_date DATE",
    )
    dealers = spark.createDataFrame([(1, "D", "R")], "dealer_id INT, dealer_name STRING, region STRING")
    assert kpi.fill_rate(sales, dealers, "2024-01-31").first()["total_order_lines"] == 1
    moved = kpi.stock_with_movement(stock, sales, "2024-01-31").first()
    assert (moved["qty_on_hand"], moved["days_no_movement"]) == (3, 21)


def test_rows_of_one_rank_are_sorted_in_many_tasks(spark):
    """Parts without demand tie in days of stock, rows of one risk level in the order of risk."""
    n = 300
    parts = spark.range(n).selectExpr("cast(id as int) part_id", "concat('P-', id) part_number", "'x' part_name", "'c' category", "false is_critical")
    dealers = spark.createDataFrame([(1, "North")], "dealer_id INT, dealer_name STRING")
    stock = spark.range(n).selectExpr("cast(id as int) part_id", "1 dealer_id", "date'2024-12-01' snapshot_date", "5 qty_on_hand", "5 qty_available",
                                      "0 qty_in_transit", "1.0 total_stock_value")
    sales = spark.createDataFrame([], "part_id INT, dealer_id INT, transaction_date DATE, qty_sold INT")
    policy = spark.createDataFrame([], "part_id INT, dealer_id INT, reorder_point DOUBLE, safety_stock_qty DOUBLE, avg_daily_demand DOUBLE, avg_lead_time_days DOUBLE")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for out in (kpi.stock_health(stock, sales, parts, dealers, AS_OF), kpi.stockout_risk(stock, policy, parts, dealers)):
            tasks = out.withColumn("_task", F.spark_partition_id()).groupBy("_task").count().collect()
            assert len(tasks) > 4 and sum(r["count"] for r in tasks) == n
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
