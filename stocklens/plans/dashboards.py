"""Datasets behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import (
    KEYS,
    as_of_or_max,
    bands,
    exact_std,
    half_even,
    month_start,
    num_round,
    safe_divide,
    year_month,
)
from stocklens.operators import cube, key_day, kpi, measures
from stocklens.operators.classify import abc_xyz_summary, action_matrix
from stocklens.operators.latest import latest_row
from stocklens.sources.scratch import materialize


def _share(df: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """Sum per group and its share of the total; ``df`` is a small aggregate."""
    total = df.select(F.sum(value)).scalar()
    return df.select(
        by, F.col(value).cast("double").alias(value), num_round(safe_divide(F.col(value), total) * 100, 2).alias(out)
    )


# ---------------------------------------------------------------- executive page
def monthly_revenue_cogs(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(year_month("transaction_date").alias("month"))
        .agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("cogs").cast("double").alias("cogs"))
        .orderBy("month")
    )


def revenue_by_category(sales: DataFrame, parts: DataFrame) -> DataFrame:
    per_part = sales.groupBy("part_id").agg(F.sum("revenue").alias("revenue"))
    by_category = per_part.join(parts.select("part_id", "category"), "part_id").groupBy("category").agg(
        F.sum("revenue").alias("revenue")
    )
    return _share(by_category, "category", "revenue", "revenue_share_pct").orderBy(F.desc("revenue"))


def fill_by_branch(sales: DataFrame, dealers: DataFrame, as_of=None) -> DataFrame:
    return kpi.fill_rate(sales, dealers, as_of).select("dealer_name", "fill_rate_pct", "backorder_rate_pct")


def revenue_by_customer_type(sales: DataFrame) -> DataFrame:
    sums = sales.groupBy("customer_type").agg(F.sum("revenue").alias("revenue"))
    return _share(sums, "customer_type", "revenue", "revenue_share_pct").orderBy(F.desc("revenue"))


def top_parts(sales: DataFrame, parts: DataFrame, n: int = 10) -> DataFrame:
    """Top parts by revenue; only the n winners meet the part master."""
    best = sales.groupBy("part_id").agg(F.sum("revenue").alias("revenue")).orderBy(F.desc("revenue"), "part_id").limit(n)
    return best.join(parts.select("part_id", "part_number", "part_name"), "part_id").select(
        "part_number", "part_name", F.col("revenue").cast("double").alias("revenue")
    ).orderBy(F.desc("revenue"), "part_number")


# ---------------------------------------------------------------- inventory page
def segment_counts(classified: DataFrame) -> DataFrame:
    """Part and dealer pairs in each of the nine segments, empty ones as 0."""
    seen = classified.groupBy("combined_class").agg(F.count("part_id").alias("n"))
    grid = action_matrix(classified.sparkSession).select("combined_class")
    return grid.join(seen, "combined_class", "left").select(
        "combined_class", F.coalesce("n", F.lit(0)).alias("sku_count")
    ).orderBy("combined_class")


def stock_by_age(inventory: DataFrame, sales: DataFrame, as_of=None) -> DataFrame:
    """Latest stock value by days since movement."""
    stock = kpi.stock_with_movement(inventory, sales, as_of)
    days = F.col("days_no_movement")
    age = (
        F.when(days < 30, "Active <30d").when(days <= 90, "Watch 30-90d").when(days <= 365, "Slow >90d").otherwise("Dead >365d")
    )
    sums = stock.groupBy(age.alias("age_band")).agg(F.sum("total_stock_value").alias("stock_value"))
    return _share(sums, "age_band", "stock_value", "value_share_pct")


def dead_stock_priority(inventory: DataFrame, sales: DataFrame, parts: DataFrame, dealers: DataFrame, as_of=None, n: int = 20) -> DataFrame:
    """Largest idle stock values."""
    rows = kpi.dead_stock(inventory, sales, parts, dealers, as_of)
    return rows.select(
        "part_number", "part_name", "category", "dealer_name", "qty_on_hand", "stock_value", "days_no_movement", "stock_status"
    ).orderBy(F.desc("stock_value"), F.desc("days_no_movement"), "part_number", "dealer_name").limit(n)


def health_counts(inventory: DataFrame, sales: DataFrame, parts: DataFrame, dealers: DataFrame, as_of=None) -> DataFrame:
    rows = kpi.stock_health(inventory, sales, parts, dealers, as_of)
    return rows.groupBy("stock_health").agg(
        F.count(F.lit(1)).alias("sku_count"),
        F.sum(F.col("stock_value").cast("decimal(18,2)")).cast("double").alias("stock_value"),
    )


def class_heatmap(classified: DataFrame) -> DataFrame:
    """ABC rows against XYZ columns."""
    return classified.groupBy("abc_class").agg(
        *[F.count_if(F.col("xyz_class") == c).alias(f"{c.lower()}_count") for c in "XYZ"],
        *[
            F.coalesce(F.sum(F.when(F.col("xyz_class") == c, F.col("annual_revenue"))).cast("double"), F.lit(0.0)).alias(
                f"{c.lower()}_revenue"
            )
            for c in "XYZ"
        ],
    )


# ---------------------------------------------------------------- demand page
def top_category_demand(sales: DataFrame, parts: DataFrame, n: int = 4) -> DataFrame:
    """Monthly units of the n categories with most units."""
    monthly = kpi.monthly_by_category(sales, parts).select("month_start", "category", "total_qty")
    best = monthly.groupBy("category").agg(F.sum("total_qty").alias("t")).orderBy(F.desc("t"), "category").limit(n)
    return monthly.join(best, "category", "left_semi").select(
        year_month("month_start").alias("month"), "category", "total_qty"
    ).orderBy("month", "category")


def pareto(classified: DataFrame) -> DataFrame:
    return abc_xyz_summary(classified, "abc_class").select("abc_class", "part_share_pct", "revenue_share_pct")


def xyz_distribution(classified: DataFrame) -> DataFrame:
    sums = classified.groupBy("xyz_class").agg(F.count("part_id").alias("sku_count"))
    return _share(sums, "xyz_class", "sku_count", "sku_share_pct").withColumn("sku_count", F.col("sku_count").cast("bigint"))


def units_by_customer_type(sales: DataFrame) -> DataFrame:
    sums = sales.groupBy("customer_type").agg(F.sum("qty_sold").alias("units"))
    return _share(sums, "customer_type", "units", "unit_share_pct").withColumn("units", F.col("units").cast("bigint"))


# ---------------------------------------------------------------- supplier page
def supplier_on_time(po: DataFrame, suppliers: DataFrame, as_of) -> DataFrame:
    """On-time share of orders closed in the last 12 months, banded."""
    end = as_of_or_max(as_of, po, "order_date")
    inside = (F.col("order_date") >= F.add_months(end, -12)) & (F.col("order_date") <= end)
    recent = po.where((F.col("po_status") == "Closed") & inside)
    rates = recent.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("closed_pos"), F.count_if(F.col("lead_time_delta") <= 0).alias("ok")
    )
    pct = safe_divide(F.col("ok"), F.col("closed_pos")) * 100
    band = F.when(pct >= 90, "on target").when(pct >= 80, "watch").otherwise("below")
    return rates.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id").select(
        "supplier_name", "closed_pos", num_round(pct, 1).alias("on_time_pct"), band.alias("otd_band")
    ).orderBy(F.desc("on_time_pct"), "supplier_name")


def lead_time_scatter(po: DataFrame, suppliers: DataFrame) -> DataFrame:
    lead = F.when(F.col("lead_time_actual") > 0, F.col("lead_time_actual").cast("bigint"))
    sums = po.groupBy("supplier_id").agg(
        F.count(lead).alias("n"), F.sum(lead).alias("s"), F.sum(lead * lead).alias("q"), F.sum("total_cost").alias("value")
    )
    return sums.join(suppliers.select("supplier_id", "supplier_name", "supplier_type"), "supplier_id").select(
        "supplier_name", "supplier_type",
        num_round(safe_divide(F.col("s"), F.col("n")), 2).alias("avg_lead_time_days"),
        num_round(exact_std(F.col("n"), F.col("s"), F.col("q")), 2).alias("lead_time_std_dev"),
        F.col("value").cast("double").alias("total_po_value"),
    )


def supplier_scorecard(po: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Suppliers ranked by punctuality. Status cut-offs 90 / 85 / 75 are our choice."""
    pct = F.col("on_time_pct")
    status = F.when(pct >= 90, "Preferred").when(pct >= 85, "Active").when(pct >= 75, "Monitor").otherwise("Review")
    return kpi.supplier_lead_time(po, suppliers).select(
        "supplier_name", "supplier_type", "country", "on_time_pct", "avg_actual_lead_time", "lead_time_std_dev",
        status.alias("supplier_status"),
    )


def late_deliveries_by_month(po: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Received orders more than three days late by supplier and receipt month."""
    received = po.where(F.col("actual_receipt_date").isNotNull() & (F.col("po_status") == "Closed"))
    sums = received.groupBy("supplier_id", month_start("actual_receipt_date").alias("m")).agg(
        F.count(F.lit(1)).alias("received_pos"), F.count_if(F.col("lead_time_delta") > 3).alias("late_deliveries")
    )
    return sums.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id").select(
        "supplier_name", year_month("m").alias("month"), "received_pos", "late_deliveries"
    )


# ---------------------------------------------------------------- replenishment page
def action_list(
    inventory: DataFrame, policy: DataFrame, parts: DataFrame, classified: DataFrame, scores: DataFrame | None = None,
    as_of=None, n: int | None = None,
) -> DataFrame:
    """Positions below the reorder point with segment, days of stock, risk and lot size.

    Ranked by model probability when scores are given, else by days of stock.
    """
    keys = list(KEYS)
    stock = latest_row(inventory, "snapshot_date", ["qty_available"], as_of=as_of)
    rows = (
        stock.join(kpi.latest_policy(policy, as_of).select(*keys, "avg_daily_demand", "reorder_point", "economic_order_qty"), keys)
        .where(F.col("qty_available") < F.col("reorder_point"))
        .join(classified.select(*keys, "combined_class"), keys, "left")
        .join(parts.select("part_id", "part_number", "part_name"), "part_id")
        .withColumn("days_of_stock", num_round(safe_divide(F.col("qty_available"), F.col("avg_daily_demand")), 1))
    )
    cols = ["part_number", "part_name", "dealer_id", "combined_class", "qty_available", "reorder_point", "days_of_stock"]
    if scores is None:
        out = rows.select(*cols, "economic_order_qty").orderBy(F.asc("days_of_stock"), "part_number", "dealer_id")
    else:
        out = rows.join(scores.select(*keys, "stockout_probability"), keys, "left").select(
            *cols, "stockout_probability", "economic_order_qty"
        ).orderBy(F.desc("stockout_probability"), F.asc("days_of_stock"), "part_number", "dealer_id")
    return out if n is None else out.limit(n)


def kpi_cards(
    sales: DataFrame, inventory: DataFrame, po: DataFrame, parts: DataFrame, policy: DataFrame, as_of,
    classified: DataFrame | None = None, forecasts: DataFrame | None = None, s: Settings = DEFAULTS,
) -> DataFrame:
    """(card, value): the headline figures of all pages, on the latest stock.

    The latest stock is written once at key level; the sales, stock and order figures are one pass each over their
    fact (or over a key x day state of the sales). ``classified`` and ``forecasts`` add the cards that need them.
    """
    stock = materialize(
        latest_row(inventory, "snapshot_date", ["qty_on_hand", "qty_available", "avg_unit_cost", "last_movement_date"]),
        "latest_stock",
    )
    turnover = measures.inventory_turnover_ratio(sales, inventory, as_of)
    end = as_of_or_max(as_of, sales, "transaction_date")
    this_year = F.col("transaction_date").between(F.trunc(end, "YEAR"), end)
    ordered = F.col("order_date").between(F.trunc(end, "YEAR"), end)
    growth = cube.sales_measures(sales, end)
    net = "net" if key_day.is_state(sales) else F.col("qty_sold") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct"))
    frames = [
        measures.sales_overview(sales),
        cube.measures_of(sales, {n: growth[n] for n in ("revenue_vs_prior", "gross_profit_margin_pct", "avg_monthly_demand_per_part", "demand_mom_growth_pct")}),
        sales.where(this_year).agg(
            num_round(F.sum(net).cast("double") / 100.0, 2).alias("revenue_ytd"), F.sum("qty_sold").alias("units_ytd")),
        po.where(ordered).agg(num_round(F.sum(F.col("qty_ordered") * F.col("unit_cost")).cast("double"), 2).alias("po_value_ytd")),
        measures.avg_coverage_days(stock, sales, as_of),
        measures.recommended_order_qty(stock, policy),
        measures.stock_overview(stock, as_of, slow_days=s.slow_days, dead_days=s.dead_days),
        measures.active_sku_count(stock, parts),
        turnover.select("inventory_turnover", num_round(safe_divide(F.lit(365.0), F.col("inventory_turnover"), 0), 4).alias("days_on_hand")),
        measures.purchase_overview(po),
        measures.parts_at_risk(stock, policy),
        measures.replenishment_cost(stock, policy, parts),
        measures.urgency_score(stock, sales, policy, parts, as_of),
        policy.agg(half_even(F.avg(num_round("days_of_safety_stock", 6)), 2).alias("avg_safety_stock_days")),
    ]
    if classified is not None:
        frames.append(measures.a_class_revenue_share_pct(sales, classified))
    if forecasts is not None:
        frames += [measures.avg_forecast_mape(forecasts), measures.next_month_forecast_qty(forecasts, as_of)]
    out = _melt(frames[0])
    for frame in frames[1:]:
        out = out.unionByName(_melt(frame))
    return out


def _melt(one_row: DataFrame) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("card"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*cells)))
