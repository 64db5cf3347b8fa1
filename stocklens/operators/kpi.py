"""Inventory, service and supplier KPIs.

Facts are reduced by key before they meet a dimension, so joins move aggregates
and a part that holds a third of the rows is one row by then. No broadcast is
forced: Spark broadcasts a dimension only when its size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import (
    KEYS,
    abc_band,
    as_of_or_max,
    exact_std,
    month_start,
    movement_status,
    num_round,
    risk_rank,
    safe_divide,
    stock_health_status,
    stockout_status,
    year_month,
)
from stocklens.operators.asof import asof_by_key
from stocklens.operators.key_day import is_state, line_aggregates
from stocklens.operators.latest import last_event, latest_row
from stocklens.operators.ordered import prefix_sum


def inventory_turnover(sales: DataFrame, inventory: DataFrame, parts: DataFrame, as_of=None) -> DataFrame:
    """COGS of the trailing 12 months over the mean snapshot value, by category."""
    today = as_of_or_max(as_of, sales, "transaction_date")
    start = F.add_months(today, -12)
    category = parts.select("part_id", "category")
    cogs = (
        sales.where(F.col("transaction_date").between(start, today))
        .groupBy("part_id").agg(F.sum("cogs").alias("cogs"))
        .join(category, "part_id")
        .groupBy("category").agg(F.sum("cogs").alias("total_cogs"))
    )
    stock = (
        inventory.where(F.col("snapshot_date").between(start, today))
        .groupBy("part_id")
        .agg(F.sum("total_stock_value").alias("value"), F.count("total_stock_value").alias("n"))
        .join(category, "part_id")
        .groupBy("category").agg(safe_divide(F.sum("value"), F.sum("n")).alias("avg_value"))
    )
    turnover = safe_divide(F.col("total_cogs"), F.col("avg_value"))
    return (
        cogs.join(stock, "category")
        .select(
            "category",
            num_round("total_cogs", 2).alias("annual_cogs"),
            num_round("avg_value", 2).alias("avg_inventory_value"),
            num_round(turnover, 2).alias("inventory_turnover"),
            num_round(safe_divide(F.lit(365.0), turnover), 1).alias("days_on_hand"),
        )
        .orderBy(F.desc_nulls_first("inventory_turnover"))
    )


def fill_rate(sales: DataFrame, dealers: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Order lines fulfilled and backordered per dealer over the last ``days``."""
    today = as_of_or_max(as_of, sales, "transaction_date")
    start = F.date_sub(today, days)
    counts = line_aggregates(sales)
    lines = (
        sales.where(F.col("transaction_date").between(start, today))
        .groupBy("dealer_id")
        .agg(
            *[counts[c].alias(c) for c in ("lines", "filled", "missed")],
            F.sum("backorder_qty").alias("backorder"),
        )
        .join(dealers.select("dealer_id", "dealer_name", "region"), "dealer_id")
    )
    total = F.sum("lines")
    return (
        lines.groupBy("dealer_name", "region")
        .agg(
            total.alias("total_order_lines"),
            F.sum("filled").alias("fulfilled_lines"),
            F.sum("backorder").alias("total_backorder_qty"),
            num_round(100.0 * F.sum("filled") / total, 2).alias("fill_rate_pct"),
            num_round(100.0 * F.sum("missed") / total, 2).alias("backorder_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("fill_rate_pct"))
    )


def stock_with_movement(inventory: DataFrame, sales: DataFrame, as_of) -> DataFrame:
    """Latest stock per part and dealer with days since the last sale (or movement)."""
    today = as_of_or_max(as_of, sales, "transaction_date")
    held = inventory if as_of is None else inventory.where(F.col("snapshot_date") <= today)
    sold = sales.where(F.col("transaction_date") <= today)
    stock = latest_row(held, "snapshot_date", ["qty_on_hand", "total_stock_value", "last_movement_date"])
    moved = F.coalesce("last_sale_date", "last_movement_date")
    return (
        stock.join(last_event(sold, "transaction_date", "last_sale_date"), list(KEYS), "left")
        .withColumn("last_movement", moved)
        .withColumn("days_no_movement", F.datediff(today, "last_movement"))
    )


def dead_stock(
    inventory: DataFrame, sales: DataFrame, parts: DataFrame, dealers: DataFrame, as_of=None, s: Settings = DEFAULTS
) -> DataFrame:
    """Positive stock without movement for more than the watch-list days."""
    idle = stock_with_movement(inventory, sales, as_of).where(
        (F.col("qty_on_hand") > 0) & (F.col("days_no_movement") > s.watch_days)
    )
    return (
        idle.join(parts.select("part_id", "part_number", "part_name", "category", "brand"), "part_id")
        .join(dealers.select("dealer_id", "dealer_name"), "dealer_id")
        .select(
            "part_number", "part_name", "category", "brand", "dealer_name", "qty_on_hand",
            num_round("total_stock_value", 2).alias("stock_value"),
            "last_movement", "days_no_movement",
            movement_status(F.col("days_no_movement"), s).alias("stock_status"),
        )
        .orderBy(F.desc_nulls_first("days_no_movement"), F.desc_nulls_first("stock_value"))
    )


def stock_health(
    inventory: DataFrame, sales: DataFrame, parts: DataFrame, dealers: DataFrame, as_of=None, days: int = 90
) -> DataFrame:
    """Latest stock against the mean daily demand of the last ``days``."""
    today = as_of_or_max(as_of, sales, "transaction_date")
    start = F.date_sub(today, days)
    demand = (
        sales.where(F.col("transaction_date").between(start, today))
        .groupBy(*KEYS).agg(F.sum("qty_sold").alias("qty"))
        .withColumn("daily", num_round(F.col("qty") / float(days), 4))
    )
    daily = F.coalesce("daily", F.lit(0.0))
    held = inventory if as_of is None else inventory.where(F.col("snapshot_date") <= today)
    return (
        latest_row(held, "snapshot_date", ["qty_on_hand", "total_stock_value"])
        .join(demand, list(KEYS), "left")
        .join(parts.select("part_id", "part_number", "part_name", "category"), "part_id")
        .join(dealers.select("dealer_id", "dealer_name"), "dealer_id")
        .select(
            "part_number", "part_name", "category", "dealer_name", "qty_on_hand",
            num_round("total_stock_value", 2).alias("stock_value"),
            F.coalesce("qty", F.lit(0)).cast("bigint").alias("qty_sold_90d"),
            daily.alias("avg_daily_demand"),
            F.coalesce(num_round(safe_divide(F.col("qty_on_hand"), daily), 0), F.lit(9999.0)).alias("days_of_stock"),
            stock_health_status(F.col("qty_on_hand"), daily).alias("stock_health"),
        )
        .orderBy(F.desc_nulls_first("days_of_stock"), "part_number", "dealer_name")  # most rows tie; names spread them over tasks
    )


def lead_time_profile(po: DataFrame) -> DataFrame:
    """Unrounded lead-time sums per supplier over closed and received orders."""
    lead, late = F.col("lead_time_actual").cast("bigint"), F.col("lead_time_delta")
    received = po.where(F.col("actual_receipt_date").isNotNull() & (F.col("po_status") == "Closed"))
    return received.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("po_count"),
        F.count(lead).alias("n"),
        F.sum(lead).alias("s"),
        F.sum(lead * lead).alias("q"),
        F.count(late).alias("n_delta"),
        F.sum(late).alias("s_delta"),
        F.count_if(late > 3).alias("late_deliveries"),
        F.count_if(late <= 0).alias("on_time"),
        F.sum("total_cost").alias("cost"),
        F.count("total_cost").alias("n_cost"),
    )


def supplier_lead_time(po: DataFrame, suppliers: DataFrame, min_orders: int = 3) -> DataFrame:
    """Lead-time level, spread and punctuality per supplier with enough orders."""
    mean = safe_divide(F.col("s"), F.col("n"))
    std = exact_std(F.col("n"), F.col("s"), F.col("q"))
    return (
        lead_time_profile(po)
        .where(F.col("po_count") >= min_orders)
        .join(suppliers, "supplier_id")
        .select(
            "supplier_name", "supplier_type", "country", "po_count",
            num_round(mean, 1).alias("avg_actual_lead_time"),
            F.col("lead_time_days").alias("contracted_lead_time"),
            num_round(std, 2).alias("lead_time_std_dev"),
            num_round(safe_divide(std, mean) * 100, 1).alias("lead_time_cov_pct"),
            num_round(safe_divide(F.col("s_delta"), F.col("n_delta")), 1).alias("avg_delay_days"),
            "late_deliveries",
            num_round(100.0 * F.col("on_time") / F.col("po_count"), 1).alias("on_time_pct"),
            num_round(safe_divide(F.col("cost"), F.col("n_cost")), 2).alias("avg_po_value"),
        )
        .orderBy(F.desc_nulls_first("on_time_pct"))
    )


def abc_revenue(
    sales: DataFrame, parts: DataFrame, dealers: DataFrame, as_of=None, s: Settings = DEFAULTS
) -> DataFrame:
    """Pareto classes of year-to-date revenue per part and dealer."""
    today = as_of_or_max(as_of, sales, "transaction_date")
    start = F.trunc(today, "YEAR")
    revenue = (
        sales.where(F.col("transaction_date").between(start, today))
        .groupBy(*KEYS).agg(F.sum("revenue").alias("annual"))
    )
    ranked = prefix_sum(
        revenue, {"running": "annual"}, [F.col("annual").desc(), F.col("part_id").asc(), F.col("dealer_id").asc()]
    )
    total = ranked.select(F.sum("annual")).scalar()
    cumulative = safe_divide(F.col("running"), total) * 100
    return (
        ranked.join(parts.select("part_id", "part_number", "part_name", "category"), "part_id")
        .join(dealers.select("dealer_id", "dealer_name"), "dealer_id")
        .select(
            "part_number", "part_name", "category", "dealer_name",
            num_round("annual", 2).alias("annual_revenue"),
            num_round(safe_divide(F.col("annual"), total) * 100, 3).alias("revenue_pct"),
            num_round(cumulative, 2).alias("cumulative_pct"),
            abc_band(cumulative, s.abc_a_pct, s.abc_b_pct).alias("abc_class"),
        )
        .orderBy(F.desc_nulls_first("annual_revenue"))
    )


def monthly_by_category(sales: DataFrame, parts: DataFrame) -> DataFrame:
    """Month x category sums.

    Reduced to (month, part) first: the distinct part count of a category is then
    a row count, so no distinct aggregate has to expand the fact rows.
    """
    per_part = sales.groupBy(month_start("transaction_date").alias("month_start"), "part_id").agg(
        F.sum("qty_sold").alias("qty"),
        F.sum("revenue").alias("revenue"),
        F.sum("cogs").alias("cogs"),
        line_aggregates(sales)["n"].alias("lines"),
    )
    return (
        per_part.join(parts.select("part_id", "category"), "part_id")
        .groupBy("month_start", "category")
        .agg(
            F.sum("qty").alias("total_qty"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("cogs").alias("total_cogs"),
            F.count(F.lit(1)).alias("unique_parts_sold"),
            F.sum("lines").alias("lines"),
        )
    )


def monthly_trend(sales: DataFrame, parts: DataFrame) -> DataFrame:
    """Monthly demand per category with growth on the previous observed month."""
    by_month = Window.partitionBy("category").orderBy("month_start")  # one row per month
    before = F.col("prev_month_qty")
    return (
        monthly_by_category(sales, parts)
        .withColumn("prev_month_qty", F.lag("total_qty").over(by_month))
        .orderBy("month_start", "category")
        .select(
            year_month("month_start").alias("month"),
            "category",
            "total_qty",
            F.col("total_revenue").cast("double").alias("total_revenue"),
            "unique_parts_sold",
            num_round(safe_divide(F.col("total_qty"), F.col("lines")), 2).alias("avg_qty_per_line"),
            "prev_month_qty",
            num_round(safe_divide(100.0 * (F.col("total_qty") - before), before), 1).alias("mom_growth_pct"),
        )
    )


def latest_policy(policy: DataFrame, as_of=None) -> DataFrame:
    """Newest policy per part and dealer; a frame without effective_date is current as is."""
    return latest_row(policy, "effective_date", as_of=as_of) if "effective_date" in policy.columns else policy


_POLICY_COLS = ["reorder_point", "safety_stock_qty", "avg_daily_demand", "avg_lead_time_days"]


def _with_risk(stock: DataFrame, parts: DataFrame, dealers: DataFrame, *more: str) -> DataFrame:
    """Stock rows that carry their policy, with names, days of stock and risk level."""
    available = F.col("qty_available")
    return (
        stock.join(parts.select("part_id", "part_number", "part_name", "category", "is_critical"), "part_id")
        .join(dealers.select("dealer_id", "dealer_name"), "dealer_id")
        .select(
            *more, "part_number", "part_name", "category", "is_critical", "dealer_name", "qty_available", "qty_in_transit",
            *_POLICY_COLS,
            num_round(safe_divide(available, F.col("avg_daily_demand")), 1).alias("days_of_stock_remaining"),
            stockout_status(available, F.col("safety_stock_qty"), F.col("reorder_point")).alias("risk_level"),
        )
    )


def stockout_risk(
    inventory: DataFrame, policy: DataFrame, parts: DataFrame, dealers: DataFrame, as_of=None, ordered: bool = True
) -> DataFrame:
    """Latest available stock against the latest reorder policy."""
    stock = latest_row(inventory, "snapshot_date", ["qty_available", "qty_in_transit"], as_of=as_of)
    out = _with_risk(stock.join(latest_policy(policy, as_of).select(*KEYS, *_POLICY_COLS), list(KEYS), "left"), parts, dealers)
    # Eight kinds of rows: the names spread those of one kind over tasks.
    order = (risk_rank(F.col("risk_level")), F.desc("is_critical"), "part_number", "dealer_name")
    return out.orderBy(*order) if ordered else out


def stockout_risk_history(inventory: DataFrame, policy: DataFrame, parts: DataFrame, dealers: DataFrame) -> DataFrame:
    """Every snapshot against the reorder policy that was valid on its day (none before the first).

    Of two policies of one key and day the one with the greater reorder point counts, then the greater of its
    other columns."""
    stock = inventory.select(*KEYS, "snapshot_date", "qty_available", "qty_in_transit")
    valid = asof_by_key(stock, policy, "snapshot_date", "effective_date", [*_POLICY_COLS, "effective_date"])
    return _with_risk(valid, parts, dealers, "snapshot_date", "effective_date")


def create_stockout_view(name: str = "vw_stockout_risk", **frames) -> DataFrame:
    """Register the stock-out risk frame as a session view."""
    df = stockout_risk(**frames)
    df.createOrReplaceTempView(name)
    return df


def service_level(sales: DataFrame, by: tuple[str, ...] = ("dealer_id",)) -> DataFrame:
    """1 - stock-out events / demand events.

    A demand event is a day on which a part was asked for at a dealer; it is a
    stock-out event when any line of that day was not fulfilled.
    """
    keys = list(dict.fromkeys([*by, *KEYS, "transaction_date"]))
    missed = F.col("missed") > 0 if is_state(sales) else ~F.col("was_fulfilled")
    events = sales.groupBy(*keys).agg(F.max(missed.cast("int")).alias("missed"))
    return events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("demand_events"),
        F.sum("missed").alias("stockout_events"),
        num_round(100.0 * (1.0 - F.sum("missed") / F.count(F.lit(1))), 2).alias("service_level_pct"),
    )
