"""Demand and lead-time statistics, safety stock and reorder policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import KEYS, exact_std, order_quantity, reorder_point, safe_divide, safety_stock, square
from stocklens.operators.key_day import is_state


def demand_stats(sales: DataFrame) -> DataFrame:
    """Mean and spread of daily quantity per part and dealer over days with sales; of a fact or a key x day state."""
    if is_state(sales):  # it has one row per key and day
        daily = sales.select(*KEYS, F.col("qty_sold").alias("q"))
    else:
        daily = sales.groupBy(*KEYS, "transaction_date").agg(F.sum("qty_sold").alias("q"))
    sums = daily.groupBy(*KEYS).agg(
        F.count("q").alias("n"), F.sum("q").alias("s"), F.sum(square(F.col("q"))).alias("qq")
    )
    std = exact_std(F.col("n"), F.col("s"), F.col("qq"))
    return sums.select(
        *KEYS,
        safe_divide(F.col("s"), F.col("n")).alias("avg_daily_demand"),
        F.coalesce(std, F.lit(0.0)).alias("demand_std_daily"),
    )


def lead_time_stats(po: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Mean and spread of received lead times per part."""
    lead = F.col("lead_time_actual").cast("bigint")
    sums = (
        po.where(F.col("actual_receipt_date").isNotNull() & (lead > 0))
        .groupBy("part_id")
        .agg(F.count(lead).alias("n"), F.sum(lead).alias("s"), F.sum(lead * lead).alias("qq"))
    )
    std = exact_std(F.col("n"), F.col("s"), F.col("qq"))
    return sums.select(
        "part_id",
        safe_divide(F.col("s"), F.col("n")).alias("avg_lead_time_days"),
        F.coalesce(std, F.lit(s.single_po_lead_time_std)).alias("lead_time_std_dev"),
    )


def reorder_policies(
    sales: DataFrame,
    purchase_orders: DataFrame,
    abc: DataFrame | None = None,
    parts: DataFrame | None = None,
    s: Settings = DEFAULTS,
) -> DataFrame:
    """One reorder policy per part and dealer."""
    df = demand_stats(sales).join(lead_time_stats(purchase_orders, s), "part_id", "left")
    raised = F.lit(False)
    cost = F.lit(s.default_unit_cost)
    extra: list[str] = []
    if abc is not None:
        df = df.join(abc.select(*KEYS, "abc_class"), list(KEYS), "left")
        raised = raised | F.col("abc_class").eqNullSafe("A")
        extra.append("abc_class")
    if parts is not None and "is_critical" in parts.columns:
        df = df.join(parts.select("part_id", "is_critical", "standard_cost"), "part_id", "left")
        raised = raised | F.coalesce("is_critical", F.lit(False))
        cost = F.coalesce(F.col("standard_cost").cast("double"), cost)
        extra += ["is_critical", "standard_cost"]
    demand, spread = F.col("avg_daily_demand"), F.col("demand_std_daily")
    lead, lead_std = F.col("avg_lead_time_days"), F.col("lead_time_std_dev")
    floor = F.greatest(demand, F.lit(0.001))
    return (
        df.withColumns(
            {
                "avg_lead_time_days": F.coalesce(lead, F.lit(s.default_lead_time)),
                "lead_time_std_dev": F.coalesce(lead_std, F.lit(s.default_lead_time_std)),
                "service_level_z": F.when(raised, s.service_z_high).otherwise(s.service_z),
            }
        )
        .withColumn("safety_stock_qty", safety_stock(F.col("service_level_z"), lead, lead_std, demand, spread))
        .withColumn("reorder_point", reorder_point(demand, lead, F.col("safety_stock_qty")))
        .withColumn("economic_order_qty", order_quantity(demand * 365, cost * s.holding_rate, s.ordering_cost))
        .withColumn("max_stock_level", F.col("reorder_point") + F.col("economic_order_qty"))
        .withColumn("demand_cov", spread / floor)
        .withColumn("days_of_safety_stock", F.col("safety_stock_qty") / floor)
        .select(
            *KEYS, "avg_daily_demand", "demand_std_daily", "avg_lead_time_days", "lead_time_std_dev", *extra,
            "service_level_z", "safety_stock_qty", "reorder_point", "economic_order_qty", "max_stock_level",
            "demand_cov", "days_of_safety_stock",
        )
    )
