"""Warehouse table types and the columns derived from others."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from stocklens.functions.scalar import as_date, month_start

_SIMPLE = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
}


def struct_of(columns: str) -> StructType:
    """``"name TYPE, ..."`` as a StructType, without needing a running session."""
    fields = []
    for name, kind, precision, scale in re.findall(r"(\w+) (\w+)(?:\((\d+),(\d+)\))?", columns):
        kind_type = T.DecimalType(int(precision), int(scale)) if kind == "DECIMAL" else _SIMPLE[kind]
        fields.append(T.StructField(name, kind_type))
    return StructType(fields)


TABLES: dict[str, StructType] = {
    "dim_parts": struct_of(
        "part_id INT, part_number STRING, oem_number STRING, part_name STRING, part_description STRING, "
        "brand STRING, category STRING, sub_category STRING, unit_of_measure STRING, "
        "standard_cost DECIMAL(12,2), list_price DECIMAL(12,2), weight_kg DECIMAL(8,3), "
        "is_critical BOOLEAN, is_active BOOLEAN, superseded_by STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "dim_suppliers": struct_of(
        "supplier_id INT, supplier_code STRING, supplier_name STRING, country STRING, city STRING, "
        "supplier_type STRING, payment_terms STRING, currency STRING, lead_time_days INT, "
        "min_order_value DECIMAL(12,2), is_preferred BOOLEAN, rating DECIMAL(3,1), is_active BOOLEAN, "
        "created_at TIMESTAMP"
    ),
    "dim_dealers": struct_of(
        "dealer_id INT, dealer_code STRING, dealer_name STRING, region STRING, city STRING, country STRING, "
        "warehouse_type STRING, is_active BOOLEAN"
    ),
    "fact_inventory": struct_of(
        "inventory_id BIGINT, snapshot_date DATE, part_id INT, dealer_id INT, qty_on_hand INT, qty_reserved INT, "
        "qty_in_transit INT, qty_available INT, avg_unit_cost DECIMAL(12,4), total_stock_value DECIMAL(16,2), "
        "last_movement_date DATE, shelf_location STRING"
    ),
    "fact_sales": struct_of(
        "sale_id BIGINT, transaction_date DATE, part_id INT, dealer_id INT, customer_type STRING, qty_sold INT, "
        "unit_price DECIMAL(12,2), discount_pct DECIMAL(5,2), revenue DECIMAL(16,2), cogs DECIMAL(16,2), "
        "gross_profit DECIMAL(16,2), order_source STRING, was_fulfilled BOOLEAN, backorder_qty INT, "
        "created_at TIMESTAMP"
    ),
    "fact_purchase_orders": struct_of(
        "po_id BIGINT, po_number STRING, po_line INT, part_id INT, supplier_id INT, dealer_id INT, "
        "order_date DATE, promised_date DATE, actual_receipt_date DATE, qty_ordered INT, qty_received INT, "
        "unit_cost DECIMAL(12,4), total_cost DECIMAL(16,2), po_status STRING, lead_time_actual INT, "
        "lead_time_delta INT, created_at TIMESTAMP"
    ),
    "fact_demand_forecast": struct_of(
        "forecast_id BIGINT, forecast_date DATE, part_id INT, dealer_id INT, forecast_qty DECIMAL(10,2), "
        "forecast_lower DECIMAL(10,2), forecast_upper DECIMAL(10,2), model_used STRING, mape DECIMAL(6,2), "
        "generated_at TIMESTAMP"
    ),
    "analytics_abc_xyz": struct_of(
        "classification_id BIGINT, classification_month DATE, part_id INT, dealer_id INT, abc_class STRING, "
        "xyz_class STRING, combined_class STRING, annual_revenue DECIMAL(16,2), revenue_pct DECIMAL(6,3), "
        "cumulative_revenue_pct DECIMAL(6,3), demand_cov DECIMAL(18,4), avg_monthly_demand DECIMAL(10,2)"
    ),
    "analytics_reorder_policy": struct_of(
        "policy_id BIGINT, effective_date DATE, part_id INT, dealer_id INT, avg_daily_demand DECIMAL(10,4), "
        "demand_std_dev DECIMAL(10,4), avg_lead_time_days DECIMAL(8,2), lead_time_std_dev DECIMAL(8,2), "
        "service_level_z DECIMAL(5,3), safety_stock_qty INT, reorder_point INT, economic_order_qty INT, "
        "max_stock_level INT"
    ),
}

# Date column by which each fact is laid out (one directory per month).
PARTITION_DATE = {
    "fact_inventory": "snapshot_date",
    "fact_sales": "transaction_date",
    "fact_purchase_orders": "order_date",
    "fact_demand_forecast": "forecast_date",
    "analytics_abc_xyz": "classification_month",
    "analytics_reorder_policy": "effective_date",
}

PRIMARY_KEYS = {
    "dim_parts": [["part_id"], ["part_number"]],
    "dim_suppliers": [["supplier_id"], ["supplier_code"]],
    "dim_dealers": [["dealer_id"], ["dealer_code"]],
    "fact_inventory": [["snapshot_date", "part_id", "dealer_id"]],
    "fact_sales": [["sale_id"]],
    "fact_purchase_orders": [["po_number", "po_line"]],
    "fact_demand_forecast": [["forecast_date", "part_id", "dealer_id", "model_used"]],
    "analytics_abc_xyz": [["classification_month", "part_id", "dealer_id"]],
    "analytics_reorder_policy": [["effective_date", "part_id", "dealer_id"]],
}

# Column defaults of the warehouse.
DEFAULT_VALUES = {
    "dim_parts": {"unit_of_measure": "EA", "is_critical": False, "is_active": True},
    "dim_suppliers": {"currency": "USD", "is_preferred": False, "is_active": True},
    "dim_dealers": {"country": "Egypt", "warehouse_type": "Regional", "is_active": True},
    "fact_inventory": {"qty_on_hand": 0, "qty_reserved": 0, "qty_in_transit": 0},
    "fact_sales": {"discount_pct": 0, "was_fulfilled": True, "backorder_qty": 0},
    "fact_purchase_orders": {"po_line": 1, "qty_received": 0, "po_status": "Open"},
}

PO_STUB_COLUMNS = (
    "po_id BIGINT, part_id BIGINT, supplier_id BIGINT, dealer_id INT, order_date DATE, "
    "actual_receipt_date DATE, lead_time_actual INT, lead_time_delta INT, qty_ordered INT, "
    "unit_cost DOUBLE, po_status STRING"
)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Fill nulls of present columns with the table's defaults (a no-op elsewhere)."""
    present = {c: v for c, v in DEFAULT_VALUES.get(table, {}).items() if c in df.columns}
    return df.fillna(present) if present else df


def derive_inventory(df: DataFrame) -> DataFrame:
    """qty_available and total_stock_value."""
    value = F.round(F.col("qty_on_hand") * F.col("avg_unit_cost").cast("decimal(18,4)"), 2)
    return df.withColumns(
        {
            "qty_available": F.col("qty_on_hand") - F.col("qty_reserved"),
            "total_stock_value": value.cast("decimal(16,2)"),
        }
    )


def derive_sales(df: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """revenue, plus cogs (when the part costs are given) and gross_profit."""
    keep = (F.lit(100) - F.col("discount_pct")) * F.lit("0.01").cast("decimal(3,2)")
    revenue = F.round(F.col("qty_sold") * F.col("unit_price") * keep, 2).cast("decimal(16,2)")
    df = df.withColumn("revenue", revenue)
    if parts is not None:
        costs = parts.select("part_id", F.col("standard_cost").alias("_cost"))
        cogs = F.round(F.col("qty_sold") * F.col("_cost"), 2).cast("decimal(16,2)")
        df = df.join(costs, "part_id", "left").withColumn("cogs", cogs).drop("_cost")
    if "cogs" in df.columns:
        df = df.withColumn("gross_profit", (F.col("revenue") - F.col("cogs")).cast("decimal(16,2)"))
    return df


def derive_purchase_orders(df: DataFrame) -> DataFrame:
    """total_cost and the two lead-time day counts."""
    cost = F.round(F.col("qty_ordered") * F.col("unit_cost").cast("decimal(18,4)"), 2)
    return df.withColumns(
        {
            "total_cost": cost.cast("decimal(16,2)"),
            "lead_time_actual": F.datediff("actual_receipt_date", "order_date"),
            "lead_time_delta": F.datediff("actual_receipt_date", "promised_date"),
        }
    )


def derive_abc(df: DataFrame) -> DataFrame:
    return df.withColumn("combined_class", F.concat("abc_class", "xyz_class"))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Project onto the table's columns and types; absent columns become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].fields
        ]
    )


def policy_table(policies: DataFrame, effective_date) -> DataFrame:
    """Reorder policies under the warehouse column names."""
    named = policies.withColumnRenamed("demand_std_daily", "demand_std_dev")
    return conform(named.withColumn("effective_date", as_date(effective_date)), "analytics_reorder_policy")


def abc_xyz_table(classified: DataFrame, month) -> DataFrame:
    """Classification under the warehouse column names."""
    named = classified.withColumnRenamed("cum_rev_pct", "cumulative_revenue_pct")
    return conform(named.withColumn("classification_month", month_start(as_date(month))), "analytics_abc_xyz")


def forecast_table(forecasts: DataFrame) -> DataFrame:
    return conform(forecasts, "fact_demand_forecast")


