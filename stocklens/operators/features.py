"""Feature matrix of the stock-out classifier: one row per part and dealer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import KEYS, as_date, as_of_or_max, clip, exact_std, safe_divide
from stocklens.operators.key_day import line_aggregates
from stocklens.operators.latest import last_non_null
from stocklens.sources.scratch import materialize

# Model inputs, in order, and the target.
FEATURE_COLS = (
    "qty_on_hand", "qty_available", "qty_in_transit",
    "qty_sold_30d", "qty_sold_60d", "qty_sold_90d",
    "txn_count_30d", "demand_std_30d",
    "avg_daily_demand_30d", "avg_daily_demand_90d",
    "demand_trend", "days_coverage", "stock_vs_rop",
    "safety_stock_coverage_days", "avg_lead_time_days",
    "lead_time_std_dev", "on_time_rate", "avg_po_lead_time",
    "abc_class", "xyz_class", "combined_class",
)
TARGET_COL = "will_stockout_14d"


def latest_inventory(inventory: DataFrame, as_of=None) -> DataFrame:
    if as_of is not None:
        inventory = inventory.where(F.col("snapshot_date") <= as_date(as_of))
    return last_non_null(
        inventory, "snapshot_date", ["qty_on_hand", "qty_available", "qty_in_transit", "total_stock_value"]
    )


def demand_windows(sales: DataFrame, windows: Sequence[int] = (30, 60, 90), as_of=None) -> DataFrame:
    """Quantity, line count and spread per trailing window, all windows in one aggregate over a fact or a state.

    Only rows of the longest window are read; a key without lines in a shorter
    window has nulls there, and a single line has spread 0.
    """
    today = as_of_or_max(as_of, sales, "transaction_date")
    aggs, out = [], []
    for d in windows:
        inside = line_aggregates(sales, F.col("_age") <= d)
        aggs += [inside[k].alias(f"_{k}{d}") for k in "nsq"]
        n = F.col(f"_n{d}")
        std = F.coalesce(exact_std(n, F.col(f"_s{d}"), F.col(f"_q{d}")), F.lit(0.0))
        out += [
            F.col(f"_s{d}").alias(f"qty_sold_{d}d"),
            F.when(n > 0, n).alias(f"txn_count_{d}d"),
            F.when(n > 0, std).alias(f"demand_std_{d}d"),
        ]
    day = F.col("transaction_date")
    recent = sales.where((day >= F.date_sub(today, max(windows))) & (day <= today))
    aged = recent.withColumn("_age", F.datediff(today, F.col("transaction_date")))
    return aged.groupBy(*KEYS).agg(*aggs).select(*KEYS, *out)


def supplier_performance(po: DataFrame) -> DataFrame:
    """Share of received orders on or before the promise, and mean lead time, per part."""
    on_time = F.coalesce(F.col("lead_time_delta") <= 0, F.lit(False)).cast("int")
    lead = F.col("lead_time_actual").cast("bigint")
    return (
        po.where(F.col("actual_receipt_date").isNotNull())
        .groupBy("part_id")
        .agg(
            safe_divide(F.sum(on_time), F.count(F.lit(1))).alias("on_time_rate"),
            safe_divide(F.sum(lead), F.count(lead)).alias("avg_po_lead_time"),
        )
    )


def _encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Alphabetical label codes; nulls count as "C". A label set has at most ten values.

    The labels depend on which keys found a class, so the joined rows are written
    once and the three label sets come from one small aggregate over them.
    """
    base = materialize(df.withColumns({c: F.coalesce(c, F.lit("C")) for c in columns}), "features")
    sets = F.struct(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])
    labels = base.select(sets).scalar()
    return base.withColumns(
        {c: (F.array_position(labels.getField(c), F.col(c)) - 1).cast("int") for c in columns}
    )


def build_features(
    inventory: DataFrame,
    sales: DataFrame,
    purchase_orders: DataFrame,
    policies: DataFrame | None = None,
    abc_xyz: DataFrame | None = None,
    as_of=None,
    s: Settings = DEFAULTS,
) -> DataFrame:
    keys = list(KEYS)
    df = latest_inventory(inventory, as_of).join(demand_windows(sales, as_of=as_of), keys, "left")
    df = df.withColumns(
        {
            "avg_daily_demand_30d": F.col("qty_sold_30d") / 30.0,
            "avg_daily_demand_90d": F.col("qty_sold_90d") / 90.0,
            "demand_trend": F.col("qty_sold_30d") / 30.0 - F.col("qty_sold_90d") / 90.0,
        }
    )
    cover = safe_divide(F.col("qty_available"), F.col("avg_daily_demand_30d"), 999.0)
    df = df.withColumn("days_coverage", clip(cover, high=365.0))
    if policies is not None:
        # A policy table without rows counts as no table.
        some = policies.select(F.count(F.lit(1)) > 0).scalar()
        cols = ["safety_stock_qty", "reorder_point", "avg_lead_time_days", "lead_time_std_dev", "economic_order_qty"]
        df = df.join(policies.select(*keys, *cols), keys, "left").withColumns(
            {
                "stock_vs_rop": F.when(some, F.col("qty_available") - F.col("reorder_point")).otherwise(F.lit(0)),
                "safety_stock_coverage_days": F.when(
                    some, safe_divide(F.col("safety_stock_qty"), F.col("avg_daily_demand_30d"), 0.0)
                ).otherwise(F.lit(0.0)),
                "avg_lead_time_days": F.when(some, F.col("avg_lead_time_days")).otherwise(F.lit(s.default_lead_time)),
                "lead_time_std_dev": F.when(some, F.col("lead_time_std_dev")).otherwise(F.lit(s.default_lead_time_std)),
            }
        )
    else:
        df = df.withColumns(
            {
                "stock_vs_rop": F.lit(0).cast("bigint"),
                "safety_stock_coverage_days": F.lit(0.0),
                "avg_lead_time_days": F.lit(s.default_lead_time),
                "lead_time_std_dev": F.lit(s.default_lead_time_std),
            }
        )
    df = df.join(supplier_performance(purchase_orders), "part_id", "left").withColumns(
        {
            "on_time_rate": F.coalesce("on_time_rate", F.lit(s.default_on_time_rate)),
            "avg_po_lead_time": F.coalesce("avg_po_lead_time", F.lit(s.default_lead_time)),
        }
    )
    if abc_xyz is not None:
        classes = ["abc_class", "xyz_class", "combined_class"]
        df = df.join(abc_xyz.select(*keys, *classes), keys, "left")
        df = _encode(df, classes)
    else:
        df = df.withColumns({"abc_class": F.lit(2), "xyz_class": F.lit(2), "combined_class": F.lit(8)})
    short = F.col("qty_available") < F.col("avg_daily_demand_30d") * s.label_days
    return df.withColumn(TARGET_COL, F.coalesce(short, F.lit(False)).cast("int"))
