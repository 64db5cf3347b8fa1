"""ABC (revenue) and XYZ (demand variability) classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import (
    KEYS,
    abc_band,
    as_date,
    exact_std,
    half_even,
    month_diff,
    month_start,
    resolve_as_of,
    safe_divide,
    square,
    xyz_band,
)
from stocklens.operators.ordered import densify, prefix_sum
from stocklens.sources.scratch import materialize, partitions

# Segment labels and recommended actions.
ACTIONS = (
    ("AX", "High Value / Stable", "Tight control. Min safety stock. Frequent replenishment."),
    ("AY", "High Value / Variable", "Maintain safety stock. Short-term forecasting. Weekly review."),
    ("AZ", "High Value / Irregular", "Close monitoring. Emergency supplier contract. Hold buffer."),
    ("BX", "Med Value / Stable", "Standard replenishment. Monthly review."),
    ("BY", "Med Value / Variable", "Moderate safety stock. Monthly forecast review."),
    ("BZ", "Med Value / Irregular", "Demand analysis needed. Consider de-listing."),
    ("CX", "Low Value / Stable", "Bulk ordering. Reduce review frequency."),
    ("CY", "Low Value / Variable", "Consignment or JIT. Reduce stock holding."),
    ("CZ", "Low Value / Irregular", "Candidate for removal. Order on demand only."),
)


def classify_abc(
    df: DataFrame,
    value: str,
    keys: Sequence[str],
    a_pct: float = DEFAULTS.abc_a_pct,
    b_pct: float = DEFAULTS.abc_b_pct,
    boundary: str = "running",
) -> DataFrame:
    """Adds share_pct, cum_pct and abc_class by descending value.

    ``boundary="running"`` classifies by the total up to and including the row (so
    one item with more than 95 % of the value is C); ``"preceding"`` by the total
    before the row (so the largest item is always A). A zero total makes all C.
    """
    if boundary not in ("running", "preceding"):
        raise ValueError(f"unknown boundary: {boundary}")
    order = [F.col(value).desc(), *[F.col(k).asc() for k in keys]]
    ranked = prefix_sum(df, {"_running": value}, order)
    total = ranked.select(F.sum(value)).scalar()
    cumulative = safe_divide(F.col("_running"), total) * 100
    if boundary == "running":
        label = abc_band(F.col("cum_pct"), a_pct, b_pct)
    else:
        before = safe_divide(F.col("_running") - F.col(value), total) * 100
        label = F.when(before < a_pct, "A").when(before < b_pct, "B").otherwise("C")
    return (
        ranked.withColumn("share_pct", safe_divide(F.col(value), total) * 100)
        .withColumn("cum_pct", cumulative)
        .withColumn("abc_class", F.coalesce(label, F.lit("C")))
        .drop("_running")
    )


def _xyz_columns(n: Column, total: Column, squares: Column, s: Settings) -> dict[str, Column]:
    return _xyz_from(safe_divide(total, n), F.coalesce(exact_std(n, total, squares), F.lit(0.0)), s)


def _xyz_from(mean: Column, std: Column, s: Settings) -> dict[str, Column]:
    cov = F.coalesce(safe_divide(std, mean), F.lit(s.no_demand_cov))
    return {
        "avg_monthly_demand": mean,
        "demand_std": std,
        "demand_cov": cov,
        "xyz_class": xyz_band(cov, s.xyz_x_cov, s.xyz_y_cov),
    }


def classify_xyz(
    monthly: DataFrame,
    keys: Sequence[str] = KEYS,
    period: str = "year_month",
    value: str = "qty_sold",
    s: Settings = DEFAULTS,
) -> DataFrame:
    """Variability class per key over all observed periods, absent ones counting as 0.

    Zero months add nothing to a sum, so whole quantities need no zero rows at all:
    mean and variance follow exactly from the sum, the sum of squares and the
    number of periods. Fractional quantities go through the dense form. The rows, a few for each key, are dealt by key,
    to more tasks than a shuffle of Spark's choice has: a task holds them in hash maps twice.
    """
    keys = list(keys)
    if not isinstance(monthly.schema[value].dataType, IntegralType):
        stats = densify(monthly, keys, period, value).groupBy(*keys).agg(
            F.avg(value).alias("_mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("_std")
        )
        return stats.withColumns(_xyz_from(F.col("_mean"), F.col("_std"), s)).drop("_mean", "_std")
    sums = (
        monthly.select(*keys, period, value).repartition(partitions(monthly.sparkSession), *keys)
        .groupBy(*keys, period).agg(F.sum(value).alias("_q"))
        .groupBy(*keys).agg(F.sum("_q").alias("_s"), F.sum(square(F.col("_q"))).alias("_qq"))
    )
    periods = monthly.select(period).distinct().select(F.count(period)).scalar()
    return sums.withColumns(_xyz_columns(periods, F.col("_s"), F.col("_qq"), s)).drop("_s", "_qq")


def abc_xyz(
    sales: DataFrame, months: int = 12, as_of=None, boundary: str = "running", s: Settings = DEFAULTS
) -> DataFrame:
    """Both classes per part and dealer over the trailing window (both ends included).

    The facts are read once: revenue, quantity sums and bit masks of the months
    seen (one for every 60 months) come from the same two-level aggregate. The key-level
    result is written, and the number of observed months is the bit count of all masks together.
    """
    end = as_date(as_of if as_of is not None else resolve_as_of(sales, "transaction_date"))
    start = F.add_months(end, -months)
    month = month_start("transaction_date")
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), _offset % 60)")
    masks = {f"_seen{i}": F.bit_or(F.when(F.floor(F.col("_offset") / 60) == i, bit)) for i in range(months // 60 + 1)}
    keyed = materialize(
        sales.where((F.col("transaction_date") >= start) & (F.col("transaction_date") <= end))
        .groupBy(*KEYS, month_diff(start, month).alias("_offset"))
        .agg(F.sum("revenue").alias("_rev"), F.sum("qty_sold").alias("_q"))
        .groupBy(*KEYS)
        .agg(
            F.sum("_rev").alias("annual_revenue"),
            F.sum("_q").alias("_s"),
            F.sum(square(F.col("_q"))).alias("_qq"),
            *[mask.alias(name) for name, mask in masks.items()],
        ),
        "abcxyz",
    )
    if keyed.isEmpty():
        raise ValueError("No sales data in the reference period.")
    seen = [F.coalesce(F.bit_count(F.bit_or(name)), F.lit(0)) for name in masks]
    observed = keyed.select(sum(seen, F.lit(0))).scalar()
    ranked = classify_abc(keyed, "annual_revenue", KEYS, s.abc_a_pct, s.abc_b_pct, boundary)
    return ranked.withColumns(_xyz_columns(observed, F.col("_s"), F.col("_qq"), s)).select(
        *KEYS,
        "annual_revenue",
        F.col("share_pct").alias("revenue_pct"),
        F.col("cum_pct").alias("cum_rev_pct"),
        "abc_class",
        "avg_monthly_demand",
        "demand_std",
        "demand_cov",
        "xyz_class",
        F.concat(F.coalesce("abc_class", F.lit("C")), F.coalesce("xyz_class", F.lit("Z"))).alias("combined_class"),
    )


def abc_xyz_summary(classified: DataFrame, by: str = "combined_class") -> DataFrame:
    """Counts, revenue and shares per class (at most nine rows)."""
    groups = classified.groupBy(by).agg(
        F.count("part_id").alias("part_count"),
        F.sum("annual_revenue").alias("_rev"),
        F.avg("avg_monthly_demand").alias("_demand"),
        F.avg("demand_cov").alias("_cov"),
    )
    revenue, count = groups.select(F.sum("_rev")).scalar(), groups.select(F.sum("part_count")).scalar()
    return groups.select(
        by,
        "part_count",
        half_even("_rev", 2).alias("total_revenue"),
        half_even("_demand", 2).alias("avg_monthly_demand"),
        half_even("_cov", 2).alias("avg_cov"),
        half_even(safe_divide(F.col("_rev"), revenue) * 100, 2).alias("revenue_share_pct"),
        half_even(safe_divide(F.col("part_count"), count) * 100, 2).alias("part_share_pct"),
    ).orderBy(F.desc("total_revenue"))


def action_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ACTIONS), "combined_class STRING, segment_label STRING, recommended_action STRING")


def with_actions(classified: DataFrame) -> DataFrame:
    """Classification with the recommended action (the matrix is nine fixed rows)."""
    return classified.join(F.broadcast(action_matrix(classified.sparkSession)), "combined_class", "left")
