"""Warehouse constraints and business rules as data-quality jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.scalar import as_date
from stocklens.sources.scratch import partitions


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count.

    As in SQL, a key with a null part is never a duplicate. Keys are dealt before they are counted: most are there once,
    so counts made before the shuffle would hold them all and save nothing.
    """
    keyed = df.select(*columns).dropna().repartition(partitions(df.sparkSession), *columns)
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def check_foreign_key(df: DataFrame, column: str, dim: DataFrame, dim_column: str | None = None) -> DataFrame:
    """Referenced values without a dimension row, with the rows that carry them.

    The fact is first reduced to its distinct keys, so the anti join moves keys,
    not facts, and a hot key is one row.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    known = dim.select(F.col(dim_column or column).alias("_known"))
    return used.join(known, F.col(column) == F.col("_known"), "left_anti")


def check_predicate(df: DataFrame, rule: str | Column) -> DataFrame:
    """Rows that break a rule; an unknown (null) outcome passes, as in SQL CHECK."""
    return df.where(~(F.expr(rule) if isinstance(rule, str) else rule))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count), all columns in one pass."""
    return _unpivot(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]), "column_name", "null_count")


def check_rules(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """(rule, violations) for many predicates in one pass."""
    counts = [
        F.count_if(~(F.expr(r) if isinstance(r, str) else r)).alias(name) for name, r in rules.items()
    ]
    return _unpivot(df.agg(*counts), "rule", "violations")


def sales_rules(as_of) -> dict[str, Column]:
    """Documented rules of the sales fact."""
    fulfilled = F.col("was_fulfilled")
    return {
        "date_not_in_future": F.col("transaction_date") <= as_date(as_of),
        "qty_positive": F.col("qty_sold") > 0,
        "price_positive": F.col("unit_price") > 0,
        "discount_0_100": F.col("discount_pct").between(0, 100),
        "no_backorder_when_fulfilled": ~fulfilled | (F.col("backorder_qty") == 0),
    }


# CHECK clauses of the warehouse tables.
TABLE_RULES = {
    "dim_suppliers": {"rating_0_5": "rating BETWEEN 0 AND 5"},
    "fact_sales": {"qty_sold_positive": "qty_sold > 0"},
    "fact_purchase_orders": {"qty_ordered_positive": "qty_ordered > 0"},
    "analytics_abc_xyz": {
        "abc_class_known": "abc_class IN ('A', 'B', 'C')",
        "xyz_class_known": "xyz_class IN ('X', 'Y', 'Z')",
    },
}


def _unpivot(one_row: DataFrame, name: str, value: str) -> DataFrame:
    return one_row.unpivot([], one_row.columns, name, value)


def upsert_latest(
    current: DataFrame, updates: DataFrame, keys: Sequence[str], order_col: str, stamp: str = "updated_at", now=None
) -> DataFrame:
    """Current rows with the newest update per key applied.

    Changed and new rows get ``stamp = now``; rows whose values did not change keep
    their stamp. Both sides meet in one aggregate by key (no window, no join).
    """
    keys = list(keys)
    values = [c for c in current.columns if c not in keys and c != stamp]
    now = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now).cast("timestamp"))
    row = F.struct(*values)
    old = current.select(*keys, row.alias("_row"), F.col(stamp).alias("_stamp"), F.lit(0).alias("_new"),
                         F.lit(None).cast(updates.schema[order_col].dataType).alias("_order"))
    new = updates.select(*keys, row.alias("_row"), F.lit(None).cast("timestamp").alias("_stamp"),
                         F.lit(1).alias("_new"), F.col(order_col).alias("_order"))
    merged = old.unionByName(new).groupBy(*keys).agg(
        F.max_by("_row", F.struct("_new", "_order", "_row")).alias("_latest"),
        F.max_by("_row", F.when(F.col("_new") == 0, 0)).alias("_before"),
        F.max("_stamp").alias("_stamp"),
        F.count_if(F.col("_new") == 0).alias("_had"),
    )
    same = (F.col("_had") > 0) & F.col("_latest").eqNullSafe(F.col("_before"))
    return merged.select(
        *keys,
        *[F.col(f"_latest.{c}").alias(c) for c in values],
        F.when(same, F.col("_stamp")).otherwise(now).alias(stamp),
    ).select(*current.columns)
