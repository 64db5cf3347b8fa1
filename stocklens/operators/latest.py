"""Latest-row operators (the work of DISTINCT ON and correlated MAX)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from stocklens.functions.scalar import KEYS, as_date


_TIE_BITS = 40


def _order(df: DataFrame, order_col: str, columns: Sequence[str], tie_by: Sequence[str]) -> Column:
    """What the newest row is the greatest by. With ``tie_by`` the columns decide ties, then the rows' values.

    Without, the rows of one day are told apart by a hash of their values: day and 40 bits of hash make one number,
    so the aggregate stays a hash aggregate, and permuted partitions give the same row.
    """
    values = F.xxhash64(*columns)
    dated = F.col(order_col).isNotNull()
    if tie_by:
        return F.when(dated, F.struct(order_col, *tie_by, values))
    if isinstance(df.schema[order_col].dataType, DateType):
        return F.shiftleft(F.unix_date(order_col).cast("bigint"), _TIE_BITS) + values.bitwiseAND(F.lit((1 << _TIE_BITS) - 1))
    return F.when(dated, F.struct(order_col, values))


def latest_row(
    df: DataFrame,
    order_col: str,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = KEYS,
    as_of=None,
    tie_by: Sequence[str] = (),
) -> DataFrame:
    """Newest row per key, optionally only among rows on or before ``as_of``.

    One ``max_by`` per column: with fixed-width columns this is a hash aggregate
    with map-side combine, so history is dropped before the shuffle and nothing is
    sorted. All columns follow the same comparisons and so the same row. Of several rows of one
    day the greatest by ``tie_by`` is taken; without it, one that depends on the values alone.
    """
    keys = list(keys)
    if columns is None:
        columns = [c for c in df.columns if c not in keys]
    if as_of is not None:
        df = df.where(F.col(order_col) <= as_date(as_of))
    order = _order(df, order_col, [c for c in columns if c != order_col] or [order_col], tie_by)
    picks = [
        F.max(c).alias(c) if c == order_col else F.max_by(c, "_order").alias(c) for c in columns
    ]
    return df.withColumn("_order", order).groupBy(*keys).agg(*picks)


def last_non_null(
    df: DataFrame, order_col: str, columns: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Per column, the newest non-null value of each key; of several of one day, one that depends on the values alone."""
    order = _order(df, order_col, columns, ())
    picks = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c) for c in columns]
    return df.withColumn("_order", order).groupBy(*keys).agg(*picks)


def last_event(df: DataFrame, date_col: str, out: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Date of the newest row per key."""
    return df.groupBy(*keys).agg(F.max(date_col).alias(out))
