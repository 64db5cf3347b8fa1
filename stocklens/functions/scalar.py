"""Column expressions shared by the operators.

Everything here is a composition of built-in functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings

KEYS = ("part_id", "dealer_id")


# ---------------------------------------------------------------- numbers and dates in text
# Date forms besides ISO that extracts use, tried in this order.
DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "yyyyMMdd")
WHOLE = ("tinyint", "smallint", "int", "bigint")


def number_from_text(column: str, kind: str) -> Column:
    """Text as a number or date of type ``kind``, null where it is none.

    Dates may be written in any of DATE_FORMATS. Integers may be written with a fraction of zero ("5.0", as exporters write nullable
    integers); "5.5" is not an integer.
    """
    if kind == "date":
        return date_from_text(column)
    if kind not in WHOLE:
        return F.col(column).try_cast(kind)
    exact = F.col(column).try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast(kind))


def date_from_text(column: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text as a date: ISO first, then each of ``formats``; null where none fits. 03/04/2024 is read month first
    unless ``formats`` has d/M/yyyy before (or instead of) M/d/yyyy."""
    others = [F.try_to_timestamp(F.trim(column), F.lit(f)).cast("date") for f in formats]
    return F.coalesce(F.col(column).try_cast("date"), *others)


# ---------------------------------------------------------------- as-of dates
def as_date(value) -> Column:
    """Turn a date, ISO string or Column into a DATE expression."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def as_of_or_max(as_of, df: DataFrame, column: str) -> Column:
    """``as_of`` if given, else the latest date in ``df`` as a scalar subquery.

    The subquery keeps the plan lazy; pass a literal date where the filter should
    also reach the file scan as a pushed-down predicate.
    """
    if as_of is not None:
        return as_date(as_of)
    return df.select(F.max(F.col(column).cast("date"))).scalar()


def resolve_as_of(df: DataFrame, column: str) -> dt.date:
    """Latest date in ``df`` as a Python date (one single-column aggregate job)."""
    return df.agg(F.max(F.col(column).cast("date"))).first()[0]


def month_start(day) -> Column:
    return F.trunc(day, "MM")


def year_month(day) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_diff(start: Column, end: Column) -> Column:
    """Month *boundaries* crossed between two dates, as a BI tool counts them."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


# ------------------------------------------------------------------- numerics
def num_round(col, digits: int) -> Column:
    """Round half away from zero on NUMERIC semantics, returned as DOUBLE."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("decimal(28,9)"), digits).cast("double")


def half_even(col, digits: int) -> Column:
    """Banker's rounding, returned as DOUBLE."""
    col = F.col(col) if isinstance(col, str) else col
    return F.bround(col.cast("decimal(28,9)"), digits).cast("double")


def safe_divide(num, den, alt=None) -> Column:
    """num / den as DOUBLE; ``alt`` when the denominator is zero or either is null."""
    ratio = F.try_divide(num.cast("double"), den.cast("double"))
    return ratio if alt is None else F.coalesce(ratio, F.lit(alt).cast("double"))


def exact_variance(n: Column, total: Column, squares: Column) -> Column:
    """Sample variance from integer count, sum and sum of squares.

    The numerator is exact integer arithmetic, so the result depends neither on
    partitioning nor on summation order, and needs only plain ``sum`` aggregates
    with map-side combine. Null for fewer than two observations.
    """
    n_int, s_int = n.cast("decimal(19,0)"), total.cast("decimal(19,0)")
    spread = (n_int * squares.cast("decimal(38,0)") - s_int * s_int).cast("double")
    pairs = n.cast("double") * (n.cast("double") - 1.0)
    return F.when(n > 1, spread / pairs)


def square(whole: Column) -> Column:
    """Square of a whole number, wide enough that sums of squares do not overflow."""
    wide = whole.cast("decimal(18,0)")
    return wide * wide


def exact_std(n: Column, total: Column, squares: Column) -> Column:
    return F.sqrt(exact_variance(n, total, squares))


def clip(col: Column, low=None, high=None) -> Column:
    """Clamp to [low, high]; a null stays null (least/greatest would not keep it)."""
    out = F.when(col.isNull(), None)
    if low is not None:
        out = out.when(col < F.lit(low), F.lit(low))
    if high is not None:
        out = out.when(col > F.lit(high), F.lit(high))
    return out.otherwise(col)


def bands(col: Column, edges: Iterable[tuple[float, str]], last: str) -> Column:
    """Right-closed bins: the first edge with ``col <= edge`` names the band."""
    out = F.when(col.isNull(), None)
    for edge, name in edges:
        out = out.when(col <= F.lit(edge), F.lit(name))
    return out.otherwise(F.lit(last))


def abc_band(cumulative_pct: Column, a: float, b: float) -> Column:
    return bands(cumulative_pct, [(a, "A"), (b, "B")], "C")


def xyz_band(cov: Column, x: float, y: float) -> Column:
    return bands(cov, [(x, "X"), (y, "Y")], "Z")


# ---------------------------------------------------------------- commerce
def net_revenue(qty="qty_sold", price="unit_price", discount="discount_pct") -> Column:
    """qty x price x (1 - discount/100), unrounded DOUBLE."""
    keep = 1.0 - F.col(discount).cast("double") / 100.0
    return F.col(qty).cast("double") * F.col(price).cast("double") * keep


def safety_stock(
    z: Column, lead_time: Column, lead_time_std: Column, demand: Column, demand_std: Column
) -> Column:
    """max(0, ceil(Z * sqrt(LT * sd^2 + d^2 * sLT^2))) as BIGINT."""
    variance = lead_time * (demand_std * demand_std) + (demand * demand) * (lead_time_std * lead_time_std)
    units = F.ceil(z * F.sqrt(variance))
    return F.greatest(F.lit(0), units).cast("bigint")


def reorder_point(demand: Column, lead_time: Column, safety: Column) -> Column:
    """max(1, ceil(d * LT + SS)) as BIGINT."""
    return F.greatest(F.lit(1), F.ceil(demand * lead_time + safety)).cast("bigint")


def order_quantity(annual_demand: Column, holding_cost: Column, ordering_cost: float) -> Column:
    """Wilson lot size max(1, half-even round of sqrt(2DS/H)); 1 when any input is <= 0."""
    lot = F.bround(F.sqrt(2.0 * annual_demand * F.lit(ordering_cost) / holding_cost), 0)
    usable = (annual_demand > 0) & (holding_cost > 0) & (F.lit(ordering_cost) > 0)
    return F.when(usable, F.greatest(F.lit(1), lot.cast("bigint"))).otherwise(F.lit(1)).cast("bigint")


# ---------------------------------------------------------------- accuracy
def mape(actual: Column, predicted: Column) -> Column:
    """Aggregate: mean absolute percentage error over positive actuals, null if none."""
    return F.avg(F.when(actual > 0, F.abs((actual - predicted) / actual))) * 100.0


def rmse(actual: Column, predicted: Column) -> Column:
    """Aggregate: root mean squared error."""
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


# ---------------------------------------------------------------- ladders
# The labels and thresholds of the next three functions are those of the published business rules.
def movement_status(days: Column, s: Settings = DEFAULTS) -> Column:
    """Stock status by days without movement."""
    return (
        F.when(days > s.dead_days, "Dead Stock")
        .when(days > s.slow_days, "Slow Moving")
        .when(days > s.watch_days, "Watch List")
        .otherwise("Active")
    )


def stock_health_status(on_hand: Column, daily: Column) -> Column:
    cover = F.try_divide(on_hand.cast("double"), daily.cast("double"))
    return (
        F.when(daily == 0, "No Demand")
        .when(cover > 180, "Overstock")
        .when(cover > 90, "High Stock")
        .when(cover < 14, "Low Stock")
        .otherwise("Normal")
    )


def stockout_status(available: Column, safety: Column, rop: Column) -> Column:
    return (
        F.when(available <= 0, "STOCKOUT")
        .when(available < safety, "CRITICAL")
        .when(available < rop, "ORDER NOW")
        .when(available.cast("double") < rop * 1.2, "WATCH")
        .otherwise("OK")
    )


# Display order of the stock-out ladder.
RISK_ORDER = ("STOCKOUT", "CRITICAL", "ORDER NOW", "WATCH", "OK")


def risk_rank(level: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in RISK_ORDER]), level).cast("int")
