"""BI measures: each takes its frames, grouping columns ``by`` and, where the
measure looks at "today", an ``as_of`` date. ``by=()`` gives one row for the whole
frame; any column of the frame (join a dimension first) can serve as a slicer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.scalar import KEYS, as_date, as_of_or_max, month_diff, month_start, num_round, safe_divide, year_month
from stocklens.operators.key_day import is_state, line_aggregates

By = Sequence[str]


def _net(rows: Column | None = None) -> Column:
    """Aggregate: sum of qty x price x (100 - discount) as DOUBLE / 100; exact for decimals."""
    line = F.col("qty_sold") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct"))
    return F.sum(line if rows is None else F.when(rows, line)).cast("double") / 100.0


def _one(df: DataFrame, by: By, name: str, value: Column, digits: int = 4) -> DataFrame:
    return df.groupBy(*by).agg(num_round(value, digits).alias(name))


def _beside(left: DataFrame, right: DataFrame, by: By) -> DataFrame:
    """Put two aggregate frames side by side on ``by``; one-row frames via a scalar subquery."""
    if by:
        return left.join(right, list(by), "left")
    names = [c for c in right.columns]
    return left.select("*", *[right.select(c).scalar().alias(c) for c in names])


# ---------------------------------------------------------------- overviews
def sales_overview(sales: DataFrame, by: By = ()) -> DataFrame:
    """The sales measures that share one pass over the fact, or over a key x day state."""
    counts = line_aggregates(sales)
    fill = safe_divide(counts["filled"], counts["lines"], 1) * 100
    net = F.sum("net").cast("double") / 100.0 if is_state(sales) else _net()
    return sales.groupBy(*by).agg(
        num_round(net, 2).alias("total_revenue"),
        F.sum("qty_sold").alias("total_units_sold"),
        num_round(fill, 4).alias("fill_rate_pct"),
        num_round(F.lit(100.0) - fill, 4).alias("backorder_rate_pct"),
    )


def stock_overview(stock: DataFrame, as_of, by: By = (), slow_days: int = 180, dead_days: int = 365) -> DataFrame:
    """Value of stock, of slow-moving stock and of dead stock, in one pass."""
    slow, dead = _is_dead(as_of, slow_days) & ~_is_dead(as_of, dead_days), _is_dead(as_of, dead_days)
    return stock.groupBy(*by).agg(
        num_round(_stock_value(), 2).alias("total_inventory_value"),
        num_round(F.coalesce(_stock_value(slow), F.lit(0.0)), 2).alias("slow_moving_value"),
        num_round(F.coalesce(_stock_value(dead), F.lit(0.0)), 2).alias("dead_stock_value"),
        num_round(safe_divide(_stock_value(dead), _stock_value(), 0) * 100, 4).alias("dead_stock_pct"),
    )


def purchase_overview(po: DataFrame, by: By = ()) -> DataFrame:
    """The supplier measures, in one pass over the orders."""
    return po.groupBy(*by).agg(*[num_round(e, d).alias(n) for n, (e, d) in _purchase_measures().items()])


# ---------------------------------------------------------------- sales
def total_revenue(sales: DataFrame, by: By = ()) -> DataFrame:
    return _one(sales, by, "total_revenue", _net(), 2)


def revenue_vs_prior(sales: DataFrame, as_of=None, by: By = (), start=None) -> DataFrame:
    """(current - prior) / prior for [start, as_of] against the same days one year earlier.

    ``start`` defaults to the first day of the year. Both periods are conditional
    sums of one pass; 0 when there is no prior revenue.
    """
    end = as_of_or_max(as_of, sales, "transaction_date")
    begin = F.trunc(end, "YEAR") if start is None else as_date(start)
    day = F.col("transaction_date")
    rows = sales.where((day >= F.add_months(begin, -12)) & (day <= end)).select(
        "*",
        day.between(begin, end).alias("_now"),
        day.between(F.add_months(begin, -12), F.add_months(end, -12)).alias("_then"),
    )
    sums = rows.groupBy(*by).agg(_net(F.col("_now")).alias("cur"), _net(F.col("_then")).alias("prior"))
    growth = safe_divide(F.coalesce("cur", F.lit(0.0)) - F.col("prior"), F.col("prior"), 0)
    return sums.select(
        *by,
        num_round(F.coalesce("cur", F.lit(0.0)), 2).alias("current_revenue"),
        num_round(F.coalesce("prior", F.lit(0.0)), 2).alias("prior_revenue"),
        num_round(growth, 4).alias("revenue_vs_prior"),
    )


def gross_margin_pct(sales: DataFrame, by: By = ()) -> DataFrame:
    profit = F.sum(F.col("revenue") - F.col("cogs"))
    return _one(sales, by, "gross_profit_margin_pct", safe_divide(profit, _net(), 0) * 100)


def fill_rate_pct(sales: DataFrame, by: By = ()) -> DataFrame:
    return _one(sales, by, "fill_rate_pct", _fill(), 4)


def _fill() -> Column:
    return safe_divide(F.count_if("was_fulfilled"), F.count(F.lit(1)), 1) * 100


def backorder_rate_pct(sales: DataFrame, by: By = ()) -> DataFrame:
    return _one(sales, by, "backorder_rate_pct", F.lit(100.0) - _fill(), 4)


def units_sold(sales: DataFrame, by: By = ()) -> DataFrame:
    return sales.groupBy(*by).agg(F.sum("qty_sold").alias("total_units_sold"))


def avg_monthly_demand_per_part(sales: DataFrame, by: By = ()) -> DataFrame:
    """Units / (distinct parts x months between first and last sale)."""
    per_part = sales.groupBy(*dict.fromkeys([*by, "part_id"])).agg(
        F.sum("qty_sold").alias("q"), F.min("transaction_date").alias("a"), F.max("transaction_date").alias("b")
    )
    months = month_diff(F.min("a"), F.max("b"))
    return _one(per_part, by, "avg_monthly_demand_per_part", safe_divide(F.sum("q"), F.count("part_id") * months, 0))


def demand_mom_growth_pct(sales: DataFrame, as_of=None, by: By = ()) -> DataFrame:
    """Month to date against the same days of the month before."""
    end = as_of_or_max(as_of, sales, "transaction_date")
    before = F.add_months(end, -1)
    day = F.col("transaction_date")
    rows = sales.where((day >= month_start(before)) & (day <= end)).select(
        *by,
        F.when(day >= month_start(end), F.col("qty_sold")).alias("now"),
        F.when(day <= before, F.col("qty_sold")).alias("then"),
    )
    now, then = F.coalesce(F.sum("now"), F.lit(0)), F.sum("then")
    return _one(rows, by, "demand_mom_growth_pct", safe_divide(now - then, then, 0) * 100)


def a_class_revenue_share_pct(sales: DataFrame, abc_xyz: DataFrame, by: By = ()) -> DataFrame:
    keys = list(dict.fromkeys([*by, *KEYS]))
    net = F.sum("net").cast("double") / 100.0 if is_state(sales) else _net()
    revenue = sales.groupBy(*keys).agg(net.alias("rev"))
    a = F.sum(F.when(F.col("abc_class") == "A", F.col("rev")).otherwise(0.0))
    joined = revenue.join(abc_xyz.select(*KEYS, "abc_class"), list(KEYS), "left")
    return _one(joined, by, "a_class_revenue_share_pct", safe_divide(a, F.sum("rev"), 0) * 100)


# ---------------------------------------------------------------- inventory
def _stock_value(rows: Column | None = None) -> Column:
    value = F.col("qty_on_hand") * F.col("avg_unit_cost")
    return F.sum(value if rows is None else F.when(rows, value)).cast("double")


def active_sku_count(inventory: DataFrame, parts: DataFrame, by: By = ()) -> DataFrame:
    """Distinct active parts with a stock record; reduced to distinct keys before the join."""
    seen = inventory.select(*dict.fromkeys([*by, "part_id"])).distinct()
    active = parts.where("is_active").select("part_id")
    return seen.join(active, "part_id", "left_semi").groupBy(*by).agg(F.count("part_id").alias("active_sku_count"))


def total_inventory_value(inventory: DataFrame, by: By = ()) -> DataFrame:
    return _one(inventory, by, "total_inventory_value", _stock_value(), 2)


def _is_dead(as_of, days: int = 365) -> Column:
    return F.datediff(as_date(as_of), F.col("last_movement_date")) > days


def dead_stock_value(inventory: DataFrame, as_of, by: By = ()) -> DataFrame:
    return _one(inventory, by, "dead_stock_value", F.coalesce(_stock_value(_is_dead(as_of)), F.lit(0.0)), 2)


def dead_stock_pct(inventory: DataFrame, as_of, by: By = ()) -> DataFrame:
    return _one(inventory, by, "dead_stock_pct", safe_divide(_stock_value(_is_dead(as_of)), _stock_value(), 0) * 100)


def _turnover(sales: DataFrame, inventory: DataFrame, as_of, by: By) -> DataFrame:
    """by, _turnover: COGS of 12 months over the mean monthly stock value."""
    end = as_of_or_max(as_of, sales, "transaction_date")
    day = F.col("transaction_date")
    cogs = sales.where((day > F.add_months(end, -12)) & (day <= end)).groupBy(*by).agg(F.sum("cogs").alias("_cogs"))
    monthly = inventory.groupBy(*by, month_start("snapshot_date").alias("_m")).agg(F.sum("total_stock_value").alias("_v"))
    stock = monthly.groupBy(*by).agg(F.sum("_v").alias("_v"), F.count("_m").alias("_n"))
    mean = safe_divide(F.col("_v"), F.col("_n"))
    return _beside(stock, cogs, by).select(*by, safe_divide(F.col("_cogs"), mean, 0).alias("_turnover"))


def inventory_turnover_ratio(sales: DataFrame, inventory: DataFrame, as_of=None, by: By = ()) -> DataFrame:
    return _turnover(sales, inventory, as_of, by).select(*by, num_round("_turnover", 4).alias("inventory_turnover"))


def days_on_hand(sales: DataFrame, inventory: DataFrame, as_of=None, by: By = ()) -> DataFrame:
    ratio = safe_divide(F.lit(365.0), F.col("_turnover"), 0)
    return _turnover(sales, inventory, as_of, by).select(*by, num_round(ratio, 4).alias("days_on_hand"))


def avg_coverage_days(stock: DataFrame, sales: DataFrame, as_of=None, by: By = ()) -> DataFrame:
    """Mean over part and dealer of available stock / mean daily quantity of 90 days (999 without sales)."""
    end = as_of_or_max(as_of, sales, "transaction_date")
    day = F.col("transaction_date")
    demand = sales.where((day > F.date_sub(end, 90)) & (day <= end)).groupBy(*KEYS).agg(F.sum("qty_sold").alias("_q"))
    held = stock.groupBy(*dict.fromkeys([*by, *KEYS])).agg(F.sum("qty_available").alias("_a"))
    cover = safe_divide(F.col("_a"), F.col("_q") / 90.0, 999)
    joined = held.join(demand, list(KEYS), "left")
    return _one(joined, by, "avg_stock_coverage_days", F.avg(num_round(cover, 6)))


def _below_rop(stock: DataFrame, policy: DataFrame, by: By, *cols: str) -> DataFrame:
    held = stock.select(*dict.fromkeys([*by, *KEYS, "qty_available"]))
    joined = held.join(policy.select(*KEYS, "reorder_point", *cols), list(KEYS))
    return joined.where(F.col("qty_available") < F.col("reorder_point"))


def parts_at_risk(stock: DataFrame, policy: DataFrame, by: By = ()) -> DataFrame:
    """Policies whose latest available stock is below the reorder point."""
    return _below_rop(stock, policy, by).groupBy(*by).agg(F.count(F.lit(1)).alias("parts_at_risk_count"))


def recommended_order_qty(stock: DataFrame, policy: DataFrame, by: By = ()) -> DataFrame:
    short = _below_rop(stock, policy, by, "economic_order_qty")
    return short.groupBy(*by).agg(F.coalesce(F.sum("economic_order_qty"), F.lit(0)).alias("recommended_order_qty"))


def replenishment_cost(stock: DataFrame, policy: DataFrame, parts: DataFrame, by: By = ()) -> DataFrame:
    short = _below_rop(stock, policy, by, "economic_order_qty").groupBy(*dict.fromkeys([*by, "part_id"])).agg(
        F.sum("economic_order_qty").alias("_lot")
    )
    priced = short.join(parts.select("part_id", F.col("standard_cost").alias("_cost")), "part_id")
    cost = F.coalesce(F.sum(F.col("_lot") * F.col("_cost")).cast("double"), F.lit(0.0))
    return _one(priced, by, "estimated_replenishment_cost", cost, 2)


def urgency_score(
    stock: DataFrame, sales: DataFrame, policy: DataFrame, parts: DataFrame, as_of=None, by: By = ()
) -> DataFrame:
    """0.6 x (100 - coverage against 30 days) + 0.4 x share of active parts at risk."""
    base = _beside(avg_coverage_days(stock, sales, as_of, by), parts_at_risk(stock, policy, by), by)
    base = _beside(base, active_sku_count(stock, parts, by), by)
    coverage = 100.0 - F.least(safe_divide(F.col("avg_stock_coverage_days"), F.lit(30.0), 0) * 100, F.lit(100.0))
    risk = safe_divide(F.coalesce("parts_at_risk_count", F.lit(0)), F.col("active_sku_count"), 0) * 100
    return base.select(*by, num_round(coverage * 0.60 + risk * 0.40, 4).alias("replenishment_urgency_score"))


# ---------------------------------------------------------------- suppliers
def _purchase_measures() -> dict[str, tuple[Column, int]]:
    """Aggregate expression and output digits per measure.

    The lead-time spread is the population deviation, from exact integer sums.
    """
    closed, delta = F.col("po_status") == "Closed", F.col("lead_time_delta")
    lead = F.when(F.col("lead_time_actual") > 0, F.col("lead_time_actual").cast("bigint"))
    late = F.when((delta > 0) & closed, delta)
    n, total, squares = (c.cast("decimal(19,0)") for c in (F.count(lead), F.sum(lead), F.sum(lead * lead)))
    count = F.count(lead).cast("double")
    return {
        "supplier_on_time_pct": (
            safe_divide(F.count_if(closed & (delta <= 0)), F.count_if(closed), 0) * 100, 4),
        "avg_lead_time_days": (safe_divide(F.sum(lead), F.count(lead)), 4),
        "lead_time_std_dev": (F.sqrt(F.try_divide((n * squares - total * total).cast("double"), count * count)), 4),
        "total_po_value": (F.sum(F.col("qty_ordered") * F.col("unit_cost")).cast("double"), 2),
        "avg_delay_days": (safe_divide(F.sum(late), F.count(late)), 4),
    }


def _purchase(po: DataFrame, by: By, name: str) -> DataFrame:
    value, digits = _purchase_measures()[name]
    return _one(po, by, name, value, digits)


def on_time_pct(po: DataFrame, by: By = ()) -> DataFrame:
    return _purchase(po, by, "supplier_on_time_pct")


def avg_lead_time(po: DataFrame, by: By = ()) -> DataFrame:
    return _purchase(po, by, "avg_lead_time_days")


def lead_time_std(po: DataFrame, by: By = ()) -> DataFrame:
    return _purchase(po, by, "lead_time_std_dev")


def total_po_value(po: DataFrame, by: By = ()) -> DataFrame:
    return _purchase(po, by, "total_po_value")


def avg_delay_days(po: DataFrame, by: By = ()) -> DataFrame:
    return _purchase(po, by, "avg_delay_days")


# ---------------------------------------------------------------- forecasts
def avg_forecast_mape(forecasts: DataFrame, by: By = ()) -> DataFrame:
    """Mean error over forecast rows; two-decimal errors are summed exactly."""
    error = F.col("mape").cast("decimal(18,2)")
    return _one(forecasts, by, "avg_forecast_mape", safe_divide(F.sum(error), F.count(error)))


def next_month_forecast_qty(forecasts: DataFrame, as_of, by: By = ()) -> DataFrame:
    month = year_month(F.add_months(as_date(as_of), 1))
    rows = forecasts.where(F.col("year_month") == month)
    return _one(rows, by, "next_month_forecast_qty", F.sum(F.col("forecast_qty").cast("decimal(18,2)")).cast("double"), 2)
