"""Measures with subtotals: grouping sets over states that can be merged, ratios finished last.

A ratio of a subtotal is not the mean of its parts, nor is a distinct count their sum. So each measure names the
states it needs (sums, minima, maxima, distinct values), the states are merged over every grouping set, and the
measure is computed from the merged states. The facts are read once: they are reduced to the finest groups and
distinct values, and only that small table is expanded to the sets.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.scalar import as_date, month_diff, month_start, num_round, safe_divide
from stocklens.operators.key_day import is_state, line_aggregates
from stocklens.sources.scratch import materialize, partitions

Sets = Sequence[Sequence[str]]


@dataclass(frozen=True)
class Measure:
    """``states`` are aggregates over fact rows that are merged by addition, ``least`` and ``most`` by minimum and
    maximum; ``distinct`` names a column whose distinct non-null values are counted as ``n_<column>``. ``value`` is
    computed from the merged states."""

    value: Column
    digits: int
    states: Mapping[str, Column] = field(default_factory=dict)
    least: Mapping[str, str] = field(default_factory=dict)
    most: Mapping[str, str] = field(default_factory=dict)
    distinct: str | None = None


def rollup_sets(by: Sequence[str]) -> Sets:
    return [tuple(by[:n]) for n in range(len(by), -1, -1)]


def cube_sets(by: Sequence[str]) -> Sets:
    return [s for n in range(len(by), -1, -1) for s in itertools.combinations(by, n)]


def sales_measures(sales: DataFrame, as_of=None) -> dict[str, Measure]:
    """The sales measures of the dashboards, over a sales fact or a key x day state.

    With ``as_of`` also the growth of the year to date and of the month to date."""
    lines = line_aggregates(sales)
    state = is_state(sales)
    line = F.col("net") if state else F.col("qty_sold") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct"))
    units = F.sum(F.col("qty_sold").cast("bigint"))
    net, c = {"net": F.sum(line)}, F.col
    revenue = c("net").cast("double") / 100.0
    fill = {"lines": lines["lines"], "filled": lines["filled"]}
    share = safe_divide(c("filled"), c("lines"), 1) * 100
    span = {"least": {"first_day": "transaction_date"}, "most": {"last_day": "transaction_date"}}
    parts_months = c("n_part_id") * month_diff(c("first_day"), c("last_day"))
    out = {
        "total_revenue": Measure(revenue, 2, net),
        "total_units_sold": Measure(c("units"), 0, {"units": units}),
        "gross_profit_margin_pct": Measure(
            safe_divide(c("profit"), revenue, 0) * 100, 4, {**net, "profit": F.sum(F.col("revenue") - F.col("cogs"))}
        ),
        "fill_rate_pct": Measure(share, 4, fill),
        "backorder_rate_pct": Measure(F.lit(100.0) - share, 4, fill),
        "parts_sold": Measure(c("n_part_id"), 0, distinct="part_id"),
        "avg_monthly_demand_per_part": Measure(safe_divide(c("units"), parts_months, 0), 4, {"units": units}, **span, distinct="part_id"),
    }
    if as_of is not None:
        out |= _growth(line, as_of)
    return out


def _growth(line: Column, as_of) -> dict[str, Measure]:
    end, day, qty = as_date(as_of), F.col("transaction_date"), F.col("qty_sold").cast("bigint")
    start, before = F.trunc(end, "YEAR"), F.add_months(end, -1)
    ytd = {
        "net_ytd": F.sum(F.when(day.between(start, end), line)),
        "net_prior": F.sum(F.when(day.between(F.add_months(start, -12), F.add_months(end, -12)), line)),
    }
    mtd = {
        "units_mtd": F.sum(F.when(day.between(month_start(end), end), qty)),
        "units_prior": F.sum(F.when(day.between(month_start(before), before), qty)),
    }
    change = lambda now, then: safe_divide(F.coalesce(F.col(now), F.lit(0)) - F.col(then), F.col(then), 0)
    return {
        "revenue_vs_prior": Measure(change("net_ytd", "net_prior"), 4, ytd),
        "demand_mom_growth_pct": Measure(change("units_mtd", "units_prior") * 100, 4, mtd),
    }


def stock_measures(as_of, dead_days: int = 365) -> dict[str, Measure]:
    """The stock measures, over a frame of stock rows with ``qty_on_hand``, ``avg_unit_cost`` and ``last_movement_date``."""
    value = F.col("qty_on_hand") * F.col("avg_unit_cost")
    dead = F.datediff(as_date(as_of), F.col("last_movement_date")) > dead_days
    states = {"value": F.sum(value), "dead": F.sum(F.when(dead, value))}
    total = F.col("value").cast("double")
    return {
        "total_inventory_value": Measure(total, 2, {"value": states["value"]}),
        "dead_stock_value": Measure(F.coalesce(F.col("dead").cast("double"), F.lit(0.0)), 2, {"dead": states["dead"]}),
        "dead_stock_pct": Measure(safe_divide(F.col("dead"), F.col("value"), 0) * 100, 4, states),
        "sku_count": Measure(F.col("n_part_id"), 0, distinct="part_id"),
    }


def _aggregates(measures: Mapping[str, Measure]) -> tuple[list[Column], list[Column], list[str]]:
    """(aggregates over fact rows, merges of them, the distinct column in a list or none)."""
    states = {n: a for m in measures.values() for n, a in m.states.items()}
    least = {n: c for m in measures.values() for n, c in m.least.items()}
    most = {n: c for m in measures.values() for n, c in m.most.items()}
    distinct = sorted({m.distinct for m in measures.values() if m.distinct})
    if len(distinct) > 1:
        raise ValueError(f"one distinct column at a time, not {distinct}")
    rows = [*[a.alias(n) for n, a in states.items()], *[F.min(c).alias(n) for n, c in least.items()], *[F.max(c).alias(n) for n, c in most.items()]]
    merges = [*[F.sum(n).alias(n) for n in states], *[F.min(n).alias(n) for n in least], *[F.max(n).alias(n) for n in most]]
    return rows, merges, distinct


def _finished(measures: Mapping[str, Measure]) -> list[Column]:
    return [(num_round(m.value, m.digits) if m.digits else m.value.cast("bigint")).alias(name) for name, m in measures.items()]


def measures_of(facts: DataFrame, measures: Mapping[str, Measure], by: Sequence[str] = ()) -> DataFrame:
    """(by, measures) in one pass, without subtotals; one row for the whole frame when ``by`` is empty."""
    rows, merges, distinct = _aggregates(measures)
    if not distinct:
        return facts.groupBy(*by).agg(*rows).select(*by, *_finished(measures))
    fine = facts.groupBy(*dict.fromkeys([*by, *distinct])).agg(*rows)
    counts = [F.count(d).alias(f"n_{d}") for d in distinct]
    return fine.groupBy(*by).agg(*merges, *counts).select(*by, *_finished(measures))


def measure_cube(facts: DataFrame, measures: Mapping[str, Measure], by: Sequence[str], sets: Sets | None = None) -> DataFrame:
    """(by, level, measures) for every group of every set of ``by`` (default: all subsets).

    ``level`` has a bit for each column of ``by``, the first highest, set where the row is a subtotal over it; so a
    null group (bit 0) is told from a subtotal (bit 1). An empty fact has no rows, not even a grand total.
    """
    by = list(by)
    sets = cube_sets(by) if sets is None else [list(s) for s in sets]
    rows, merges, distinct = _aggregates(measures)
    count = F.sum("_rows").alias("_rows")
    rows = [*rows, F.count(F.lit(1)).alias("_rows")]
    level = F.grouping_id(*by).cast("int").alias("level")
    if not distinct:
        merged = facts.groupBy(*by).agg(*rows).groupingSets(sets, *by).agg(*merges, count, level)
    else:
        fine = _sums_and_values(facts, rows, by, distinct[0])
        sums = fine.where("NOT _value").drop("_distinct", "_value").groupingSets(sets, *by).agg(*merges, count, level)
        counts = _distinct_counts(fine.where("_value").select(*by, "_distinct"), by, sets, f"n_{distinct[0]}")
        both = sums.unionByName(counts, allowMissingColumns=True)
        merged = both.groupBy(*by, "level").agg(*merges, count, F.coalesce(F.sum(f"n_{distinct[0]}"), F.lit(0)).alias(f"n_{distinct[0]}"))
    return merged.where("_rows > 0").select(*by, "level", *_finished(measures))


def _sums_and_values(facts: DataFrame, rows: Sequence[Column], by: Sequence[str], distinct: str) -> DataFrame:
    """The states of the finest groups (``_value`` false) and, as rows without states, each value of the distinct column
    in them (``_distinct``, ``_value`` true). Both come from one pass over the facts and are written once.

    So sums are reduced to groups before they are shuffled, and what is shuffled for a value is the value."""
    twice = facts.withColumn("_distinct", F.col(distinct)).withColumn("_value", F.explode(F.array(F.lit(False), F.lit(True))))
    twice = twice.where("NOT _value OR _distinct IS NOT NULL")
    bare = {c: F.when(~F.col("_value"), F.col(c)) for c in facts.columns if c not in by}
    told = twice.withColumns({**bare, "_distinct": F.when(F.col("_value"), F.col("_distinct"))})
    return materialize(told.groupBy(*by, "_distinct", "_value").agg(*rows), "cube")


def _distinct_counts(values: DataFrame, by: Sequence[str], sets: Sets, out: str) -> DataFrame:
    """(by, level, out): the number of values in each group of each set.

    The values are dealt by value while there is one row of each finest group, then expanded to the sets: the rows of
    a value in a set meet in its task, so the expanded rows are not shuffled."""
    dealt = values.repartition(partitions(values.sparkSession), "_distinct")
    bits = {c: 1 << (len(by) - 1 - i) for i, c in enumerate(by)}
    levels = [sum(bit for c, bit in bits.items() if c not in s) for s in sets]
    one = dealt.select("*", F.explode(F.array(*[F.lit(n) for n in levels])).alias("level"))
    kept = {c: F.when(F.col("level").bitwiseAND(F.lit(bit)) == 0, F.col(c)) for c, bit in bits.items()}
    return one.withColumns(kept).select(*by, "level", "_distinct").distinct().groupBy(*by, "level").agg(F.count(F.lit(1)).alias(out))
