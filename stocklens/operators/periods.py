"""Period sums by look-up: running totals per group and day, any range being the difference of two of them.

The facts are reduced to group x day once, and a chunked prefix sum makes the running totals. Every period of every
anchor date (month to date, year to date, the same days a year earlier, the last twelve months) is then two as-of
look-ups in them, all in a single as-of join, however many periods are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.scalar import month_start
from stocklens.operators.asof import asof_join
from stocklens.operators.ordered import prefix_sum

#: A period of an anchor day: the day before it begins, and its last day.
Period = tuple[Column, Column]


def standard_periods(anchor: str = "anchor") -> dict[str, Period]:
    """The periods of the dashboard that end on (or a year or a month before) the anchor day."""
    day = F.col(anchor)
    year, month = F.trunc(day, "YEAR"), month_start(day)
    last_year, last_month = F.add_months(day, -12), F.add_months(day, -1)
    return {
        "mtd": (F.date_sub(month, 1), day),
        "ytd": (F.date_sub(year, 1), day),
        "prior_month_mtd": (F.date_sub(month_start(last_month), 1), last_month),
        "prior_year_mtd": (F.date_sub(F.add_months(month, -12), 1), last_year),
        "prior_year_ytd": (F.date_sub(F.add_months(year, -12), 1), last_year),
        "trailing_12": (last_year, day),
    }


def period_index(facts: DataFrame, values: Mapping[str, str | Column], by: Sequence[str] = (), day: str = "transaction_date") -> DataFrame:
    """(by, day, one running total per value): totals up to and including each day on which the group has rows.

    ``values`` maps names to columns or expressions of ``facts``. Rows without a day belong to no period, null groups
    are groups of their own."""
    sums = [F.sum(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in values.items()]
    daily = facts.where(F.col(day).isNotNull()).groupBy(*by, F.col(day).alias("day")).agg(*sums)
    filled = daily.withColumns({name: F.coalesce(F.col(name), F.lit(0).cast(daily.schema[name].dataType)) for name in values})
    running = prefix_sum(filled, {f"_run_{name}": name for name in values}, [F.col("day").asc()], by)
    return running.select(*by, "day", *[F.col(f"_run_{name}").alias(name) for name in values])


def month_ends(index: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, anchor): the last day of every month between the first and the last day of the index, for each group."""
    whole = index.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    months = whole.select(F.transform(F.sequence(month_start("a"), month_start("b"), F.expr("interval 1 month")), lambda m: F.last_day(m))).scalar()
    groups = index.select(*by).distinct() if by else index.limit(1)
    return groups.select(*by, F.explode(months).alias("anchor"))


def period_sums(
    index: DataFrame, anchors: DataFrame, values: Sequence[str], periods: Mapping[str, Period] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by, anchor, <value>_<period>): the sums of every period of every anchor, 0 where a period has no rows.

    ``anchors`` has the columns of ``by`` (without nulls) and ``anchor``."""
    periods = standard_periods() if periods is None else periods
    by = list(by)
    asks = [
        F.struct(F.lit(i).alias("period"), when.alias("at"), F.lit(sign).alias("sign"))
        for i, (start, end) in enumerate(periods.values())
        for when, sign in ((end, 1), (start, -1))
    ]
    asked = anchors.select(*by, "anchor", F.inline(F.array(*asks)))
    keyed = lambda df: df if by else df.withColumn("_all", F.lit(0))
    found = asof_join(keyed(asked), keyed(index), "at", "day", list(values), by or ["_all"])
    sums = []
    for v in values:
        kind = index.schema[v].dataType
        for i, name in enumerate(periods):
            part = F.when(F.col("period") == i, F.col("sign") * F.col(v))
            sums.append(F.coalesce(F.sum(part), F.lit(0)).cast(kind).alias(f"{v}_{name}"))
    return found.groupBy(*by, "anchor").agg(*sums)


def period_table(facts: DataFrame, values: Mapping[str, str | Column], by: Sequence[str] = (), day: str = "transaction_date") -> DataFrame:
    """The standard periods at every month end for every group."""
    index = period_index(facts, values, by, day)
    return period_sums(index, month_ends(index, by), list(values), None, by)
