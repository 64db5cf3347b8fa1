"""Labels from what really came: the day on which the stock of a snapshot ran out.

The classifier's own target is a rule over its inputs. These labels look ahead instead: to the next snapshot of the
key without available stock, and to the first day on which more had been asked for than was there.

Snapshots and daily demand are dealt by key once and sorted by day; windows over a key's days find everything, and
nothing is written. Snapshots without a key or a day meet nothing and stay out of the windows, however many there are.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.config import DEFAULTS, Settings
from stocklens.functions.scalar import KEYS
from stocklens.operators.ordered import prefix_sum
from stocklens.sources.scratch import partitions

FUTURE_COL = "stockout_within_horizon"
_DAY, _ASKS, _UNITS = "_day", "_asks", "_units"


def _daily(sales: DataFrame) -> DataFrame:
    """(part_id, dealer_id, day, _q): units of each day; of a fact or a state."""
    return sales.groupBy(*KEYS, F.col("transaction_date").alias("day")).agg(F.sum(F.col("qty_sold").cast("bigint")).alias("_q"))


def running_demand(sales: DataFrame) -> DataFrame:
    """(part_id, dealer_id, day, sold): units sold up to and including each day with sales; of a fact or a state."""
    daily = _daily(sales).where("_q > 0 and day is not null")
    return prefix_sum(daily, {"sold": "_q"}, [F.col("day").asc()], KEYS).drop("_q")


def _present(*columns: str) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _timeline(snapshots: DataFrame, daily: DataFrame) -> DataFrame:
    """Snapshots (``_asks``) and daily demand (``_units``) of each key with the day as a number, ``_day``.

    Demand is dealt by part as the snapshots of ``Star`` are: rows of the same partitions are united in place, others are
    moved once, for the first window."""
    n, known = partitions(snapshots.sparkSession), _present(*KEYS, "day")
    asks = snapshots.withColumns({_DAY: F.unix_date("snapshot_date"), _ASKS: F.lit(True), _UNITS: F.lit(None).cast("bigint")})
    blank = {c: F.lit(None).cast(snapshots.schema[c].dataType) for c in snapshots.columns if c not in KEYS}
    sold = daily.where(known).repartition(n, KEYS[0]).withColumns({**blank, _DAY: F.unix_date("day"), _ASKS: F.lit(False), _UNITS: F.col("_q")})
    return asks.unionByName(sold.select(*asks.columns))


def label_future_stockout(inventory: DataFrame, sales: DataFrame, s: Settings = DEFAULTS, horizon: int | None = None) -> DataFrame:
    """Per snapshot: ``gone_date``, the first day without available stock, ``days_to_stockout`` and the label.

    That day is the snapshot's own when nothing is available then. Else it is the earlier of two: the next snapshot of
    the part and dealer without available stock, and the first day on which sales since the snapshot reach its
    available stock, if that comes before the next snapshot (which knows what was delivered). It is null when
    neither comes. The label is 1 when the day lies at most ``horizon`` (default 14) days ahead. Snapshots with null
    keys or dates have no day; one key has one snapshot a day (of repeated ones each is labelled).
    """
    days = s.label_days if horizon is None else horizon
    columns = [*KEYS, "snapshot_date", "qty_available"]
    snapshots, known = inventory.select(*columns), _present(*KEYS, "snapshot_date")
    line = _timeline(snapshots.where(known), _daily(sales).where("_q > 0")).withColumn("_back", -F.col(_DAY))
    # Backwards in time: what comes after a row's day lies before it.
    later = Window.partitionBy(*KEYS).orderBy("_back").rangeBetween(Window.unboundedPreceding, -1)
    empty = F.min(F.when(F.col(_ASKS) & (F.col("qty_available") <= 0), F.col(_DAY))).over(later)
    line = line.withColumns({
        "_later": F.coalesce(F.sum(_UNITS).over(later), F.lit(0)), "_empty": empty,
        # Minus the day of the next snapshot: this order is the one the rows are in.
        "_next": F.max(F.when(F.col(_ASKS), F.col("_back"))).over(later),
    })
    # A snapshot shares its next snapshot with the demand from its day up to the day before that one: at most a row a day.
    span = Window.partitionBy(*KEYS, "_next")
    sold = F.collect_list(F.when(~F.col(_ASKS), F.struct(F.col(_DAY).alias("day"), F.col("_later").alias("later")))).over(span)
    line = line.withColumn("_sold", sold).where(_ASKS)
    enough = F.filter("_sold", lambda d: F.col("_later") - d["later"] >= F.col("qty_available"))
    reached = F.array_min(F.transform(enough, lambda d: d["day"]))
    gone = F.when(F.col("qty_available") <= 0, F.col(_DAY)).when(F.col("qty_available") > 0, F.least("_empty", reached))
    found = line.select(*columns, F.date_from_unix_date(gone).alias("gone_date"))
    ready = found.unionByName(snapshots.where(~known).withColumn("gone_date", F.lit(None).cast("date")))
    left = F.datediff("gone_date", "snapshot_date")
    label = F.coalesce(left <= days, F.lit(False)).cast("int")
    return ready.select(*columns, "gone_date", left.alias("days_to_stockout"), label.alias(FUTURE_COL))


def demand_before(snapshots: DataFrame, sales: DataFrame, windows: tuple[int, ...] = (30, 60, 90)) -> DataFrame:
    """(part_id, dealer_id, snapshot_date, ``qty_sold_<n>d``): units of the last n days before and on each distinct
    snapshot day, so that a model can be trained on any past day. All windows come from one pass over the keys."""
    line = _timeline(snapshots.select(*KEYS, "snapshot_date").dropna(), _daily(sales))
    by_day = Window.partitionBy(*KEYS).orderBy(_DAY)
    before = F.lag(F.struct(_DAY, _ASKS)).over(Window.partitionBy(*KEYS).orderBy(_DAY, _ASKS))
    again = F.coalesce(before == F.struct(_DAY, _ASKS), F.lit(False))
    line = line.withColumn("_again", again).withColumns({f"qty_sold_{n}d": F.coalesce(F.sum(_UNITS).over(by_day.rangeBetween(-n, 0)), F.lit(0)) for n in windows})
    return line.where(F.col(_ASKS) & ~F.col("_again")).select(*KEYS, "snapshot_date", *[f"qty_sold_{n}d" for n in windows])


def label_counts(labelled: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Snapshots and stock-outs ahead per date."""
    return labelled.groupBy(by).agg(F.count(F.lit(1)).alias("snapshots"), F.sum(FUTURE_COL).alias("stockouts")).orderBy(by)
