"""One additive state per part, dealer and day, and a table of it that grows by batches.

Every key-level operator (demand statistics and windows, classes, health, turnover, fill rate) needs sums over days.
The state holds them once: the facts with their joins are read a single time, and arriving days add to the state
instead of making the facts be read again. A state has the columns of the sums, named like the fact's columns, so an
operator that only adds up quantities and money takes a state in place of the fact; the few that count lines
look for LINES.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.functions.scalar import KEYS, as_date, month_start
from stocklens.sources.scratch import partitions

DAY = "transaction_date"
#: Sales lines behind a row of the state; a frame with this column is a state.
LINES = "lines"
#: Columns that are added up as they are.
SUMS = ("qty_sold", "revenue", "cogs", "backorder_qty")
_BATCH, _MONTH = "batch", "month"


def is_state(sales: DataFrame) -> bool:
    return LINES in sales.columns


def key_day_state(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums per part, dealer and day (and the columns of ``by``): quantities, money, lines by outcome.

    ``qty_lines`` and ``qty_squares`` are count and sum of squares of the line quantities, ``net`` is quantity x
    price x (100 - discount), exact for decimals. Null quantities and amounts add nothing; columns that the sales
    lack are left out. Whole numbers and decimals make the state independent of how it is cut into batches.

    Lines are dealt before they are added up: few share a key and a day, and a line is less than half as wide as its sums.
    """
    have = set(sales.columns)
    keys = [*KEYS, DAY, *by]
    used = [c for c in sales.columns if c in {*keys, *SUMS, "was_fulfilled", "unit_price", "discount_pct"}]
    qty = F.col("qty_sold").cast("bigint")
    sums = [F.sum(qty if c == "qty_sold" else F.col(c)).alias(c) for c in SUMS if c in have]
    sums += [F.count(F.lit(1)).alias(LINES), F.count(qty).alias("qty_lines"), F.sum(qty * qty).alias("qty_squares")]
    if "was_fulfilled" in have:
        sums += [F.count_if("was_fulfilled").alias("filled"), F.count_if(~F.col("was_fulfilled")).alias("missed")]
    if {"unit_price", "discount_pct"} <= have:
        sums.append(F.sum(F.col("qty_sold") * F.col("unit_price") * (F.lit(100) - F.col("discount_pct"))).alias("net"))
    return _dealt(sales.select(*used), keys).groupBy(*keys).agg(*sums)


def _dealt(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), *keys)


def _numbers(state: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in state.columns if c not in (*keys, _BATCH, _MONTH)]


def merge_states(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows of one key and day added up; types stay those of ``state``."""
    keys = [*KEYS, DAY, *by]
    sums = [F.sum(c).cast(state.schema[c].dataType).alias(c) for c in _numbers(state, keys)]
    return _dealt(state.select(*keys, *_numbers(state, keys)), keys).groupBy(*keys).agg(*sums)


# ---------------------------------------------------------------- the stored state
def write_batch(state: DataFrame, folder: str, batch: str) -> None:
    """Store the state of one batch of arriving sales, in a directory for each of its months.

    A batch owns its directory: loading it again replaces it, so a repeated load changes nothing and a corrected
    batch leaves nothing of the old one. Days that several batches bring are added up when they are read.
    """
    out = state.withColumn(_MONTH, month_start(DAY)).repartitionByRange(partitions(state.sparkSession), _MONTH, DAY, *KEYS)
    out.write.mode("overwrite").option("compression", "snappy").partitionBy(_MONTH).parquet(f"{folder.rstrip('/')}/{_BATCH}={batch}")


def read_state(spark: SparkSession, folder: str, schema: StructType, start=None, end=None, by: Sequence[str] = ()) -> DataFrame:
    """All batches as one state. ``schema`` is that of the batches; ``start`` and ``end`` (days, both included) bound
    the month directories that are read."""
    named = StructType(schema.fields[:]).add(_BATCH, "string").add(_MONTH, "date")
    stored = spark.read.schema(named).parquet(folder)
    if start is not None:
        stored = stored.where((F.col(_MONTH) >= month_start(as_date(start))) & (F.col(DAY) >= as_date(start)))
    if end is not None:
        stored = stored.where((F.col(_MONTH) <= month_start(as_date(end))) & (F.col(DAY) <= as_date(end)))
    return merge_states(stored, by)


def compact(spark: SparkSession, folder: str, target: str, schema: StructType, by: Sequence[str] = ()) -> None:
    """Write the batches of ``folder`` as the single batch ``base`` of ``target``, one row per key and day."""
    write_batch(read_state(spark, folder, schema, by=by), target, "base")


# ---------------------------------------------------------------- aggregates over lines or states
def line_aggregates(sales: DataFrame, rows: Column | None = None) -> dict[str, Column]:
    """Aggregates that count lines, over a fact or a state: lines, filled, missed, and the line quantities' count, sum
    and sum of squares (n, s, q). ``rows`` restricts them to some rows."""
    some = (lambda c: c) if rows is None else (lambda c: F.when(rows, c))
    qty = F.col("qty_sold").cast("bigint")
    if is_state(sales):
        parts = {"lines": F.col(LINES), "n": F.col("qty_lines"), "s": qty, "q": F.col("qty_squares")}
        parts |= {c: F.col(c) for c in ("filled", "missed") if c in sales.columns}
        return {name: F.coalesce(F.sum(some(c)), F.lit(0)) if name not in "sq" else F.sum(some(c)) for name, c in parts.items()}
    out = {"lines": F.count(some(F.lit(1))), "n": F.count(some(qty)), "s": F.sum(some(qty)), "q": F.sum(some(qty * qty))}
    if "was_fulfilled" in sales.columns:
        held = F.lit(True) if rows is None else rows
        out |= {"filled": F.count_if(held & F.col("was_fulfilled")), "missed": F.count_if(held & ~F.col("was_fulfilled"))}
    return out
