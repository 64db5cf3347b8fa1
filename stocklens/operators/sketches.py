"""Distinct counts from sketches that add up: one per group and month, merged when they are read.

A HyperLogLog sketch of 2^lg_k cells stands for a set of any size in a few kilobytes. Stored beside the months of a
fact, sketches give the distinct count of any range of months, or of any coarser group, without the fact. The
relative error of an estimate is below RELATIVE_ERROR with a probability of over 99.7 % (three standard errors of
1.04 / sqrt(2^lg_k)); small sets are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions.scalar import as_date, month_start

LG_K = 12
#: Three standard errors at LG_K.
RELATIVE_ERROR = 3 * 1.04 / (1 << LG_K) ** 0.5


def distinct_sketches(facts: DataFrame, column: str, by: Sequence[str] = (), day: str = "transaction_date", lg_k: int = LG_K) -> DataFrame:
    """(by, month, sketch) of the distinct non-null values of a whole-number or text column."""
    dated = facts.where(F.col(day).isNotNull() & F.col(column).isNotNull())
    return dated.groupBy(*by, month_start(day).alias("month")).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def distinct_estimate(sketches: DataFrame, by: Sequence[str] = (), start=None, end=None) -> DataFrame:
    """(by, estimate) over the months from ``start`` to ``end`` (both included, any day of the month names it)."""
    if start is not None:
        sketches = sketches.where(F.col("month") >= month_start(as_date(start)))
    if end is not None:
        sketches = sketches.where(F.col("month") <= month_start(as_date(end)))
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def distinct_audit(facts: DataFrame, sketches: DataFrame, column: str, by: Sequence[str], error: float = RELATIVE_ERROR) -> DataFrame:
    """(by, exact, within): the exact distinct counts, and whether the sketches' estimates lie within ``error``."""
    exact = facts.where(F.col(column).isNotNull()).select(*by, column).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("exact"))
    off = F.abs(F.col("estimate") - F.col("exact")) / F.col("exact")
    return exact.join(distinct_estimate(sketches, by), list(by)).select(*by, "exact", (off <= error).alias("within"))
