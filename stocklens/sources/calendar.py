"""Date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions.scalar import as_date, month_start, year_month


def dim_date(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end]."""
    bounds = spark.range(1).select(as_date(start).alias("a"), as_date(end).alias("b"))
    return calendar_between(bounds, "a", "b")


def calendar_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar for the span held in a one-row frame, e.g. min and max sale date."""
    days = bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        month_start("date").alias("month_start"),
        year_month("date").alias("year_month"),
        F.weekday("date").alias("day_of_week"),
    )
