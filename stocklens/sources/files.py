"""Reading the inputs and writing the results."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocklens.functions.scalar import as_date, month_start, number_from_text
from stocklens.operators.quality import check_foreign_key, check_unique
from stocklens.schemas import PARTITION_DATE, PO_STUB_COLUMNS, PRIMARY_KEYS, TABLES, conform, struct_of
from stocklens.sources.scratch import materialize

log = logging.getLogger(__name__)

# Raw extracts: dates stay text so that the cleaner can count unparseable ones.
RAW_SALES = (
    "transaction_date STRING, part_id BIGINT, dealer_id INT, customer_type STRING, qty_sold INT, "
    "unit_price DOUBLE, discount_pct DOUBLE, revenue DOUBLE, cogs DOUBLE, gross_profit DOUBLE, "
    "order_source STRING, was_fulfilled BOOLEAN, backorder_qty INT"
)
RAW_INVENTORY = (
    "snapshot_date STRING, part_id BIGINT, dealer_id INT, qty_on_hand INT, qty_reserved INT, "
    "qty_in_transit INT, avg_unit_cost DOUBLE, last_movement_date DATE"
)
RAW_PARTS = (
    "part_id BIGINT, part_number STRING, part_name STRING, brand STRING, category STRING, "
    "standard_cost DOUBLE, list_price DOUBLE, is_critical BOOLEAN, is_active BOOLEAN"
)

# File names of the demo inputs and of the result set.
INPUT_FILES = {
    "sales": ("fact_sales_sample.csv", RAW_SALES),
    "inventory": ("fact_inventory_sample.csv", RAW_INVENTORY),
    "parts": ("dim_parts_sample.csv", RAW_PARTS),
}
OUTPUT_FILES = {
    "abc_xyz": "abc_xyz_classification.parquet",
    "reorder_policies": "reorder_policies.parquet",
    "forecasts": "demand_forecasts.parquet",
    "stockout_scores": "stockout_risk_scores.parquet",
    "abc_xyz_summary": "abc_xyz_summary.csv",
}


#: Rows of one range of a stored batch with more of them than the shuffle partitions take.
RANGE_ROWS = 2_000_000

#: Column with the place of a row in its source: file, start of the split in it, number within the split.
POSITION = "_position"


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, position: bool = False) -> DataFrame:
    """Header CSV. Columns are bound by *name*; unknown ones stay strings.

    Casting is tolerant (a bad number becomes null and is then counted by the
    cleaner), whole numbers may be written as "5.0", and reading never infers a schema, which
    would cost an extra pass. ``position`` adds POSITION, which orders rows as the files do.
    """
    raw = spark.read.csv(path, header=True, enforceSchema=False)
    if position:
        place = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        raw = raw.select("*", F.struct(*[c.alias(n) for c, n in zip(place, ("file", "split", "row"), strict=True)]).alias(POSITION))
    if schema is None:
        return raw
    types = {f.name: f.dataType for f in _struct(schema).fields}
    return raw.select(
        *[number_from_text(c, types[c].simpleString()).alias(c) if c in types else F.col(c) for c in raw.columns]
    )


def _struct(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else struct_of(schema)


def load_inputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The demo inputs as lazy frames; a missing file is reported and left out."""
    data: dict[str, DataFrame] = {}
    for key, (name, schema) in INPUT_FILES.items():
        try:
            data[key] = read_csv(spark, f"{folder.rstrip('/')}/{name}", schema)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("input %s not found in %s", name, folder)
    data["purchase_orders"] = empty_purchase_orders(spark)
    return data


def empty_purchase_orders(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PO_STUB_COLUMNS)


def write_outputs(results: Mapping[str, DataFrame], folder: str, run_at: dt.datetime | None = None) -> str:
    """Write the result set under a per-run folder; absent or empty results are skipped.

    The summary is at most nine rows, so it becomes one CSV part file; the others
    keep the partitioning they have.
    """
    run_dir = f"{folder.rstrip('/')}/{(run_at or dt.datetime.now()):%Y%m%d_%H%M}"
    for key, name in OUTPUT_FILES.items():
        df = results.get(key)
        if df is None:
            continue
        path = f"{run_dir}/{name}"
        if name.endswith(".csv"):
            df.coalesce(1).write.mode("overwrite").csv(path, header=True)
        else:
            df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        _drop_if_empty(df, path, "csv" if name.endswith(".csv") else "parquet")
    return run_dir


def _drop_if_empty(df: DataFrame, path: str, kind: str) -> None:
    """Remove a result without rows; what was written is looked at, so that nothing is computed twice."""
    spark = df.sparkSession
    if spark.read.schema(df.schema).format(kind).option("header", True).load(path).isEmpty():
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_table(df: DataFrame, table: str, folder: str, mode: str = "overwrite") -> str:
    """Store a warehouse table as Parquet; facts in one directory per month.

    Rows are range partitioned on (month, day, keys): each task writes few months,
    and a month that holds most rows is still written by many tasks.
    """
    path = f"{folder.rstrip('/')}/{table}"
    out = conform(df, table)
    writer_df, parts = out, []
    if table in PARTITION_DATE:
        day = PARTITION_DATE[table]
        writer_df = out.withColumn("month", month_start(day)).repartitionByRange("month", day, *_spread(table))
        parts = ["month"]
    writer = writer_df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    return path


def replace_months(
    df: DataFrame, table: str, folder: str, references: Mapping[str, DataFrame] | None = None, keys: bool = True
) -> dict[str, int]:
    """Store a batch of a fact so that it replaces every month it brings, and no other; returns the rows by month.

    Loading a batch again changes nothing, and a corrected batch replaces the months it corrects: each month lies in
    a directory of its own, and only the directories of the batch are rewritten (dynamic partition overwrite). Before
    anything is written, the batch is checked alone: its primary keys must be unique (``keys``), and its foreign keys,
    a column -> dimension map, must be known. Rows without a date belong to no month and are refused as well. A dimension
    has no months: it is replaced as a whole.
    """
    path = f"{folder.rstrip('/')}/{table}"
    out = materialize(conform(df, table), f"batch_{table}")
    problems = _violations(out, table, references or {}, keys)
    if problems:
        raise ValueError(f"{table}: " + ", ".join(f"{name} {n}" for name, n in sorted(problems.items())))
    if table not in PARTITION_DATE:
        out.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return {}
    day = PARTITION_DATE[table]
    dated = out.withColumn("month", month_start(day))
    # A task sorts its range by month before it writes it: a large batch has more ranges, not larger ones.
    ranges = out.count() // RANGE_ROWS
    more = [ranges] if ranges > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    writer = dated.repartitionByRange(*more, "month", day, *_spread(table)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy("month").parquet(path)
    # A row a month of the batch.
    return {str(r["month"]): r["count"] for r in dated.groupBy("month").count().collect()}


def _violations(batch: DataFrame, table: str, references: Mapping[str, DataFrame], keys: bool) -> dict[str, int]:
    """Numbers of repeated keys, unknown references and rows without a date; empty if the batch is sound."""
    found = {}
    for columns in PRIMARY_KEYS[table] if keys else ():
        found[f"repeated {'+'.join(columns)}"] = check_unique(batch, columns).count()
    for column, dim in references.items():
        found[f"unknown {column}"] = check_foreign_key(batch, column, dim).count()
    if table in PARTITION_DATE:
        found["without date"] = batch.where(F.col(PARTITION_DATE[table]).isNull()).count()
    return {name: n for name, n in found.items() if n}


def _spread(table: str) -> list[str]:
    return [c for c in ("part_id", "dealer_id", "supplier_id") if c in TABLES[table].names]


def read_table(spark: SparkSession, table: str, folder: str, start=None, end=None) -> DataFrame:
    """A stored warehouse table with its declared types.

    ``start`` and ``end`` (days, both included) bound a fact by its date; the months that they lie
    in bound the directories that are read.
    """
    schema = TABLES[table]
    if table in PARTITION_DATE:
        schema = StructType(schema.fields[:]).add("month", "date")
    stored = spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{table}")
    if (start is not None or end is not None) and table not in PARTITION_DATE:
        raise ValueError(f"{table} has no date to bound")
    if start is not None:
        stored = stored.where((F.col("month") >= month_start(as_date(start))) & (F.col(PARTITION_DATE[table]) >= as_date(start)))
    if end is not None:
        stored = stored.where((F.col("month") <= month_start(as_date(end))) & (F.col(PARTITION_DATE[table]) <= as_date(end)))
    return stored
