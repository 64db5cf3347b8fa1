"""Incremental cleaning: files arriving in a folder, taken in per micro-batch, merged when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from stocklens.config import DEFAULTS
from stocklens.functions.scalar import number_from_text
from stocklens.operators.cleaning import CLEANERS, clean_merged, first_sales
from stocklens.schemas import struct_of


def clean_stream(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    checkpoint: str,
    table_type: str = "sales",
    columns: list[str] | None = None,
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Take in every file not seen before, append the result as Parquet, then stop.

    Each micro-batch owns the directory ``batch_id=N`` and overwrites it, so a batch that is replayed after a failure
    leaves one copy. Of sales a batch stores the state that cleaning needs (the first copy of each duplicate key and the
    number of copies), by month. ``read_cleaned`` merges the states, so duplicates and price limits are those of
    all files together, and do not depend on how many batches the files came in or in which order. Inventory is
    cleaned row by row and stored clean.
    """
    if table_type not in CLEANERS:
        raise ValueError(f"Unknown table_type: {table_type}. Choose from {list(CLEANERS)}")
    cleaner, ddl = CLEANERS[table_type]
    types = {f.name: f.dataType for f in struct_of(ddl).fields}
    names = columns or list(types)
    text = StructType()
    for c in names:
        text = text.add(c, StringType())
    reader = spark.readStream.schema(text).option("header", True).option("enforceSchema", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.csv(input_dir)
    typed = raw.select(*[number_from_text(c, types[c].simpleString()).alias(c) if c in types else F.col(c) for c in names])

    def store(batch: DataFrame, batch_id: int) -> None:
        if table_type == "sales":
            state = first_sales(batch, **options).withColumn("period", F.date_format("transaction_date", "yyyy-MM"))
            writer = state.write.partitionBy("period")
        else:
            writer = cleaner(batch, **options).clean.write
        writer.mode("overwrite").option("compression", "snappy").parquet(f"{output_dir.rstrip('/')}/batch_id={batch_id}")

    return (
        typed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()
    )


def read_cleaned(spark: SparkSession, output_dir: str, iqr_multiplier: float = DEFAULTS.iqr_multiplier) -> DataFrame:
    """All batches as one cleaned table."""
    stored = spark.read.parquet(output_dir)
    stored = stored.drop("batch_id", "period")
    return clean_merged(stored, iqr_multiplier) if "_copies" in stored.columns else stored
