"""Cutting lineage through a written table in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors do not share one, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stocklens-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the checkpoint folder and read it back.

    Used where two branches must see the very same rows (for example the same
    range partitioning) or where one expensive result feeds several consumers.
    The copy outlives executors, is compressed, and later reads prune columns. The
    session's JVM owns it and deletes it when it ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stocklens/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Partitions of a table that is dealt by part before each part becomes many rows: several for each core, so that a task
    sorts and groups its share in memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
