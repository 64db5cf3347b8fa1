"""Shared helpers of the text operators: tables, stored intermediate results, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct words whose hashes a worker keeps; beyond it the cache starts anew (no effect on results).
CACHE_WORDS = 150_000
#: Rows that a batch function holds as Python objects at a time.
ROWS_AT_ONCE = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without one gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = f"file://{tempfile.mkdtemp(prefix='shared-')}"
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def store(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut and what follows
    survives lost executors. The session's JVM owns the table and deletes it when it ends."""
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    files, place = _place(spark, path)
    files.deleteOnExit(place)
    stored = spark.read.schema(schema).parquet(path)
    stored._stored_path = path
    return stored


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def discard(*stored: DataFrame) -> None:
    """Delete tables made by store() that no returned result reads any more."""
    for df in stored:
        files, place = _place(df.sparkSession, df._stored_path)
        files.delete(place, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """df, to be broadcast if it has at most so many rows: it is counted first. Larger, it is joined by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def map_batches(df: DataFrame, function: Callable[[dict[str, list]], dict[str, Iterable]], schema: str, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """mapInArrow over dicts of columns: `function` gets the columns of so many rows of a batch as lists and
    returns the columns of the rows that it makes of them."""
    from pyspark.sql.types import StructType

    kinds = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                made = function({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def crc32_mod(column: str, divisor: int) -> F.Column:
    """crc32 of an integer's decimal text, modulo divisor; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)


class WordHashes(dict):
    """Word bytes -> 64-bit hash, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = value
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None, lower: bool) -> list[bytes]:
    """Runs of bytes other than ASCII white space; `lower` folds A-Z only. Null has none."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), in place of weak low bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE = 0x9E3779B97F4A7C15


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent hashes of all runs of `width` consecutive elements (empty if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    done, span = 0, 1
    block = mix(hashes)  # hashes of runs of `span` elements, doubled step by step
    start = 0
    with np.errstate(over="ignore"):
        while True:
            if width >> done & 1:
                out = out * _power(span) + block[start : start + n]
                start += span
            done += 1
            if width >> done == 0:
                break
            block = block[:-span] * _power(span) + block[span:]
            span *= 2
    return mix(out + np.uint64(_BASE * width & (1 << 64) - 1))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE | 1, n, 1 << 64))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

