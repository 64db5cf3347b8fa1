"""A corpus pipeline of text operators: quality, near duplicates, repeated spans, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and returns the
columns of documents, but the last, which returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm.common import store, table
from stocklens.llm.decontam import contaminated_texts, with_text_key
from stocklens.llm.jaccard import document_components
from stocklens.llm.packing import pack_documents
from stocklens.llm.quality import accepted, quality_weights
from stocklens.llm.spans import without_repeated_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, whatever else the table has."""
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; rows with a null doc_id are judged like others."""
    return accepted(_columns(docs), quality_weights(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest doc_id, of several texts of that id the
    one with the smallest hash. Rows that repeat id and text are one document; documents without words are linked
    with nothing and stay (of several such texts of one id one), and so do documents with a null doc_id."""
    docs = _columns(docs)
    found = document_components(docs).where("doc_id is not null")
    first = found.groupBy("component_id", F.col("n_shingles") == 0).agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    kept = store(first.select("kept.doc_id", "kept.text_hash"), "kept_ids")
    named = docs.where("doc_id is not null").withColumn("text_hash", F.xxhash64("text")).join(kept, ["doc_id", "text_hash"], "left_semi")
    return named.dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id is null"), allowMissingColumns=True).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words outside repeated 35-word windows, one space apart; a text without any stays as it is."""
    cut = without_repeated_spans(_columns(docs))
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark window."""
    docs = _columns(docs)
    hit = contaminated_texts(docs, table(spark, sf_dir, "benchmark")).select("h1", "h2")
    return with_text_key(docs).join(hit, ["h1", "h2"], "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 2048 ids."""
    import public_tokenizers

    return pack_documents(_columns(docs), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("jaccard_join", near_duplicates),
    ("substring_dedup", substrings),
    ("decontamination", decontaminated),
    ("best_fit_packing", packing),
]

#: No SQL expresses the classifier and the tokenizer; the tests compare stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents, each written as a table and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
