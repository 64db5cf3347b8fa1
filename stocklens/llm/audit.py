"""Divergence of sources: how far the term frequencies of two sources of a language lie apart.

Terms are counted in the tasks by length-bucketed packing. A term of up to 8 bytes is one 64-bit word, one of up
to 16 bytes is two; packed words are radix-sorted in 16-bit digits and counted as runs. Longer terms stand in a
bucket for each power of two of their length and are sorted as bytes. The runs of a chunk then meet in one shuffle.

Pair sums need every kept term in every source of the language. Terms are dealt to blocks of a bounded number of
counts, and a block adds up its own share of every pair in integer matrices, so that no pair of rows is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.bytewords import LETTERS, Words, chunks, packed, pieces, words_in
from stocklens.llm.common import discard, small, store

#: A language keeps the terms that stand in at least so many of its documents.
MIN_DOCS = 10
#: Ranks of the part `term`.
TOP_TERMS = 10
#: Counts (source x term) that a block of terms has about; no effect on results.
BLOCK_CELLS = 100_000
#: Numbers of a matrix that a block holds at a time; no effect on results.
MATRIX_CELLS = 1_000_000
#: Rows of sums by group that are broadcast after counting them; more are joined by shuffle.
BROADCAST_GROUPS = 100_000
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


# ------------------------------------------------------------ packed counting in a task
def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by the keys (most significant first), in passes over 16-bit digits from the lowest."""
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_counts(order: np.ndarray, keys: list[np.ndarray], text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each run's first element, elements, distinct texts) of the runs of equal keys in sorted rows."""
    if not len(order):
        return order, order, order
    first = np.ones(len(order), bool)
    first[1:] = False
    for key in keys:
        k = key[order]
        first[1:] |= k[1:] != k[:-1]
    t = text[order]
    other = first.copy()
    other[1:] |= t[1:] != t[:-1]
    at = np.flatnonzero(first)
    return order[at], np.diff(np.append(at, len(order))), np.add.reduceat(other.astype(np.int64), at)


def counted(words: Words, group: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, their groups, occurrences, texts) by length bucket; `group` is the group of each word."""
    length = words.end - words.start
    group = group.astype(np.uint32)
    for least, most in ((1, 8), (9, 16)):
        at = np.flatnonzero((length >= least) & (length <= most))
        parts = [packed(words.data, words.start[at] + offset, words.end[at]) for offset in range(0, most, 8)]
        keys = [*parts, group[at]]
        rows, n, docs = run_counts(radix_order(keys), keys, words.text[at])
        raw = np.column_stack([p[rows] for p in parts]).astype(">u8")
        yield pa.array(np.ascontiguousarray(raw).view(f"S{most}").ravel(), pa.binary()), group[at][rows], n, docs
    raw = words.data.tobytes()
    bucket = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for width in np.unique(bucket[length > 16]):
        at = np.flatnonzero((length > 16) & (bucket == width))
        spans = zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)
        terms = np.array([raw[a:b] for a, b in spans], f"S{1 << width}")
        order = radix_order([group[at]])
        order = order[np.argsort(terms[order], kind="stable")]
        rows, n, docs = run_counts(order, [terms, group[at]], words.text[at])
        yield pa.array(terms[rows].tolist(), pa.binary()), group[at][rows], n, docs


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
    for texts, rows in chunks(batches):
        names = list(zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), strict=True))
        groups = {name: i for i, name in enumerate(dict.fromkeys(names))}
        of_text = np.fromiter(map(groups.__getitem__, names), np.uint32, len(names))
        langs, sources = (pa.array([name[i] for name in groups], pa.string()) for i in (0, 1))
        zero = np.zeros(len(groups), np.int64)
        yield from pieces([langs, sources, pa.array([""] * len(groups)), pa.array(zero), pa.array(zero)], schema)
        words = words_in(texts, LETTERS)
        for terms, group, n, docs in counted(words, of_text[words.text]):
            index = pa.array(group)
            yield from pieces([langs.take(index), sources.take(index), terms, pa.array(n), pa.array(docs)], schema)


# ------------------------------------------------------------ the corpus
def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, n_lang, once) of the kept terms, stored: occurrences in the group and in the
    language; `once` holds on one row of each (lang, term). Each group also has a row with the empty term.

    One shuffle by (lang, term): it brings a row for each chunk and source that a term stands in.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    runs = docs.select(empty("text"), empty("lang"), empty("source")).mapInArrow(_count, COUNTS)
    dealt = runs.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    known = dealt.select(
        "lang", "source", "term", "n", F.sum("docs").over(term).alias("in_docs"), F.sum("n").over(term).alias("n_lang"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("once"),
    )
    return store(known.where((F.col("term") == "") | (F.col("in_docs") >= min_docs)).drop("in_docs"), "term_counts")


def group_sums(counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, kept), stored: occurrences of kept terms in the group and in the language,
    kept terms of the language."""
    kept = F.count_if(F.col("once") & (F.col("term") != ""))
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), kept.alias("first_seen"))
    lang = Window.partitionBy("lang")
    return store(
        groups.select("lang", "source", "total", F.sum("total").over(lang).alias("lang_total"), F.sum("first_seen").over(lang).alias("kept")),
        "group_sums",
    )


def share(n: str, total: str) -> Column:
    """1 + floor(1e9 (n + 2) / (total + 2 kept)) in exact decimals; null if nothing is kept."""
    above = f"CAST(1000000000 AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(19,0))"
    return F.expr(f"1 + ({above}) div NULLIF(CAST({total} + 2 * kept AS DECIMAL(19,0)), 0)")


def top_terms(counts: DataFrame, sums: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """The terms that a source uses more often than its language, most telling first."""
    shares = counts.where("term <> ''").join(small(sums, BROADCAST_GROUPS), ["lang", "source"])
    shares = shares.select("lang", "source", F.col("term").alias("item"), share("n", "total").alias("p"), share("n_lang", "lang_total").alias("q"))
    scored = shares.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def pair_sums(p: np.ndarray) -> np.ndarray:
    """For a matrix of shares (terms x sources): over all terms, the sum of floor((p - q)^2 / (p + q)) for each
    two sources (upper triangle). Shares are below 2^30, so squares stay exact in 64 bits."""
    out = np.zeros((p.shape[1], p.shape[1]), np.int64)
    for i in range(p.shape[1] - 1):
        gap, both = p[:, i + 1 :] - p[:, i : i + 1], p[:, i + 1 :] + p[:, i : i + 1]
        out[i, i + 1 :] = (gap * gap // both).sum(axis=0)
    return out


def _block(counts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of one block of terms for each two sources (a < b) of its language."""
    groups = groups.sort_values("source", ignore_index=True)
    names, total = groups["source"].to_numpy(), np.zeros((len(groups), len(groups)), np.int64)
    if len(counts):
        none = groups["p0"].to_numpy(np.int64)
        term, _ = pd.factorize(counts["term"])
        order = np.argsort(term, kind="stable")
        term, p = term[order], counts["p"].to_numpy(np.int64)[order]
        source = pd.Index(names).get_indexer(counts["source"])[order]
        step = max(1, MATRIX_CELLS // len(names))
        for low in range(0, term[-1] + 1, step):
            a, b = np.searchsorted(term, [low, low + step])
            matrix = np.tile(none, (min(step, term[-1] + 1 - low), 1))
            matrix[term[a:b] - low, source[a:b]] = p[a:b]
            total += pair_sums(matrix)
    i, j = np.triu_indices(len(names), 1)
    return pd.DataFrame({"lang": groups["lang"].iloc[:1].repeat(len(i)).to_numpy(), "a": names[i], "b": names[j], "value": total[i, j]})


def source_pairs(counts: DataFrame, sums: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """Every two sources of a language with the summed distance of all kept terms, ranked for each source."""
    kept = counts.where("term <> ''")
    blocks = -(-kept.count() // block_cells) or 1
    cells = kept.join(small(sums, BROADCAST_GROUPS), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block"), "term", "source", share("n", "total").alias("p")
    )
    groups = sums.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), "source", F.expr("0").alias("n"), "total", "kept")
    groups = groups.select("lang", "block", "source", share("n", "total").alias("p0"))
    shares = cells.groupBy("lang", "block").cogroup(groups.groupBy("lang", "block")).applyInPandas(_block, "lang string, a string, b string, value bigint")
    pairs = shares.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    both = pairs.select("lang", "value", F.inline(sides))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return both.withColumn("rank", F.row_number().over(order))


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: the part `pair` sets each source of a language against every other,
    the part `term` lists the terms that set it apart from the language.

    Null texts, languages and sources are empty strings. Every row is a document, repeated rows count each time.
    A source without terms takes part with counts of 0, a source alone in its language has no pairs, and a
    language that keeps no term has pairs of value 0. Ties rank by item in byte order. Other columns are ignored.
    """
    counts = term_counts(docs, min_docs)
    sums = group_sums(counts)
    parts = [("pair", source_pairs(counts, sums)), ("term", top_terms(counts, sums, top))]
    columns = lambda name, df: df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))
    made = store(columns(*parts[0]).unionByName(columns(*parts[1])), "divergence")
    discard(counts, sums)
    return made
