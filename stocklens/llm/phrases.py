"""Collocations: phrases of two and three words that stand together more often than their parts suggest.

Phrases are mined by partitions (SON). Documents are dealt to a fixed number of shards by hash, and each shard is
mined completely at the support lowered in proportion to its share of the language's words: a phrase below that
in every shard is below the support in all. A shard is no task: tasks count the phrases of a chunk with numpy, one
shuffle by phrase adds the chunks of a shard up, so shards grow with the corpus at a constant local support.
The union of the locally frequent phrases is then counted over the whole corpus, exactly.

Longer phrases are looked for only where both shorter ones are frequent. Tasks know those by a bitmap of hashes of
at most 16 MB, which can only let phrases pass that are counted and dropped later.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.bytewords import Words, chunks, pieces, span_hashes, words_in
from stocklens.llm.common import discard, mix, small, store

#: Occurrences that make a phrase a candidate.
SUPPORT = 10
#: Shards that are mined at a lowered support; with four of equal size it is 3 of 10.
SHARDS = 4
#: Words of the longest phrases.
LONGEST = 3
#: Rows of each language in the result.
TOP = 2000
#: Bits of the largest bitmap (16 MB); beyond about ten million phrases it lets more pass, with equal results.
MAX_BITS = 1 << 27
#: Text bytes that a task counts at a time: numbers of all phrases have to fit in the memory of a worker.
CHUNK_BYTES = 2 << 20
#: Rows that are broadcast after counting them; more are joined by shuffle.
BROADCAST_ROWS = 200_000
COUNTS = "lang string, shard int, phrase string, n bigint"
_BREAKS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_WORD = ~_BREAKS & ~np.isin(np.arange(256), list(b" \t"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------ hashes and bitmaps
def _longer(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases prolonged by a word."""
    return mix(hashes * _STEP + word)


def _in_lang(hashes: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return mix(hashes ^ lang)


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, langs), np.uint64, len(langs))


def phrase_hashes(langs: list[str], phrases: list[bytes], width: int) -> np.ndarray:
    """Hashes of phrases of `width` words, each in its language."""
    words = span_hashes(words_in(phrases, _WORD)).reshape(-1, width)
    with np.errstate(over="ignore"):
        return _in_lang(functools.reduce(_longer, words.T), _lang_hashes(langs))


def bitmap(phrases: DataFrame, width: int) -> np.ndarray:
    """Bits of the hashes of (lang, phrase) as 64-bit words: a power of two, 16 for a phrase up to MAX_BITS."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (16 * phrases.count()).bit_length()))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([pa.array((hashes & np.uint64(bits - 1)).astype(np.int64))], ["slot"])

    made = phrases.select("lang", "phrase").mapInArrow(slots, "slot bigint")
    one = F.expr("shiftleft(1L, CAST(slot % 64 AS INT))")
    words = made.groupBy(F.expr("slot div 64").alias("at")).agg(F.bit_or(one).alias("word")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[np.asarray(words["at"])] = np.asarray(words["word"])
    return out.view(np.uint64)


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


# ------------------------------------------------------------ counting in a task
def chunk_phrases(texts: list[bytes | None], group: np.ndarray, langs: list[str], width: int, filters: list[np.ndarray | None]):
    """(group, phrase, occurrences) of the phrases of `width` words in a chunk; `group` is the group of each text,
    langs the language of each group. filters[k] is a bitmap that phrases of k + 1 words must pass, or None."""
    words = words_in(texts, _WORD)
    n_words = len(words.start)
    # A phrase lies in one piece: no break stands between its words.
    line = np.cumsum(_BREAKS[words.data], dtype=np.int32)[words.start]
    of = group[words.text]
    hashed = any(f is not None for f in filters)
    of_word, of_lang = span_hashes(words) if hashed else None, _lang_hashes(langs)
    place = np.arange(n_words, dtype=np.int32)  # where the phrases begin
    hashes, passed = of_word, None
    with np.errstate(over="ignore"):
        for k in range(width):
            if k:
                fits = place[place + k < n_words]
                follows = (line[fits] == line[fits + k]) & passed[fits + 1]  # its last k words must have passed as well
                place = fits[follows]
                hashes = _longer(hashes[: len(fits)][follows], of_word[place + k]) if hashed else None
            if filters[k] is not None:
                ok = _known(filters[k], _in_lang(hashes, of_lang[of[place]]))
                place, hashes = place[ok], hashes[ok]
            if k + 1 < width:
                passed = np.zeros(n_words + 1, bool)
                passed[place] = True
    if not len(place):
        return np.empty(0, np.int64), pa.array([], pa.large_string()), np.empty(0, np.int64)
    word, vocabulary = _numbered(words, place, width)
    found, n = _runs([of[place], *[word[place + k] for k in range(width)]], [len(langs), *[max(len(vocabulary), 1)] * width])
    text = [vocabulary.take(pa.array(f)) for f in found[1:]]
    phrase = text[0] if width == 1 else pc.binary_join_element_wise(*text, pa.scalar(" ", pa.large_string()))
    return found[0], phrase, n


def _numbered(words: Words, place: np.ndarray, width: int) -> tuple[np.ndarray, pa.Array]:
    """(number of each word that stands in a phrase beginning at `place`, the numbered words)."""
    used = np.zeros(len(words.start), bool)
    for k in range(width):
        used[place + k] = True
    length = words.end - words.start
    letters = np.ascontiguousarray(words.data[_WORD[words.data]])
    letters = letters if used.all() else letters[np.repeat(used, length)]
    offsets = np.concatenate([[0], np.cumsum(length[used])]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    numbers = np.zeros(len(words.start), np.int32)
    numbers[used] = np.asarray(terms.indices)
    return numbers, terms.dictionary


def _runs(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """(the distinct rows of columns of numbers below their sizes, how often each stands there)."""
    if np.prod([float(size) for size in sizes]) < 2.0**63:
        key = columns[0].astype(np.uint64)
        for column, size in zip(columns[1:], sizes[1:], strict=True):
            key = key * np.uint64(size) + column.astype(np.uint64)
        key = np.sort(key)
        edge = _edges(key[1:] != key[:-1])
        return _unpacked(key[edge], sizes), np.diff(np.append(edge, len(key)))
    order = np.lexsort(columns[::-1])  # too wide for one number
    rows = [c[order] for c in columns]
    edge = _edges(np.any([r[1:] != r[:-1] for r in rows], axis=0))
    return [r[edge] for r in rows], np.diff(np.append(edge, len(order)))


def _edges(changes: np.ndarray) -> np.ndarray:
    """Where runs begin, from the places at which a value differs from the one before (none of no rows)."""
    return np.flatnonzero(np.concatenate([[True], changes]))


def _unpacked(key: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    out = []
    for size in reversed(sizes[1:]):
        out.append((key % np.uint64(size)).astype(np.int64))
        key = key // np.uint64(size)
    return [key.astype(np.int64), *reversed(out)]


def _counts(width: int, filters: list[Broadcast | None], by_shard: bool, totals: bool = False):
    """Batches of (text, lang, shard) -> (lang, shard, phrase, n); without shards the shard is -1. `totals` adds
    the words of each (lang, shard) under the empty phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
        bits = [None if f is None else f.value for f in filters]
        for texts, rows in chunks(batches, limit=CHUNK_BYTES):
            lang, shard = rows.column("lang").to_pylist(), rows.column("shard").to_pylist()
            names = list(zip(lang, shard if by_shard else [-1] * len(lang), strict=True))
            groups = {name: i for i, name in enumerate(dict.fromkeys(names))}
            of_text = np.fromiter(map(groups.__getitem__, names), np.int64, len(names))
            of, phrase, n = chunk_phrases(texts, of_text, [g[0] for g in groups], width, bits)
            columns = [pa.array([g[i] for g in groups], schema.types[i]) for i in (0, 1)]
            yield from pieces([*[c.take(pa.array(of)) for c in columns], phrase, pa.array(n)], schema)
            if totals:
                every = list(zip(lang, shard, strict=True))
                sizes = np.bincount(words_in(texts, _WORD).text, minlength=len(texts)).tolist()
                yield from pieces([pa.array(lang), pa.array(shard, pa.int32()), pa.array([""] * len(every)), pa.array(sizes)], schema)

    return run


# ------------------------------------------------------------ the corpus
def _texts(docs: DataFrame, shards: int) -> DataFrame:
    text, lang = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(text.alias("text"), lang.alias("lang"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"))


def _counted(texts: DataFrame, *keys: str, **how) -> DataFrame:
    return texts.mapInArrow(_counts(**how), COUNTS).groupBy(*keys).agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n): words of each language; [(lang, phrase, n)] of 1, 2, ... words with n >= support), all stored."""
    spark, texts = docs.sparkSession, _texts(docs, shards)
    words = _counted(texts, "lang", "shard", "phrase", width=1, filters=[None], by_shard=False, totals=True)
    words = store(words.where((F.col("phrase") == "") | (F.col("n") >= support)), "words")
    sizes = words.where("phrase = ''").select("lang", "shard", F.col("n").alias("own"))
    totals = store(sizes.groupBy("lang").agg(F.sum("own").alias("n")), "lang_words")
    # The support lowered to the shard's share of the language's words, rounded up.
    raised = f"(CAST({support} AS DECIMAL(10,0)) * CAST(own AS DECIMAL(19,0)) + n - 1) div CAST(nullif(n, 0) AS DECIMAL(19,0))"
    local = store(sizes.join(totals, "lang").select("lang", "shard", F.expr(f"greatest(1L, {raised})").alias("least")), "local_support")
    found = [store(words.where("phrase <> ''").select("lang", "phrase", "n"), "phrases1")]
    discard(words)
    filters: list[Broadcast | None] = [spark.sparkContext.broadcast(bitmap(found[0], 1))]
    for width in range(2, longest + 1):
        mined = _counted(texts, "lang", "shard", "phrase", width=width, filters=[*filters, None], by_shard=True)
        mined = mined.join(small(local, BROADCAST_ROWS), ["lang", "shard"]).where("n >= least")
        candidates = store(mined.select("lang", "phrase").distinct(), f"candidates{width}")
        own = spark.sparkContext.broadcast(bitmap(candidates, width))
        exact = _counted(texts, "lang", "phrase", width=width, filters=[*filters, own], by_shard=False)
        found.append(store(exact.where(F.col("n") >= support).join(candidates, ["lang", "phrase"], "left_semi"), f"phrases{width}"))
        discard(candidates)
        if width < longest:
            filters.append(spark.sparkContext.broadcast(bitmap(found[-1], width)))
    discard(local)
    return totals, found


def scored_cuts(found: list[DataFrame], width: int) -> DataFrame:
    """(lang, phrase, a, k, l, r, score) of the cut with the lowest score of each phrase of `width` words."""
    word = F.split("phrase", " ")
    phrases = found[width - 1].select("lang", "phrase", F.col("n").alias("a"))
    for k in range(1, width):
        for side, size, start in (("l", k, 1), ("r", width - k, k + 1)):
            part = found[size - 1].select("lang", F.col("phrase").alias("_part"), F.col("n").alias(f"{side}{k}"))
            phrases = phrases.withColumn("_part", F.array_join(F.slice(word, start, size), " ")).join(part, ["lang", "_part"]).drop("_part")
    exact = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    score = lambda k: F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * ({exact('a')} * {exact('a')})) div ({exact(f'l{k}')} * {exact(f'r{k}')})")
    cuts = [F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, width)]
    least = F.array_min(F.array(*cuts))
    return phrases.select("lang", "phrase", "a", least.alias("cut")).select("lang", "phrase", "a", "cut.k", "cut.l", "cut.r", "cut.score")


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def covered(found: list[DataFrame], percent: int = 50) -> DataFrame:
    """(lang, phrase) of the phrases that lie inside a longer one with at least so many percent of their occurrences."""
    word, insides = F.split("phrase", " "), []
    for width in range(3, len(found) + 1):
        for size in range(2, width):
            parts = F.array_distinct(F.array(*[F.array_join(F.slice(word, start, size), " ") for start in range(1, width - size + 2)]))
            insides.append(found[width - 1].select("lang", F.explode(parts).alias("phrase"), F.col("n").alias("longer")))
    most = _union(insides or [found[0].where("false").withColumn("longer", F.col("n"))]).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return _union(found[1:]).join(most, ["lang", "phrase"]).where(F.expr(f"100 * longer >= {percent} * n")).select("lang", "phrase")


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the collocations of each language, best first.

    Null texts are empty, a null lang is `und`; every row is a document, repeated rows count each time. Ties rank
    by a (descending), then by phrase in byte order. A language without candidates has no rows. Counts up to
    10^15 are exact. Other columns are ignored.
    """
    totals, found = frequent_phrases(docs, support, shards)
    scored = _union([scored_cuts(found, width) for width in range(2, len(found) + 1)])
    left = scored.join(covered(found), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    made = store(
        ranked.join(small(totals, BROADCAST_ROWS), "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"),
        "collocations",
    )
    discard(totals, *found)
    return made
