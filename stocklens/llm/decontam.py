"""Benchmark decontamination with a distributed positional index, in DataFrame operations only.

Every window (10 consecutive words of a test item) is a phrase. One pass over the corpus counts the
words that phrases use; a second stores the postings (text key, position) of each phrase's two
rarest terms. A phrase's occurrences are the rarest term's list, shifted by its offset and
intersected with the shifted list of the next rarest; what survives is compared in full with the text.

Texts are keyed by a 128-bit hash, so copies of a text are indexed and matched once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import discard, store

WINDOW = 10
#: Keys of texts to compare in full are broadcast up to this count (16 bytes each), else joined.
BROADCAST_KEYS = 300_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_KEY = ["h1", "h2"]


def words_of(text: str | Column) -> Column:
    """Words: digits, a-z (A-Z folded) and all non-ASCII characters; null has none."""
    folded = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    parts = F.split(folded, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.filter(parts, lambda w: w != "")


def with_text_key(docs: DataFrame) -> DataFrame:
    """docs with (h1, h2), a 128-bit hash of the text."""
    return docs.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


def _keyed(docs: DataFrame) -> DataFrame:
    return with_text_key(docs.select("doc_id", "text"))


def phrases_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, phrase): each item's windows; an item of fewer words is one window. Null ids are left out."""
    words = items.where("item_id is not null").select("item_id", words_of("text").alias("w")).where("size(w) > 0")
    last = F.greatest(F.size("w") - window, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, window))
    return words.select("item_id", F.explode(windows).alias("phrase")).distinct()


def term_frequencies(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences in the corpus of the terms in `vocabulary`, counted before any shuffle."""
    return docs.select(F.explode(words_of("text")).alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count("*").alias("n"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The index: (term, h1, h2, pos) of the given terms in each distinct text."""
    placed = _keyed(docs).select(*_KEY, F.posexplode(words_of("text")).alias("pos", "term"))
    return placed.join(terms, "term").select("term", *_KEY, "pos").distinct()


def proximity_matches(index: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """Texts (h1, h2, pos, other) where `second` stands at most `within` words from `first`.

    Positions are cut into cells of `within` words, so only neighbouring cells are joined."""
    cell = F.floor(F.col("pos") / F.lit(within))
    a = index.where(F.col("term") == first).select(*_KEY, "pos", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    b = index.where(F.col("term") == second).select(*_KEY, F.col("pos").alias("other"), cell.alias("cell"))
    near = (F.abs(F.col("pos") - F.col("other")) <= within) & (F.col("pos") != F.col("other"))
    return a.join(b, [*_KEY, "cell"]).where(near).select(*_KEY, "pos", "other")


def phrase_matches(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Exact occurrences (h1, h2, start, pid, len) of the phrases (pid, phrase); stored."""
    terms = phrases.select("pid", F.posexplode("phrase").alias("offset", "term"))
    vocabulary = store(terms.select("term").distinct(), "vocabulary")
    frequency = store(term_frequencies(docs, vocabulary), "frequency")
    # A phrase with a term that the corpus lacks cannot occur.
    ranked = terms.join(frequency, "term").groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("by_n"))
    ranked = ranked.join(phrases, "pid").where("size(by_n) = size(phrase)")
    second = F.element_at("by_n", F.least(F.size("by_n"), F.lit(2)))
    anchors = ranked.select(
        "pid", F.size("phrase").alias("len"), F.col("by_n")[0]["term"].alias("t1"), F.col("by_n")[0]["offset"].alias("o1"),
        second["term"].alias("t2"), second["offset"].alias("o2"),
    )
    anchors = store(anchors, "anchors")
    used = store(anchors.select(F.col("t1").alias("term")).union(anchors.select("t2")).distinct(), "terms")
    index = store(postings(docs, used), "postings")

    at = index.join(anchors, index["term"] == anchors["t1"]).select(*_KEY, (F.col("pos") - F.col("o1")).alias("start"), "pid", "len", "t2", "o2")
    at = at.where("start >= 0").withColumn("pos", F.col("start") + F.col("o2")).withColumnRenamed("t2", "term")
    both = at.join(index, [*_KEY, "pos", "term"]).select(*_KEY, "start", "pid", "len")
    both = store(both, "intersected")

    keys = store(both.select(_KEY).distinct(), "keys")
    texts = _keyed(docs)
    texts = texts.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, _KEY, "left_semi").dropDuplicates(_KEY)
    starts = both.groupBy(_KEY).agg(F.collect_list(F.struct("start", "pid", "len")).alias("starts"))
    read = texts.select(*_KEY, words_of("text").alias("w")).join(starts, _KEY)
    found = F.transform("starts", lambda s: F.struct(s["start"].alias("start"), s["pid"].alias("pid"), F.slice("w", s["start"] + 1, s["len"]).alias("phrase")))
    found = read.select(*_KEY, F.explode(found).alias("f")).select(*_KEY, "f.start", "f.pid", "f.phrase")
    matches = store(found.join(phrases, ["pid", "phrase"]).select(*_KEY, "start", "pid", F.size("phrase").alias("len")), "matches")
    discard(vocabulary, frequency, anchors, used, index, both, keys)
    return matches


def contaminated_texts(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h1, h2, n_hit, items) of every distinct text in which a window of an item occurs; stored."""
    of_items = store(phrases_of(items, window), "item_phrases")
    phrases = store(of_items.select("phrase").distinct().withColumn("pid", F.monotonically_increasing_id()), "phrases")
    matches = phrase_matches(docs, phrases)
    places = matches.select(*_KEY, F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos")).distinct()
    hit = places.groupBy(_KEY).agg(F.count("*").alias("n_hit"))
    ids = of_items.join(phrases, "phrase").select("pid", F.col("item_id").cast("string").alias("item"))
    named = matches.select(*_KEY, "pid").distinct().join(ids, "pid").groupBy(_KEY).agg(F.array_sort(F.collect_set("item")).alias("items"))
    return store(hit.join(named, _KEY), "summary")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit (words inside any occurrence of an item's window), n_items,
    items_sha256 (of the item_ids sorted as strings, comma-joined; of the empty string if none), contaminated.

    Null and empty texts have no words. Items without words match nothing, repeated items and rows count
    once each, rows with a null item_id take no part, null doc_ids are kept. Other columns are ignored.
    """
    summary = contaminated_texts(docs, items, window)
    rows = _keyed(docs).select("doc_id", *_KEY, F.size(words_of("text")).cast("bigint").alias("n_words")).join(summary, _KEY, "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
