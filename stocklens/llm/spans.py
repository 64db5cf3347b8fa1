"""Removing word runs that occur more than once in a corpus.

`repeated_spans` removes every word covered by a window of `window` words that starts anywhere
else. Windows are found in two exact steps. Every window holds a minimizer (the smallest hash
of its 8-word runs), and equal windows have equal minimizers, so windows whose minimizer
occurs once in the corpus cannot repeat; only the others are compared as whole windows.

`remove_reference` streams documents against suffix automata of reference shards; see its docstring.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import as_long, discard, map_batches, small, split_words, store, window_hashes, word_hashes

WINDOW = 35
#: Words of the runs among which a window's minimizer is chosen.
SEED_WORDS = 8
#: Ids are broadcast up to this count (a few numbers each), else joined by shuffle.
BROADCAST_IDS = 500_000


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each run of `width` elements, by doubling."""
    span = 1
    while 2 * span <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def minimizers(hashes: np.ndarray, window: int = WINDOW, seed: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the seeds that are the smallest of some window (ties count all)."""
    seeds = window_hashes(hashes, seed)
    span = window - seed + 1
    if len(seeds) < span:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = sliding(seeds, span, np.minimum)
    pad = np.zeros(span - 1, np.uint64)
    chosen = np.nonzero(sliding(np.concatenate([pad, least, pad]), span, np.maximum) == seeds)[0]
    return chosen, seeds[chosen]


def covered(n_words: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Mask of the words within `width` of a start."""
    return _within(n_words, starts, starts + width - 1)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _marks(docs: DataFrame, window: int, id_type: str) -> DataFrame:
    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("n_words", "kept_sha256", "at", "seed")}
        for text in rows["text"]:
            words = split_words(text, lower=False)
            at, seeds = minimizers(word_hashes(words), window)
            out["n_words"].append(len(words))
            out["kept_sha256"].append(_sha(words))
            out["at"].append(at.astype(np.int32))
            out["seed"].append(as_long(seeds))
        return out | {c: rows[c] for c in ("doc_id", *_KEY)}

    schema = f"doc_id {id_type}, h1 bigint, h2 bigint, n_words bigint, kept_sha256 string, at array<int>, seed array<bigint>"
    return map_batches(docs.select("doc_id", "text", *_KEY), run, schema)


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """Hashes of the windows that hold one of the positions in `at`."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"start": [], "window": []}
        for text, at in zip(rows["text"], rows["at"], strict=True):
            hashes = window_hashes(word_hashes(split_words(text, lower=False)), window)
            # A window holds a seed if it starts at most window - SEED_WORDS words before it.
            first = np.asarray(at, np.int64) - (window - SEED_WORDS)
            starts = np.nonzero(_within(len(hashes), first, np.asarray(at, np.int64)))[0]
            out["start"].append(starts.astype(np.int32))
            out["window"].append(as_long(hashes[starts]))
        return out | {"rid": rows["rid"], "copies": rows["copies"]}

    schema = "rid bigint, copies bigint, start array<int>, window array<bigint>"
    return map_batches(docs.select("rid", "copies", "text", "at"), run, schema)


def _within(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.clip(first, 0, n), 1)
    np.add.at(edge, np.clip(last + 1, 0, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _repeating(keyed: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once, a row counting `copies` times. Counts are combined before
    their shuffle, and the join back is one that Spark splits where a key is frequent."""
    often = keyed.groupBy(key).agg(F.sum("copies").alias("n")).where("n > 1").select(key)
    return keyed.join(often, key)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256.

    Words are runs of non-white-space, unchanged. Null and empty texts have none; documents shorter
    than a window keep everything; a row repeating another (same doc_id and text, null ids
    included) counts as another occurrence. Other columns are ignored.
    """
    marks, cut = _find_and_cut(docs, window)
    changed = cut.select(*_KEY, "n_removed", F.col("kept_sha256").alias("left_sha256"))
    rows = marks.select("doc_id", *_KEY, "n_words", "kept_sha256").join(changed, _KEY, "left")
    # Texts without a repeated window keep all their words, as hashed in the first pass.
    return rows.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("left_sha256", "kept_sha256").alias("kept_sha256"))


def without_repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs with all their columns; in texts that hold a repeated window, what is left of the
    words, joined by one space. Other texts stay as they are."""
    _, cut = _find_and_cut(docs, window)
    changed = cut.select(*[F.col(c).alias(f"_{c}") for c in (*_KEY, "text")])
    h1, h2 = _text_key()
    rows = docs.join(changed, (h1 == F.col("_h1")) & (h2 == F.col("_h2")), "left")
    text = F.when(F.col("_h1").isNotNull(), F.col("_text")).otherwise(F.col("text"))
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns])


_KEY = ["h1", "h2"]


def _text_key() -> tuple[F.Column, F.Column]:
    """A 128-bit hash of the text."""
    return F.xxhash64("text"), F.xxhash64(F.lit(1), "text")


def _find_and_cut(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """First-pass marks of all rows, and the distinct texts with repeated windows, cut; both stored.

    Copies of a text are searched once, and count as many times as they are."""
    id_type = dict(docs.dtypes)["doc_id"]
    h1, h2 = _text_key()
    docs = docs.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"))
    marks = store(_marks(docs, window, id_type).withColumn("rid", F.monotonically_increasing_id()), "marks")
    texts = marks.where(F.col("n_words") >= window).groupBy(*_KEY).agg(F.count("*").alias("copies"), F.min("rid").alias("rid"))
    texts = store(texts, "texts")
    seeds = marks.select("rid", F.explode(F.arrays_zip("at", "seed")).alias("m")).select("rid", "m.at", "m.seed")
    seeds = seeds.join(small(texts.select("rid", "copies"), BROADCAST_IDS), "rid")
    own = store(_repeating(seeds, "seed").groupBy("rid").agg(F.collect_set("at").alias("at")).join(texts, "rid"), "own")
    texts_of = docs.join(small(own.select(_KEY), BROADCAST_IDS), _KEY, "left_semi").select(*_KEY, "text").dropDuplicates(_KEY)
    doubted = store(texts_of.join(own, _KEY), "doubted")
    windows = store(_windows(doubted, window), "windows")
    starts = windows.select("rid", "copies", F.explode(F.arrays_zip("start", "window")).alias("w")).select("rid", "copies", "w.start", "w.window")
    found = _repeating(starts, "window").groupBy("rid").agg(F.collect_set("start").alias("starts"))
    cut = store(_cut(doubted.drop("at").join(found, "rid"), window), "cut")
    discard(texts, own, doubted, windows)
    return marks, cut


def _cut(docs: DataFrame, window: int) -> DataFrame:
    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("n_words", "n_removed", "kept_sha256", "text")}
        for text, starts in zip(rows["text"], rows["starts"], strict=True):
            words = split_words(text, lower=False)
            gone = covered(len(words), np.asarray(starts, np.int64), window)
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(_sha(kept))
            out["text"].append(b" ".join(kept).decode())
        return out | {c: rows[c] for c in _KEY}

    schema = "h1 bigint, h2 bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string"
    return map_batches(docs.select(*_KEY, "text", "starts"), run, schema)


class SuffixAutomaton:
    """All substrings of the added word sequences (integers); states hold the longest length."""

    def __init__(self) -> None:
        self.link, self.length, self.next = array("q", [-1]), array("q", [0]), [{}]

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:  # already there, from an earlier sequence
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        new = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def matching(self, sequence: list[int]) -> np.ndarray:
        """For each position, the length of the longest match that ends there."""
        state = size = 0
        out = np.zeros(len(sequence), np.int64)
        for i, c in enumerate(sequence):
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if (to := self.next[state].get(c)) is not None:
                state, size = to, size + 1
            else:
                state = size = 0
            out[i] = size
        return out


def automaton_of(texts: list[str | None]) -> SuffixAutomaton:
    automaton = SuffixAutomaton()
    for text in texts:
        automaton.add(word_hashes(split_words(text, lower=False)).tolist())
    return automaton


def remove_reference(docs: DataFrame, reference: DataFrame, min_words: int = WINDOW, shard_words: int = 200_000) -> DataFrame:
    """Per document (doc_id, text): the words left after removing every maximal span of at least
    `min_words` words that also stands in a text of `reference` (column text).

    The reference is cut into shards of about `shard_words` words (a text is never cut); one pass over the
    documents per shard broadcasts the shard's suffix automaton, so this is for a reference that
    is small beside the corpus. Documents stream through it: where the longest match ending at
    a word reaches `min_words`, the match is marked. Null texts stay null; nothing is dropped.
    """
    spark = docs.sparkSession
    id_type = dict(docs.dtypes)["doc_id"]
    sized = reference.select("text", F.size(F.split(F.coalesce("text", F.lit("")), "\\s+")).alias("n"))
    total = sized.agg(F.sum("n")).first()[0] or 0
    n_shards = max(1, -(-total // shard_words))
    shards = store(sized.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(n_shards))), "reference")
    marked = store(docs.select("doc_id", "text").withColumn("rid", F.monotonically_increasing_id()), "reference_docs")
    hits = spark.createDataFrame([], "rid bigint, last array<int>, size array<int>")
    for shard in range(n_shards):
        sent = spark.sparkContext.broadcast([r["text"] for r in shards.where(F.col("shard") == shard).select("text").toLocalIterator()])
        hits = hits.unionByName(_stream(marked, sent, min_words))
    spans = hits.select("rid", F.explode(F.arrays_zip("last", "size")).alias("s")).select("rid", "s.last", "s.size")
    spans = spans.groupBy("rid").agg(F.collect_set(F.struct("last", "size")).alias("spans"))

    def cut(rows: dict[str, list]) -> dict[str, list]:
        texts = []
        for text, found in zip(rows["text"], rows["spans"], strict=True):
            words = split_words(text, lower=False)
            last = np.array([s["last"] for s in found or []], np.int64)
            gone = _within(len(words), last + 1 - np.array([s["size"] for s in found or []], np.int64), last)
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode()
            texts.append(kept if found else text)
        return {"doc_id": rows["doc_id"], "text": texts}

    return map_batches(marked.join(spans, "rid", "left").select("doc_id", "text", "spans"), cut, f"doc_id {id_type}, text string")


def _stream(docs: DataFrame, sent: object, min_words: int) -> DataFrame:
    built: list[SuffixAutomaton] = []

    def run(rows: dict[str, list]) -> dict[str, list]:
        if not built:
            built.append(automaton_of(sent.value))
        last, size = [], []
        for text in rows["text"]:
            matches = built[0].matching(word_hashes(split_words(text, lower=False)).tolist())
            at = np.nonzero(matches >= min_words)[0]
            last.append(at.astype(np.int32))
            size.append(matches[at].astype(np.int32))
        return {"rid": rows["rid"], "last": last, "size": size}

    return map_batches(docs.select("rid", "text"), run, "rid bigint, last array<int>, size array<int>")
