"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Only the histogram of piece lengths (at most `capacity` numbers, whatever the corpus size)
reaches the driver. There, patterns of two or three lengths that fill a sequence exactly are
enumerated, their repeat counts are fitted to the histogram by non-negative least squares,
rounded, and what is left over is packed best fit, longest length first. The plan says which
ranks of each length go where; pieces are then ranked within their length on the executors.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm.common import map_batches, store
from stocklens.llm.subwords import of_json

CAPACITY = 2048
#: The id that ends every document.
END_ID = 0
#: Pieces of one length are ranked in buckets of about so many.
BUCKET_ROWS = 2_000
#: Chunks of text whose ids a worker keeps.
CACHE_CHUNKS = 100_000
NNLS_STEPS = 200


# ------------------------------------------------------------------ tokenising
class ChunkIds(dict):
    """Chunk of text -> its ids as little-endian unsigned 32-bit bytes.

    The byte-level pre-tokeniser never joins what stands on both sides of a single space, so
    a text without doubled spaces is the concatenation of its chunks, each with the space before it. Chunks
    seen for the first time are encoded many in one call; other texts, and those
    that hold the text of a special token, go to the tokenizer whole.
    """

    def __init__(self, tokenizer_path: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._pieces = of_json(tokenizer_path, pattern)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]

    def _learn(self, chunks: list[str]) -> None:
        ids, begins = self._pieces.flat(chunks)
        raw = ids.astype("<u4").tobytes()
        at = [*(4 * begins).tolist(), len(raw)]
        self.update(zip(chunks, (raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        chunked: list[list[str]] = []
        for text in texts:
            whole = "  " in text or any(s in text for s in self._special)
            chunked.append([] if whole else (" " + text).replace(" ", "\0 ").split("\0")[1:] if "\0" not in text else [])
        if len(self) > CACHE_CHUNKS:
            self.clear()
        if new := [c for c in set().union(*chunked) if c not in self]:
            self._learn(new)
        out = []
        for text, chunks in zip(texts, chunked, strict=True):
            if len(chunks) > 1:
                first = self._pieces.encode(chunks[0][1:]).astype("<u4").tobytes()  # no space before the first
                out.append(first + b"".join(map(self.__getitem__, chunks[1:])))
            else:
                out.append(np.asarray(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
        return out


@functools.cache
def _chunk_ids(path: str, pattern: str) -> ChunkIds:
    return ChunkIds(path, pattern)


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first of several may be shorter."""
    if n_ids <= capacity:
        return [(0, n_ids)]
    first = n_ids % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n_ids, capacity))]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, if asked for)."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        end = np.asarray([END_ID], "<u4").tobytes()
        texts = [t or "" for t in rows["text"]]
        for at in range(0, len(texts), 256):
            part = zip(rows["doc_id"][at : at + 256], _chunk_ids(tokenizer_path, pattern).encode(texts[at : at + 256]), strict=True)
            for doc_id, raw in part:
                raw += end
                for piece, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    own = raw[4 * start : 4 * (start + length)]
                    for name, value in zip(out, (doc_id, piece, start, length, zlib.crc32(own)), strict=False):
                        out[name].append(value)
                    if with_ids:
                        out["ids"].append(np.frombuffer(own, "<u4").astype(np.int64))
        return out

    id_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return map_batches(docs.select("doc_id", "text"), run, schema + (", ids array<bigint>" if with_ids else ""))


# -------------------------------------------------------------------- the plan
def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All patterns of two or three of the lengths that fill the capacity; rows of three, 0 for none."""
    present = np.zeros(capacity + 1, bool)
    present[lengths] = True
    pairs = [(a, capacity - a, 0) for a in lengths if 2 * a >= capacity and a < capacity and present[capacity - a]]
    found = [np.array(pairs, np.int64).reshape(-1, 3)]
    for a in lengths[3 * lengths >= capacity]:
        b = lengths[lengths <= a]
        c = capacity - a - b
        b, c = b[(c > 0) & (c <= b)], c[(c > 0) & (c <= b)]
        b, c = b[present[c]], c[present[c]]
        found.append(np.stack([np.full(len(b), a), b, c], 1))
    return np.concatenate(found)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = NNLS_STEPS) -> np.ndarray:
    """Non-negative least squares of sum(repeats x pattern) against the histogram, by accelerated
    projected gradients (the pattern matrix is never written out)."""
    used = (patterns > 0).astype(float)

    def counts(x: np.ndarray) -> np.ndarray:
        out = np.bincount(patterns.ravel(), (used * x[:, None]).ravel(), len(histogram))
        out[0] = 0
        return out

    def back(y: np.ndarray) -> np.ndarray:
        return (y[patterns] * used).sum(1)

    v = np.ones(len(patterns))
    for _ in range(10):  # the largest eigenvalue bounds the step
        v = back(counts(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.05 * norm)
    target = histogram.astype(float)
    target[0] = 0
    x = z = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, z - step * back(counts(z) - target))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins as ([(length, times in the bin), ...], number of such bins), covering the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    bins: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        bins.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    lengths = np.nonzero(left)[0]
    patterns = exact_patterns(lengths, capacity)
    if len(patterns):
        repeats = np.rint(fit_repeats(patterns, left)).astype(np.int64)
        for i in np.argsort(-repeats, kind="stable"):
            if repeats[i] <= 0:
                break
            own, times = np.unique(patterns[i][patterns[i] > 0], return_counts=True)
            n = int(min(repeats[i], (left[own] // times).min()))
            if n > 0:
                left[own] -= n * times
                bins.append(([(int(a), int(b)) for a, b in zip(own[::-1], times[::-1], strict=True)], n))
    present = sorted(int(x) for x in np.nonzero(left)[0])
    while present:  # what rounding left over: best fit, longest first
        room, content = capacity, []
        at = len(present) - 1
        while at >= 0 and room:
            length = present[at]
            if times := min(room // length, int(left[length])):
                content.append((length, times))
                room -= times * length
            at -= 1
            while at >= 0 and present[at] > room:
                at -= 1
        n = min(int(left[length]) // times for length, times in content)
        for length, times in content:
            left[length] -= n * times
        bins.append((content, n))
        present = [x for x in present if left[x]]
    return bins


def slots(bins: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """Runs of places: ranks from `rank` on of `length` go to sequences from `sequence` on, at `offset`."""
    taken: dict[int, int] = {}
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0
    for content, n in bins:
        offset = 0
        for length, times in content:
            for _ in range(times):
                rank = taken.get(length, 0)
                rows.append((length, rank, sequence, offset))
                taken[length] = rank + n
                offset += length
        sequence += n
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), cols, strict=True))


_RANK_BITS = 48


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece its sequence_id and offset. `pieces` is stored first: several passes read it."""
    spark = pieces.sparkSession
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[row["length"]] = row["count"]
    places = slots(plan(histogram, capacity))
    sent = spark.sparkContext.broadcast(((places["length"] << _RANK_BITS) + places["rank"], places))

    n_buckets = max(1, -(-int(histogram.max()) // BUCKET_ROWS))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, ["length", "_bucket"])

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length, rank):  # noqa: ANN001, ANN202
        import pandas as pd

        keys, runs = sent.value
        rank = rank.to_numpy(np.int64)
        at = np.searchsorted(keys, (length.to_numpy(np.int64) << _RANK_BITS) + rank, side="right") - 1
        return pd.DataFrame({"sequence_id": runs["sequence"][at] + rank - runs["rank"][at], "offset": runs["offset"][at]})

    placed = ranked.withColumn("_place", place(F.col("length"), F.col("_rank") + F.col("_before")))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack the documents (doc_id, text) into sequences of at most `capacity` ids of the tokenizer in
    `tokenizer_path`, a byte-level BPE that splits texts by `pattern`.

    Null and empty texts are the one id that ends a document; null doc_ids and repeated rows
    are packed as rows of their own; other columns are ignored; an empty table gives no rows.
    """
    return pack(store(tokenized_pieces(docs, tokenizer_path, pattern, capacity, with_ids), "pieces"), capacity)
