"""Text quality: logistic regression on hashed word n-grams, fitted by follow-the-regularised-leader.

Features, all hashed to one weight vector: words without their punctuation, pairs of them, and triples
of word shapes (punctuation around the word, capitals, whether it repeats the word before, whether its
3-gram stands elsewhere in the text). A feature's value is the square root of its
share, so texts of any length are comparable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm.common import CACHE_WORDS, ROWS_AT_ONCE, map_batches, mix, table, window_hashes, word_hashes
from stocklens.llm.labelled import held_out, labelled_sample, sigmoid

BITS = 18
#: Labelled documents that the classifier is fitted on, at most.
TRAIN_ROWS = 5_000
EPOCHS = 3
FOLD, HELD = 3, 1


class WordParts:
    """Hashes of the letters (folded) and of the shape of words, kept for words seen before."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._hashes = np.zeros((0, 2), np.uint64)

    def lookup(self, words: list[str]) -> np.ndarray:
        """Two hashes per word."""
        fresh = list({w for w in words if w not in self._index})
        if fresh:
            if len(self._index) + len(fresh) > CACHE_WORDS:
                self._clear()
                fresh = list(set(words))
            at = len(self._index)
            self._index.update(zip(fresh, range(at, at + len(fresh)), strict=True))
            self._hashes = np.concatenate([self._hashes, np.array([_parts(w) for w in fresh], np.uint64)])
        return self._hashes[np.fromiter(map(self._index.__getitem__, words), np.int64, len(words))]


def _parts(word: str) -> tuple[int, int]:
    core = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    at = word.find(core) if core else 0
    around = word if not core else f"{word[:at][:3]}_{word[at + len(core) :][:3]}"
    shape = f"{around}{'A' if len(core) > 1 and core.isupper() else 'a' if core else ''}"
    return xxhash.xxh3_64_intdigest(core.lower()), xxhash.xxh3_64_intdigest(shape)


_PARTS = WordParts()
#: Texts are looked up together up to so many words.
GROUP_WORDS = 50_000


def vectors(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse vectors (indices, values) of whole texts; null and empty ones have no features."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    group: list[list[str]] = []
    for i, text in enumerate(texts):
        group.append((text or "").split())
        if sum(map(len, group)) >= GROUP_WORDS or i == len(texts) - 1:
            found = _PARTS.lookup([w for words in group for w in words])
            at = np.cumsum([0, *map(len, group)])
            out += [features(found[low:high]) for low, high in zip(at[:-1], at[1:], strict=True)]
            group = []
    return out


def features(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse vector of one text from the hashes of its words."""
    n_words = len(parts)
    if not n_words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    core, shape = parts[:, 0], parts[:, 1]
    same = np.zeros(n_words, np.uint64)
    same[1:] = core[1:] == core[:-1]
    again = np.zeros(n_words, np.uint64)
    if n_words >= 3:
        _, back, n = np.unique(window_hashes(core, 3), return_inverse=True, return_counts=True)
        again[: len(back)] = n[back] > 1
    with np.errstate(over="ignore"):
        marked = mix(shape + same * np.uint64(11) + again * np.uint64(101))
    indices, values = [], []
    for kind, grams in enumerate((mix(core), window_hashes(core, 2), marked, window_hashes(marked, 3))):
        if len(grams):
            with np.errstate(over="ignore"):
                at, n = np.unique(mix(grams + np.uint64(kind + 1)) >> np.uint64(64 - BITS), return_counts=True)
            indices.append(at.astype(np.int32))
            values.append(np.sqrt(n / len(grams)).astype(np.float32))
    return np.concatenate(indices), np.concatenate(values)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01) -> np.ndarray:
    """Weights (the last one is the intercept) by per-coordinate follow-the-regularised-leader updates."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[i]) <= l1, 0.0, (np.sign(z[i]) * l1 - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            at, x, y = rows[k]
            at = np.append(at, size - 1)
            x = np.append(x, 1.0)
            w = weights(at)
            g = np.bincount(np.arange(len(at)), (sigmoid(w @ x) - y) * x)
            np.add.at(z, at, g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w)
            np.add.at(n, at, g * g)
    return weights(slice(None)).astype(np.float32)


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Fit on at most `train_rows` labelled documents outside the held-out fold; features are made on
    the executors, and only they come to the driver. Without labels, every score is 0.5."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        made = vectors(rows["text"])
        return {"doc_id": rows["doc_id"], "y": rows["y"], "at": [a.tobytes() for a, _ in made], "x": [x.tobytes() for _, x in made]}

    sample = labelled_sample(docs, labels, "quality", FOLD, HELD, train_rows)
    id_type = dict(docs.dtypes)["doc_id"]
    made = map_batches(sample.select("doc_id", "text", F.col("y").cast("double").alias("y")), run, f"doc_id {id_type}, y double, at binary, x binary")
    got = made.orderBy(F.xxhash64("doc_id"), F.xxhash64("at")).limit(train_rows).collect()
    return fit_ftrl([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32), r["y"]) for r in got])


def score_quality(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from its whole text (null as empty)."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": _scores(rows["text"], sent.value)}

    id_type = dict(docs.dtypes)["doc_id"]
    scored = map_batches(docs.select("doc_id", held_out(FOLD, HELD).alias("held_out"), "text"), run, f"doc_id {id_type}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _scores(texts: list[str | None], w: np.ndarray) -> np.ndarray:
    return sigmoid(np.array([w[-1] + w[at] @ x for at, x in vectors(texts)], float))


def accepted(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of docs, all columns, whose text scores at least 0.5."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            slices = [texts.iloc[at : at + ROWS_AT_ONCE].tolist() for at in range(0, len(texts), ROWS_AT_ONCE)]
            yield pd.Series(np.concatenate([np.empty(0), *[_scores(own, sent.value) for own in slices]]))

    return docs.where(score("text") >= 0.5)


def quality_weights(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """Fitted on the labelled documents of the folder, which a filtered table may lack."""
    return fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
