"""Token counts by greedy longest match in linear time, without building the pieces.

A trie of the vocabulary gets failure links: where no edge continues a partial match, the link
leads to the state after the pieces that greedy matching would pop there, and each state
stores how many those are. Counting reads every byte once and adds the popped counts.
"""

from __future__ import annotations

import base64
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import CACHE_WORDS, map_batches


class LongestMatch:
    """`count(word)`: number of greedy longest-match pieces, or -1 if some part matches no piece."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        self.edges: list[dict[int, int]] = [{}]
        self.is_piece = [False]
        for piece in vocabulary:
            at = 0
            for byte in piece:
                to = self.edges[at].get(byte)
                if to is None:
                    to = len(self.edges)
                    self.edges[at][byte] = to
                    self.edges.append({})
                    self.is_piece.append(False)
                at = to
            self.is_piece[at] = at != 0
        self._link()

    def _link(self) -> None:
        """Breadth first: a piece pops itself; other states pop what their parent's state would."""
        n = len(self.edges)
        self.fail, self.popped = [-1] * n, [0] * n
        level = [0]
        while level:
            below = []
            for state in level:
                for byte, child in self.edges[state].items():
                    below.append(child)
                    if self.is_piece[child]:
                        self.fail[child], self.popped[child] = 0, 1
                        continue
                    pops, to = self.popped[state], self.fail[state]
                    while to >= 0 and byte not in self.edges[to]:
                        pops += self.popped[to]
                        to = self.fail[to]
                    if to >= 0:
                        self.fail[child], self.popped[child] = self.edges[to][byte], pops
            level = below

    def count(self, word: bytes) -> int:
        state = total = 0
        edges, fail, popped = self.edges, self.fail, self.popped
        for byte in word:
            while (to := edges[state].get(byte)) is None:
                if fail[state] < 0:
                    return -1
                total += popped[state]
                state = fail[state]
            state = to
        while state:
            if fail[state] < 0:
                return -1
            total += popped[state]
            state = fail[state]
        return total


class WordCounts(dict):
    def __init__(self, automaton: LongestMatch) -> None:
        super().__init__()
        self._automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self._automaton.count(b" " + word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = n
        return n


@functools.cache
def _word_counts(vocabulary_path: str) -> WordCounts:
    with open(vocabulary_path, "rb") as lines:
        return WordCounts(LongestMatch([base64.b64decode(line.split()[0]) for line in lines if line.strip()]))


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per row: doc_id, n_words, n_tokens: pieces of every word with a space before it, by greedy longest match.

    Words are runs of bytes other than ASCII white space. `vocabulary_path` is a file of
    base64 pieces on every executor. A word that no pieces cover counts as one token. Null and
    empty texts have none; null ids, repeated rows and other columns make no difference.
    """

    def run(rows: dict[str, list]) -> dict[str, list]:
        counts = _word_counts(vocabulary_path)
        n_words, n_tokens = [], []
        for text in rows["text"]:
            words = (text or "").encode().split()
            n_words.append(len(words))
            n_tokens.append(sum(map(abs, map(counts.__getitem__, words))))
        return {"doc_id": rows["doc_id"], "n_words": n_words, "n_tokens": n_tokens}

    id_type = dict(docs.dtypes)["doc_id"]
    return map_batches(docs.select("doc_id", F.col("text")), run, f"doc_id {id_type}, n_words bigint, n_tokens bigint")
