"""Subword ids of many words at once."""

from __future__ import annotations

import base64
import functools
import json

import numpy as np


class Subwords:
    """Byte-level pieces with their ranks as ids: whole runs of words are encoded in one call
    and cut again where a piece begins with a space."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import tiktoken

        self.size = max(ranks.values()) + 1
        self._encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._starts = np.zeros(self.size, bool)
        for piece, rank in ranks.items():
            self._starts[rank] = piece.startswith(b" ")

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(text), np.int64)

    def flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, each with the space that begins it, and where each word's ids begin.
        Words begin with a space and hold no other."""
        ids, begins, done = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            own = self.encode("".join(part))
            begin = np.nonzero(self._starts[own])[0]
            if len(begin) != len(part) or begin[0]:  # white space that ran together: one by one
                each = [self.encode(w) for w in part]
                own = np.concatenate(each)
                begin = np.cumsum([0, *[len(e) for e in each[:-1]]])
            ids.append(own)
            begins.append(begin + done)
            done += len(own)
        return np.concatenate(ids), np.concatenate(begins)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 bytes for themselves,
    the others, in order, for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.cache
def of_json(path: str, pattern: str) -> Subwords:
    """From a tokenizers file of a byte-level BPE whose ids follow its merges."""
    letters = _byte_letters()
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    ranks = {bytes(letters[c] for c in piece): rank for piece, rank in vocab.items() if all(c in letters for c in piece)}
    return Subwords(ranks, pattern)


@functools.cache
def of_ranks(path: str, pattern: str) -> Subwords:
    """From lines of base64 pieces and ranks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return Subwords(ranks, pattern)
