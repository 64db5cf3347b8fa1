"""Words of many texts at once: a table of 256 entries marks the bytes of words, its edges are their spans.

ASCII classes decide alone: every byte of a non-ASCII character is 0x80 or more and belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from stocklens.llm.common import mix

#: Text bytes that a task looks at together; a longer text is looked at alone.
CHUNK_BYTES = 6 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.arange(256)
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
#: Bytes of letters: A-Z, a-z and every non-ASCII character.
LETTERS = _LETTER & (_BYTES < 128) | (_BYTES >= 128)
_LOWER = np.where(_LETTER & (_BYTES < 97), _BYTES + 32, _BYTES).astype(np.uint8)
_LOWER[128:] = _BYTES[128:]
_KEEP = np.array([0, *((1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9))], np.uint64)
#: Longer words are hashed one by one.
LONG = 64


@dataclass
class Words:
    """The words of some texts in order: data[start:end] is a word (A-Z folded), `text` the text it stands in."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def words_in(texts: list[bytes | None], word_bytes: np.ndarray) -> Words:
    """All maximal runs of `word_bytes`; null and empty texts have none. Texts stand one line feed apart, which
    must not be a word byte."""
    raw = b"\n".join([b"", *[t or b"" for t in texts], b""])
    data = np.frombuffer(raw, np.uint8)
    inside = word_bytes[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[::2].copy(), edges[1::2].copy()
    ends = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts)))
    return Words(_LOWER[data], start, end, np.searchsorted(ends, start - 1, side="right").astype(np.int32))


def packed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each start as a big-endian 64-bit number, zeros from `end` on."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    every = np.ndarray((len(padded) - 7,), ">u8", buffer=padded, strides=(1,))
    return every[np.minimum(start, len(data))].astype(np.uint64) & _KEEP[np.clip(end - start, 0, 8)]


def span_hashes(words: Words) -> np.ndarray:
    """64-bit hashes of all words, from their packed bytes."""
    length = words.end - words.start
    with np.errstate(over="ignore"):
        out = mix(packed(words.data, words.start, words.end) + length.astype(np.uint64))
        for offset in range(8, LONG, 8):
            at = np.flatnonzero(length > offset)
            if not len(at):
                return out
            out[at] = mix(out[at] * _STEP + packed(words.data, words.start[at] + offset, words.end[at]))
    for i in np.flatnonzero(length > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words.data[words.start[i] : words.end[i]].tobytes())
    return out


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[list[bytes | None], pa.Table]]:
    """The rows of a task in chunks of about so many text bytes: (texts as UTF-8, the other columns)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = np.array(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        at = 0
        while at < batch.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), limit - size, side="right")
            room = max(int(room), 0 if held else 1)
            if room:
                held.append(batch.slice(at, room))
                size += int(lengths[at : at + room].sum())
                at += room
            if at < batch.num_rows:
                yield _chunk(held, text)
                held, size = [], 0
    if held:
        yield _chunk(held, text)


def _chunk(held: list[pa.RecordBatch], text: str) -> tuple[list[bytes | None], pa.Table]:
    rows = pa.Table.from_batches(held)
    return rows.column(text).cast(pa.binary()).to_pylist(), rows.drop_columns([text])


def pieces(columns: list[pa.Array], schema: pa.Schema, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """A result of many rows as batches that the receiving side can hold."""
    made = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    for at in range(0, made.num_rows, rows):
        yield made.slice(at, rows)
