"""Words of a column of texts as numpy arrays: no Python object per word.

A word is a run of bytes other than the six of white space in ASCII; as no other character's UTF-8 holds those bytes, that
is the pattern [^\\x20\\x09-\\x0D]+ over code points. A word's hash depends on its bytes alone, on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 2 << 20
SPACES = b" \t\n\v\f\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _tables(lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and powers of an odd base and of its inverse, of a segment's length."""
    base = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93][lane]
    inverse = pow(base, -1, 1 << 64)
    per_byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
    powers = []
    for b in (base, inverse):
        p = np.full(CHUNK + 1, b, np.uint64)
        p[0] = 1
        powers.append(np.multiply.accumulate(p))
    return per_byte, *powers


@cache
def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


@cache
def _marks() -> np.ndarray:
    """Bytes between words of letters and digits: all of ASCII but 0-9 and a-z, to be asked for after lower-casing."""
    table = np.zeros(256, bool)
    for first, last in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
        table[first : last + 1] = True
    return table


@cache
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@dataclass
class Words:
    """Words of some rows. `data` holds the texts' bytes, `doc` each word's row, counted from `first`."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.rows)

    def hashes(self, lane: int = 0) -> np.ndarray:
        per_byte, powers, inverses = _tables(lane)
        out = np.empty(len(self.start), np.uint64)
        i = 0
        while i < len(self.start):
            at = self.start[i]
            j = int(np.searchsorted(self.end, at + CHUNK, "right"))
            if j == i:  # one word longer than a segment
                raw = self.data[at : self.end[i]].tobytes()
                out[i] = xxhash.xxh64_intdigest(raw, seed=lane)
                i += 1
                continue
            part = self.data[at : self.end[j - 1]]
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(per_byte[part] * powers[: len(part)], out=total[1:])
            a, b = self.start[i:j] - at, self.end[i:j] - at
            out[i:j] = (total[b] - total[a]) * inverses[a] + (b - a).astype(np.uint64)
            i = j
        return mix(out)

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return offsets, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def words(texts: pa.Array, lower: bool = False, chunk: int = CHUNK, alphanumeric: bool = False) -> Iterator[Words]:
    """Words of a column, NULL counting as no text, some rows at a time: about `chunk` bytes, a longer text alone.
    `alphanumeric`: words are lower-cased runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] instead."""
    lower = lower or alphanumeric
    between = _marks() if alphanumeric else _spaces()
    offsets, data = _buffers(texts)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk, "right")) - 1)
        to = min(to, len(texts))
        own = offsets[row : to + 1] - offsets[row]
        part = data[offsets[row] : offsets[to]]
        if lower:
            part = _lower()[part]
        inside = ~between[part]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = own[(own > 0) & (own < len(part))]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        doc = np.searchsorted(own, start, "right") - 1
        yield Words(row, to - row, part, own, start, end, doc)
        row = to


def windows(hashes: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of so many words within a document, and the index of each one's first word."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n].copy()
    for i in range(1, length):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += hashes[i : n + i]
    whole = doc[:n] == doc[length - 1 :]
    return mix(out)[whole], np.flatnonzero(whole)
