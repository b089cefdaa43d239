"""Words, hashes and shingles of whole Arrow batches in numpy, without a Python object per word.

A word is a run of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. In UTF-8 every byte of a
non-ASCII character is 128 or more, so words can be found byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 250_000
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_is_word = np.zeros(256, bool)
_is_word[48:58] = _is_word[97:123] = _is_word[128:] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit keys evenly (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base & _MASK))
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


class Words:
    """Words of consecutive texts: ``row``, ``start`` and ``end`` byte, 64-bit ``hash`` each; ``first`` word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.rows = len(offsets) - 1
        low = _lower[data]
        word = _is_word[low]
        new = np.zeros(len(data) + 1, bool)
        new[offsets] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0] = after[-1] = False
            before[1:] = word[:-1]
            after[:-1] = word[1:]
        self.start = np.flatnonzero(word & (~before | new[:-1]))
        self.end = np.flatnonzero(word & (~after | new[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))
        up, down = _power_table(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
        self.low, self._sums, self._down = low, sums, down
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the lower-cased bytes of each span."""
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def prefix_end(self, characters: int) -> np.ndarray:
        """End byte of each word's first characters (its own end if it has fewer)."""
        begins = np.append(np.flatnonzero((self.low & 0xC0) != 0x80), len(self.low))
        at = np.searchsorted(begins, self.start) + characters
        return np.minimum(begins[np.minimum(at, len(begins) - 1)], self.end)

    def text(self, i: int) -> str:
        return self.low[self.start[i]:self.end[i]].tobytes().decode("utf-8")

    def texts(self, begin: int, stop: int) -> list[str]:
        """Words ``begin`` to ``stop`` (exclusive)."""
        return [self.text(i) for i in range(begin, stop)]


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of each ``size`` consecutive words (rows are not regarded)."""
    n = max(len(hashes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + n]
    return mix(out + np.uint64(size))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word shingles of each row: row, hash, number of occurrences, sorted by row and hash.

    A text of fewer words is one shingle; a text without words has none.
    """
    counts = np.diff(words.first)
    full = runs(words.hash, size)
    keep = np.repeat(counts, counts)[:len(full)]
    place = np.arange(len(full)) - words.first[words.row[:len(full)]]
    ok = place + size <= keep
    rows, keys = words.row[:len(full)][ok], full[ok]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        parts = [runs(words.hash[words.first[r]:words.first[r + 1]], counts[r]) for r in short]
        rows, keys = np.concatenate([rows, short]), np.concatenate([keys, *parts])
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    return rows[at], keys[at], np.diff(np.append(at, len(rows)))
