"""Whole-text helpers on Arrow string columns.

Texts stay in Arrow's own byte buffers; words are found and hashed with numpy,
a block of documents at a time, so no Python string is made per word.  A block
holds whole documents: its size is bounded by ``BLOCK_BYTES`` or by one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text per block; one longer text is a block of its own.  A block's arrays are
#: some hundred times that: two workers an executor share its memory with Spark
BLOCK_BYTES = 1 << 19
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
#: word separators: space and U+0009..U+000D
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
#: a second sum, over the field of this prime: words whose sums agree modulo 2**64 for any odd base (Thue-Morse) differ here
_PRIME = (1 << 31) - 1
_FIELD_BASE = 0x5DEECE66 % _PRIME
_FIELD_BYTE = np.random.default_rng(20240301).integers(1, _PRIME, 256, dtype=np.uint64)
_FIELD_FOLDED = _FIELD_BYTE.copy()
_FIELD_FOLDED[65:91] = _FIELD_BYTE[97:123]
_field_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, base in ((0, _BASE), (1, _INVERSE)):
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            _powers[k] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def _near(x: np.ndarray) -> np.ndarray:
    """x modulo the prime or a little more (below 2**34), for x below 2**64."""
    return (x & U64(_PRIME)) + (x >> U64(31))


def _exact(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2**64."""
    x = _near(_near(x))
    return np.where(x >= U64(_PRIME), x - U64(_PRIME), x)


def _field_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo the prime for i < n."""
    for k, base in ((0, _FIELD_BASE), (1, pow(_FIELD_BASE, -1, _PRIME))):
        while len(_field_powers[k]) < n:
            have = _field_powers[k]
            _field_powers[k] = np.concatenate([have, _exact(have * U64(pow(base, len(have), _PRIME)))])
    return _field_powers[0][:n], _field_powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


class Block:
    """Words of some whole documents: ``first[i]:first[i + 1]`` are document i's
    words, ``start``/``end`` their byte places in ``raw`` and ``hash`` their keys."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, row: int, fold: bool, breaks: np.ndarray = SEPARATOR):
        self.row, self.n_docs = row, len(offsets) - 1
        at = offsets - offsets[0]
        self.raw, self.offsets, self.origin = raw[offsets[0]:offsets[-1]], at, int(offsets[0])
        solid = ~breaks[self.raw]
        n = len(solid)
        edge = np.zeros(n + 1, dtype=bool)
        edge[at] = True
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = solid[:-1]
        self.start = np.flatnonzero(solid & (~before | edge[:n]))
        after = np.empty(n, dtype=bool)
        after[:-1] = solid[1:]
        after[n - 1:] = False
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, at)
        self._table, self._field = (_FOLDED, _FIELD_FOLDED) if fold else (_BYTE, _FIELD_BYTE)

    @property
    def hash(self) -> np.ndarray:
        if not hasattr(self, "_hash"):
            self._hash = self.span_hash(self.start, self.end)
        return self._hash

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit keys of byte spans, alike for equal (folded) bytes."""
        n = len(self.raw) + 1
        if not hasattr(self, "_sums"):
            self._sums, self._field_sums = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
            np.cumsum(self._table[self.raw] * _power_tables(n)[0][:-1], out=self._sums[1:])
            np.cumsum(_near(self._field[self.raw] * _field_tables(n)[0][:-1]), out=self._field_sums[1:])
        wide = (self._sums[end] - self._sums[start]) * _power_tables(n)[1][start]
        field = _exact(_exact(self._field_sums[end] - self._field_sums[start]) * _field_tables(n)[1][start])
        return mix(wide + field * _BASE + (end - start).astype(np.uint64))

    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all k-word shingles and where each document's begin (one more
        than documents).  A document of 1 to k-1 words has one: all its words."""
        h, n = self.hash, np.diff(self.first)
        weight = [U64(int(mix(np.array([j + 1], dtype=np.uint64))[0]) | 1) for j in range(k)]
        m = max(0, len(h) - k + 1)
        g = np.zeros(m, dtype=np.uint64)
        for j in range(k):
            g += h[j:j + m] * weight[j]
        doc = self.word_doc()
        inside = np.flatnonzero(doc[:m] == doc[k - 1:k - 1 + m]) if m else np.zeros(0, np.int64)
        keys, owner = mix(g[inside]), doc[inside]
        few = np.flatnonzero((n > 0) & (n < k))
        if len(few):
            extra = np.array([int(mix(sum((h[self.first[i] + j:self.first[i] + j + 1] * weight[j] for j in range(n[i])),
                                          np.full(1, 7 * int(n[i]) + 1, dtype=np.uint64)))[0]) for i in few], dtype=np.uint64)
            keys, owner = np.concatenate([keys, extra]), np.concatenate([owner, few])
            order = np.argsort(owner, kind="stable")
            keys, owner = keys[order], owner[order]
        return keys, np.searchsorted(owner, np.arange(self.n_docs + 1))


def blocks(column: pa.Array, fold: bool = False, breaks: np.ndarray = SEPARATOR, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    raw, offsets = text_bytes(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield Block(raw, offsets[i:j + 1], i, fold, breaks)
        i = j
