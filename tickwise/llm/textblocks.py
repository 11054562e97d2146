"""Helpers shared by the operators that read texts in Arrow batches.

A batch is cut into blocks of whole rows of about ``BLOCK_BYTES`` bytes, so
the numpy arrays of a task stay small whatever the batch size is. A text
longer than that makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20

# ASCII lower-casing, and the bytes that make up a word: 0-9, A-Z, a-z and
# every byte of a non-ASCII character.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True

_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_powers = np.cumprod(np.full(256, _MULT, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(max(n, 2 * len(_powers)), _MULT, dtype=np.uint64))
    return _powers


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, kind)
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values, offsets.astype(np.int64)


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``size`` bytes, at least one row each."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


class Words:
    """Words of the rows of one block.

    ``start``/``end``: byte positions in the block; ``row``: the word's row in
    the block; ``first``: for each row the index of its first word (one more
    entry than rows); ``low``: the lower-cased bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        base = int(offsets[0])
        offs = offsets - base
        self.low = LOWER[data[base:int(offsets[-1])]]
        self.offsets = offs
        m = IS_WORD[self.low]
        n = len(m)
        begin, stop = m.copy(), m.copy()
        begin[1:] &= ~m[:-1]
        stop[:-1] &= ~m[1:]
        edge = offs[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        begin[edge] = m[edge]
        stop[edge - 1] = m[edge - 1]
        self.is_word = m
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offs)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each lower-cased word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        codes = BYTE_CODES[self.low]
        codes[~self.is_word] = 0
        step = np.ones(len(self.low), np.int32)
        step[:self.start[0]] = 0
        step[self.start[0]] = 0
        step[self.start[1:]] = 1 - np.diff(self.start)
        at = np.cumsum(step, dtype=np.int32)  # byte's place in its word (gaps go on counting)
        at[~self.is_word] = 0
        codes *= powers(int(length.max()) + 1)[at]
        return mix(np.add.reduceat(codes, self.start) + length.astype(np.uint64) * _MULT)
