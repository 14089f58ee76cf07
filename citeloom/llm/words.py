"""Words of Arrow text columns, found and hashed with numpy.

A hash of a span of bytes is a polynomial over random byte values modulo 2**64, mixed: equal spans have equal hashes,
different ones the same with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
BLOCK_BYTES = 2 << 20
_KIND = np.zeros(256, np.int8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[39] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, salt: int) -> np.ndarray:
    """n odd 64-bit numbers, the same everywhere."""
    return mix(np.arange(1, n + 1, dtype=U) * U(BASE) + U(salt)) | U(1)


_BYTE = constants(256, 11)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            step = np.full(size, base, U)
            step[0] = 1
            _powers[k] = np.cumprod(step)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, U)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


@dataclass
class Block:
    """Some documents: their bytes, where each begins, their words and where each document's words begin."""

    row: int
    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    _hash: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.at) - 1

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hashes(self.data, self.start, self.end)
        return self._hash


def kinds(data: np.ndarray) -> np.ndarray:
    """1 for bytes of letters of Latin-1, 2 for ASCII digits, 3 for ASCII signs; 0 for white space, apostrophes and all else."""
    kind = _KIND[data]
    after = data[1:]
    letter = np.flatnonzero((data[:-1] == 0xC3) & (after != 0x97) & (after != 0xB7))
    kind[letter] = kind[letter + 1] = 1
    return kind


def find_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    space = SPACE[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:] = space[:-1]
    after[:-1] = space[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    start = np.flatnonzero(before & ~space)
    end = np.flatnonzero(after & ~space) + 1
    return start, end, np.searchsorted(start, at)


def blocks(texts: pa.Array, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of whole documents of about size bytes (a longer document is a block of its own); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, where, body = texts.buffers()
    at = np.frombuffer(where, np.int64)[texts.offset : texts.offset + n + 1]
    body = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        data = body[at[row] : at[last]]
        own = at[row : last + 1] - at[row]
        data = LOWER[data] if lower else data
        yield Block(row, data, own, *find_words(data, own))
        row = last


def runs(block: Block, k: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of k words: the hash, the index of its first word, and where each document's runs begin."""
    h, n = block.hash, len(block.hash)
    m = max(0, n - k + 1)
    total = np.zeros(m, U)
    for j, c in enumerate(constants(k, salt)):
        total += h[j : j + m] * c
    good = np.ones(m, bool)
    for j in range(1, k):
        last = block.first[1:] - j
        last = last[(last >= block.first[:-1]) & (last < m)]
        good[last] = False
    pos = np.flatnonzero(good)
    return mix(total[pos]), pos, np.searchsorted(pos, block.first)
