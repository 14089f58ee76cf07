"""Sets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from citeloom.llm.words import U, blocks, constants, mix, runs

WORDS = 5
_SALT = 101


def shingle_sets(texts: pa.Array, k: int = WORDS) -> Iterator[np.ndarray]:
    """Each document's distinct shingles as sorted 64-bit hashes.

    Words are runs of bytes other than space and \\t to \\r, with A-Z lower-cased.  A document of fewer than k words has
    one shingle, its whole sequence; without words or text it has none.
    """
    few = constants(k, _SALT + 1)
    for block in blocks(texts, lower=True):
        hashes, _, at = runs(block, k, _SALT)
        for i in range(len(block)):
            a, b = block.first[i], block.first[i + 1]
            if b - a >= k:
                yield np.unique(hashes[at[i] : at[i + 1]])
            elif b > a:
                yield mix((block.hash[a:b] * few[: b - a]).sum(dtype=U, keepdims=True) + U(b - a))
            else:
                yield np.zeros(0, U)
