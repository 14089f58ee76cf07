"""Pieces of several megabytes, and the contraction of long pieces against tiktoken."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from citeloom.llm import byte_bpe
from citeloom.llm.words import blocks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.mark.parametrize("letters, size", [("=", 3_000_000), ("acgt", 2_500_000), ("abcdeinrstlü", 60_000), (" ", 2_000_000)])
def test_long_pieces(letters, size):
    r = random.Random(size)
    codec = byte_bpe.encoder(RANKS, PATTERN)
    text = "".join(r.choices(letters, k=size))
    ids = b"".join(byte_bpe.encode_block(codec, next(iter(blocks(pa.array([text]), size=1 << 30)))))
    got = np.frombuffer(ids, "<u4")
    names = {rank: token for token, rank in codec.ranks.items()}
    assert b"".join([names[i] for i in got.tolist()]) == text.encode()
    if size <= 60_000:
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
        assert got.tolist() == own.encode_ordinary(text)


@pytest.mark.parametrize("letters", ["=", "acgt", "abcdeinrstlü ", " \t", "0123456789"])
def test_heap_contracts_like_the_query(letters):
    r = random.Random(7)
    codec = byte_bpe.encoder(RANKS, PATTERN)
    words = ["".join(r.choices(letters, k=k)).encode() for k in (2, 3, 65, 400)]
    assert [codec._contract_long(w) for w in words] == codec._contract(words)
