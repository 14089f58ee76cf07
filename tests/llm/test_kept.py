"""What workers keep of spans met before: right values, bounded, and no costly work for known parts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from citeloom.llm import byte_bpe, packing
from citeloom.llm.interning import Kept, pick
from citeloom.llm.words import blocks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def value(h):
    return np.arange(h % 7 if h % 50 else 5000, dtype="<u4") + h


def test_values_over_generations():
    kept, r, asked = Kept(40), np.random.default_rng(3), []
    for _ in range(60):
        hashes = r.choice(np.arange(200, dtype=np.uint64), 30, replace=False)

        def learn(new):
            own = [value(int(h)) for h in hashes[new]]
            asked.append(len(new))
            return np.concatenate([np.zeros(0, "<u4"), *own]), np.array([len(x) for x in own], np.int64)

        flat, begin, length = kept.values(hashes, learn)
        for h, a, n in zip(hashes.tolist(), begin, length):
            assert flat[a : a + n].tolist() == value(h).tolist()
        assert pick(flat, begin, length).tolist() == [x for h in hashes.tolist() for x in value(h).tolist()]
        for own in (kept.young, kept.old):
            assert len(own.hash) <= 70 and len(own.flat) <= 1000 and (np.diff(own.hash.astype(np.int64)) > 0).all()
    assert sum(asked) < 60 * 30
    empty = kept.values(np.zeros(0, np.uint64), learn)
    assert [len(x) for x in empty[1:]] == [0, 0]


def test_packing_learns_a_word_beside_signs_and_digits_once(monkeypatch):
    model = packing.Parts(WORDS)
    monkeypatch.setitem(packing._models, WORDS, model)
    seen, encode = [], model.encode
    monkeypatch.setattr(model, "encode", lambda texts: seen.extend(texts) or encode(texts))
    texts = ["Größe, größe. (größe) größe12", "größe; 21größe", "it's größe's"]
    for t in texts:
        got = [x for b in blocks(pa.array([t])) for x in packing.token_ids(WORDS, b)]
        own = Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids
        assert np.frombuffer(got[0], "<u4").tolist() == own
    assert seen.count("größe".encode()) == 1
    assert len(seen) == len(set(seen))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aZéß×÷Å'.,=<|_9 ̸́\n日…", max_size=40), min_size=1, max_size=5))
def test_packing_cuts_where_the_tokenizer_does(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    got = [x for b in blocks(pa.array(texts)) for x in packing.token_ids(WORDS, b)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_learns_a_word_beside_signs_once(monkeypatch):
    codec = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    seen, encode = [], codec.encode
    monkeypatch.setattr(codec, "encode", lambda chunks: seen.extend(chunks) or encode(chunks))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    for t in [" größenwahnig, größenwahnig.", "x größenwahnig! größenwahnig's größenwahnig…", "größéé×é"]:
        got = [x for b in blocks(pa.array([t])) for x in byte_bpe.encode_block(codec, b)]
        assert np.frombuffer(got[0], "<u4").tolist() == own.encode_ordinary(t)
    assert seen.count(" größenwahnig".encode()) == 1
    assert len(seen) == len(set(seen))


@pytest.mark.parametrize("count", [3])
def test_bpe_keeps_no_long_values(count):
    codec = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    text = " ".join("acgtbdfh"[i % 8] * 30_000 + "xq" * 4_000 * (1 + i) for i in range(count))
    for b in blocks(pa.array([text])):
        list(byte_bpe.encode_block(codec, b))
    assert len(codec.kept.young.flat) <= 4096 * count
