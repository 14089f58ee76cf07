"""A large group of copies with many edits, most of them just too far apart to link."""

import random

import numpy as np
from helpers import table
from test_dedup import plain_components

from citeloom.llm import minhash_dedup


def copies(n=260, length=130, seed=3):
    """Copies of one text, each with some of the same few edits."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(length)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        own = list(base)
        for at in r.sample(range(5, length, 6), r.randrange(2, 7)):
            own[at] = f"edit{at}"
        out.append(" ".join(own))
    return sorted(set(out))


def test_pairs_that_cannot_link_are_not_compared(spark, monkeypatch):
    texts = copies()
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    counts, plain = [], minhash_dedup.compared

    def compared(pairs, full):
        pairs = pairs.localCheckpoint()
        counts.append((pairs.count(), plain(pairs, full).where("common * 100 >= all * 75").count()))
        return plain(pairs, full)

    monkeypatch.setattr(minhash_dedup, "compared", compared)
    docs = table(spark, list(enumerate(texts)))
    got = {r["id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == plain_components(list(range(len(texts))), links)
    pairs, found = counts[-1]
    assert pairs <= 2 * found, counts


def test_parities_bound_the_difference():
    r = np.random.default_rng(0)
    for n in (0, 1, 40, 300, 5000):
        a = r.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate((a[n // 3 :], r.integers(0, 2**63, 30).astype(np.uint64)))
        x, y = minhash_dedup.parities(a), minhash_dedup.parities(b)
        assert len(x) * 64 == minhash_dedup.BITS
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and (n > 300 or differ > 0)
