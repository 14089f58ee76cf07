"""Exact, near and substring duplicates against plain versions."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import edited, odd_texts, table, text, words

from citeloom.llm import minhash_dedup, substring_dedup
from citeloom.llm.exact_dedup import exact_dedup, misra_gries
from citeloom.llm.graph import components
from citeloom.llm.shingles import shingle_sets


def plain_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (300, 200), (300, 300)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    want = plain_components({x for e in chain for x in e}, chain)
    assert got == {n: c for n, c in want.items()}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_misra_gries_keeps_what_is_frequent():
    counts, rows = {}, ["hot"] * 400 + [f"k{i}" for i in range(1000)]
    for i in range(0, len(rows), 100):
        for k in rows[i : i + 100]:
            counts[k] = counts.get(k, 0) + 1
        counts = misra_gries(counts, 4)
    assert len(counts) <= 4 and "hot" in counts


@pytest.mark.parametrize("counters", [2, 1024])
def test_exact(spark, counters):
    docs = table(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    same = defaultdict(list)
    for i, t in rows:
        same[(t or "").encode().lower()].append(i)
    got = sorted((r["id"] or -1, r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in exact_dedup(docs, counters=counters).collect())
    want = []
    for i, t in rows:
        own = same[(t or "").encode().lower()]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i or -1, keep, len(own), i == keep, hashlib.sha256((t or "").encode().lower()).digest()))
    assert got == sorted(want, key=lambda x: (x[0], x[4]))
    assert exact_dedup(table(spark, [])).count() == 0


def plain_shingles(t):
    w = words(t, lower=True)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near(spark):
    base = text(50, 150)
    rows = [(10 + 3 * i, t) for i, t in enumerate(odd_texts())]
    rows += [(1000 + i, edited(base, 12 + 9 * i)) for i in range(12)] + [(2000, base), (28, odd_texts()[6]), (None, "no id")]
    got = {r["id"]: r for r in minhash_dedup.near_duplicates(table(spark, rows)).collect()}
    sets = {i: plain_shingles(t) for i, t in rows}
    known = [i for i in sets if i is not None]
    links = [
        (a, b) for a in known for b in known
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    assert len(links) > 10
    want = plain_components(known, links)
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items() if i is not None} == want
    assert all(r["kept"] == (i is None or want[i] == i) for i, r in got.items())
    assert minhash_dedup.near_duplicates(table(spark, rows)).count() == len(rows)
    assert minhash_dedup.near_duplicates(table(spark, [])).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t é", max_size=60) | st.none(), max_size=8))
def test_shingle_counts(texts):
    got = [len(s) for s in shingle_sets(pa.array(texts, pa.string()))]
    assert got == [len(plain_shingles(t)) for t in texts]


def test_rare_prefixes_find_every_pair(spark):
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 60, 60)
    sets = []
    for i in range(40):
        own = base.copy()
        own[r.random(60) < 0.02 * (i % 12)] = r.integers(0, 1 << 60)
        sets.append(np.unique(own.astype(np.uint64)))
    df = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "id bigint, shingles binary")
    prefix = defaultdict(set)
    for row in minhash_dedup.rare_prefixes(df, 75).collect():
        prefix[row["id"]].add(row["shingle"])
    for a in range(40):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                assert prefix[a] & prefix[b] or (sets[a].tolist() == sets[b].tolist())


def plain_removed(rows, window):
    all_words = [words(t) for _, t in rows]
    starts = Counter(tuple(w[i : i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, all_words):
        gone = {j for s in range(len(w) - window + 1) if starts[tuple(w[s : s + window])] > 1 for j in range(s, s + window)}
        out.append((-1 if i is None else i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out)


@pytest.mark.parametrize("hot", [20_000, 0])
@pytest.mark.parametrize("window", [35, 9])
def test_substrings(spark, monkeypatch, hot, window):
    monkeypatch.setattr(substring_dedup, "HOT_STRINGS", hot)
    rows = [(10 + 3 * i, t) for i, t in enumerate(odd_texts()[:19] + odd_texts()[20:])] + [(28, odd_texts()[6]), (None, text(9, 50))]
    rows += [(500 + i, f"{i} " * 40 + text(60, 45) + f" end{i}") for i in range(5)]
    got = substring_dedup.remove_repeated(table(spark, rows), window).collect()
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3]) for r in got) == plain_removed(rows, window)
    assert substring_dedup.remove_repeated(table(spark, [])).count() == 0
