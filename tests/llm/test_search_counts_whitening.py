"""Ranked search, token counts and whitening against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ROOT, odd_texts, table

from citeloom.llm import lexical_search, token_counts, whitening
from citeloom.llm.words import blocks

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=20):
    own = [(key, Counter(terms(t))) for key, t in docs]
    own = [(key, c) for key, c in own if c]
    n_docs, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        found = []
        for key, c in own:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * n_docs) // total
            score = 0
            for t, q in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += q * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, key is None, key, score))
        found.sort(key=lambda f: f[:2] + (f[2] or 0,))
        out += [(item, i + 1, f[2], f[3]) for i, f in enumerate(found[:top])]
    return Counter(out)


@pytest.mark.parametrize("block, window", [(1 << 20, 4 << 20), (40, 64)])
def test_search(spark, monkeypatch, block, window):
    """Ties, repeated rows and ids, null and empty texts, odd characters, very long texts, many blocks of items."""
    monkeypatch.setattr(lexical_search._hits, "__defaults__", (window,))
    monkeypatch.setattr(lexical_search, "SCORES", 64)
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    texts = odd_texts() + ["a_b.C\x00d\x7fe", "größe GRÖSSE", "x" * 3000 + " y", "b a", "a b", "A-B", "日本語テキスト。テキスト"]
    rows = [(10 + 3 * i, t) for i, t in enumerate(texts)] + [(10 + 3 * 6, texts[6]), (None, "a b"), (None, "no id a")]
    items = [(1, "a b"), (1, "B a a"), (2, None), (3, ""), (4, " \x00"), (None, "größe c"), (5, texts[6]), (6, "x" * 3000), (7, "テキスト"), (8, "nowhere")]
    got = lexical_search.ranked_search(
        table(spark, rows), spark.createDataFrame([(k, t, "x", 1) for k, t in items], "item_id int, text string, doc_id string, rank int"),
        top=3, automaton_bytes=block,
    )
    assert dict(got.dtypes) == {"item_id": "int", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert Counter(map(tuple, got.collect())) == plain_search(rows, items, 3)
    none = table(spark, rows[:0])
    some = spark.createDataFrame(items, "item_id int, text string")
    assert lexical_search.ranked_search(none, some).count() == 0
    assert lexical_search.ranked_search(table(spark, rows), some.limit(0)).count() == 0


def test_terms_are_whole_and_blocks_bounded(spark):
    made = lexical_search.Terms.of(["b a b", "a"])
    assert made.terms == [b"b", b"a"] and made.at.tolist() == [0, 1, 3]
    assert made.item.tolist() == [0, 0, 1] and made.times.tolist() == [2, 1, 1]
    items = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([3, 3, 9, 50, 1])], "k int, t string").coalesce(1)
    sizes = [[len(t) for _, t in b] for b in lexical_search._item_blocks(items, 10)]
    assert sizes == [[3, 3], [9], [50], [1]]


def library_counts(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(e) for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts(spark):
    texts = odd_texts() + ["<|endoftext|> <|ENDOFTEXT|>", "it's 12'LL 3", "word " * 200_000, "ab12" * 50_000, "y" * 200_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(6, texts[6]), (None, "no id here")]
    got = token_counts.token_counts(table(spark, rows), public_tokenizers.path("word_bpe_49k.json"))
    want = [(k, len((t or "").encode()), n, n > 2048) for (k, t), n in zip(rows, library_counts([t for _, t in rows]))]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert token_counts.token_counts(table(spark, rows[:0]), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_counts_of_sentence_pieces(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(table(spark, rows), path).collect()}
    assert got == {i: len(model.encode(t or "", num_threads=1)) for i, t in rows}


def test_boundaries_are_safe():
    """Cut texts of awkward characters count as the whole ones; where nothing is known nothing is cut."""
    r = random.Random(5)
    signs = list("aZé0 9\t\n'’sStT<|>endoftext.,-!日本̸̧́Å가가ÀIİßς\xa0　\x1c\x0b²½٣") + ["<|endoftext|>", "<|startoftext|>", "'s", "'LL"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(50))) for _ in range(4000)]
    counter = token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"))
    assert counter.cuts and not token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json")).cuts
    got = [n for b in blocks(pa.array(texts), size=5000) for n in counter.counts(b).tolist()]
    assert got == library_counts(texts)


def plain_whitening(x, k=8):
    n = len(x)
    centred = x - x.sum(axis=0) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return centred @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def test_whitening(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    r = np.random.default_rng(3)
    good = (r.normal(size=(600, 12)) * np.arange(1, 13) @ r.normal(size=(12, 12))).astype(np.float32).tolist()
    good += [good[5]] * 40 + [[0.0] * 12]
    bad = [None, [], [None] + good[0][1:], [float("nan")] * 12, good[0][:-1] + [float("-inf")]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good + bad)] + [(None, good[0], "x", 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, x string, component int").repartition(5)
    got = whitening.whiten(df).collect()
    x = np.floor(1024 * np.array(good + good[:1], float)).astype(int) + 100_000
    n, sums = len(x), x.sum(axis=0)
    white, share = plain_whitening(x)
    ids = list(range(len(good))) + [None]
    assert {(g["vec_id"], g["component"]) for g in got} == {(i, c) for i in ids for c in range(1, 9)}
    assert {g["n"] for g in got} == {n} and len({g["identity_error"] for g in got}) == 1 and got[0]["identity_error"] < 1e-9
    deviation = {i: int(((n * a.astype(object) - sums) ** 2).sum()) for i, a in zip(ids, x)}
    assert all(g["deviation"] == deviation[g["vec_id"]] for g in got)
    mine = {(g["vec_id"], g["component"]): g for g in got}
    for c in range(8):
        own = np.array([mine[i, c + 1]["whitened"] for i in ids])
        assert np.allclose(own, np.sign(own @ white[:, c]) * white[:, c], atol=1e-9)
        assert math.isclose(mine[0, c + 1]["explained"], share[c], rel_tol=1e-9)


def test_whitening_of_little(spark):
    """Empty tables, one vector, equal ones, fewer dimensions than components, too large or unequal vectors."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    made = lambda rows: spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id int, embedding array<double>")
    for rows in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        assert whitening.whiten(made(rows)).count() == 0
    two = whitening.whiten(made([[1.0, 0.0], [-1.0, 0.0], [0.0, 3.0], [0.0, -3.0]])).collect()
    assert sorted({r["component"] for r in two}) == [1, 2] and two[0]["identity_error"] < 1e-9
    line = whitening.whiten(made([[1.0, 2.0], [2.0, 4.0], [4.0, 8.0]])).collect()
    assert {r["component"] for r in line} == {1} and math.isclose(line[0]["explained"], 1)
    for rows in ([[1.0], [1.0, 2.0]], [[1e300]]):
        with pytest.raises(Exception, match="differ in length|too large"):
            whitening.whiten(made(rows)).count()
    far = np.array([[2**41, 5], [0, 7]])
    assert whitening._deviations(far, 10**9, far.sum(axis=0)).to_pylist() == [None, None]
    assert whitening._deviations(far, 2, far.sum(axis=0)).to_pylist() == [None, None]


@pytest.mark.parametrize("seed", range(4))
def test_divide_and_conquer(seed):
    r = np.random.default_rng(seed)
    q, _ = np.linalg.qr(r.normal(size=(40, 40)))
    for values in (r.uniform(size=40), 10.0 ** -r.uniform(0, 12, 40), np.repeat([5.0, 3.0, 3.0, 1.0], 10), np.r_[np.ones(4), np.zeros(36)]):
        a = (q * values) @ q.T
        a = (a + a.T) / 2
        split = whitening._split(a)
        assert split and np.linalg.norm(split[0].T @ a @ split[1]) < 1e-12
        sign = whitening.polar_sign(a - (values.max() + values.min()) / 2.1 * np.eye(40))
        assert np.allclose(sign @ sign, np.eye(40), atol=1e-12)
        e, v = whitening.principal_components(a)
        assert np.allclose(e, np.sort(values)[::-1], atol=1e-13) and np.allclose(v.T @ v, np.eye(40), atol=1e-13)
        assert np.linalg.norm(a @ v - v * e) < 1e-12
