"""Language model, language identification and quality against plain versions and held-out rows."""

import math
from collections import Counter

import numpy as np
import pytest
from helpers import odd_texts, table, text, words

from citeloom.llm import kneser_ney, language_id, quality

SF = "/root/testdata/sf0.01"


def discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    if min(n) == 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0), k + 1) for k in range(3)]


class Plain:
    """Interpolated modified Kneser-Ney with counters."""

    def __init__(self, texts, order):
        self.order = order
        self.tables = [Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["<s>"] * (order - 1) + words(t, True) + ["</s>"]
            for i in range(order - 1, len(w)):
                self.tables[order][tuple(w[i - order + 1 : i + 1])] += 1
        self.words = Counter(x for t in texts for x in words(t, True) + ["</s>"])
        for k in range(order - 1, 0, -1):
            for gram in self.tables[k + 1]:
                self.tables[k][gram[1:]] += 1
        self.d = [discounts(t.values()) for t in self.tables]

    def p(self, context, word):
        if not context:
            table, total = self.tables[1], sum(self.tables[1].values())
            low = 1 / (len(self.words) + 1)
            own = {g: c for g, c in table.items()}
        else:
            own = {g: c for g, c in self.tables[len(context) + 1].items() if g[:-1] == context}
            total = sum(own.values())
            low = self.p(context[1:], word)
        if not total:
            return low
        d = self.d[len(context) + 1]
        left = sum(d[min(c, 3) - 1] for c in own.values())
        c = own.get((*context, word), 0)
        return (max(c - d[min(c, 3) - 1], 0) * (c > 0) + left * low) / total

    def score(self, t):
        w = ["<s>"] * (self.order - 1) + words(t, True) + ["</s>"]
        return sum(math.log10(self.p(tuple(w[i - self.order + 1 : i]), w[i])) for i in range(self.order - 1, len(w)))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_kneser_ney(spark, order):
    rows = [(i, text(i % 9, 5 + i)) for i in range(30)] + [(90, None), (91, "Unseen words and der1")]
    docs = table(spark, rows)
    learn = docs.where("doc_id < 25")
    model = kneser_ney.train(learn, order, shard_bytes=400)
    assert model.shards.number > 3
    plain = Plain([t for i, t in rows if i < 25], order)
    got = {r["doc_id"]: r for r in kneser_ney.score(docs, model).collect()}
    total, kinds = sum(plain.words.values()), len(plain.words)
    for i, t in rows:
        own = words(t, True) + ["</s>"]
        base = sum(math.log10((plain.words[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(own), sum(plain.words[w] > 0 for w in own))
        assert got[i]["train_tokens"] == total and got[i]["base_score"] == pytest.approx(base)
        assert got[i]["score"] == pytest.approx(plain.score(t), rel=1e-9), i
    # the probabilities of all words and an unknown one make 1
    context = tuple(words(rows[0][1], True)[: order - 1])
    assert sum(plain.p(context, w) for w in [*plain.words, "?"]) == pytest.approx(1)


def test_kneser_ney_hot_context_and_odd_rows(spark):
    docs = table(spark, [(i, " ".join(f"the w{i * 37 % 211 + j}" for j in range(40))) for i in range(12)])
    model = kneser_ney.train(docs, 2, shard_bytes=300)
    assert model.shards.hot  # a context of half of all words is spread over the shards
    plain = Plain([r["text"] for r in docs.collect()], 2)
    for r in kneser_ney.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r["score"] == pytest.approx(plain.score(r["text"]), rel=1e-9)
    odd = table(spark)
    assert kneser_ney.score(odd, model).count() == odd.count()
    none = kneser_ney.train(table(spark, []))
    scored = kneser_ney.score(odd, none).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in scored)
    assert kneser_ney.score(table(spark, []), model).count() == 0


def test_kneser_ney_registered_order_reads_two_words_of_context(spark):
    rows = [(i, text(i % 7, 20 + i)) for i in range(20)] + [(50, " ".join(words(text(3, 20), True)[::-1]))]
    docs = table(spark, rows)
    plain = Plain([t for _, t in rows], 3)
    for r in kneser_ney.score(docs, kneser_ney.train(docs)).collect():
        assert r["score"] == pytest.approx(plain.score(dict(rows)[r["doc_id"]]), rel=1e-9)


@pytest.mark.parametrize("k", [0, 1, 2])
def test_kneser_ney_blocks_come_back(k):
    r = np.random.default_rng(k)
    grams = kneser_ney.Grams(
        r.integers(0, 40, (3000, k)).astype(kneser_ney.U) << kneser_ney.U(50),
        r.integers(0, 400, 3000).astype(kneser_ney.U), r.integers(1, 300, 3000),
    ).merged()[0]
    parts = [kneser_ney.unpack_block(b) for _, b in grams.packed(kneser_ney.Shards(5))]
    again = kneser_ney.joined(parts).merged()[0]
    for name in ("before", "word", "count"):
        assert np.array_equal(getattr(again, name), getattr(grams, name))


def test_language_accuracy_and_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs.where("doc_id % 2 = 0"))
    held = docs.where("doc_id % 2 = 1")
    got = language_id.predict(held, model).join(held.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)
    long = {r["lang"]: r["text"] for r in held.where("n_chars > 1500").collect()}
    mixed = language_id.predict(table(spark, [(1, long["de"][:1500] + " " + long["fr"][:1500])]), model).first()
    assert sorted(mixed["languages"]) == ["de", "fr"] and min(mixed["proportions"]) > 0.3


def test_language_odd_rows(spark):
    docs = table(spark)
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    assert len(got) == len(odd_texts()) + 1
    for i, t in enumerate(odd_texts()):
        letters = any(c.isalpha() for c in t or "")
        assert (got[10 + 3 * i]["lang_pred"] == "und") == (not letters)
    none = language_id.predict(docs, language_id.train(table(spark, []))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert language_id.predict(table(spark, []), language_id.train(docs)).count() == 0


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 3 <> 0"))
    got = quality.with_quality(docs, model).select("row.doc_id", "score", "kept").join(labels.where("doc_id % 3 = 0"), "doc_id")
    got = got.collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15


def test_quality_odd_rows(spark):
    docs = table(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = quality.with_quality(docs, quality.train(docs, none))
    assert kept.where("kept").count() == docs.count() and kept.select("row.*").columns == docs.columns
    labels = spark.createDataFrame([(10 + 3 * (i % 21), i % 2, 0) for i in range(60)] + [(None, 1, 0), (13, None, 0)], none.schema)
    model = quality.train(docs, labels)
    assert quality.with_quality(docs, model).where("score BETWEEN 0 AND 1").count() == docs.count()
    assert quality.with_quality(docs.select("text"), model).count() == docs.count()
    assert quality.with_quality(table(spark, []), quality.train(table(spark, []), none)).count() == 0
