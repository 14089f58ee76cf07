"""Document quality by co-training of two views.

One logistic classifier sees the text (shapes of characters, repetition of words), the other the metadata (language,
source, length).  Both begin with the labelled rows.  In each round every view labels the pool rows it is sure of for the
other view.  At the end each view is calibrated on labelled rows that it was not trained on, and a document's score
joins both views' calibrated odds.

The fit sees at most LABELLED labelled and POOL other rows, chosen by a hash of the id; the scores cover all rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.words import blocks

LABELLED = 20_000
POOL = 20_000
ROUNDS = 4
CONFIDENT = 0.97
ADDED = 2_000
KEEP = 0.5
RIDGE = 1.0
_HELD = 5
_BLOCK = 2_048

# classes of bytes: small and capital letters, digits, space, line end, full stop and comma, ! and ?, signs, the rest, not ASCII
_CLASS = np.full(256, 8, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9]], _CLASS[[10, 13]] = 0, 1, 2, 3, 4
_CLASS[[ord(c) for c in ".,;:"]], _CLASS[[ord(c) for c in "!?"]] = 5, 6
_CLASS[[ord(c) for c in "*#$%&|@^~=_+<>/\\{}[]"]], _CLASS[128:] = 7, 9
_KINDS = 10
TEXT_FEATURES = _KINDS * _KINDS + 4
_SOURCES, _LANGUAGES, _LENGTHS = 64, 16, 16
META_FEATURES = _SOURCES + _LANGUAGES + _LENGTHS


def text_features(texts: pa.Array) -> np.ndarray:
    """Roots of the frequencies of pairs of byte classes; word length, repeated words, words equal to the one before."""
    out = [np.zeros((0, TEXT_FEATURES), np.float32)]
    for block in blocks(texts, lower=False):
        n = len(block)
        size = np.diff(block.at)
        kind = _CLASS[block.data]
        doc = np.repeat(np.arange(n), size)
        pair = np.zeros((n, _KINDS * _KINDS))
        if len(kind) > 1:
            same = doc[1:] == doc[:-1]
            code = (doc[1:] * _KINDS + kind[:-1]) * _KINDS + kind[1:]
            pair = np.bincount(code[same], minlength=pair.size).reshape(pair.shape)
        words = np.diff(block.first)
        own = np.repeat(np.arange(n), words)
        letters = np.bincount(own, block.end - block.start, n)
        again = np.zeros(n)
        if len(own) > 1:
            again = np.bincount(own[1:][(block.hash[1:] == block.hash[:-1]) & (own[1:] == own[:-1])], minlength=n)
        kinds = np.array([len(np.unique(block.hash[a:b])) for a, b in zip(block.first[:-1], block.first[1:])])
        many = np.maximum(words, 1)
        rest = np.stack((letters / many / 8, 1 - kinds / many, again / many, np.log1p(words) / 8), axis=1)
        out.append(np.hstack((np.sqrt(pair / np.maximum(size, 1)[:, None]), rest)).astype(np.float32))
    return np.concatenate(out)


def meta_features(lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Language, source and size class, each as one of a few bins; null is a value of its own."""
    def bins(values: pa.Array, number: int) -> np.ndarray:
        values = values.to_pylist()
        code = {v: zlib.crc32(repr(v).encode()) % number for v in set(values)}
        return np.array([code[v] for v in values], np.int64)

    n = len(lang)
    size = np.array([-1 if v is None else v for v in n_chars.to_pylist()], np.float64)
    level = np.where(size < 0, 0, np.minimum(np.log2(np.maximum(size, 0) + 1).astype(np.int64) + 1, _LENGTHS - 1))
    out = np.zeros((n, META_FEATURES), np.float32)
    rows = np.arange(n)
    out[rows, bins(source, _SOURCES)] = 1
    out[rows, _SOURCES + bins(lang, _LANGUAGES)] = 1
    out[rows, _SOURCES + _LANGUAGES + level] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of a logistic regression with a bias at the end, by Newton's method."""
    w = np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(25):
        gradient = penalty * w
        hessian = np.diag(penalty) + 1e-9 * np.eye(len(w))
        for i in range(0, len(x), _BLOCK):  # only a block at a time in double precision
            part = np.ones((len(x[i : i + _BLOCK]), len(w)))
            part[:, :-1] = x[i : i + _BLOCK]
            p, own = _sigmoid(part @ w), weight[i : i + _BLOCK]
            gradient += part.T @ (own * (p - y[i : i + _BLOCK]))
            hessian += (part * (own * p * (1 - p))[:, None]).T @ part
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class QualityModel:
    """Weights of both views, their calibration (slope, shift) and the odds of good text; without labels all is kept."""

    text: np.ndarray
    meta: np.ndarray
    calibration: tuple[np.ndarray, np.ndarray]
    prior: float
    keep: float = KEEP

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        views = (_logit(text, self.text), _logit(meta, self.meta))
        odds = [a * v + b for v, (a, b) in zip(views, self.calibration)]
        return _sigmoid(odds[0] + odds[1] - self.prior)


def co_train(
    views: tuple[np.ndarray, np.ndarray], label: np.ndarray, pool: tuple[np.ndarray, np.ndarray], rounds: int = ROUNDS
) -> QualityModel:
    """Fit on labelled rows (0 or 1) and a pool without labels."""
    held = np.arange(len(label)) % _HELD == 0
    if len(np.unique(label[held])) < 2 or len(np.unique(label[~held])) < 2:
        good = 0.5 if not len(label) else (label.sum() + 0.5) / (len(label) + 1)
        flat = (np.zeros(2), np.zeros(2))
        odds = float(np.log(good / (1 - good)))
        none = tuple(np.array([0.0, odds]) for _ in flat)
        return QualityModel(np.zeros(TEXT_FEATURES + 1), np.zeros(META_FEATURES + 1), none, odds, 0.0)
    y = label[~held].astype(np.float64)
    given: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0)) for _ in views]

    def fit(view: int) -> np.ndarray:
        rows, own = given[view]
        x = np.concatenate((views[view][~held], pool[view][rows]))
        return fit_logistic(x, np.concatenate((y, own)), np.concatenate((np.ones(len(y)), np.full(len(own), 0.5))))

    def calibrate(view: int, w: np.ndarray) -> np.ndarray:
        x = _logit(views[view][held], w)[:, None]
        return fit_logistic(x, label[held].astype(np.float64), np.ones(len(x)), 0.1)

    weights = [fit(0), fit(1)]
    for _ in range(rounds):
        told = []
        for view in (0, 1):
            p = _sigmoid(_logit(_logit(pool[view], weights[view])[:, None], calibrate(view, weights[view])))
            sure = np.flatnonzero((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
            sure = sure[np.argsort(-np.abs(p[sure] - 0.5), kind="stable")][:ADDED]
            told.append((sure, (p[sure] >= 0.5).astype(np.float64)))
        given = [told[1], told[0]]
        weights = [fit(0), fit(1)]
    good = label.mean()
    calibration = (calibrate(0, weights[0]), calibrate(1, weights[1]))
    return QualityModel(weights[0], weights[1], calibration, float(np.log(good / (1 - good))))


def _column(docs: DataFrame, name: str, kind: str) -> Column:
    return F.col(f"`{name}`").cast(kind) if name in docs.columns else F.lit(None).cast(kind)


def _inputs(docs: DataFrame, text_col: str) -> list[Column]:
    names = (("lang", "string"), ("source", "string"), ("n_chars", "bigint"))
    return [F.col(f"`{text_col}`")] + [_column(docs, name, kind) for name, kind in names]


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    labelled: int = LABELLED, pool: int = POOL,
) -> QualityModel:
    """Fit from labels (doc_id, quality); of several labels of a document the lowest holds."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    spot = F.xxhash64("id")
    ids = docs.select(F.col(id_col).cast("bigint").alias("id")).where("id IS NOT NULL").distinct()
    marked = ids.join(known.withColumnRenamed("doc_id", "id"), "id", "left")
    some = marked.where("quality IS NOT NULL").orderBy(spot, "id").limit(labelled)
    more = marked.where("quality IS NULL").orderBy(spot, "id").limit(pool)
    chosen = F.broadcast(some.unionByName(more).withColumnRenamed("id", "chosen"))  # at most labelled + pool rows
    names = ("text", "lang", "source", "n_chars")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), *(c.alias(n) for c, n in zip(_inputs(docs, text_col), names)))
    rows = rows.join(chosen, F.col("id") == F.col("chosen"))

    def features(batches):
        for b in batches:
            both = np.hstack((text_features(b.column(1)), meta_features(*b.columns[2:5]))).astype(np.float32)
            found = [b.column(0), b.column(5), pa.array([x.tobytes() for x in both], pa.binary())]
            yield pa.RecordBatch.from_arrays(found, names=["id", "quality", "x"])

    got = rows.select("id", *names, F.col("quality").cast("int").alias("quality")).mapInArrow(
        features, "id bigint, quality int, x binary"
    )
    got = got.groupBy("id").agg(F.min("quality").alias("quality"), F.min("x").alias("x"))  # a repeated id counts once
    # as Arrow, copied batch by batch into its place: rows of Python would be several times as large
    table = got.toArrow()
    ids = table.column("id").to_pylist()
    order = np.array(sorted(range(len(ids)), key=lambda i: (zlib.crc32(str(ids[i]).encode()), ids[i])), np.int64)
    quality = np.array([-1 if q is None else q for q in table.column("quality").to_pylist()], np.int64)[order]
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    x = np.empty((len(ids), TEXT_FEATURES + META_FEATURES), np.float32)
    at = 0
    for chunk in table.column("x").chunks:
        found = np.frombuffer(b"".join(chunk.to_pylist()), np.float32)
        x[place[at : at + len(chunk)]] = found.reshape(len(chunk), x.shape[1])
        at += len(chunk)
    own = quality >= 0
    known_x, pool_x = x[own], x[~own]
    del table, x
    split = TEXT_FEATURES
    return co_train(
        (known_x[:, :split], known_x[:, split:]), quality[own], (pool_x[:, :split], pool_x[:, split:])
    )


def scorer(model: QualityModel) -> Callable[..., Column]:
    @F.arrow_udf("double")
    def score(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        return pa.array(model.score(text_features(text), meta_features(lang, source, n_chars)), pa.float64())

    return score


def with_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """row (all columns of docs), score (the chance of good text, 0 to 1) and kept.

    Null text counts as empty, missing metadata columns as null.  Without labels of both kinds all rows are kept.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    scored = docs.select(row, scorer(model)(*_inputs(docs, text_col)).alias("score"))
    return scored.withColumn("kept", F.col("score") >= model.keep)
