"""Language identification by inference of a mixture of languages.

Training counts the byte trigrams of every labelled text by language, hashed into BINS bins.  A document is then taken
as a mixture: expectation-maximisation estimates the languages' proportions from the trigrams' likelihoods, and the set
of languages is the one of greatest likelihood less a penalty for each language beyond the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.shared import arrow_stage
from citeloom.llm.words import Block, blocks

BINS = 1 << 15
ROUNDS = 25
#: Penalty of a further language, in units of the logarithm of the number of trigrams; neighbouring trigrams overlap, so
#: it is more than the half of independent observations.
PENALTY = 4.0
UNKNOWN = "und"

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the trigrams whose middle byte is of a letter, and where each document's begin."""
    data = _LETTER[block.data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(len(block.at), np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    good = data[1:-1] != 32
    for inner in (1, 2):  # a trigram does not reach into the next document
        edge = block.at[1:-1] - inner
        good[edge[(edge >= 0) & (edge < len(good))]] = False
    pos = np.flatnonzero(good)
    return ((code[pos] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64), np.searchsorted(pos, block.at)


@dataclass
class LanguageModel:
    """The languages, in order, and the probability of each bin in each; of a size fixed by BINS and the languages."""

    languages: list[str]
    chance: np.ndarray  # (BINS, languages)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from all rows with a language; null texts count as empty."""
    types = pa.schema([("lang", pa.string()), ("bin", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            own = batch.column(1).to_pylist()
            names = {x: i for i, x in enumerate(dict.fromkeys(own))}
            number = np.array([names[x] for x in own])
            sums = np.zeros((len(names), BINS), np.int64)
            for block in blocks(batch.column(0)):
                bins, at = trigrams(block)
                rows = np.repeat(number[block.row : block.row + len(block)], np.diff(at))
                sums += np.bincount(rows * BINS + bins, minlength=sums.size).reshape(sums.shape)
            for name, i in names.items():
                totals[name] = totals.get(name, 0) + sums[i]
        for name, n in totals.items():
            bins = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(bins), pa.string()), pa.array(bins), pa.array(n[bins])], schema=types
            )

    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang IS NOT NULL")
    counts = labelled.mapInArrow(count, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").agg(F.collect_list("bin").alias("bins"), F.collect_list("n").alias("n"))
    rows = sorted(found.collect())  # one row a language, of at most BINS bins
    chance = np.full((BINS, len(rows)), 0.5)
    for k, (_, bins, n) in enumerate(rows):
        chance[bins, k] += n
    return LanguageModel([r[0] for r in rows], chance / chance.sum(axis=0))


def mixture(chance: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns of chance that explain the counts best, and the logarithm of their likelihood."""
    share = np.full(chance.shape[1], 1 / chance.shape[1])
    total = count.sum()
    for _ in range(ROUNDS if chance.shape[1] > 1 else 0):
        weighted = chance @ share
        new = share * ((count / weighted) @ chance) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(count @ np.log(chance @ share))


def language_set(chance: np.ndarray, count: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The columns chosen, their proportions, and the proportions over all columns."""
    full, _ = mixture(chance, count)
    order = np.argsort(-full, kind="stable")
    cost = penalty * np.log(count.sum() + 1)
    chosen, share, best = order[:1], np.ones(1), float(count @ np.log(chance[:, order[0]]))
    for k in range(2, len(order) + 1):
        trial, value = mixture(chance[:, order[:k]], count)
        if value - cost * (k - 1) <= best:
            break
        chosen, share, best = order[:k], trial, value - cost * (k - 1)
    return chosen, share, full


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode(errors="replace"))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, languages and their proportions.

    lang_pred is the language of the greatest proportion in the chosen set (of equal ones the first by name), score its
    proportion among all languages.  Texts that are null or have no letter, and all texts if nothing was learned, are
    `und` with score 0 and no languages.  A letter that gives no trigram is decided by the first language with score 0.
    Repeated rows come back each; other columns are not read.
    """
    types = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
        + [("languages", pa.list_(pa.string())), ("proportions", pa.list_(pa.float64()))]
    )
    names = model.languages

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in blocks(batch.column(1)):
            bins, at = trigrams(block)
            out: list[tuple] = []
            for i in range(len(block)):
                own = bins[at[i] : at[i + 1]]
                if not names or not _has_letter(block.data[block.at[i] : block.at[i + 1]].tobytes()):
                    out.append((UNKNOWN, 0.0, [], []))
                elif not len(own):
                    out.append((names[0], 0.0, [names[0]], [1.0]))
                else:
                    kinds, count = np.unique(own, return_counts=True)
                    chosen, share, full = language_set(model.chance[kinds], count)
                    top = int(np.argmax(share))
                    score = min(1.0, max(0.0, float(full[chosen[top]])))
                    out.append((names[chosen[top]], score, [names[c] for c in chosen], share.tolist()))
            columns = dict(zip(types.names[1:], zip(*out)))
            yield {"doc_id": batch.column(0).slice(block.row, len(block)), **columns}

    kind = "doc_id bigint, lang_pred string, score double, languages array<string>, proportions array<double>"
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return arrow_stage(source, step, kind, types)
