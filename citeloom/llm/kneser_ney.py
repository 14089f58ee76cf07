"""Interpolated modified Kneser-Ney models, counted in Spark and kept as sorted hash arrays that workers map.

Counting.  A first pass counts the words, a second one the n-grams: each task sums its own n-grams and sends them as
packed blocks (a list of their words' numbers and sorted places in it, compressed) to the shard of their context; a shard merges its blocks,
writes its arrays and passes on, for each different n-gram, its suffix, which the next lower order counts (continuation
counts).  The shards of a model grow with the corpus and the order, so a task never holds more than a shard.  A context that may hold more than half a shard (at most two for
each shard) is spread over all shards by its next word.

Scoring.  Every worker maps the arrays and looks up a block of documents at once.  The model folder must be a path that
executors can map: a shared file system in spark.checkpoint.dir (file: or without scheme).

Text is lower-cased (A-Z); a document is its words, runs of bytes other than space and \\t to \\r, and one end.  Before
the first word stand order - 1 begins.  Words are known by 64-bit hashes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.shared import arrow_stage, stored
from citeloom.llm.words import U, Block, blocks, mix
from citeloom.plans.scratch import new_path

ORDER = 3
SHARD_BYTES = 24 << 20
TASK_GRAMS = 2_000_000
END, BEGIN = U(0x5DEECE66D1234567), U(0x2545F4914F6CDD1D)
_STEP, _KEY = U(0xD1342543DE82EF95), U(0xA0761D6478BD642F)


def local_path(path: str) -> str:
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"{path}: workers can map the model only on a mounted shared file system")
    return parsed.path


def begin_contexts(order: int) -> list[np.uint64]:
    found = [np.zeros(1, U)]
    for _ in range(1, order):
        found.append(mix(found[-1] * _STEP + BEGIN))
    return [x[0] for x in found]


def tokens(block: Block, order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """The tokens with ends; for each token the contexts of 1 to order - 1 tokens before it; where documents begin."""
    token = np.insert(block.hash, block.first[1:], END)
    at = block.first + np.arange(len(block.first))
    begins = begin_contexts(order)
    contexts: list[np.ndarray] = []
    shorter = np.zeros(len(token), U)
    for j in range(1, order):
        longer = np.empty(len(token), U)
        longer[1:] = mix(shorter[:-1] * _STEP + token[:-1])
        longer[at[:-1]] = begins[j]
        contexts.append(longer)
        shorter = longer
    return token, contexts, at


def words_before(token: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The order - 1 words before each token, the farthest first; begins where the document has none."""
    place = np.arange(len(token)) - np.repeat(at[:-1], np.diff(at))
    before = np.full((len(token), order - 1), BEGIN, U)
    for j in range(1, order):
        own = np.flatnonzero(place >= j)
        before[own, order - 1 - j] = token[own - j]
    return before


@dataclass(frozen=True)
class Shards:
    """Where an n-gram belongs: by its context; for contexts of very many n-grams by the next word too."""

    number: int
    hot: tuple[int, ...] = ()

    def of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        shard = context % U(self.number)
        if self.hot:
            spread = np.isin(context, np.array(self.hot, U))
            shard[spread] = mix(word[spread] ^ context[spread]) % U(self.number)
        return shard.astype(np.int64)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Write whole or not at all: a task that runs again puts the same file in place."""
    os.makedirs(folder, exist_ok=True)
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        np.save(out, array)
    os.replace(own, f"{folder}/{name}.npy")


def _unit(width: int) -> np.ndarray:
    """What a row of a table is that was seen once: a count of 1, or a context's sums 1, 1, 0, 0."""
    return (np.arange(width) < 2).astype(np.int64)


def _save_table(folder: str, name: str, keys: np.ndarray, values: np.ndarray) -> None:
    """One file of three sorted arrays of keys: those of large values, of one-byte values, and seen once, without values."""
    once = (values == _unit(values.shape[1])).all(axis=1)
    small = ~once & (values.max(axis=1) < 256)
    large = ~once & ~small
    head = np.array([large.sum(), small.sum(), once.sum(), values.shape[1]], np.int64)
    parts = [head, keys[large], keys[small], keys[once], values[large].astype(np.int64), values[small].astype(np.uint8)]
    _save(folder, name, np.frombuffer(b"".join(np.ascontiguousarray(p).tobytes() for p in parts), np.uint8))


def _load_table(path: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """The arrays of keys of one mapped file, each with its values."""
    raw = np.load(path, mmap_mode="r")
    large, small, once, width = raw[:32].view(np.int64).tolist()
    ends = np.cumsum([4, large, small, once, large * width]) * 8
    keys = [raw[a:b].view(U) for a, b in zip(ends[:3], ends[1:4])]
    wide = raw[ends[3] : ends[4]].view(np.int64).reshape(large, width)
    narrow = raw[ends[4] :].reshape(small, width)
    return list(zip(keys, (wide, narrow, np.broadcast_to(_unit(width), (once, width)))))


class Words:
    """Numbers for the words of the text, by their places in the mapped tables of words; frequent words have small ones.

    A number is 1 plus the shard plus the shards' number times the place; 0 is the begin.
    """

    def __init__(self, folder: str, number: int) -> None:
        self.folder, self.number = folder, number
        self.known: dict[int, list[np.ndarray]] = {}

    def _keys(self, shard: int) -> list[np.ndarray]:
        if shard not in self.known:
            self.known[shard] = [keys for keys, _ in _load_table(f"{self.folder}/words-{shard}/grams.npy")]
        return self.known[shard]

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(shard, kind="stable")
        new = np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)[: len(order)])
        for own in np.split(order, new[1:]) if len(order) else ():
            yield int(shard[own[0]]), own

    def codes(self, word: np.ndarray) -> np.ndarray:
        code = np.zeros(len(word), np.int64)
        text = np.flatnonzero(word != BEGIN)
        for shard, own in self._by_shard((word[text] % U(self.number)).astype(np.int64)):
            own, base = text[own], 0
            for keys in self._keys(shard):
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, word[own]), len(keys) - 1)
                    hit = keys[at] == word[own]
                    code[own[hit]] = 1 + shard + self.number * (base + at[hit])
                    own = own[~hit]
                base += len(keys)
        return code

    def words(self, code: np.ndarray) -> np.ndarray:
        word = np.full(len(code), BEGIN, U)
        text = np.flatnonzero(code)
        place, of = np.divmod(code[text].astype(np.int64) - 1, self.number)
        for shard, own in self._by_shard(of):
            base = 0
            for keys in self._keys(shard):
                hit = own[(place[own] >= base) & (place[own] < base + len(keys))]
                word[text[hit]] = keys[place[hit] - base]
                base += len(keys)
        return word

    def exchange(self, grams: Grams, by: Callable[[np.ndarray], np.ndarray]) -> Grams:
        """n-grams with numbers for words or words for numbers, each different one of a column looked up once."""
        before, word = np.empty(grams.before.shape, U), np.empty(len(grams.word), U)
        columns = [(before[:, j], grams.before[:, j]) for j in range(before.shape[1])]
        for out, column in [*columns, (word, grams.word)]:
            codes, kinds = pd.factorize(column)
            out[:] = by(kinds).astype(U)[codes]
        return Grams(before, word, grams.count)


_dictionary: dict[str, Words] = {}


def _words(folder: str | None, shards: Shards) -> Words | None:
    """This worker's numbers of a model's words; None while the words are counted."""
    if folder is not None and folder not in _dictionary:
        _dictionary.clear()
        _dictionary[folder] = Words(folder, shards.number)
    return _dictionary.get(folder) if folder is not None else None


@dataclass
class Grams:
    """n-grams: the words before (the farthest first, one column each), the word, a count."""

    before: np.ndarray  # (n, order - 1)
    word: np.ndarray
    count: np.ndarray

    def context(self) -> np.ndarray:
        """The hash of the words before, as tokens() has it."""
        found = np.zeros(len(self.word), U)
        for j in range(self.before.shape[1]):
            found = mix(found * _STEP + self.before[:, j])
        return found

    def key(self) -> np.ndarray:
        return gram_key(self.context(), self.word) if self.before.shape[1] else self.word

    def merged(self) -> tuple[Grams, np.ndarray]:
        """Each n-gram once, ordered by key; the keys."""
        key = self.key()
        order = np.argsort(key)
        key = key[order]
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        count = np.add.reduceat(self.count[order], new) if len(new) else self.count[:0]
        first = order[new]
        return Grams(self.before[first], self.word[first], count), key[new]

    def suffixes(self) -> Grams:
        return Grams(self.before[:, 1:], self.word, np.ones(len(self.word), np.int64)).merged()[0]

    def packed(self, shards: Shards, words: Words | None = None) -> Iterator[tuple[int, bytes]]:
        lead = self.context() if self.before.shape[1] else self.word
        shard = shards.of(lead, self.word)
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(shards.number + 1))
        sent = words.exchange(self, words.codes) if words else self
        for s in range(shards.number):
            own = order[ends[s] : ends[s + 1]]
            if len(own):
                yield s, pack_block(sent.before[own], sent.word[own], sent.count[own])


def gram_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * _KEY + word)


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second bytes and so on, which compresses well where most values are small."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def pack_block(before: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
    """Each word (its number or hash) once, then the n-grams sorted by the places of their words in that list, compressed.

    Of a sorted column stand the differences, afresh wherever a column before it changes; counts over 254 follow those
    of one byte.
    """
    n, k = before.shape
    code, known = pd.factorize(np.concatenate([before.T.ravel(), word]).astype(U))
    rank = np.argsort(known)
    place = np.empty(len(rank), np.uint32)
    place[rank] = np.arange(len(rank))
    code, known = place[code], np.diff(known[rank], prepend=U(0))
    columns = code.reshape(k + 1, n)
    order = np.lexsort(columns[::-1])
    columns, count = columns[:, order], count[order]
    new = np.zeros(n, bool)
    new[:1] = True
    steps = [_planes(known)]
    for column in columns:
        step = column.copy()
        step[1:] -= np.where(new[1:], np.uint32(0), column[:-1])
        steps.append(_planes(step))
        new |= np.append(True, column[1:] != column[:-1])[:n]
    large = count > 254
    steps += [np.where(large, 255, count).astype(np.uint8).tobytes(), count[large].astype(np.int64).tobytes()]
    packed = b"".join(steps)
    head = np.array([n, k, len(known), large.sum(), len(packed)], np.int64)
    return head.tobytes() + pa.compress(packed, "zstd", asbytes=True)


def unpack_block(data: bytes) -> Grams:
    n, k, kinds, large, size = np.frombuffer(data, np.int64, 5).tolist()
    raw = np.frombuffer(pa.decompress(data[40:], size, "zstd", asbytes=True), np.uint8)
    known = np.cumsum(np.ascontiguousarray(raw[: 8 * kinds].reshape(8, kinds).T).view(U).ravel())
    raw = raw[8 * kinds :]
    new = np.zeros(n, bool)
    new[:1] = True
    found = np.empty((k + 1, n), U)
    for j in range(k + 1):
        planes = raw[4 * n * j : 4 * n * (j + 1)].reshape(4, n)
        step = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
        start = np.flatnonzero(new)
        code = np.cumsum(step)
        code -= np.repeat(code[start] - step[start], np.diff(np.append(start, n)))
        found[j] = known[code]
        new |= np.append(True, code[1:] != code[:-1])[:n]
    at = 4 * n * (k + 1)
    count = raw[at : at + n].astype(np.int64)
    count[count == 255] = np.frombuffer(raw[at + n :].tobytes(), np.int64, large)
    return Grams(found[:k].T, found[k], count)


def joined(parts: list[Grams]) -> Grams:
    return Grams(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("before", "word", "count")))


_BLOCKS = pa.schema([("shard", pa.int64()), ("block", pa.binary()), ("context", pa.int64()), ("n", pa.int64())])


def _rows(shard: list, block: list, context: list, n: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((shard, block, context, n), _BLOCKS.types)], schema=_BLOCKS)


def _count(texts: DataFrame, order: int, shards: Shards, heavy_orders: int = 0, folder: str | None = None) -> DataFrame:
    """Packed n-grams of one order as (shard, block); with heavy_orders also rows of contexts that may be hot.

    With the folder of a model whose words have been built, blocks hold numbers of words.

    Those rows have shard -1, a context with more than a half of a shard's part of what the task read, and how often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Grams] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if held:
                grams = joined(held)
                rows = list(grams.merged()[0].packed(shards, _words(folder, shards)))
                none = [None] * len(rows)
                yield _rows([s for s, _ in rows], [b for _, b in rows], none, none)
            held, size = [], 0

        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                token, contexts, at = tokens(block, heavy_orders + 1)
                for c in contexts[:heavy_orders]:
                    values, n = np.unique(c, return_counts=True)
                    hot = n * 2 * shards.number > len(token)
                    none = [None] * int(hot.sum())
                    yield _rows([-1] * len(none), none, values[hot].view(np.int64), n[hot])
                held.append(Grams(words_before(token, at, order), token, np.ones(len(token), np.int64)))
                size += len(token)
                if size >= TASK_GRAMS:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "shard bigint, block binary, context bigint, n bigint")


_SHARD_OUT = pa.schema(
    [("shard", pa.int64()), ("block", pa.binary()), ("kinds", pa.int64()), ("total", pa.int64())]
    + [("of_counts", pa.list_(pa.int64())), ("hot", pa.list_(pa.list_(pa.int64())))]
)


def _build(counted: DataFrame, folder: str, order: int, name: str, shards: Shards) -> DataFrame:
    """Merge each shard's blocks and write its arrays; gives blocks of the next lower order and one row of totals."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        numbers = _words(folder if name != "words" else None, shards)
        grams = joined([unpack_block(b.as_py()) for b in table.column("block")])
        grams, key = (numbers.exchange(grams, numbers.words) if numbers else grams).merged()
        place = f"{folder}/{name}-{shard}"
        _save_table(place, "grams", key, grams.count[:, None])
        kind = np.minimum(grams.count, 5)
        hot: list[list[int]] = []
        if order > 1:
            context, which = np.unique(grams.context(), return_inverse=True)
            sums = [np.bincount(which, grams.count, len(context)).astype(np.int64)]
            sums += [np.bincount(which, sel, len(context)).astype(np.int64) for sel in (kind == 1, kind == 2, kind > 2)]
            spread = np.isin(context, np.array(shards.hot, U))
            hot = np.column_stack([context.view(np.int64), *sums])[spread].tolist()
            _save_table(place, "contexts", context[~spread], np.column_stack(sums)[~spread])
        lower = list(grams.suffixes().packed(shards, numbers)) if order > 1 else []
        own = {
            "shard": [-1] + [s for s, _ in lower],
            "block": [None] + [b for _, b in lower],
            "kinds": [len(key)] + [None] * len(lower),
            "total": [int(grams.count.sum())] + [None] * len(lower),
            "of_counts": [np.bincount(kind, minlength=6)[:6].tolist()] + [None] * len(lower),
            "hot": [hot] + [None] * len(lower),
        }
        return pa.table([pa.array(own[f.name], f.type) for f in _SHARD_OUT], schema=_SHARD_OUT)

    kind = "shard bigint, block binary, kinds bigint, total bigint, of_counts array<bigint>, hot array<array<bigint>>"
    return stored(counted.groupBy("shard").applyInArrow(merge, kind), f"lm-{name}")


def _discounts(n: list[int]) -> np.ndarray:
    """D1, D2 and D3+ from the numbers of n-grams seen 1, 2, 3 and 4 times; of too few n-grams 0.5, 1 and 1.5."""
    if min(n) <= 0:
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3)]
    return np.array([min(max(d, 0.0), k + 1.0) for k, d in enumerate(found)])


@dataclass
class Totals:
    kinds: int
    total: int
    of_counts: list[int]
    hot: np.ndarray  # rows of context, total, n1, n2, n3+

    @classmethod
    def read(cls, built: DataFrame) -> Totals:
        """Sums over the shards' rows; hot contexts are at most two for each shard."""
        own = built.where("shard = -1")
        sums = own.agg(
            F.sum("kinds"), F.sum("total"), *(F.sum(F.col("of_counts")[i]) for i in range(6))
        ).first()
        rows = own.select(F.explode("hot").alias("h")).groupBy(F.col("h")[0].alias("c"))
        rows = rows.agg(*(F.sum(F.col("h")[i]).alias(f"s{i}") for i in range(1, 5))).collect()
        hot = np.array([tuple(r) for r in rows], np.int64).reshape(len(rows), 5)
        hot = hot[np.argsort(hot[:, 0].view(U))]
        return cls(sums[0] or 0, sums[1] or 0, [x or 0 for x in sums[2:]], hot)


@dataclass
class Model:
    """What scoring needs besides the mapped arrays; a few numbers for each order and at most two hot contexts a shard."""

    folder: str
    order: int
    shards: Shards
    words: Totals
    orders: dict[int, Totals]


def train(texts: DataFrame, order: int = ORDER, shard_bytes: int = SHARD_BYTES) -> Model:
    """A model of a table with the column text; null is empty."""
    spark = texts.sparkSession
    folder = local_path(new_path(spark, "lm"))
    texts = texts.select("text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = Shards(max(1, -(-total * max(1, order - 1) // shard_bytes)))
    counted = stored(_count(texts, 1, shards, order - 1), "lm-words")
    words = Totals.read(_build(counted.where("shard >= 0"), folder, 1, "words", shards))
    hot = {}
    if order > 1:
        heavy = counted.where("shard = -1").groupBy("context").agg(F.sum("n").alias("n"))
        hot = heavy.where(F.col("n") * 2 * shards.number > words.total).select("context").collect()
    shards = Shards(shards.number, tuple(sorted(r[0] % (1 << 64) for r in hot)))
    orders: dict[int, Totals] = {}
    if order > 1:
        source = _count(texts, order, shards, folder=folder)
        for k in range(order, 0, -1):
            built = _build(source, folder, k, f"grams{k}", shards)
            orders[k] = Totals.read(built)
            source = built.where("shard >= 0").select("shard", "block")
    else:
        orders[1] = words
    return Model(folder, order, shards, words, orders)


class Mapped:
    """A model's arrays, mapped by this worker."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.tables: dict[tuple[str, int, str], list[tuple[np.ndarray, np.ndarray]]] = {}

    def table(self, name: str, shard: int, what: str) -> list[tuple[np.ndarray, np.ndarray]]:
        key = (name, shard, what)
        if key not in self.tables:
            path = f"{self.model.folder}/{name}-{shard}/{what}.npy"
            self.tables[key] = _load_table(path) if os.path.exists(path) else []
        return self.tables[key]

    def find(self, name: str, what: str, shard: np.ndarray, key: np.ndarray, width: int) -> np.ndarray:
        """The values stored under each key, 0 where there is none."""
        codes, kinds = pd.factorize(key)
        first = np.empty(len(kinds), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        shard = shard[first]
        out = np.zeros((len(kinds), width), np.int64)
        order = np.lexsort((kinds, shard))
        ends = np.searchsorted(shard[order], np.arange(self.model.shards.number + 1))
        for s in np.flatnonzero(np.diff(ends)):
            own = order[ends[s] : ends[s + 1]]
            for keys, values in self.table(name, s, what):
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, kinds[own]), len(keys) - 1)
                    hit = keys[at] == kinds[own]
                    out[own[hit]] = values[at[hit]]
                    own = own[~hit]
        return out[codes]

    def word_counts(self, token: np.ndarray) -> np.ndarray:
        return self.find("words", "grams", self.model.shards.of(token, token), token, 1)[:, 0]

    def probabilities(self, token: np.ndarray, contexts: list[np.ndarray]) -> np.ndarray:
        """The interpolated probability of each token after its contexts (1 token, 2 tokens, ...)."""
        model = self.model
        low = model.orders[1]
        found = "words" if model.order == 1 else "grams1"
        count = self.find(found, "grams", model.shards.of(token, token), token, 1)[:, 0]
        discount = np.append(0.0, _discounts(low.of_counts[1:5]))
        p = np.full(len(token), 1.0 / (model.words.kinds + 1))
        if low.total:
            n = low.of_counts
            left = discount[1] * n[1] + discount[2] * n[2] + discount[3] * (n[3] + n[4] + n[5])
            p = (np.maximum(count - discount[np.minimum(count, 3)], 0) + left * p) / low.total
        for k in range(2, model.order + 1):
            context, own = contexts[k - 2], model.orders[k]
            shard = model.shards.of(context, token)
            count = self.find(f"grams{k}", "grams", shard, gram_key(context, token), 1)[:, 0]
            sums = self.find(f"grams{k}", "contexts", (context % U(model.shards.number)).astype(np.int64), context, 4)
            if len(own.hot):
                keys = own.hot[:, 0].view(U)
                at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
                hit = keys[at] == context
                sums[hit] = own.hot[at[hit], 1:]
            discount = np.append(0.0, _discounts(own.of_counts[1:5]))
            seen = sums[:, 0] > 0
            total = np.maximum(sums[:, 0], 1)
            left = sums[:, 1:] @ discount[1:]
            p = np.where(seen, (np.maximum(count - discount[np.minimum(count, 3)], 0) + left * p) / total, p)
        return p


_open: dict[str, Mapped] = {}


def _mapped(model: Model) -> Mapped:
    if model.folder not in _open:
        _open.clear()
        _open[model.folder] = Mapped(model)
    return _open[model.folder]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    score is the base-10 logarithm of the text's probability; base_score that of a unigram model with 0.5 added to each
    count.  Null and empty texts are the end alone.  Repeated rows and rows without an id come back each; other columns
    are not read.  A model of no text gives every token the same probability.
    """
    types = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64())]
        + [(name, pa.float64()) for name in ("base_score", "score", "perplexity")]
    )
    words = model.words

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        mapped = _mapped(model)
        for block in blocks(batch.column(1), lower=True):
            token, contexts, at = tokens(block, model.order)
            count = mapped.word_counts(token)
            base = np.log10((count + 0.5) / (words.total + 0.5 * (words.kinds + 1)))
            own = np.add.reduceat(np.log10(mapped.probabilities(token, contexts)), at[:-1])
            n = np.diff(at)
            yield {
                "doc_id": batch.column(0).slice(block.row, len(block)),
                "n_tokens": n,
                "n_known": np.add.reduceat((count > 0).astype(np.int64), at[:-1]),
                "train_tokens": np.full(len(n), words.total),
                "base_score": np.add.reduceat(base, at[:-1]),
                "score": own,
                "perplexity": np.power(10.0, np.minimum(-own / n, 300)),
            }

    kind = ", ".join(f"{f.name} {'double' if f.type == pa.float64() else 'bigint'}" for f in types)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return arrow_stage(source, step, kind, types)
