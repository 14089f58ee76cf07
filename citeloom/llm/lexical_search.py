"""Ranked lexical search by an Aho-Corasick scan of whole documents.

All terms of the items go into one automaton, each with a guard (a space) on either side, so that only whole terms match.
The automaton is broadcast and reads the texts directly; there is no index of the documents.  A first scan counts documents
by term, a second one scores: the automaton's outputs lead from a term to the items it stands in, tasks keep each item's
best documents, and the best of these are found in two steps.

What is broadcast is bounded: items are taken in blocks of at most AUTOMATON_BYTES of text (an item longer than that is a
block of its own), and every block scans the documents again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.shared import stored
from citeloom.llm.words import blocks

TOP = 20
AUTOMATON_BYTES = 1 << 20
#: Text read by the automaton at a time, scores held at a time, and parts in which tasks' best documents are merged first.
SCAN_BYTES, SCORES, MERGE_PARTS = 4 << 20, 1 << 22, 256

#: Bytes of terms stay, A-Z in lower case; every other byte is a guard.
_GUARD = 32
_TERM = np.array([b if chr(b).isalnum() or b > 127 else _GUARD for b in range(256)], np.uint8)
_TERM[65:91] += 32
_TABLE = _TERM.tobytes()


@dataclass
class Terms:
    """The terms of a block of items; term t stands in items item[at[t]:at[t + 1]], each time as often as times says."""

    terms: list[bytes]
    at: np.ndarray
    item: np.ndarray
    times: np.ndarray
    items: int

    @staticmethod
    def of(texts: list[str | None]) -> Terms:
        number: dict[bytes, int] = {}
        pairs: dict[tuple[int, int], int] = {}
        for i, text in enumerate(texts):
            for term in (text or "").encode().translate(_TABLE).split():
                key = (number.setdefault(term, len(number)), i)
                pairs[key] = pairs.get(key, 0) + 1
        order = sorted(pairs)
        at = np.searchsorted(np.array([t for t, _ in order], np.int64), np.arange(len(number) + 1))
        return Terms(
            list(number), at, np.array([i for _, i in order], np.int64),
            np.array([pairs[k] for k in order], np.int64), len(texts),
        )


_built: tuple[Terms | None, object] = (None, None)


def _automaton(terms: Broadcast):
    """The automaton of the broadcast terms, built once in each worker.  Bytes stand for characters of the same number."""
    global _built
    if _built[0] is not terms.value:
        import ahocorasick

        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(terms.value.terms):
            made.add_word(f" {term.decode('latin-1')} ", i)
        made.make_automaton()
        _built = terms.value, made
    return _built[1]


def _spaced(block) -> tuple[bytes, np.ndarray]:
    """A guard, then each document followed by a guard, and where each of them begins."""
    body = block.data.tobytes()
    at = block.at.tolist()
    return b" ".join([b"", *(body[a:b] for a, b in zip(at, at[1:])), b""]), block.at[:-1] + np.arange(1, len(block) + 1)


_HIT = np.dtype([("end", "<i8"), ("term", "<i8")])


def _hits(automaton, text: bytes, size: int = SCAN_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ends (the guard after a term) and terms, in windows of about size bytes that meet in a guard."""
    a = 0
    while a < len(text) - 1:
        b = len(text) - 1
        if b - a > size:
            b = text.rfind(b" ", a + 1, a + size)
            b = b if b > 0 else text.find(b" ", a + size)
        if automaton:
            found = np.fromiter(automaton.iter(text[a : b + 1].decode("latin-1")), _HIT)
            yield found["end"] + a, found["term"]
        a = b


@dataclass
class Scanned:
    """Some documents: how many terms each has, and (document, term, times) for the items' terms."""

    row: int
    lengths: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    tf: np.ndarray


def _scan(texts: pa.Array, terms: Broadcast) -> Iterator[Scanned]:
    automaton, kinds = _automaton(terms), len(terms.value.terms)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, where, body = texts.buffers()
    if body is not None:
        plain = pa.py_buffer(_TERM[np.frombuffer(body, np.uint8)])
        texts = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, where, plain], offset=texts.offset)
    for block in blocks(texts):
        text, begin = _spaced(block)
        ends, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for e, t in _hits(automaton if kinds else None, text):
            ends.append(e)
            found.append(t)
        doc = np.searchsorted(begin, np.concatenate(ends) - 1, "right") - 1
        key, tf = np.unique(doc * max(kinds, 1) + np.concatenate(found), return_counts=True)
        yield Scanned(block.row, np.diff(block.first), key // max(kinds, 1), key % max(kinds, 1), tf.astype(np.int64))


def _statistics(source: DataFrame, terms: Broadcast) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms of all documents, and documents by term of the block."""
    kinds = len(terms.value.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kinds + 2, np.int64)
        for batch in batches:
            for s in _scan(batch.column(1), terms):
                total[:kinds] += np.bincount(s.term, minlength=kinds)[:kinds]
                total[kinds] += np.count_nonzero(s.lengths)
                total[kinds + 1] += s.lengths.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["key", "n"])

    out = np.zeros(kinds + 2, np.int64)
    for key, n in source.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n")).collect():
        out[key] = n
    return int(out[kinds]), int(out[kinds + 1]), out[:kinds]


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Best:
    """Each item's best documents so far: by score, then by the lesser id, rows without an id last."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.least = top, np.ones(items, np.int64)  # least: what a document must reach
        self.rows = [np.zeros(0, np.int64)] * 4  # item, score, document, whether it has no id

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        item, score, doc, no_id = (np.concatenate(x) for x in zip(self.rows, (item, score, doc, no_id)))
        order = np.lexsort((doc, no_id, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.top
        self.rows = [item[kept], score[order][kept], doc[order][kept], no_id[order][kept]]
        full = rank == self.top - 1
        self.least[item[full]] = score[order][full]


def _scores(s: Scanned, t: Terms, weight: np.ndarray, n_docs: int, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first document, scores of items by documents), some documents at a time."""
    m = np.array([75 + 25 * n * n_docs // total for n in s.lengths.tolist()], np.int64)
    value = weight[s.term] * ((1_000_000_000 * s.tf) // (1000 * s.tf + 12 * m[s.doc]))
    step = max(1, SCORES // max(t.items, 1))
    for a in range(0, len(m), step):
        b = min(a + step, len(m))
        lo, hi = np.searchsorted(s.doc, (a, b))
        term = s.term[lo:hi]
        each = t.at[term + 1] - t.at[term]
        which = np.repeat(np.arange(lo, hi), each)
        place = np.repeat(t.at[term] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        sums = np.zeros(t.items * (b - a), np.int64)
        np.add.at(sums, t.item[place] * (b - a) + s.doc[which] - a, value[which] * t.times[place])
        yield a, sums.reshape(t.items, b - a)


def _candidates(
    source: DataFrame, terms: Broadcast, weight: Broadcast, n_docs: int, total: int, top: int
) -> DataFrame:
    """The best documents of every task: item, doc_id, score."""
    types = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(terms.value.items, top)
        for batch in batches:
            ids = batch.column(0)
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for s in _scan(batch.column(1), terms):
                for first, sums in _scores(s, terms.value, weight.value, n_docs, total):
                    item, doc = np.nonzero(sums >= best.least[:, None])
                    if len(item):
                        at = s.row + first + doc
                        best.add(item, sums[item, doc], ids[at], no_id[at])
        item, score, doc, none = best.rows
        ids = pa.array(doc, pa.int64(), mask=none.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(item), ids, pa.array(score)], schema=types)

    return source.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _item_blocks(items: DataFrame, size: int) -> Iterator[list[tuple]]:
    """Items in blocks of at most size bytes of text; the driver holds one block at a time."""
    block, held = [], 0
    for row in items.toLocalIterator():
        own = len((row[1] or "").encode())
        if block and held + own > size:
            yield block
            block, held = [], 0
        block.append(tuple(row))
        held += own
    if block:
        yield block


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Each item's top documents with a score above 0: item_id, rank (from 1), doc_id, score.

    Terms are runs of letters and digits of ASCII and of all other characters from U+0080, with A-Z lower-cased.  An
    item's score for a document sums w * ((10**9 * tf) div (1000 * tf + 12 * m)) over its terms, repeats included, with w =
    floor(1000 * ln((2N + 2) / (2 df + 1))) and m = 75 + (25 n N) div L.

    Null and empty texts have no terms: as documents they are not counted, as items they get no rows.  Equal scores go by
    ascending id, rows without an id last.  Every row is a document and every row is an item of its own, also where ids
    repeat.  Other columns are not read; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    wanted = items.select(F.col(f"`{item_col}`"), F.col(f"`{item_text_col}`"))
    kind = wanted.schema[0].dataType
    found: DataFrame | None = None
    for block in _item_blocks(wanted, automaton_bytes):
        terms = spark.sparkContext.broadcast(Terms.of([text for _, text in block]))
        n_docs, total, df = _statistics(source, terms)
        weight = spark.sparkContext.broadcast(weights(n_docs, df))
        some = _candidates(source, terms, weight, n_docs, total, top)
        names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(block)], f"item bigint, item_id {kind.simpleString()}")
        best = stored(_best(some, top).join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    return found


def _best(found: DataFrame, top: int) -> DataFrame:
    """The best of what tasks found, first within some parts: an item's rows grow with the tasks, not one part's."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.spark_partition_id() % MERGE_PARTS
    first = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    some = found.withColumn("part", part).withColumn("rank", first).where(F.col("rank") <= top)
    last = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return some.select("item", "doc_id", "score", last.alias("rank")).where(F.col("rank") <= top)
