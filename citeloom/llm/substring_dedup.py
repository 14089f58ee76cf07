"""Removal of word sequences that occur more than once, by super-k-mer partitioning.

A window is WINDOW consecutive words of a document.  Its minimiser is the least hash of the runs of MINIMISER words in
it.  Consecutive windows with the same minimiser travel as one packed string of words to the minimiser's bucket.  Equal
windows have equal minimisers, so a bucket sees all occurrences of its windows: it sorts the windows' words and counts
them exactly.  A bucket of one packed string without a repeated window is done at once.

A first count of the minimisers says which occur only once; their strings need not travel.  The map side knows that from
a bit for each hash of a repeated minimiser, of FILTER_BITS bits at most: where many share a bit, more strings travel.

A minimiser of very many packed strings (a passage in a third of all documents) is found by that count too.  Its windows
travel one by one, as digests of 128 bits, to be counted by a shuffle that combines equal ones first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.shared import arrow_stage, identified, stored
from citeloom.llm.words import SPACE, Block, U, blocks, runs

WINDOW = 35
MINIMISER = 5
HOT_STRINGS = 20_000
LEAST_BITS, FILTER_BITS = 1 << 20, 1 << 27
_SALT = 301


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The least or greatest of each `width` consecutive values."""
    now, have = values, 1
    while have < width:
        step = min(have, width - have)
        now = best(now[: len(now) - step], now[step:])
        have += step
    return now


@dataclass
class SuperKmers:
    """Runs of windows of one minimiser: document, first window (its word in the document), windows, minimiser, and
    whether the minimiser may occur more than once in the run, so that it may repeat a window itself."""

    doc: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    least: np.ndarray
    inner: np.ndarray


def super_kmers(block: Block, window: int, k: int) -> SuperKmers:
    none = np.zeros(0, np.int64)
    empty = SuperKmers(none, none, none, np.zeros(0, U), np.zeros(0, bool))
    hashes, pos, at = runs(block, k, _SALT)
    width = window - k + 1
    if len(hashes) < width:
        return empty
    least = _sliding(hashes, width, np.minimum)
    doc = np.repeat(np.arange(len(block)), np.diff(at))
    good = doc[: len(least)] == doc[width - 1 :]  # the window stays in one document
    where = np.flatnonzero(good)
    if not len(where):
        return empty
    # the runs of words that are the minimiser of a window, and those that are so twice within reach of a window
    around = np.zeros(len(hashes) + width - 1, U)
    around[width - 1 : width - 1 + len(least)] = np.where(good, least, U(0))
    chosen = np.flatnonzero(_sliding(around, width, np.maximum) == hashes)
    twice = (hashes[chosen[1:]] == hashes[chosen[:-1]]) & (np.diff(chosen) <= width)
    least, own = least[where], doc[where]
    new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (own[1:] != own[:-1])))
    first = pos[where[new]] - block.first[own[new]]
    inner = np.isin(least[new], hashes[chosen[1:][twice]])
    return SuperKmers(own[new], first, np.diff(np.append(new, len(where))), least[new], inner)


_PACKED = pa.schema(
    [("id", pa.int64()), ("row", pa.int64()), ("first", pa.int64()), ("minimiser", pa.int64())]
    + [("words", pa.binary()), ("inner", pa.bool_()), ("digest", pa.binary())]
)


def minimiser_counts(docs: DataFrame, window: int, k: int, text_col: str) -> DataFrame:
    """minimiser and its number of packed strings, summed by each task first."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in blocks(batch.column(0)):
            found, n = np.unique(super_kmers(block, window, k).least, return_counts=True)
            yield {"minimiser": found.view(np.int64), "n": n}

    types = pa.schema([("minimiser", pa.int64()), ("n", pa.int64())])
    counted = arrow_stage(docs.select(F.col(text_col).alias("text")), step, "minimiser bigint, n bigint", types)
    return counted.groupBy("minimiser").agg(F.sum("n").alias("n"))


def repeated_bits(repeated: DataFrame) -> np.ndarray:
    """A bit for each repeated minimiser's hash, about sixteen for each up to FILTER_BITS, as 64-bit words."""
    bits = LEAST_BITS
    count = repeated.count()
    while bits < FILTER_BITS and bits < 16 * count:
        bits *= 2
    bit = F.pmod("minimiser", F.lit(bits))
    one = F.shiftright(bit, 6).alias("word"), F.expr("1L").alias("one"), F.pmod(bit, F.lit(64)).cast("int").alias("at")
    words = repeated.select(*one).groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, at)")).alias("bits"))
    found = words.toArrow()  # at most FILTER_BITS / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(U)


def packed_strings(
    docs: DataFrame, bits: np.ndarray, hot: list[int], window: int, k: int, id_col: str, text_col: str
) -> DataFrame:
    """Rows of the word strings of super-k-mers that may repeat; for hot minimisers of the digests of windows instead."""
    hot_keys = np.array(sorted(hot), np.int64)
    shared_bits = docs.sparkSession.sparkContext.broadcast(bits)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in blocks(batch.column(2)):
            found = super_kmers(block, window, k)
            least, own = found.least.view(np.int64), block.row + found.doc
            plain, start = _joined_words(block)
            lo = block.first[found.doc] + found.first
            hi = lo + found.windows + window - 1  # the word after
            spread = np.isin(least, hot_keys)
            at = found.least & U(64 * len(shared_bits.value) - 1)
            again = (shared_bits.value[at >> U(6)] >> (at & U(63))) & U(1) == 1
            calm = np.flatnonzero(~spread & (again | found.inner))
            rows = pa.array(own[calm])
            yield {
                "id": batch.column(0).take(rows),
                "row": batch.column(1).take(rows),
                "first": found.first[calm],
                "minimiser": least[calm],
                "words": [plain[x:y] for x, y in zip(start[lo[calm]].tolist(), (start[hi[calm]] - 1).tolist())],
                "inner": found.inner[calm],
                "digest": pa.nulls(len(calm), pa.binary()),
            }
            # hot minimisers: a row for each window
            n = found.windows[spread]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            lo = np.repeat(lo[spread], n) + nth
            text = [plain[x:y] for x, y in zip(start[lo].tolist(), (start[lo + window] - 1).tolist())]
            rows = pa.array(np.repeat(own[spread], n))
            yield {
                "id": batch.column(0).take(rows),
                "row": batch.column(1).take(rows),
                "first": np.repeat(found.first[spread], n) + nth,
                "minimiser": np.repeat(least[spread], n),
                "words": pa.nulls(len(lo), pa.binary()),
                "inner": np.zeros(len(lo), bool),
                "digest": [xxhash.xxh3_128_digest(x) for x in text],
            }

    kind = "id bigint, row bigint, first bigint, minimiser bigint, words binary, inner boolean, digest binary"
    return arrow_stage(identified(docs, id_col, text_col), step, kind, _PACKED)


def _joined_words(block: Block) -> tuple[bytes, np.ndarray]:
    """All words of the block, each with a space after it, and where each begins; at last the length."""
    start = np.append(0, np.cumsum(block.end - block.start + 1))
    out = np.full(start[-1], 32, np.uint8)
    inside = np.ones(start[-1], bool)
    inside[start[1:] - 1] = False
    out[inside] = block.data[~SPACE[block.data]]
    return out.tobytes(), start


def repeated_in_bucket(first: list[int], words: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """Of packed strings with the same minimiser, the windows that occur more than once: (first window, how many)."""
    found: list[tuple[bytes, int, int]] = []
    for i, text in enumerate(words):
        cuts = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        start = [0] + (cuts + 1).tolist()
        end = cuts.tolist() + [len(text)]
        found += [(text[start[w] : end[w + window - 1]], i, w) for w in range(len(start) - window + 1)]
    found.sort()
    again: list[list[int]] = [[] for _ in words]
    for j, (text, i, w) in enumerate(found):
        if (j and found[j - 1][0] == text) or (j + 1 < len(found) and found[j + 1][0] == text):
            again[i].append(w)
    out: list[list[tuple[int, int]]] = []
    for i, own in enumerate(again):
        spans: list[tuple[int, int]] = []
        for w in sorted(own):
            if spans and sum(spans[-1]) == w:
                spans[-1] = (spans[-1][0], spans[-1][1] + 1)
            else:
                spans.append((w, 1))
        out.append([(first[i] + w, n) for w, n in spans])
    return out


def repeated_windows(
    docs: DataFrame, window: int = WINDOW, k: int = MINIMISER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Runs of windows that also start elsewhere: id, row, first (the window's word in its document), windows."""
    repeated = stored(minimiser_counts(docs, window, k, text_col).where("n > 1"), "repeated-minimisers")
    hot = [r[0] for r in repeated.where(F.col("n") > HOT_STRINGS).select("minimiser").collect()]
    packed = packed_strings(docs, repeated_bits(repeated), hot, window, k, id_col, text_col)
    names = ("id", "row", "first", "windows")
    types = pa.schema([(name, pa.int64()) for name in names])

    def close(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, rows, first, key, words, inner = batch.columns
        key = key.to_numpy()
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(edge, len(key)))
        todo = (size > 1) | inner.to_numpy(zero_copy_only=False)[edge]
        out: list[tuple] = []
        for a, n in zip(edge[todo].tolist(), size[todo].tolist()):
            spans = repeated_in_bucket(first.slice(a, n).to_pylist(), words.slice(a, n).to_pylist(), window)
            out += [(ids[a + i].as_py(), rows[a + i].as_py(), w, m) for i, own in enumerate(spans) for w, m in own]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=types)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by minimiser; a bucket may reach over batches."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            key = batch.column(3).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            if held and held[-1].column(3)[-1].as_py() != key[0]:
                yield from close(_together(held))
                held = []
            if cut:
                yield from close(_together([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from close(_together(held))

    calm = packed.where("words IS NOT NULL").select("id", "row", "first", "minimiser", "words", "inner")
    dealt = calm.repartition("minimiser").sortWithinPartitions("minimiser")
    found = dealt.mapInArrow(count, ", ".join(f"{name} bigint" for name in names))
    if hot:
        single = stored(packed.where("digest IS NOT NULL").select("id", "row", "first", "digest"), "hot-windows")
        twice = single.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        again = single.join(twice, "digest").select("id", "row", "first", F.lit(1).cast("bigint").alias("windows"))
        found = found.unionByName(again)
    return found


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


def remove_repeated(
    docs: DataFrame, window: int = WINDOW, k: int = MINIMISER, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, text (the words kept, joined by one space).

    Words are runs of bytes other than space and \\t to \\r, unchanged.  Every word of a window whose words also start
    anywhere else goes, all occurrences alike, judged on the input.  Null and empty texts have no words.  Repeated rows
    repeat each other's windows.  Other columns are not read.
    """
    spans = stored(repeated_windows(docs, window, k, id_col, text_col), "repeated-windows")
    own = spans.groupBy("id", "row").agg(F.collect_list("first").alias("first"), F.collect_list("windows").alias("windows"))
    own = own.select(F.col("id").alias("span_id"), F.col("row").alias("span_row"), "first", "windows")
    source = identified(docs, id_col, text_col)
    same = source["row"].eqNullSafe(own["span_row"]) & source["id"].eqNullSafe(own["span_id"])
    types = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.binary())])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        first, windows = batch.column(2), batch.column(3)
        for block in blocks(batch.column(1)):
            drop = np.zeros(len(block.start) + 1, np.int64)
            for i in range(len(block)):
                if (at := first[block.row + i].values) is not None:
                    at = at.to_numpy() + block.first[i]
                    np.add.at(drop, at, 1)
                    np.add.at(drop, at + windows[block.row + i].values.to_numpy() + window - 1, -1)
            drop = np.cumsum(drop)[:-1] > 0
            gone = np.append(0, np.cumsum(drop))[block.first]
            plain, start = _joined_words(block)
            cut = np.repeat(drop, np.diff(start))
            kept = np.frombuffer(plain, np.uint8)[~cut].tobytes()
            end = np.append(0, np.cumsum(~cut))[start[block.first]]
            yield {
                "doc_id": batch.column(0).slice(block.row, len(block)),
                "n_words": np.diff(block.first),
                "n_removed": np.diff(gone),
                "text": [kept[x : max(x, y - 1)] for x, y in zip(end[:-1].tolist(), end[1:].tolist())],
            }

    joined = source.join(own, same, "left").select("id", "text", "first", "windows")
    out = arrow_stage(joined, step, "doc_id bigint, n_words bigint, n_removed bigint, text binary", types)
    return out.withColumn("text", F.col("text").cast("string"))
