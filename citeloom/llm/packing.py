"""Packing of tokenised documents into sequences by best-two-fit.

Documents are tokenised part by part, so each worker keeps the ids of parts it has met: words, as no token spans white
space, and for tokenizers known to cut there (token_counts.can_cut) their letters, digits and signs.  Only pieces'
lengths are packed.  Pieces are dealt by a hash into groups of about GROUP_PIECES, enough for a close packing,
and each group is packed by itself: a sequence is filled greedily with the longest piece that fits; then its smallest
piece is replaced by two unpacked ones whose lengths fit the gap more tightly, as long as that closes the gap further.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.interning import Kept, intern, spell
from citeloom.llm.shared import arrow_stage, stored
from citeloom.llm.token_counts import can_cut
from citeloom.llm.words import LOWER, Block, blocks, kinds, span_hashes

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 65_536
KEPT_PARTS = 300_000
CALL_PARTS = 2048
BLOCK_BYTES = 1 << 20


class Parts:
    """A tokenizer and the ids of parts met lately."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.cuts = can_cut(json.load(file))
        self.kept = Kept(KEPT_PARTS)

    def spans(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the parts of a block start and end, and where each document's begin.

        Letters and signs are cut apart where both are known (not beside apostrophes, which begin tokens like 's, and not
        before characters that may join the one before them), and every digit from what stands before it.
        """
        if not self.cuts:
            return block.start, block.end, block.first
        kind = kinds(block.data)
        cut = np.flatnonzero((kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))) + 1
        cut = cut[~np.isin(cut, block.at)]
        start, end = np.sort(np.append(block.start, cut)), np.sort(np.append(block.end, cut))
        return start, end, np.searchsorted(start, block.at)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts in a row, and how many each has."""
        flat, length = [np.zeros(0, "<u4")], []
        for a in range(0, len(texts), CALL_PARTS):
            found = self.tokenizer.encode_batch_fast([t.decode() for t in texts[a : a + CALL_PARTS]], add_special_tokens=False)
            ids = [e.ids for e in found]
            length += map(len, ids)
            flat.append(np.fromiter(chain.from_iterable(ids), "<u4"))
        return np.concatenate(flat), np.array(length, np.int64)


_models: dict[str, Parts] = {}


def _model(path: str) -> Parts:
    if path not in _models:
        _models[path] = Parts(path)
    return _models[path]


def token_ids(path: str, block: Block) -> Iterator[bytes]:
    """Each document's ids as little-endian unsigned 32-bit integers."""
    model = _model(path)
    start, end, first = model.spans(block)
    data = LOWER[block.data]  # the tokenizer lower-cases
    hashes = span_hashes(data, start, end)
    codes, sample = intern(hashes)
    raw = data.tobytes()

    def learn(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return model.encode([raw[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())])

    ids, at = spell(codes, *model.kept.values(hashes[sample], learn), first)
    marks = b"<|" in raw  # names of special tokens count only as they are written
    for i in range(len(block)):
        text = block.data[block.at[i] : block.at[i + 1]].tobytes() if marks else b""
        yield (model.encode([text])[0] if b"<|" in text else ids[at[i] : at[i + 1]]).tobytes()


def pieces(
    docs: DataFrame, path: str, sequence: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as ids and an end id, cut only where longer than a sequence: doc_id, piece, start, length, ids_crc32.

    with_ids adds the ids (binary, little-endian unsigned 32-bit).
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    fields += [("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    end = np.array([END_ID], "<u4").tobytes()

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in blocks(batch.column(1), size=BLOCK_BYTES):
            names = [name for name, _ in fields]
            out: dict[str, list] = {name: [] for name in names}
            for key, ids in zip(batch.column(0).slice(block.row, len(block)).to_pylist(), token_ids(path, block)):
                ids += end
                for k in range(0, len(ids), 4 * sequence):
                    part = ids[k : k + 4 * sequence]
                    row = (key, k // (4 * sequence), k // 4, len(part) // 4, zlib.crc32(part), part)
                    for name, value in zip(names, row):
                        out[name].append(value)
            yield out

    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return arrow_stage(source, step, kind, pa.schema(fields))


def best_two_fit(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """For each piece the number of its sequence and its offset there.

    Pieces of one length are alike, so the lengths still to be packed are a set of bits with a stack for each.
    """
    stacks: list[list[int]] = [[] for _ in range(sequence + 1)]
    for i, n in enumerate(lengths.tolist()):
        stacks[n].append(i)
    there = sum(1 << n for n, s in enumerate(stacks) if s)
    mirror = sum(1 << (sequence - n) for n, s in enumerate(stacks) if s)  # a length n at sequence - n

    def take(n: int) -> int:
        nonlocal there, mirror
        i = stacks[n].pop()
        if not stacks[n]:
            there ^= 1 << n
            mirror ^= 1 << (sequence - n)
        return i

    def put(n: int, i: int) -> None:
        nonlocal there, mirror
        stacks[n].append(i)
        there |= 1 << n
        mirror |= 1 << (sequence - n)

    def two(least: int, most: int) -> tuple[int, int] | None:
        """Lengths of two pieces with the greatest sum over least and up to most."""
        for total in range(most, least, -1):
            both = there & (mirror >> (sequence - total))  # lengths n with total - n there too
            while both:
                n = both.bit_length() - 1
                if 2 * n != total or len(stacks[n]) > 1:
                    return n, total - n
                both ^= 1 << n
        return None

    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    sequences = 0
    while there:
        gap, own = sequence, []
        while fits := there & ((2 << gap) - 1):
            n = fits.bit_length() - 1
            own.append((n, take(n)))
            gap -= n
        while gap and there:
            least, i = min(own)
            if not (pair := two(least, least + gap)):
                break
            own.remove((least, i))
            own += [(n, take(n)) for n in pair]
            put(least, i)
            gap += least - sum(pair)
        at = 0
        for n, i in own:
            number[i], offset[i] = sequences, at
            at += n
        sequences += 1
    return number, offset


def pack(parts: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset; lengths are from 1 to sequence."""
    count = parts.count()
    groups = max(1, -(-count // group_pieces))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], kind="stable").reset_index(drop=True)
        number, pdf["offset"] = best_two_fit(pdf["length"].to_numpy(), sequence)
        pdf["sequence_id"] = (pdf["pack_group"].to_numpy() << 32) + number
        return pdf.drop(columns="pack_group")

    dealt = parts.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return dealt.groupBy("pack_group").applyInPandas(place, f"{kind}, offset bigint, sequence_id bigint")


def pack_documents(
    docs: DataFrame, path: str, sequence: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone.  Repeated rows are packed each.  Rows without an id are packed too.
    Other columns are not read; an empty table gives no rows.
    """
    return pack(stored(pieces(docs, path, sequence, id_col, text_col), "pieces"), sequence, group_pieces)
