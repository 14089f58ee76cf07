"""Token counts of whole texts, without their tokens.

An Arrow function turns a column of texts into a column of lengths.  Texts are put together to batches of about
BATCH_BYTES, however many or few rows that takes, and cut at safe boundaries: places where the tokenizer, whatever stands
on either side, never makes one token of both.  So a very long text is many short parts, each different part of a batch
goes to the library once, and the counts of parts add up to the text's.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.interning import intern
from citeloom.llm.words import Block, blocks, span_hashes

BATCH_BYTES = 4 << 20
#: Parts are handed to the library in lists of about this size, which bounds the tokens held at a time.
CALL_BYTES = 256 << 10
KEPT_PARTS = 300_000

#: Fixed value: a pre-tokenizer that drops white space and takes every digit by itself.
CUTTING_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def can_cut(spec: dict) -> bool:
    """Whether texts may be cut after white space and before digits.

    They may where the pre-tokenizer splits by CUTTING_PATTERN, and no special string has white space or a digit in it.
    Normalising to composed characters never joins anything to a space or to a digit before it, and lower-casing goes
    character by character.
    """
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    first = steps[0]
    known = (
        first.get("type") == "Split"
        and (first.get("pattern") or {}).get("Regex") == CUTTING_PATTERN
        and first.get("behavior") == "Removed"
        and first.get("invert") is True
    )
    normal = spec.get("normalizer") or {}
    kinds = {n.get("type") for n in normal.get("normalizers", [normal])} - {None}
    special = "".join(t["content"] for t in spec.get("added_tokens", []))
    plain = not any(c.isspace() or c.isdigit() for c in special)
    return known and plain and kinds <= {"NFC", "Replace", "Lowercase"} and not spec.get("post_processor")


class Counter:
    """A tokenizer, and the token counts of parts met lately in two generations of up to KEPT_PARTS."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cuts = False
            self.encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            with open(path, encoding="utf-8") as file:
                self.cuts = can_cut(json.load(file))
            self.encode = lambda texts: tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        self.young: dict[int, int] = {}
        self.old: dict[int, int] = {}

    def parts(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the parts of a block start and end, and where each text's parts begin."""
        if not self.cuts:
            return block.at[:-1], block.at[1:], np.arange(len(block) + 1)
        begins = _DIGIT[block.data]
        begins[block.start] = True
        start = np.flatnonzero(begins)
        # a part ends where the next begins in its word, or with its word
        word = np.searchsorted(block.start, start, "right") - 1
        end = np.minimum(block.end[word], np.append(start[1:], len(block.data)))
        return start, end, np.searchsorted(start, block.at)

    def counts(self, block: Block) -> np.ndarray:
        start, end, first = self.parts(block)
        if not len(start):
            return np.zeros(len(block), np.int64)
        hashes = span_hashes(block.data, start, end)
        codes, sample = intern(hashes)
        keys = hashes[sample].tolist()
        found = [self.young.get(k) if k in self.young else self.old.get(k) for k in keys]
        raw, a, b = block.data.tobytes(), start[sample].tolist(), end[sample].tolist()
        wait, size = [], 0
        for i in [i for i, n in enumerate(found) if n is None] + [-1]:
            if wait and (i < 0 or size >= CALL_BYTES):
                lengths = map(len, self.encode([raw[a[j] : b[j]].decode() for j in wait]))
                for j, n in zip(wait, lengths):
                    found[j] = n
                wait, size = [], 0
            if i >= 0:
                wait.append(i)
                size += b[i] - a[i]
        for k, n in zip(keys, found):
            if len(self.young) >= KEPT_PARTS:
                self.young, self.old = {}, self.young
            self.young[k] = n
        total = np.concatenate(([0], np.cumsum(np.array(found, np.int64)[codes])))
        return total[first[1:]] - total[first[:-1]]


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(
    docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than limit tokens).

    path is a tokenizer's file on every worker: .json for the tokenizers library, .model for sentencepiece.  Nothing is
    added before or after a text, nothing is cut off; special strings inside a text count as the library counts them.
    Null and empty texts have 0 bytes and 0 tokens.  Repeated rows and rows without an id are counted each; other columns
    are not read; an empty table gives no rows.  Where no safe boundary is known (see can_cut), whole texts are encoded.
    """

    @F.arrow_udf("bigint")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(path)
        for texts in batches:
            found = [counter.counts(block) for block in blocks(texts, size=BATCH_BYTES)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    counted = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        lengths(text).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
