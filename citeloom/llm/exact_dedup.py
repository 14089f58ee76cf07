"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries of every partition, merged, name all digests that may hold more than 1/counters of the rows.  A
second pass counts those exactly and finds their winners; there are at most `counters` of them, which bounds what is
broadcast.  Rows of heavy digests meet their winner at the map side; all other digests, each at most 1/counters of the
rows, are grouped by an ordinary shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.shared import arrow_stage, identified, stored

COUNTERS = 1024


def text_digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """id, row (row_col, or else a hash of id and text) and SHA-256 of the text with A-Z lower-cased, in UTF-8; null counts as empty."""
    types = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("digest", pa.binary())])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(2).cast(pa.large_binary())
        digests = [hashlib.sha256((t.as_buffer().to_pybytes() if t.is_valid else b"").lower()).digest() for t in texts]
        yield {"id": batch.column(0), "row": batch.column(1), "digest": digests}

    source = identified(docs, id_col, text_col)
    if row_col:
        source = docs.select(
            F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{row_col}`").alias("row"), F.col(f"`{text_col}`").alias("text")
        )
    return arrow_stage(source, step, "id bigint, row bigint, digest binary", types)


def misra_gries(counts: dict, counters: int) -> dict:
    """A summary of at most `counters` keys: the largest count that must go is taken off every key.

    Taken off again and again while keys are added, counts are too low by n / (counters + 1) at most.
    """
    if len(counts) <= counters:
        return counts
    off = sorted(counts.values(), reverse=True)[counters]
    return {k: n - off for k, n in counts.items() if n > off}


def heavy_candidates(keys: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """digest of every key with more than 1/counters of the rows, and maybe some others; at most `counters` rows.

    Every partition keeps a summary of `counters` keys, whose counts are too low by its rows / (counters + 1) at most.
    Their sums are too low by all rows / (counters + 1) at most, so a key with more than 1/counters of the rows is
    still there; of the sums, the `counters` largest can hold all such keys.
    """
    types = pa.schema([("digest", pa.binary()), ("n", pa.int64())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for key in batch.column(0).to_pylist():
                counts[key] = counts.get(key, 0) + 1
            counts = misra_gries(counts, counters)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=types
            )

    parts = keys.select("digest").mapInArrow(summarise, "digest binary, n bigint")
    sums = parts.groupBy("digest").agg(F.sum("n").alias("n"))
    return sums.orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def exact_groups(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Rows (id, row, digest) with keep_id, the largest id of the digest, and group_size.

    Repeated rows each count and each come back.  A null id never wins, unless all ids of a group are null.
    """
    found = F.broadcast(heavy_candidates(digests, counters))
    heavy = (
        digests.join(found, "digest")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    heavy = stored(heavy, "heavy-digests")  # at most `counters` rows
    marked = digests.join(
        F.broadcast(heavy.withColumnRenamed("digest", "heavy_digest")), F.col("digest") == F.col("heavy_digest"), "left"
    )
    hot = marked.where(F.col("heavy_digest").isNotNull()).drop("heavy_digest")
    rest = marked.where(F.col("heavy_digest").isNull()).select("id", "row", "digest")
    winners = rest.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return hot.select("id", "row", "digest", "keep_id", "group_size").unionByName(
        rest.join(winners, "digest").select("id", "row", "digest", "keep_id", "group_size")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS, row_col: str | None = None
) -> DataFrame:
    """One row per row of docs: id, row (the bigint row_col, or else a hash of id and text), digest, keep_id, group_size, kept (id = keep_id).

    Texts are equal if they are identical after lower-casing A-Z; null is empty.  Of equal texts the largest id stays.
    Of repeated rows with the same id all are kept together.  Other columns of docs are not read; an empty table gives
    no rows.
    """
    digests = stored(text_digests(docs, id_col, text_col, row_col), "text-digests")
    return exact_groups(digests, counters).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
