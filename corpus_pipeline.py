"""A training corpus from documents: quality, exact and near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result is written as Parquet and read
again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.llm import quality
from citeloom.llm.exact_dedup import exact_dedup
from citeloom.llm.minhash_dedup import near_duplicates
from citeloom.llm.packing import pack_documents
from citeloom.llm.shared import documents, stored
from citeloom.llm.surrogates import replace_personal_data, session_key

#: Of a row's number, the bits for its place in a file.
FILE_BITS = 40


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.with_quality(docs, model).where("kept").select("row.*")


def _placed(docs: DataFrame) -> DataFrame | None:
    """Rows of Parquet files with their places: row and n, file number and row in the file.

    None where docs are not whole files: the numbers would not tell their rows apart.
    """
    try:
        placed = docs.select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("at"),
            F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        )
    except AnalysisException:
        return None
    # one row per file; rows 0 to rows - 1 have these sums
    files = placed.groupBy("file").agg(
        F.count("at").alias("rows"), F.max("at").alias("last"), F.sum("at").alias("sum"),
        F.sum(F.col("at").cast("decimal(20,0)") * F.col("at")).alias("squares"), F.count(F.lit(1)).alias("all"),
    )
    numbers = F.row_number().over(Window.orderBy("file")).cast("bigint")
    files = stored(files.withColumn("number", numbers), "files")
    last = F.col("rows").cast("decimal(20,0)") - 1
    whole = (
        F.col("file").isNotNull() & (F.col("rows") == F.col("all")) & (F.col("last") == last)
        & (F.col("sum") * 2 == F.col("rows") * last) & (F.col("squares") * 6 == F.col("rows") * last * (2 * last + 1))
    )
    if not files.where(~F.coalesce(whole, F.lit(False))).isEmpty():
        return None
    number = F.shiftleft("number", FILE_BITS) + F.col("at")
    return placed.join(F.broadcast(files.select("file", "number")), "file").select(number.alias("n"), "row")


def _numbered(docs: DataFrame) -> DataFrame:
    """Every row of docs as row, with a number of its own, its id and its text.

    Rows of files are numbered by their places in them; others are written once, so that numbers stay.
    """
    rows = _placed(docs)
    if rows is None:
        row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
        rows = stored(docs.select(F.monotonically_increasing_id().alias("n"), row), "numbered")
    return rows.select("n", F.col("row.doc_id").cast("bigint").alias("id"), F.col("row.text").alias("text"), "row")


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose number is none of those of gone, in the columns they came with.

    The numbers travel as bitmaps, a bit per row, so that no text is shuffled.
    """
    bucket = F.bitmap_bucket_number("n")
    bits = stored(gone.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")), "gone")
    marked = rows.withColumn("bucket", bucket).join(F.broadcast(bits), "bucket", "left")
    at = F.bitmap_bit_position("n")
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_gone = F.getbit(byte, (at % 8).cast("int")) == 1
    return marked.where(F.col("bits").isNull() | ~is_gone).select("row.*")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, one of the largest doc_id."""
    rows = _numbered(docs)
    found = stored(exact_dedup(rows, "id", "text", row_col="n").select(F.col("row").alias("n"), "digest", "kept"), "exact-groups")
    first = found.where("kept").groupBy("digest").agg(F.min("n").alias("n"))
    return _without(rows, found.join(first.select("n"), "n", "left_anti"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, one of the smallest doc_id; rows without an id come last."""
    rows = _numbered(docs)
    found = near_duplicates(rows, "n", "text").select(F.col("id").alias("n"), F.col("component_id").alias("component"))
    found = stored(found.join(rows.select("n", "id"), "n"), "near-groups")
    rank = F.struct(F.col("id").isNull(), "id", "n")
    first = found.groupBy("component").agg(F.min_by("n", rank).alias("n"))
    return _without(rows, found.join(first.select("n"), "n", "left_anti"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; n_chars, where there is one, follows the text where that changed."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    bare = replace_personal_data(docs.select("text", row), session_key(spark))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_entities") > 0, F.char_length("text")).otherwise(F.col("row.n_chars"))
        new["n_chars"] = size.cast("bigint")
    return bare.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of the documents packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("personal_data", private_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the fit of the classifiers nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
