"""What the operators share: tables in the shared folder, Arrow stages, input columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.plans.scratch import new_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row (a hash of both that tells rows of one id apart) and text."""
    id_, text = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`")
    return docs.select(id_.alias("id"), F.xxhash64(id_, text).alias("row"), text.alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: the rows as a Parquet table in the folder that executors share."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_join(left: DataFrame, right: DataFrame, on: str | Column) -> DataFrame:
    """An inner join that broadcasts neither side.

    For sides that were opened from arrays, or whose files hold long values that repeat: Spark takes such rows for no larger
    than those they came from, or than their files, and would send many times its broadcast threshold through the driver.
    """
    return left.join(right.hint("merge"), on)


def arrow_stage(
    df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, types: pa.Schema
) -> DataFrame:
    """step turns a batch of df's rows into columns of the result, one batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in types], schema=types)

    return df.mapInArrow(run, schema)
