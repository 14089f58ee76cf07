"""Ordinals and first/last flags of flat child rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.operators.joins import join_keyed
from citeloom.plans.scratch import checkpoint


def ordinal_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ordinal"
) -> DataFrame:
    """Add the 0-based position of each row in its group; NULL keys are a group.

    All rows are sorted across tasks by key and order, cut wherever the range
    partitioner likes, and each piece of a group is shifted by the size of the
    pieces before it: a group of any size costs no task more than its share.
    """
    placed = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_piece", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    # the range bounds are sampled, so the placement is written down once
    placed = checkpoint(placed)
    pieces = placed.groupBy(*keys, "_piece").agg(
        F.min("_at").alias("_start"), F.count("*").alias("_rows")
    )
    # a key has at most one piece per partition
    before = (
        Window.partitionBy(*keys)
        .orderBy("_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    pieces = pieces.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_piece").alias("_own_piece"),
        "_start",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    same = F.col("_piece") == F.col("_own_piece")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    position = F.col("_before") + F.col("_at") - F.col("_start")
    return placed.join(pieces, same).select(*df.columns, position.alias(name))


def edge_flags(df: DataFrame, key: str, order: str) -> DataFrame:
    """Add `n_items`, `is_first` and `is_last` of each group by its order column.

    The group's edges come from a small aggregate that is joined back, so no
    task holds a whole group.
    """
    edges = df.groupBy(key).agg(
        F.min(order).alias("_low"),
        F.max(order).alias("_high"),
        F.count("*").cast("int").alias("n_items"),
    )
    return (
        join_keyed(df, edges, [key], "inner")
        .withColumn("is_first", F.col(order) == F.col("_low"))
        .withColumn("is_last", F.col(order) == F.col("_high"))
        .drop("_low", "_high")
    )


def child_counts(parents: DataFrame, children: DataFrame, key: str = "pmid") -> DataFrame:
    """Number of children of each parent, 0 when it has none."""
    counts = children.groupBy(key).agg(F.count("*").alias("n_children"))
    joined = join_keyed(parents.select(key), counts, [key], "left")
    return joined.select(key, F.coalesce("n_children", F.lit(0)).cast("int").alias("n_children"))
