"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.shared import stored


def _least(edges: DataFrame) -> DataFrame:
    """For each u the least of itself and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the edges (a, b); component is the least id that can be reached.

    Each round joins the edges with one row per node, so a node of very many edges is split like any skewed key.  Rounds
    end when the edges are stars around the least ids, which takes about the logarithm of the longest path.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges"
    )
    seen = None
    while (print_ := _fingerprint(now)) != seen:
        seen = print_
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = _least(large)
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = stored(small, "edges")
    ids = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
