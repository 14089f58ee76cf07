"""Equi-joins against one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_keyed(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join rows to a reduced side (distinct keys, winners, counts).

    A side that was just aggregated is already partitioned by its key, and AQE
    does not split skewed partitions of a join that reads such a side without
    a shuffle of its own.  The hash as a second key asks for that shuffle, of
    one row per key, so a hot key of the left side is split over tasks.  When
    the reduced side is small enough to be broadcast, nothing is shuffled.
    """
    keys = [F.col(k) for k in on]
    for name in on:
        a, b = left.schema[name].dataType, right.schema[name].dataType
        if a != b:
            if not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
                raise ValueError(f"{name} is {a.simpleString()} and {b.simpleString()}")
            # the hash depends on the width, the equality does not
            keys = [F.col(k).cast("string") for k in on]
    hashed = F.xxhash64(*keys).alias("_split")
    joined = left.select("*", hashed).join(right.select("*", hashed), [*on, "_split"], how)
    return joined.drop("_split")
