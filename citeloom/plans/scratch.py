"""Shared scratch space and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints, else one in the session's warehouse."""
    named = spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    spark.sparkContext.setCheckpointDir(f"{warehouse}/citeloom-checkpoints")
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/citeloom/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores when a scan has fewer partitions than there are cores.

    A few unsplittable files would otherwise keep most cores idle under a
    CPU-heavy projection.  A scan that already has enough partitions is
    returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
