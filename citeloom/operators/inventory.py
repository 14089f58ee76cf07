"""File listings: what is missing, what is not applied, what is an update."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import files

# Last baseline file number of each corpus year.
LAST_BASELINE = {21: 1062}


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Names and sizes of the `.gz` files of a folder; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*" + files.GZ_SUFFIX)
        .load(path)
    )
    return found.select(
        files.corpus_name(F.col("path")).alias("file_name"), "path", "length"
    )


def gz_sorted(listing: DataFrame) -> DataFrame:
    return listing.filter(files.is_gz(F.col("file_name"))).orderBy(files.file_rank(F.col("file_name")))


def combine(baseline: DataFrame, updates: DataFrame) -> DataFrame:
    """Append two listings (or two pages of one); nothing is deduplicated."""
    return baseline.unionByName(updates)


def not_in(listing: DataFrame, other: DataFrame) -> DataFrame:
    return listing.join(other.select("file_name"), "file_name", "left_anti")


def missing(remote: DataFrame, mirror: DataFrame) -> DataFrame:
    """Remote files that the mirror does not hold."""
    return not_in(remote, mirror)


def unapplied(mirror: DataFrame, applied: DataFrame) -> DataFrame:
    """Mirrored `.gz` files that the ledger does not name, in file order."""
    return gz_sorted(not_in(mirror, applied))


def after(listing: DataFrame, key: str) -> DataFrame:
    """Lower bound, exclusive: by file order for a corpus file's name, else by name."""
    name = F.col("file_name")
    if re.search(files.CORPUS_PARTS, key):
        return listing.filter(files.file_rank(name) > files.file_rank(F.lit(key)))
    return listing.filter(name > F.lit(key))


def file_kind(
    listing: DataFrame, last_baseline: dict[int, int] = LAST_BASELINE
) -> DataFrame:
    """Add year, number and kind: `baseline`, `update` or `reject`."""
    name = F.col("file_name")
    pairs = [F.lit(x) for item in last_baseline.items() for x in item]
    last = F.element_at(F.create_map(*pairs), F.col("file_year"))
    kind = (
        F.when(F.col("last").isNull() | F.col("file_number").isNull(), "reject")
        .when(F.col("file_number") > F.col("last"), "update")
        .otherwise("baseline")
    )
    return (
        listing.withColumn("file_year", files.corpus_year(name))
        .withColumn("file_number", files.corpus_number(name))
        .withColumn("last", last)
        .withColumn("kind", kind)
        .drop("last")
    )
