"""Upserts and deletes by key: the last writer wins.

A change row is (pmid, op, file_name, seq, ...) with op `U` or `D`.  Writers
are ordered by file (year, number, name), then deletes after upserts of the same file (the
delete list ends its file), then document order.  The order is a property of
the rows, so changes may arrive in any order and any number of times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.files import file_rank
from citeloom.operators.joins import join_keyed

UPSERT, DELETE = "U", "D"


def is_delete() -> Column:
    return F.col("op") == F.lit(DELETE)


def document_order() -> list[Column]:
    return [file_rank(F.col("file_name")), is_delete(), F.col("seq")]


def latest(
    changes: DataFrame, key: str = "pmid", order: Sequence[Column] | None = None
) -> DataFrame:
    """The winning change of each key, deletes included.

    A `max_by` aggregate and not a window: each map task keeps one row per
    key before the shuffle, so a key with a third of all rows costs no more
    than any other.
    """
    rest = [c for c in changes.columns if c != key]
    rank = F.struct(*(order or document_order()))
    winner = changes.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("w"))
    return winner.select(key, "w.*").select(*changes.columns)


def snapshot(
    changes: DataFrame, key: str = "pmid", order: Sequence[Column] | None = None
) -> DataFrame:
    """Rows alive after all changes."""
    return latest(changes, key, order).filter(F.col("op") == F.lit(UPSERT))


def deletion_log(changes: DataFrame) -> DataFrame:
    """One row per delete entry, with the file that brought it."""
    return changes.filter(is_delete()).select("pmid", "file_name")


def article_changes(articles: DataFrame, deletes: DataFrame) -> DataFrame:
    """Change rows of one scan: articles as upserts, delete lists as deletes.

    `articles` has (pmid, file_name, seq), as `deletes` has.
    """
    columns = ["pmid", "op", "file_name", "seq"]
    return (
        articles.withColumn("op", F.lit(UPSERT))
        .select(columns)
        .unionByName(deletes.withColumn("op", F.lit(DELETE)).select(columns))
    )


def cascade(children: DataFrame, deleted: DataFrame, key: str = "pmid") -> DataFrame:
    """Children left after their parents' delete."""
    return join_keyed(children, deleted.select(key), [key], "left_anti")


def with_parent(children: DataFrame, parents: DataFrame, key: str = "pmid") -> DataFrame:
    return join_keyed(children, parents.select(key), [key], "left_semi")


def orphans(children: DataFrame, parents: DataFrame, key: str = "pmid") -> DataFrame:
    """Children whose key no parent has."""
    return join_keyed(children, parents.select(key), [key], "left_anti")
