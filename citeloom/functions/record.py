"""The parts of an article record as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def citation() -> Column:
    return F.col("MedlineCitation")


def article() -> Column:
    return citation()["Article"]


def at(path: str) -> Column:
    """A field of the citation by its dotted path."""
    return F.col("MedlineCitation." + path)


def pubmed_data() -> Column:
    return F.col("PubmedData")


def reference_lists() -> Column:
    """The reference lists in document order, each followed by the lists nested in it."""

    def plain(one: Column) -> Column:
        return F.struct(one["Title"].alias("Title"), one["Reference"].alias("Reference"))

    def with_nested(one: Column) -> Column:
        nested = F.transform(one["ReferenceList"], plain)
        return F.when(nested.isNull(), F.array(plain(one))).otherwise(F.concat(F.array(plain(one)), nested))

    return F.flatten(F.transform(pubmed_data()["ReferenceList"], with_nested))
