"""Corpus file names: `pubmed<YY>n<NNNN>.xml.gz`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.text import as_int

# Forms of the names.
GZ_SUFFIX = ".gz"
CORPUS_PARTS = r"^pubmed(\d{2})n(\d+)\.xml(?:\.gz)?$"
CORPUS_NAME = r"(pubmed\d{2}n\d{4,}\.xml(?:\.gz)?)(?:/[^/]*)?$"


def corpus_year(name: Column) -> Column:
    return as_int(F.substring(name, 7, 2))


def corpus_number(name: Column) -> Column:
    """Number of a corpus file, however many digits it has; NULL for other names."""
    return F.regexp_extract(name, CORPUS_PARTS, 2).try_cast("bigint")


def file_rank(name: Column) -> Column:
    """What files are ordered by: year, number, name.

    Two-digit years are numbers (99 comes after 21).  Other names rank by name, before all corpus files.
    """
    year = F.regexp_extract(name, CORPUS_PARTS, 1).try_cast("int")
    return F.struct(year.alias("year"), corpus_number(name).alias("number"), name.alias("name"))


def is_gz(name: Column) -> Column:
    return name.endswith(GZ_SUFFIX)


def corpus_name(path: Column) -> Column:
    """Corpus file a path belongs to.

    A corpus file may also be a folder of that name holding its part, as Spark
    writes it; any other path gives its last step.
    """
    named = F.regexp_extract(path, CORPUS_NAME, 1)
    return F.when(named != "", named).otherwise(base_name(path))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def root_name(name: Column) -> Column:
    return F.regexp_replace(name, r"\.xml(\.gz)?$", "")
