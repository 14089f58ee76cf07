"""Scans of the citation XML corpus.

A file is read once, as text, in pieces that end with an article's end tag; each piece is opened into its records (articles,
delete lists, book articles), told apart by their tags, and each record is parsed by itself.  So one scan gives articles and
deletes, and a malformed record loses nothing but itself.  A gzip file cannot be split, so one file is one task; the corpus
is many files of moderate size, which is where the parallelism comes from.  Files that are not compressed are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.functions.files import corpus_name
from citeloom.functions.ids import article_id
from citeloom.functions.text import TAG_END, TAG_START, as_key
from citeloom.sources import schemas

CORRUPT = "_corrupt_record"
MODES = ("FAILFAST", "PERMISSIVE")
#: Kinds of records; END marks the piece that has a file's end tag.
ARTICLE, DELETES, BOOK, END = "article", "deletes", "book", "end"
PARSE = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # the flat relations keep surrounding blanks; documents strip them later
    "ignoreSurroundingSpaces": "false",
}
_MIXED = "|".join(schemas.MIXED_ELEMENTS)
#: A tag inside an element of mixed content: it follows the element's start tag or another such tag, with text between.
INLINE_TAG = (
    rf"(\G(?!\A)|<(?:{_MIXED})(?:\s[^<>]*)?>)([^<]*)"
    rf"<((?!/?(?:{_MIXED})[\s>/])/?[\w:.-]+(?:\s[^<>]*)?/?)>"
)
#: The first of them: texts without one, which are most, are told by a search that only looks at signs `<`.
FIRST_INLINE_TAG = rf"<(?:{_MIXED})(?:\s[^<>]*)?>[^<]*<(?!/?(?:{_MIXED})[\s>/])/?[\w:.-]+(?:\s[^<>]*)?/?>"


def _pieces(source, paths) -> DataFrame:
    """Text up to each end tag of an article, in document order, with its file."""
    text = source.format("text").option("lineSep", f"</{schemas.ARTICLE_TAG}>").load(paths)
    return text.select("value", corpus_name(F.col("_metadata.file_path")).alias("file_name"))


def _records(opened: Column) -> Column:
    """array<kind, text> of a piece split at the start tags of articles: what stands before the article, then the article.

    An article whose end tag is missing runs into the start of the next one: a record of its own, which does not parse.
    """
    before = F.get(opened, F.lit(0))

    def of(kind: str, texts: Column) -> Column:
        return F.transform(texts, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("text")))

    def elements(tag: str) -> Column:
        found = F.regexp_extract_all(before, F.lit(rf"(?s)<{tag}(?:\s[^<>]*)?>.*?</{tag}>"), F.lit(0))
        return F.when(before.contains(f"<{tag}"), found).otherwise(F.array().cast("array<string>"))

    start, end = F.lit(f"<{schemas.ARTICLE_TAG}"), F.lit(f"</{schemas.ARTICLE_TAG}>")
    articles = F.transform(F.slice(opened, 2, F.greatest(F.size(opened) - 1, F.lit(0))), lambda x: F.concat(start, x, end))
    last = F.when(before.contains(f"</{schemas.ROOT_TAG}>"), F.array(F.lit("")))
    return F.concat(
        of(BOOK, elements(schemas.BOOK_TAG)),
        of(DELETES, elements(schemas.DELETE_TAG)),
        of(END, F.coalesce(last, F.array().cast("array<string>"))),
        of(ARTICLE, articles),
    )


def prepared(article: Column) -> Column:
    """An article's text ready to be parsed into `schemas.PUBMED_ARTICLE`.

    Tags within mixed content become marked text, so that element is one string; reference lists inside a list are drawn
    out to follow it, at any depth.  The format puts a list's own references before the lists in it, so document order stays.
    """
    flat = F.regexp_replace(article, r"</ReferenceList>\s*(?=</ReferenceList>)", "")
    flat = F.regexp_replace(
        flat, r"(</Reference>|</Title>|<ReferenceList(?:\s[^<>]*)?>)\s*(?=<ReferenceList[\s>])", "$1</ReferenceList>"
    )
    flat = F.when(article.contains("ReferenceList"), flat).otherwise(article)
    marked = F.regexp_replace(flat, INLINE_TAG, f"$1$2{TAG_START}$3{TAG_END}")
    return F.when(article.rlike(FIRST_INLINE_TAG), marked).otherwise(flat)


def _parsed(pieces: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per record: kind, file_name, MedlineCitation, PubmedData, deletes, raw (of a record that does not parse)."""
    # a column of its own: a generator would split anew at each use
    opened = pieces.select("file_name", F.split("value", rf"<{schemas.ARTICLE_TAG}(?=[\s>])").alias("opened"))
    records = opened.select("file_name", F.inline(_records(F.col("opened"))))
    corrupt = T.StructField(CORRUPT, T.StringType())
    article = T.StructType([*schema.fields, corrupt])
    deletes = T.StructType([*schemas.DELETE_CITATION.fields, corrupt])
    read = records.select(
        "*",
        F.when(F.col("kind") == ARTICLE, F.from_xml(prepared(F.col("text")), article, PARSE)).alias("a"),
        F.when(F.col("kind") == DELETES, F.from_xml("text", deletes, PARSE)).alias("d"),
    )
    bad = F.coalesce(F.col(f"a.{CORRUPT}"), F.col(f"d.{CORRUPT}")).isNotNull()
    return read.select(
        "kind",
        "file_name",
        F.when(~bad, F.col("a.MedlineCitation")).alias("MedlineCitation"),
        F.when(~bad, F.col("a.PubmedData")).alias("PubmedData"),
        F.when(~bad, F.col("d.PMID._VALUE")).alias("deletes"),
        bad.alias("is_corrupt"),
        F.when(bad, F.col("text")).alias("raw"),
    )


def _checked(records: DataFrame, mode: str) -> DataFrame:
    """With FAILFAST, reading anything of a malformed record fails."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "PERMISSIVE":
        return records
    message = F.concat(F.lit("malformed record in "), F.col("file_name"), F.lit(": "), F.substring("raw", 1, 200))

    def guarded(field: T.StructField) -> Column:
        failed = F.raise_error(message).cast(field.dataType)
        return F.when(F.col("is_corrupt"), failed).otherwise(F.col(field.name)).alias(field.name)

    names = ("MedlineCitation", "PubmedData", "deletes", "is_corrupt")
    return records.select(*(guarded(f) if f.name in names else f.name for f in records.schema))


def scan_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "FAILFAST",
    schema: T.StructType = schemas.PUBMED_ARTICLE,
) -> DataFrame:
    """Every record of the files in one scan: articles, delete lists, books, and the end of each file.

    `seq` is the document order in the file: it grows along a file, and a re-run of the task gives the same order.  With
    `mode="PERMISSIVE"` a malformed record is a row whose `is_corrupt` is true, whose structs are NULL and whose text is
    in `raw`.  A file without an END row was cut off.  Of articles, what `schema` (`schemas.article_of`) leaves out is
    skipped, not parsed: Spark does not prune the schema of XML by what is read later.
    """
    return _checked(_parsed(_pieces(spark.read, paths), schema), mode).withColumn("seq", F.monotonically_increasing_id())


def scan_articles(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "FAILFAST",
    schema: T.StructType = schemas.PUBMED_ARTICLE,
) -> DataFrame:
    """Articles with `file_name` and `seq`, their document order in the file."""
    found = scan_records(spark, paths, mode, schema).filter(F.col("kind") == ARTICLE)
    return found.select("MedlineCitation", "PubmedData", "file_name", "seq", "is_corrupt", "raw")


def deleted(records: DataFrame) -> DataFrame:
    """Every PMID of the delete lists among records: (value, pmid, file_name, seq).

    `value` is the PMID as written, for those that are no number.
    """
    opened = records.filter(F.col("kind") == DELETES).select(
        F.posexplode("deletes").alias("at", "value"), "file_name", "seq"
    )
    return opened.select(
        "value",
        as_key(F.col("value")).alias("pmid"),
        "file_name",
        # lists may follow each other in a file
        (F.col("seq") + F.col("at")).alias("seq"),
    )


def scan_deletes(
    spark: SparkSession, paths: str | Sequence[str], mode: str = "FAILFAST"
) -> DataFrame:
    """Every PMID of the files' delete lists: (value, pmid, file_name, seq)."""
    return deleted(scan_records(spark, paths, mode).filter("kind = 'deletes'"))


def stream_records(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = 100,
    schema: T.StructType = schemas.PUBMED_ARTICLE,
) -> DataFrame:
    """Records of new files as a stream: kind, file_name, MedlineCitation, PubmedData, deletes, is_corrupt, raw."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    pieces = _pieces(reader, path)
    cores = spark.sparkContext.defaultParallelism
    if max_files_per_trigger < cores:
        # a file is read by one task; its pieces are parsed by all
        pieces = pieces.repartition(cores, "value")
    return _parsed(pieces, schema)


def stream_articles(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int = 100,
    schema: T.StructType = schemas.PUBMED_ARTICLE,
) -> DataFrame:
    """Articles of new files as a stream, with their file name; reading anything of a malformed one fails the stream."""
    records = _checked(stream_records(spark, path, max_files_per_trigger, schema), "FAILFAST")
    # by kind only: a filter on what was parsed is pushed down and parses every record again
    return records.filter(F.col("kind") == ARTICLE).select("MedlineCitation", "PubmedData", "file_name")


def stream_deletes(
    spark: SparkSession, path: str, max_files_per_trigger: int = 100
) -> DataFrame:
    """(value, pmid, file_name) of the delete lists of new files as a stream."""
    records = _checked(stream_records(spark, path, max_files_per_trigger), "FAILFAST")
    opened = records.filter(F.col("kind") == DELETES)
    opened = opened.select(F.explode("deletes").alias("value"), "file_name")
    return opened.select("value", as_key(F.col("value")).alias("pmid"), "file_name")


def records_per_file(articles: DataFrame, deletes: DataFrame | None = None) -> DataFrame:
    """Records, records with a DOI and delete lists of each file."""
    counted = articles.select(
        "file_name",
        F.lit(1).alias("is_article"),
        (article_id(F.col("PubmedData"), "doi") != "").cast("int").alias("has_doi"),
        F.lit(0).alias("is_delete"),
    )
    if deletes is not None:
        counted = counted.unionByName(
            deletes.select(
                "file_name",
                F.lit(0).alias("is_article"),
                F.lit(0).alias("has_doi"),
                F.lit(1).alias("is_delete"),
            )
        )
    return counted.groupBy("file_name").agg(
        F.sum("is_article").alias("n_articles"),
        F.sum("has_doi").alias("n_doi"),
        F.sum("is_delete").alias("n_deleted"),
    )


def count_books(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Book articles per file; they are counted, not shredded."""
    books = scan_records(spark, paths, "PERMISSIVE").filter(F.col("kind") == BOOK)
    return books.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_books"))
