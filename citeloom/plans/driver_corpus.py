"""Change rows of the driver tables written as a citation XML corpus.

Each corpus file is a folder `file=<name>` with one gzipped part: a header
line, its articles in order, its delete entries, a footer line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.operators.changes import DELETE

HEADER, ARTICLE, DELETED, FOOTER = range(4)


def _article(row_tag: str):
    """XML text of a change row (pmid, doi, journal_name, journal_year)."""
    citation = F.struct(
        F.lit("NLM").alias("_Owner"),
        F.lit("MEDLINE").alias("_Status"),
        F.struct(
            F.lit("1").alias("_Version"), F.col("pmid").cast("string").alias("_VALUE")
        ).alias("PMID"),
        F.struct(
            F.struct(
                F.struct(
                    F.lit("Print").alias("_CitedMedium"),
                    F.col("journal_volume").alias("Volume"),
                    F.struct(
                        F.col("journal_year").cast("string").alias("Year"),
                        F.col("journal_month").alias("Month"),
                    ).alias("PubDate"),
                ).alias("JournalIssue"),
                F.col("journal_name").alias("Title"),
            ).alias("Journal"),
            F.lit("Title").alias("ArticleTitle"),
        ).alias("Article"),
    )
    ids = F.struct(
        F.array(
            F.struct(
                F.lit("pubmed").alias("_IdType"),
                F.col("pmid").cast("string").alias("_VALUE"),
            ),
            F.struct(F.lit("doi").alias("_IdType"), F.col("doi").alias("_VALUE")),
        ).alias("ArticleId")
    )
    data = F.struct(ids.alias("ArticleIdList"))
    record = F.struct(citation.alias("MedlineCitation"), data.alias("PubmedData"))
    return F.to_xml(record, {"rowTag": row_tag})


def write_corpus(rows: DataFrame, path: str) -> str:
    """Write (file_name, op, seq, pmid, doi, journal_*) rows; returns the path."""
    pmid = F.struct(
        F.struct(
            F.lit("1").alias("_Version"), F.col("pmid").cast("string").alias("_VALUE")
        ).alias("PMID")
    )
    deleted = F.col("op") == DELETE
    records = rows.select(
        F.col("file_name").alias("file"),
        F.when(deleted, F.lit(DELETED)).otherwise(F.lit(ARTICLE)).alias("kind"),
        "seq",
        F.when(deleted, F.to_xml(pmid, {"rowTag": "DeleteCitation"}))
        .otherwise(_article("PubmedArticle"))
        .alias("value"),
    )
    return write_lines(records, path)


def write_lines(records: DataFrame, path: str) -> str:
    """Write (file, kind, seq, value) records, each file framed by its root tags."""
    frame = F.array(
        F.struct(F.lit(HEADER).alias("kind"), F.lit("<PubmedArticleSet>").alias("value")),
        F.struct(F.lit(FOOTER).alias("kind"), F.lit("</PubmedArticleSet>").alias("value")),
    )
    ends = records.select("file").distinct()
    ends = ends.select("file", F.inline(frame)).withColumn("seq", F.lit(0).cast("bigint"))
    lines = records.unionByName(ends)
    # one gzip file is one unit of work anyway, so one task writes it
    lines = lines.repartition("file").sortWithinPartitions("file", "kind", "seq")
    out = lines.select("file", "value").write.partitionBy("file")
    out.option("compression", "gzip").text(path)
    return path
