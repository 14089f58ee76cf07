"""Bibliographic views over the driver tables.

The driver has no citation XML, so its tables are read as identifiers, change
rows, file names and nested articles.  Each view is a projection of whole
tables; nothing is filtered, capped or cut.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.plans.scratch import spread
from citeloom.sources import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts) -> Column:
    """Concatenate columns and literals as text."""
    return F.concat(
        *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts]
    )


def build(schema: T.DataType, value) -> Column:
    """Column of a nested type from a dict; what the dict leaves out is NULL."""
    if isinstance(value, dict):
        unknown = set(value) - set(schema.fieldNames())
        if unknown:
            raise ValueError(f"no such fields: {sorted(unknown)}")
        fields = [build(f.dataType, value.get(f.name)).alias(f.name) for f in schema]
        return F.struct(*fields)
    if value is None:
        return F.lit(None).cast(schema)
    if isinstance(value, Column):
        # nested values are built with their type; a cast that changes no more than nullability would copy every item
        return value if isinstance(schema, T.StructType | T.ArrayType) else value.cast(schema)
    return F.lit(value).cast(schema)


def items(schema: T.ArrayType, source: Column, make) -> Column:
    """Array of nested items, one per item of `source`; `make(x, i)` is a dict."""
    return F.transform(source, lambda x, i: build(schema.elementType, make(x, i)))


def bib_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    pair = F.expr("o_orderkey div 2")
    return orders.select(
        key.alias("pmid"),
        F.when(key % 7 == 0, F.lit("")).otherwise(text("10.1000/X", pair)).alias("doi"),
        F.col("o_orderpriority").alias("journal_name"),
        F.col("o_custkey").cast("string").alias("journal_volume"),
        F.year("o_orderdate").alias("journal_year"),
        F.month("o_orderdate").cast("string").alias("journal_month"),
    )


def bib_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("pmid"),
        F.when(F.col("event_type") == "error", F.lit("D"))
        .otherwise(F.lit("U"))
        .alias("op"),
        event_file().alias("file_name"),
        F.col("event_id").alias("seq"),
        text("10.2000/", F.col("event_id")).alias("doi"),
    )


def event_file() -> Column:
    number = F.lpad(F.dayofmonth("ts").cast("string"), 4, "0")
    return text("pubmed24n", number, ".xml.gz")


def bib_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names seen in the events."""
    events = table(spark, sf_dir, "events")
    return events.select(event_file().alias("file_name")).distinct()


def bib_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of the first twenty days."""
    events = table(spark, sf_dir, "events").filter(F.dayofmonth("ts") <= 20)
    return events.select(event_file().alias("file_name")).distinct()


CHILD_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
]


def bib_child_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat child rows with their order columns; ordinals are the operator's job."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("pmid"),
        *CHILD_ORDER,
        text("D", F.col("l_partkey")).alias("ui_id"),
        text(F.col("l_returnflag"), F.col("l_linestatus")).alias("value"),
    )


def bib_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        F.col("conv_id").alias("pmid"),
        F.col("turn").alias("auth_order"),
        (F.col("role") == "system").alias("is_collective"),
        F.col("text").alias("last_name"),
    )


#: After a list's name in `only`: the number of its items is read (of key words, and of those in each list), not what they hold.
SIZE = "#"

_PLANS: dict[tuple, DataFrame] = {}


def bib_articles(
    spark: SparkSession, sf_dir: str, per_file: int | None = None, only: Collection[str] | None = None
) -> DataFrame:
    """Documents as nested articles; the unexecuted plan is kept for the session.

    `per_file` clusters them by `doc_id` in ranges of that size, while they are still documents: articles are many times
    their text.  `only` names the fields of the citation, its article and the PubmedData that a query reads, the others are
    NULL: a scan prunes what is not read of a nested column, a projection that Spark does not merge with its reader cannot.

    Putting the few hundred expressions together takes seconds, so they are
    built once.  No data is cached.
    """
    key = (spark.sparkContext.applicationId, sf_dir, per_file, None if only is None else frozenset(only))
    if key not in _PLANS:
        _PLANS[key] = _articles(spark, sf_dir, per_file, only)
    return _PLANS[key]


def _pruned(value: dict, only: Collection[str] | None) -> dict:
    return value if only is None else {name: v for name, v in value.items() if name in only or name + SIZE in only}


def _articles(spark: SparkSession, sf_dir: str, per_file: int | None, only: Collection[str] | None) -> DataFrame:
    """Lines and words become the children; `labels` gives the PubmedData side."""
    docs = table(spark, sf_dir, "documents")
    if per_file is None:
        # one CPU-heavy projection per text: use every core even for a single file
        docs = spread(docs, "doc_id")
    # one row a document: where no relation reads PubmedData, Spark leaves the join out
    labels = (
        table(spark, sf_dir, "labels")
        .groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    d = F.col("doc_id")
    n = F.col("n_chars")
    lang, source, body = F.col("lang"), F.col("source"), F.col("text")
    lines = F.split(body, "\n")
    a = schemas.ARTICLE
    mc = schemas.MEDLINE_CITATION
    pd = schemas.PUBMED_DATA

    def inner(struct: T.StructType, *path: str):
        t = struct
        for name in path:
            t = t.elementType if isinstance(t, T.ArrayType) else t
            t = t[name].dataType
        return t

    def read(name: str, make):
        """`make`, or items without values where only their number is read."""
        return make if only is None or name + SIZE not in only else lambda x, i: {}

    def words(line: Column) -> Column:
        return F.split(line, " ")

    def yn(flag: Column) -> Column:
        return F.when(flag, "Y").otherwise("N")

    def author(line: Column, i: Column) -> dict:
        collective = i % 4 == 3
        ids_t = inner(a, "AuthorList", "Author", "Identifier")
        aff_t = inner(a, "AuthorList", "Author", "AffiliationInfo")
        own = F.when(
            i % 2 == 0,
            F.array(
                build(ids_t.elementType, {"_VALUE": text(d, "-", i), "_Source": "ORCID"}),
                build(ids_t.elementType, {"_VALUE": text(i, "-", d), "_Source": "ORCID"}),
            ),
        )
        aff_ids = F.array(
            *[
                build(ids_t.elementType, {"_VALUE": text(v, i), "_Source": s})
                for v, s in (("r", "RINGGOLD"), ("i", "ISNI"), ("g", "GRID"), ("o", "ORCID"))
            ]
        )
        affiliations = F.when(
            i % 3 != 2,
            F.array(
                build(
                    aff_t.elementType,
                    {"Affiliation": {"_VALUE": F.array(line)}, "Identifier": aff_ids},
                ),
                build(
                    aff_t.elementType,
                    {"Affiliation": {"_VALUE": F.array(F.lit("second"))}},
                ),
            ),
        )
        name = build(schemas.MIXED, {"_VALUE": F.array(line)})
        return {
            "LastName": F.when(~collective, line),
            "ForeName": F.when(i % 2 == 0, source),
            "Initials": lang,
            "Suffix": F.when(i % 3 == 0, "Jr"),
            "CollectiveName": F.when(collective, name),
            "Identifier": own,
            "AffiliationInfo": affiliations,
        }

    def reference_list(line: Column, i: Column) -> dict:
        ref_t = inner(pd, "ReferenceList", "Reference")
        id_t = schemas.ARTICLE_IDS["ArticleId"].dataType.elementType

        def reference(word: Column, j: Column) -> dict:
            found = F.array(
                build(id_t, {"_VALUE": text(j), "_IdType": "pubmed"}),
                build(id_t, {"_VALUE": text("10.3/", word), "_IdType": "doi"}),
                build(id_t, {"_VALUE": text(j + 1), "_IdType": "pubmed"}),
            )
            some = build(schemas.ARTICLE_IDS, {"ArticleId": found})
            return {
                "Citation": {"_VALUE": F.array(word)},
                "ArticleIdList": F.when(j % 2 == 0, some),
            }

        return {
            "Title": F.when(i % 2 == 0, text("T", i)),
            "Reference": items(ref_t, words(line), reference),
        }

    def bank(line: Column, i: Column) -> dict:
        numbers_t = inner(a, "DataBankList", "DataBank", "AccessionNumberList")
        numbers = build(numbers_t, {"AccessionNumber": words(line)})
        return {
            "DataBankName": text("B", i),
            "AccessionNumberList": F.when(i % 2 == 0, numbers),
        }

    def heading(line: Column, i: Column) -> dict:
        return {
            "DescriptorName": {
                "_VALUE": line,
                "_UI": text("D", i),
                "_MajorTopicYN": yn(i % 2 == 0),
            },
            "QualifierName": items(
                schemas.TERMS,
                words(line),
                lambda w, j: {
                    "_VALUE": w,
                    "_UI": text("Q", j),
                    "_MajorTopicYN": yn(j % 3 == 0),
                },
            ),
        }

    def keyword_list(line: Column, i: Column) -> dict:
        word_t = inner(mc, "KeywordList", "Keyword")
        return {
            "_Owner": text(source, "-", i),
            "Keyword": items(
                word_t,
                words(line),
                read("KeywordList", lambda w, j: {"_VALUE": F.array(w), "_MajorTopicYN": yn(j % 2 == 0)}),
            ),
        }

    def correction(line: Column, i: Column) -> dict:
        pmid_t = inner(mc, "CommentsCorrectionsList", "CommentsCorrections", "PMID")
        pmid = build(pmid_t, {"_VALUE": text(d + i), "_Version": "1"})
        return {
            "_RefType": F.when(i % 2 == 0, "CommentIn").otherwise("ErratumIn"),
            "RefSource": line,
            "PMID": F.when(i % 2 == 0, pmid),
            "Note": F.when(i % 3 == 0, text("note ", i)),
        }

    kind = d % 6
    year = text(F.lit(1990) + d % 30)
    month_name = F.date_format(F.make_date(F.lit(2000), (d % 12 + 1).cast("int"), F.lit(1)), "MMM")
    season = F.element_at(
        F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Fall")]),
        (d % 4 + 1).cast("int"),
    )
    structured = kind < 3
    free = (
        F.when(kind == 3, text(year, " ", month_name, "-", month_name))
        .when(kind == 4, year)
        .when(kind == 5, text(year, " ", month_name, " ", d % 28 + 1, "-30"))
    )
    pub_date = {
        "Year": F.when(structured, year),
        "Month": F.when(kind == 0, text(d % 12 + 1)).when(kind == 1, month_name),
        "Day": F.when(kind == 0, text(d % 28 + 1)),
        "Season": F.when(kind == 2, season),
        "MedlineDate": free,
    }

    def date(value: Column) -> Column:
        parts = {
            "Year": text(F.lit(1990) + value % 30),
            "Month": text(value % 12 + 1),
            "Day": text(value % 28 + 1),
        }
        return build(schemas.DATE, parts)

    def per_line(struct: T.StructType, *path: str, make, extra: dict | None = None) -> Column:
        """A list element around one item per line."""
        container = inner(struct, *path[:-1])
        array_t = container[path[-1]].dataType
        return build(container, {path[-1]: items(array_t, lines, read(path[0], make)), **(extra or {})})

    issn_t = inner(a, "Journal", "ISSN")
    issn = build(
        issn_t,
        {"_VALUE": text("N", d), "_IssnType": F.when(d % 2 == 0, "Print").otherwise("Electronic")},
    )
    pages = build(a["Pagination"].dataType, {"MedlinePgn": text(n, "-", n + 5)})
    one_run = build(schemas.MIXED, {"_VALUE": F.array(body)})
    runs = build(schemas.MIXED, {"_VALUE": F.array(source, lang)})

    article = {
        "Journal": {
            "ISSN": F.when(d % 4 != 0, issn),
            "JournalIssue": {
                "_CitedMedium": "Print",
                "Volume": F.when(d % 6 != 5, text(n)),
                "Issue": F.when(d % 5 != 4, text(d % 12)),
                "PubDate": pub_date,
            },
            "Title": source,
            "ISOAbbreviation": lang,
        },
        "ArticleTitle": one_run,
        "Pagination": F.when(d % 3 != 1, pages),
        "ELocationID": items(
            a["ELocationID"].dataType,
            lines,
            lambda x, i: {"_VALUE": x, "_EIdType": "pii", "_ValidYN": yn(i % 2 == 0)},
        ),
        "Abstract": F.when(
            d % 11 != 10,
            per_line(
                a, "Abstract", "AbstractText",
                make=lambda x, i: {
                    "_VALUE": F.array(x),
                    "_Label": F.when(i % 5 != 4, text("P", i + 1)),
                    "_NlmCategory": F.when(i % 3 != 2, "RESULTS"),
                },
                extra={"CopyrightInformation": text("(c) ", source)},
            ),
        ),
        "AuthorList": F.when(d % 13 != 12, per_line(a, "AuthorList", "Author", make=author)),
        "Language": F.array(lang, F.lit("und")),
        "DataBankList": per_line(
            a, "DataBankList", "DataBank", make=bank, extra={"_CompleteYN": yn(d % 2 == 0)}
        ),
        "GrantList": per_line(
            a, "GrantList", "Grant",
            make=lambda x, i: {
                "GrantID": F.when(i % 2 == 0, text("G", i)),
                "Acronym": F.when(i % 3 != 0, text("A", i)),
                "Agency": x,
                "Country": lang,
            },
            extra={"_CompleteYN": yn(d % 3 == 0)},
        ),
        "PublicationTypeList": per_line(
            a, "PublicationTypeList", "PublicationType",
            make=lambda x, i: {"_VALUE": x, "_UI": text("D", i)},
        ),
        "VernacularTitle": F.when(lang != "en", one_run),
        "ArticleDate": F.array(
            build(
                a["ArticleDate"].dataType.elementType,
                {"_DateType": "Electronic", "Year": year, "Month": "1", "Day": text(d % 28 + 1)},
            )
        ),
    }
    citation = {
        "_Owner": source,
        "_Status": "MEDLINE",
        "_VersionID": F.when(d % 2 == 0, "1"),
        "_VersionDate": F.when(d % 2 == 0, text(year, "-01-01")),
        "PMID": {"_VALUE": text(d), "_Version": "1"},
        "DateCompleted": F.when(d % 3 != 0, date(d)),
        "DateRevised": F.when(d % 5 != 0, date(n)),
        "Article": _pruned(article, only),
        "MedlineJournalInfo": {"Country": lang, "MedlineTA": source, "NlmUniqueID": text(d)},
        "ChemicalList": per_line(
            mc, "ChemicalList", "Chemical",
            make=lambda x, i: {
                "RegistryNumber": text(d, "-", i),
                "NameOfSubstance": {"_VALUE": x, "_UI": text("C", i)},
            },
        ),
        "SupplMeshList": per_line(
            mc, "SupplMeshList", "SupplMeshName",
            make=lambda x, i: {
                "_VALUE": x,
                "_Type": F.when(i % 2 == 0, "Disease").otherwise("Protocol"),
                "_UI": text("C", i),
            },
        ),
        "CitationSubset": F.array(lang, source),
        "CommentsCorrectionsList": per_line(
            mc, "CommentsCorrectionsList", "CommentsCorrections", make=correction
        ),
        "GeneSymbolList": F.when(
            d % 2 == 1, build(mc["GeneSymbolList"].dataType, {"GeneSymbol": lines})
        ),
        "MeshHeadingList": per_line(mc, "MeshHeadingList", "MeshHeading", make=heading),
        "NumberOfReferences": F.when(d % 4 == 1, text(F.size(lines))),
        "PersonalNameSubjectList": per_line(
            mc, "PersonalNameSubjectList", "PersonalNameSubject",
            make=lambda x, i: {"LastName": x, "ForeName": F.when(i % 2 == 0, lang)},
        ),
        "OtherID": F.array(
            build(mc["OtherID"].dataType.elementType, {"_VALUE": text(d), "_Source": "NLM"})
        ),
        "OtherAbstract": F.array(
            build(
                mc["OtherAbstract"].dataType.elementType,
                {
                    "AbstractText": items(
                        schemas.ABSTRACT_TEXT,
                        lines,
                        lambda x, i: {"_VALUE": F.array(x), "_Label": text("O", i)},
                    )
                },
            )
        ),
        "KeywordList": F.when(
            d % 17 != 16, items(mc["KeywordList"].dataType, lines, keyword_list)
        ),
        "CoiStatement": F.when(d % 2 == 0, runs),
        "SpaceFlightMission": lines,
        "InvestigatorList": F.when(
            d % 2 == 0, per_line(mc, "InvestigatorList", "Investigator",
                make=lambda x, i: {"LastName": x, "_ValidYN": yn(i % 2 == 0)})
        ),
        "GeneralNote": items(
            mc["GeneralNote"].dataType,
            lines,
            lambda x, i: {"_VALUE": x, "_Owner": F.when(i % 2 == 0, "NLM").otherwise("KIE")},
        ),
    }
    id_t = schemas.ARTICLE_IDS["ArticleId"].dataType.elementType
    article_ids = F.filter(
        F.array(
            build(id_t, {"_VALUE": text(d), "_IdType": "pubmed"}),
            F.when(
                F.col("quality") == 1,
                build(id_t, {"_VALUE": text("10.1000/X", d), "_IdType": "doi"}),
            ),
            build(id_t, {"_VALUE": text("10.1000/Y", d), "_IdType": "doi"}),
            F.when(
                F.col("toxic") == 1,
                build(id_t, {"_VALUE": text("S", d), "_IdType": "pii"}),
            ),
            build(id_t, {"_VALUE": text("PMC", d), "_IdType": "pmcid"}),
        ),
        lambda x: x.isNotNull(),
    )
    object_t = inner(pd, "ObjectList", "Object")
    data = {
        "ArticleIdList": {"ArticleId": article_ids},
        "ObjectList": {
            "Object": items(
                object_t,
                lines,
                lambda x, i: {
                    "_Type": text("K", i),
                    "Param": F.array(
                        build(
                            object_t.elementType["Param"].dataType.elementType,
                            {"_Name": "id", "_VALUE": F.array(x)},
                        )
                    ),
                },
            )
        },
        "ReferenceList": items(pd["ReferenceList"].dataType, lines, reference_list),
    }
    joined = docs.join(labels, docs["doc_id"] == labels["label_id"], "left")
    if per_file is not None:
        # a number of its own: tasks by the size of the texts would be too few for what becomes of them
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        joined = joined.repartition(parts, F.floor(d / per_file))
    return joined.select(
        build(mc, _pruned(citation, only)).alias("MedlineCitation"),
        F.when(F.col("label_id").isNotNull(), build(pd, _pruned(data, only))).alias("PubmedData"),
    )
