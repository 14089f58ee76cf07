"""Shred articles into the article table and its fifteen child relations.

Input is any DataFrame with the `MedlineCitation` and `PubmedData` structs of
`sources.schemas`.  Children are built as one array per article and opened by
a single generator, so each relation is a narrow projection of the scan: no
shuffle, no join and no union.  Column pruning leaves only the nested fields
the relation reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import dates, ids, record
from citeloom.functions.text import as_int, count_items, default, own_text, plain, yes
from citeloom.sources import schemas


def _rows(items: Column, make: Callable[..., dict[str, Column]]) -> Column:
    """array<element> -> array<row>; `make` sees the element (and its index)."""

    def row(*args):
        return F.struct(*[c.alias(n) for n, c in make(*args).items()])

    if make.__code__.co_argcount == 2:
        return F.transform(items, lambda x, i: row(x, i))
    return F.transform(items, lambda x: row(x))


def _relation(rows: Callable[..., Column]) -> Callable[..., DataFrame]:
    """A relation out of the function that gives an article's rows; the function stays as its `rows`."""

    @wraps(rows)
    def relation(articles: DataFrame, keep: Sequence[str] = (), **form: str) -> DataFrame:
        return articles.select(*keep, ids.pmid(record.citation()).alias("pmid"), F.inline(rows(**form)))

    relation.rows = rows
    return relation


def main_columns(text: str = "complete", free_text: str = "parsed") -> list[Column]:
    mc, pd = record.citation(), record.pubmed_data()
    issue = "Article.Journal.JournalIssue"
    keyword_lists = record.at("KeywordList")
    columns = {
        "pmid": ids.pmid(mc),
        "doi": ids.article_id(pd, "doi"),
        "pii": ids.article_id(pd, "pii"),
        "pmcid": ids.article_id(pd, "pmcid"),
        "date_completed": dates.date_entry(record.at("DateCompleted")),
        "date_revised": dates.date_entry(record.at("DateRevised")),
        "issn_value": record.at("Article.Journal.ISSN._VALUE"),
        "issn_type": record.at("Article.Journal.ISSN._IssnType"),
        "journal_title": record.at("Article.Journal.Title"),
        "volume": record.at(f"{issue}.Volume"),
        "issue": record.at(f"{issue}.Issue"),
        "pub_date": dates.pub_date(record.at(f"{issue}.PubDate"), free_text),
        "iso_abbrev": record.at("Article.Journal.ISOAbbreviation"),
        "title": own_text(record.at("Article.ArticleTitle._VALUE"), text),
        "vernacular_title": default(own_text(record.at("Article.VernacularTitle._VALUE"), text)),
        "pages": default(record.at("Article.Pagination.MedlinePgn")),
        "coi": own_text(record.at("CoiStatement._VALUE"), text),
        "n_references": default(record.at("NumberOfReferences"), "None"),
        "n_chems": count_items(record.at("ChemicalList.Chemical")),
        "n_supp_mesh": count_items(record.at("SupplMeshList.SupplMeshName")),
        "n_mesh": count_items(record.at("MeshHeadingList.MeshHeading")),
        "n_authors": count_items(record.at("Article.AuthorList.Author")),
        "n_keyword_lists": count_items(keyword_lists),
        "n_keywords": F.coalesce(
            F.aggregate(
                keyword_lists, F.lit(0), lambda n, x: n + count_items(x["Keyword"])
            ),
            F.lit(0),
        ),
        "medline_date_raw": record.at(f"{issue}.PubDate.MedlineDate"),
    }
    return [c.alias(n) for n, c in columns.items()]


def main(
    articles: DataFrame,
    keep: Sequence[str] = (),
    text: str = "complete",
    free_text: str = "parsed",
) -> DataFrame:
    return articles.select(*keep, *main_columns(text, free_text))


@_relation
def abstract(text: str = "complete") -> Column:
    """One `full` row per abstract, plus a row per part unless there is one part."""
    parts = F.coalesce(
        record.at("Article.Abstract.AbstractText"), F.array().cast(schemas.ABSTRACT_TEXT)
    )

    def part_text(p: Column) -> Column:
        return default(own_text(p["_VALUE"], text))

    def full_row(body: Column) -> Column:
        return F.struct(
            F.lit(0).alias("element_id"),
            F.lit("full").alias("label"),
            F.lit("full").alias("category"),
            body.alias("text"),
        )

    part_rows = _rows(
        parts,
        lambda p, i: {
            "element_id": i + 1,
            "label": default(p["_Label"]),
            "category": default(p["_NlmCategory"]),
            "text": part_text(p),
        },
    )
    together = F.array_join(
        F.transform(
            parts, lambda p: F.concat(default(p["_Label"]), F.lit(": "), part_text(p))
        ),
        "\n",
    )
    only = own_text(F.get(parts, F.lit(0))["_VALUE"], text)
    rows = F.when(
        record.at("Article.Abstract").isNotNull(),
        F.when(F.size(parts) == 1, F.array(full_row(only))).otherwise(
            F.concat(part_rows, F.array(full_row(together)))
        ),
    )
    return rows


@_relation
def authors(text: str = "complete") -> Column:
    people = record.at("Article.AuthorList.Author")

    def make(a: Column, i: Column) -> dict[str, Column]:
        person = a["LastName"].isNotNull()
        affiliation = F.get(a["AffiliationInfo"], F.lit(0))

        def part(name: str) -> Column:
            return F.when(person, default(a[name])).otherwise(F.lit(""))

        return {
            "auth_order": i,
            "is_collective": ~person,
            "is_first": i == 0,
            "is_last": i == F.size(people) - 1,
            "last_name": F.when(person, a["LastName"]).otherwise(
                default(own_text(a["CollectiveName"]["_VALUE"], text))
            ),
            "fore_name": part("ForeName"),
            "initials": part("Initials"),
            "suffix": F.when(person, default(plain(a["Suffix"]))).otherwise(F.lit("")),
            "orcid": ids.last_of_source(a["Identifier"], "ORCID"),
            "affiliation": default(
                own_text(affiliation["Affiliation"]["_VALUE"], text)
            ),
            "ringgold_id": ids.last_of_source(affiliation["Identifier"], "RINGGOLD"),
            "isni_id": ids.last_of_source(affiliation["Identifier"], "ISNI"),
            "grid_id": ids.last_of_source(affiliation["Identifier"], "GRID"),
        }

    return _rows(people, make)


@_relation
def affiliations(text: str = "complete") -> Column:
    """Every affiliation of every author; `authors` has the first of each only."""
    people = record.at("Article.AuthorList.Author")

    def of(a: Column, i: Column) -> Column:
        return F.transform(
            a["AffiliationInfo"],
            lambda x, j: F.struct(
                i.alias("auth_order"),
                j.alias("aff_order"),
                default(own_text(x["Affiliation"]["_VALUE"], text)).alias("affiliation"),
                *[
                    ids.last_of_source(x["Identifier"], source).alias(name)
                    for name, source in (("ringgold_id", "RINGGOLD"), ("isni_id", "ISNI"), ("grid_id", "GRID"))
                ],
            ),
        )

    rows = F.filter(F.transform(people, of), lambda x: x.isNotNull())
    return F.flatten(rows)


@_relation
def chem() -> Column:
    rows = _rows(
        record.at("ChemicalList.Chemical"),
        lambda c: {
            "registry_number": c["RegistryNumber"],
            "name": c["NameOfSubstance"]["_VALUE"],
            "ui_id": c["NameOfSubstance"]["_UI"],
        },
    )
    return rows


@_relation
def comments_corrections() -> Column:
    rows = _rows(
        record.at("CommentsCorrectionsList.CommentsCorrections"),
        lambda c: {
            "ref_type": c["_RefType"],
            "ref_source": c["RefSource"],
            "note": default(c["Note"]),
            "ref_pmid": default(c["PMID"]["_VALUE"], "0"),
        },
    )
    return rows


@_relation
def data_bank() -> Column:
    """A row per accession number; a bank without a number list gives one row."""
    banks = record.at("Article.DataBankList")
    complete = yes(banks["_CompleteYN"])

    def bank_rows(b: Column) -> Column:
        numbers = F.coalesce(
            b["AccessionNumberList"]["AccessionNumber"], F.array(F.lit(""))
        )
        return F.transform(
            numbers,
            lambda n: F.struct(
                complete.alias("is_complete"),
                b["DataBankName"].alias("name"),
                n.alias("acc_number"),
            ),
        )

    rows = F.flatten(F.transform(banks["DataBank"], bank_rows))
    return rows


@_relation
def grants() -> Column:
    complete = yes(record.at("Article.GrantList._CompleteYN"))
    rows = _rows(
        record.at("Article.GrantList.Grant"),
        lambda g: {
            "is_complete": complete,
            "grant_id": default(g["GrantID"]),
            "acronym": default(g["Acronym"]),
            "agency": g["Agency"],
            "country": g["Country"],
        },
    )
    return rows


@_relation
def keywords(text: str = "complete") -> Column:
    def list_rows(owned: Column) -> Column:
        return F.transform(
            owned["Keyword"],
            lambda k: F.struct(
                owned["_Owner"].alias("owner"),
                yes(k["_MajorTopicYN"]).alias("is_major"),
                own_text(k["_VALUE"], text).alias("keyword"),
            ),
        )

    # a list without keywords must not turn the flattened array into NULL
    lists = F.filter(record.at("KeywordList"), lambda x: x["Keyword"].isNotNull())
    return F.flatten(F.transform(lists, list_rows))


@_relation
def languages() -> Column:
    return _rows(record.at("Article.Language"), lambda x: {"language": x})


@_relation
def mesh() -> Column:
    """Each heading's descriptor, then its qualifiers, under one heading id."""

    def heading_rows(h: Column, i: Column) -> Column:
        terms = F.concat(
            F.filter(F.array(h["DescriptorName"]), lambda t: t.isNotNull()),
            F.coalesce(h["QualifierName"], F.array().cast(schemas.TERMS)),
        )
        return F.transform(
            terms,
            lambda t: F.struct(
                i.alias("heading_id"),
                yes(t["_MajorTopicYN"]).alias("is_major"),
                t["_UI"].alias("ui_id"),
                t["_VALUE"].alias("value"),
            ),
        )

    headings = record.at("MeshHeadingList.MeshHeading")
    return F.flatten(F.transform(headings, heading_rows))


@_relation
def notes() -> Column:
    rows = _rows(
        record.at("GeneralNote"), lambda n: {"text": n["_VALUE"], "owner": n["_Owner"]}
    )
    return rows


@_relation
def personal_names() -> Column:
    rows = _rows(
        record.at("PersonalNameSubjectList.PersonalNameSubject"),
        lambda p: {
            "last_name": p["LastName"],
            "fore_name": default(p["ForeName"]),
            "initials": default(p["Initials"]),
            "suffix": default(plain(p["Suffix"])),
        },
    )
    return rows


@_relation
def pub_types() -> Column:
    rows = _rows(
        record.at("Article.PublicationTypeList.PublicationType"),
        lambda p: {"ui_id": p["_UI"], "value": p["_VALUE"]},
    )
    return rows


@_relation
def refs(text: str = "complete") -> Column:
    def list_rows(one: Column, i: Column) -> Column:
        return F.transform(
            one["Reference"],
            lambda r, j: F.struct(
                default(one["Title"]).alias("list_title"),
                i.alias("list_index"),
                j.alias("ref_index"),
                own_text(r["Citation"]["_VALUE"], text).alias("citation"),
                *[
                    ids.last_id(r["ArticleIdList"]["ArticleId"], kind).alias(name)
                    for name, kind in (
                        ("ref_pmid", "pubmed"),
                        ("ref_doi", "doi"),
                        ("ref_pii", "pii"),
                    )
                ],
            ),
        )

    # the index counts every list, so empty ones are dropped after numbering
    lists = F.filter(
        F.transform(record.reference_lists(), list_rows), lambda rows: rows.isNotNull()
    )
    return F.flatten(lists)


@_relation
def space() -> Column:
    rows = _rows(record.at("SpaceFlightMission"), lambda x: {"mission": x})
    return rows


@_relation
def supp_mesh() -> Column:
    rows = _rows(
        record.at("SupplMeshList.SupplMeshName"),
        lambda s: {"type": s["_Type"], "ui_id": s["_UI"], "value": s["_VALUE"]},
    )
    return rows


# Keep `main` first: it holds the keys the other relations refer to.
RELATIONS: dict[str, Callable[..., DataFrame]] = {
    "main": main,
    "abstract": abstract,
    "authors": authors,
    "chem": chem,
    "comments_corrections": comments_corrections,
    "data_bank": data_bank,
    "grants": grants,
    "keywords": keywords,
    "languages": languages,
    "mesh": mesh,
    "notes": notes,
    "personal_names": personal_names,
    "pub_types": pub_types,
    "refs": refs,
    "space": space,
    "supp_mesh": supp_mesh,
}


# Relations beside those of the file format.
EXTRA: dict[str, Callable[..., DataFrame]] = {"affiliations": affiliations}


def rows_of(name: str, **form: str) -> Column:
    """The rows of a relation an article gives, as array<struct>, its key among the columns of `main` only."""
    if name == "main":
        return F.array(F.struct(*main_columns(**form)))
    return RELATIONS[name].rows(**form)


def shred(articles: DataFrame, keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Every relation of the articles, by name."""
    return {name: make(articles, keep) for name, make in RELATIONS.items()}


def identifiers(articles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The `ids` table: identifier pair and raw journal fields."""
    journal = record.at("Article.Journal")
    issue = journal["JournalIssue"]
    columns = {
        "pmid": ids.pmid(record.citation()),
        "doi": ids.article_id(record.pubmed_data(), "doi"),
        "journal_name": journal["Title"],
        "journal_volume": default(issue["Volume"]),
        "journal_year": as_int(default(issue["PubDate"]["Year"], "0")),
        "journal_issue": default(issue["Issue"]),
        "journal_month": default(issue["PubDate"]["Month"]),
    }
    return articles.select(*keep, *[c.alias(n) for n, c in columns.items()])


def identifier_pairs(articles: DataFrame) -> DataFrame:
    """PMID and DOI with the PMID taken from the identifier list when it can be."""
    article = F.struct(record.citation().alias("MedlineCitation"), record.pubmed_data().alias("PubmedData"))
    return articles.select(
        ids.pmid_with_fallback(article).alias("pmid"),
        ids.article_id(record.pubmed_data(), "doi").alias("doi"),
    )


def _problems(text_columns: dict[str, tuple[Column, Column, bool]]) -> Column:
    found = [
        F.when(
            test,
            F.struct(
                F.lit(reason).alias("reason"),
                detail.cast("string").alias("detail"),
                F.lit(kept).alias("kept"),
            ),
        )
        for reason, (test, detail, kept) in text_columns.items()
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def problems() -> Column:
    """array<reason, detail, kept> of an article the flat tables cannot fully hold.

    `kept = false` marks what keeps the article out of the tables; identifiers
    of an unknown source only lose that identifier.
    """
    date = record.at("Article.Journal.JournalIssue.PubDate")
    people = record.at("Article.AuthorList.Author")
    none = F.array().cast("array<string>")

    def all_sources(identifiers) -> Column:
        return F.flatten(
            F.transform(people, lambda a: F.coalesce(identifiers(a)["_Source"], none))
        )

    sources = all_sources(lambda a: a["Identifier"])
    at_first = all_sources(
        lambda a: F.get(a["AffiliationInfo"], F.lit(0))["Identifier"]
    )
    unknown_own = F.filter(sources, lambda s: ~s.eqNullSafe("ORCID"))
    unknown_aff = F.filter(
        at_first,
        lambda s: s.isNull() | ~s.isin("RINGGOLD", "ISNI", "GRID", "ORCID"),
    )
    date_problem = dates.pub_date_problem(date)

    def bad_date(name: str) -> Column:
        return record.citation()[name].isNotNull() & dates.date_entry(record.citation()[name]).isNull()

    return _problems(
        {
            "bad_pmid": (ids.pmid(record.citation()).isNull(), record.at("PMID._VALUE"), False),
            "bad_pub_date": (date_problem.isNotNull(), date_problem, True),
            "bad_date_completed": (bad_date("DateCompleted"), F.to_json(record.at("DateCompleted")), True),
            "bad_date_revised": (bad_date("DateRevised"), F.to_json(record.at("DateRevised")), True),
            "unknown_author_id_source": (
                F.coalesce(F.size(unknown_own) > 0, F.lit(False)),
                F.array_join(unknown_own, ",", "NULL"),
                True,
            ),
            "unknown_affiliation_id_source": (
                F.coalesce(F.size(unknown_aff) > 0, F.lit(False)),
                F.array_join(unknown_aff, ",", "NULL"),
                True,
            ),
        }
    )
