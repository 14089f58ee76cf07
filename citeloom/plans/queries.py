"""The registered queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import dates
from citeloom.functions.files import corpus_name
from citeloom.operators import changes, documents, inventory, lookup, ordinals, relations
from citeloom.plans import bulk
from citeloom.plans import driver_views as v
from citeloom.plans.driver_corpus import ARTICLE, write_corpus, write_lines
from citeloom.plans.scratch import new_path, spread
from citeloom.plans.store import Store
from citeloom.sources import schemas, tsv, xml
from citeloom.streaming.ingest import ChangeLog, ChangeState, deletion_log_once, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Request texts: hits, a miss, a duplicate, blanks, junk, mixed case.
PMID_REQUEST = "5,12,5,999999999,,abc,7, 8"
DOI_REQUEST = "10.1000/x2,10.1000/X2,10.1000/X4,10.9/none,,10.1000/x0"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# ---- lookups ---------------------------------------------------------


@query
def lookup_pmid_doi(spark, d):
    ids = v.bib_ids(spark, d)
    hit = lookup.pmid_to_doi(ids, 5).withColumn("request", F.lit("5"))
    miss = lookup.pmid_to_doi(ids, "999999999").withColumn("request", F.lit("999999999"))
    return hit.unionByName(miss)


@query
def lookup_doi_pmid(spark, d):
    ids = v.bib_ids(spark, d)
    found = None
    for doi in ("10.1000/x2", "10.1000/X3", "10.9/none"):
        one = lookup.doi_to_pmid(ids, doi).withColumn("request", F.lit(doi))
        found = one if found is None else found.unionByName(one)
    return found


@query
def lookup_single_bodies(spark, d):
    ids = v.bib_ids(spark, d)
    doi = lookup.single_body(lookup.pmid_to_doi(ids, 5), "doi")
    pmid = lookup.single_body(lookup.doi_to_pmid(ids, "10.1000/x2"), "pmid")
    return doi.unionByName(pmid).unionByName(
        lookup.single_body(lookup.doi_to_pmid(ids, "10.9/none"), "pmid")
    )


@query
def lookup_batch_pmid_doi(spark, d):
    ids = v.bib_ids(spark, d)
    found = lookup.pmids_to_dois(ids, lookup.requests(spark, PMID_REQUEST, "pmid"))
    return lookup.compat(found, "doi")


@query
def lookup_batch_doi_pmid(spark, d):
    ids = v.bib_ids(spark, d)
    found = lookup.dois_to_pmids(ids, lookup.requests(spark, DOI_REQUEST, "doi"))
    return lookup.compat(found, "pmid")


@query
def lookup_table_pmid_doi(spark, d):
    """Every line item asks for an order's DOI; order keys repeat and some miss."""
    lines = v.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("pos"), (F.col("l_orderkey") * 2).alias("pmid")
    )
    return lookup.pmids_to_dois(v.bib_ids(spark, d), lines)


@query
def lookup_table_doi_pmid(spark, d):
    lines = v.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("pos"),
        v.text("10.1000/x", F.col("l_orderkey")).alias("doi"),
    )
    return lookup.dois_to_pmids(v.bib_ids(spark, d), lines)


@query
def lookup_collated(spark, d):
    """DOIs with accents, asked for by every line item in other case and with other accents, per form of comparison."""
    marks = F.array(*map(F.lit, ("É", "e", "Ê", "E\u0301")))
    number = F.expr("pmid div 2")
    ids = v.bib_ids(spark, d).select(
        "pmid", F.when(F.col("doi") == "", "").otherwise(v.text("10.1000/", marks[(number % 4).cast("int")], "X", number)).alias("doi")
    )
    asked = marks[(F.col("l_linenumber") % 4).cast("int")]
    lines = v.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("pos"), v.text("10.1000/", F.lower(asked), "x", F.col("l_orderkey")).alias("doi")
    )
    parts = [lookup.dois_to_pmids(ids, lines, form).withColumn("ignore", F.lit(form)) for form in lookup.FORMS]
    return _union(parts)


def _customer_requests(spark, d, prefix: str) -> DataFrame:
    key = F.col("c_custkey")
    texts = [v.text(prefix, k) for k in (key, key * 40, key, key + 1)]
    return v.table(spark, d, "customer").select(
        key.alias("request"), F.concat_ws(",", *texts, F.lit("")).alias("ids")
    )


def _bodies(requests, ids, name, translate):
    other = {"doi": "pmid", "pmid": "doi"}[name]
    items = requests.select(
        "request", F.posexplode(lookup.split_ids(F.col("ids"))).alias("pos", other)
    )
    return lookup.batch_body(translate(ids, items), name, ["request"])


@query
def lookup_bodies_pmid_doi(spark, d):
    requests = _customer_requests(spark, d, "")
    return _bodies(requests, v.bib_ids(spark, d), "doi", lookup.pmids_to_dois)


@query
def lookup_bodies_doi_pmid(spark, d):
    requests = _customer_requests(spark, d, "10.1000/x")
    return _bodies(requests, v.bib_ids(spark, d), "pmid", lookup.dois_to_pmids)


# ---- changes ---------------------------------------------------------


@query
def ids_upsert_snapshot(spark, d):
    order = [F.col("file_name"), F.col("seq")]
    return changes.snapshot(v.bib_changes(spark, d), order=order)


@query
def latest_change_per_key(spark, d):
    """Winners with tombstones under the order of real files."""
    return changes.latest(v.bib_changes(spark, d))


@query
def deleted_log(spark, d):
    return changes.deletion_log(v.bib_changes(spark, d))


def _deleted_keys(spark, d) -> DataFrame:
    won = changes.latest(v.bib_changes(spark, d))
    return won.filter(changes.is_delete()).select("pmid")


def _children(spark, d) -> DataFrame:
    return v.bib_child_rows(spark, d).select("pmid", "l_linenumber", "ui_id", "value")


@query
def cascade_children(spark, d):
    return changes.cascade(_children(spark, d), _deleted_keys(spark, d))


@query
def orphan_children(spark, d):
    return changes.orphans(_children(spark, d), v.bib_changes(spark, d).select("pmid"))


@query
def children_with_parent(spark, d):
    return changes.with_parent(_children(spark, d), v.bib_changes(spark, d).select("pmid"))


# ---- file inventory --------------------------------------------------


@query
def files_unapplied(spark, d):
    return inventory.unapplied(v.bib_files(spark, d), v.bib_applied(spark, d))


@query
def files_missing(spark, d):
    """Files of the events that the first twenty days did not bring."""
    return inventory.missing(v.bib_files(spark, d), v.bib_applied(spark, d))


@query
def files_combined(spark, d):
    return inventory.combine(v.bib_applied(spark, d), v.bib_files(spark, d))


@query
def files_after(spark, d):
    return inventory.after(v.bib_files(spark, d), "pubmed24n0015.xml.gz")


@query
def files_applied(spark, d):
    return inventory.gz_sorted(v.bib_applied(spark, d))


@query
def file_kind(spark, d):
    years = v.bib_files(spark, d)
    other = years.select(F.regexp_replace("file_name", "pubmed24", "pubmed23").alias("file_name"))
    return inventory.file_kind(years.unionByName(other), {24: 20})


@query
def records_per_file(spark, d):
    return (
        v.bib_changes(spark, d)
        .groupBy("file_name")
        .agg(F.count("*").alias("n_records"), F.count_if(F.col("op") == "U").alias("n_doi"))
    )


# ---- flat relations --------------------------------------------------

# What queries read of an article (`driver_views.bib_articles`).
IDENTIFIERS = ("PMID", "ArticleIdList")
MAIN = (
    *IDENTIFIERS, "DateCompleted", "DateRevised", "Article", "Journal", "ArticleTitle", "VernacularTitle", "Pagination",
    "CoiStatement", "NumberOfReferences",
    *(name + v.SIZE for name in ("AuthorList", "ChemicalList", "SupplMeshList", "MeshHeadingList", "KeywordList")),
)


def _register_relations() -> None:
    names = {"authors": "author_rows"}
    for relation, make in relations.RELATIONS.items():
        name = names.get(relation, f"{relation}_rows")
        only = MAIN if relation == "main" else None
        QUERIES[name] = lambda spark, d, make=make, only=only: make(v.bib_articles(spark, d, only=only))


_register_relations()


@query
def affiliation_rows(spark, d):
    return relations.affiliations(v.bib_articles(spark, d))


@query
def ids_rows(spark, d):
    return relations.identifiers(v.bib_articles(spark, d))


@query
def id_pairs(spark, d):
    return relations.identifier_pairs(v.bib_articles(spark, d))


@query
def first_id_by_type(spark, d):
    return relations.main(v.bib_articles(spark, d, only=IDENTIFIERS)).select("pmid", "doi", "pii", "pmcid")


@query
def pub_date_parse(spark, d):
    """Order dates written in every form of the format, and odd ones, parsed back."""
    return _order_dates(spark, d).select(
        "pmid",
        "form",
        dates.pub_date(F.col("date")).alias("pub_date"),
        dates.pub_date(F.col("date"), "constant").alias("constant_date"),
        dates.pub_date_problem(F.col("date")).alias("problem"),
        dates.to_calendar_date(dates.pub_date(F.col("date"))).alias("calendar_date"),
    )


def _order_dates(spark, d) -> DataFrame:
    day = F.col("o_orderdate")
    year, month, dom = (F.date_format(day, p) for p in ("yyyy", "MMM", "d"))
    number = F.date_format(day, "MM")
    form = (F.col("o_orderkey") % 10).cast("int")
    seasons = F.array(*[F.lit(s) for s in ("Winter", "Spring", "Summer", "Fall")])
    season = F.element_at(seasons, F.quarter(day))
    date = {
        "Year": F.when(form.isin(0, 1, 2, 6, 7), year),
        "Month": F.when(form == 0, number).when(form == 1, month).when(form == 7, "Foo"),
        "Day": F.when(form == 0, dom),
        "Season": F.when(form == 2, season).when(form == 6, "Autumn"),
        "MedlineDate": F.when(form == 3, v.text(year, " ", month, "-", month))
        .when(form == 4, year)
        .when(form == 5, v.text(year, " ", month, " ", dom, "-30"))
        .when(form == 8, v.text(year, " ", season)),
    }
    t = schemas.ARTICLE["Journal"].dataType["JournalIssue"].dataType["PubDate"].dataType
    dated = v.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("pmid"), form.alias("form"), v.build(t, date).alias("date")
    )
    return spread(dated, "pmid")


@query
def date_entries(spark, d):
    return relations.main(v.bib_articles(spark, d)).select(
        "pmid", "date_completed", "date_revised"
    )


@query
def rejected_articles(spark, d):
    """Articles of the orders whose publication date cannot be read."""
    t = schemas.MEDLINE_CITATION
    journal = {"JournalIssue": {"PubDate": F.col("date")}}
    citation = {"PMID": {"_VALUE": v.text(F.col("pmid"))}, "Article": {"Journal": journal}}
    articles = _order_dates(spark, d).select(
        v.build(t, citation).alias("MedlineCitation"),
        F.lit(None).cast(schemas.PUBMED_DATA).alias("PubmedData"),
    )
    return articles.select(
        F.col("MedlineCitation.PMID._VALUE").alias("pmid"), F.inline(relations.problems())
    )


# ---- flat rows: ordinals, flags, counts -------------------------------


@query
def child_ordinals(spark, d):
    rows = ordinals.ordinal_within(v.bib_child_rows(spark, d), ["pmid"], v.CHILD_ORDER)
    return rows.select("pmid", "ordinal", "ui_id", "value")


@query
def author_flags(spark, d):
    flagged = ordinals.edge_flags(v.bib_authors(spark, d), "pmid", "auth_order")
    return flagged.select(
        "pmid", "auth_order", "is_collective", "is_first", "is_last", "n_items", "last_name"
    )


@query
def child_counts(spark, d):
    parents = v.bib_ids(spark, d).select("pmid")
    children = v.bib_child_rows(spark, d).select("pmid")
    return ordinals.child_counts(parents, children)


# ---- nested documents ------------------------------------------------


def _docs(spark, d, *only: str) -> DataFrame:
    """Documents of the articles, with all parts or those named."""
    return documents.documents(v.bib_articles(spark, d, only=only or None))


def _joined(items, *paths: str, sep: str = "|"):
    """Array of structs as text, one field after the other."""

    def one(x):
        values = []
        for path in paths:
            c = x
            for step in path.split("."):
                c = c[step]
            values.append(F.coalesce(c, F.lit("~")))
        return F.concat_ws("/", *values)

    return F.array_join(F.transform(items, one), sep)


def _citation_part(docs: DataFrame) -> DataFrame:
    journal = "Article.Journal"
    return docs.select(
        F.col("PMID.Value").alias("pmid"),
        F.col("PMID.Version").alias("pmid_version"),
        F.col("Owner").alias("owner"),
        F.col("Status").alias("status"),
        F.col("VersionID").alias("version_id"),
        F.col("VersionDate").alias("version_date"),
        F.col("DateCompleted.Month").alias("completed_month"),
        F.col("DateRevised.Day").alias("revised_day"),
        F.col(f"{journal}.ISSN.IssnType").alias("issn_type"),
        F.col(f"{journal}.JournalIssue.PubDate.Season").alias("season"),
        F.col(f"{journal}.JournalIssue.PubDate.MedlineDate").alias("medline_date"),
        F.col(f"{journal}.Title").alias("journal_title"),
        F.col("MedlineJournalInfo.Country").alias("country"),
        F.col("MedlineJournalInfo.NlmUniqueID").alias("nlm_id"),
        F.col("MedlineJournalInfo.ISSNLinking").alias("issn_linking"),
        F.col("NumberOfReferences").alias("n_references"),
        F.col("CoiStatement").alias("coi"),
        F.array_join("CitationSubsets", ",").alias("subsets"),
        _joined(F.col("OtherIDs"), "Source", "Value").alias("other_ids"),
    )


@query
def nested_citation(spark, d):
    return _citation_part(_docs(
        spark, d, "PMID", "_Owner", "_Status", "_VersionID", "_VersionDate", "DateCompleted", "DateRevised", "Article", "Journal",
        "MedlineJournalInfo", "NumberOfReferences", "CoiStatement", "CitationSubset", "OtherID",
    ))


def _article_part(docs: DataFrame) -> DataFrame:
    a = F.col("Article")
    authors = F.transform(
        a["AuthorList"],
        lambda x: F.concat_ws(
            "/",
            F.coalesce(x["CollectiveName"], x["LastName"]),
            F.coalesce(x["ForeName"], F.lit("~")),
            _joined(x["Identifiers"], "Source", "Value", sep=","),
            F.size(x["Affiliations"]).cast("string"),
            _joined(x["Affiliations"], "Affiliation", sep=","),
        ),
    )
    return docs.select(
        F.col("PMID.Value").alias("pmid"),
        a["ArticleTitle"].alias("title"),
        a["Pagination"]["MedlinePgn"].alias("pages"),
        _joined(a["ELocationIDs"], "EIdType", "ValidYN", "Value").alias("locations"),
        _joined(a["ArticleDates"], "Year", "Month", "Day", "DateType").alias("dates"),
        a["Abstract"]["CopyrightInformation"].alias("copyright"),
        _joined(a["Abstract"]["Parts"], "Label", "Value").alias("parts"),
        F.array_join(authors, "|").alias("authors"),
        F.array_join(a["Language"], ",").alias("languages"),
        a["VernacularTitle"].alias("vernacular_title"),
    )


@query
def nested_article(spark, d):
    return _article_part(_docs(
        spark, d, "PMID", "Article", "ArticleTitle", "Pagination", "ELocationID", "ArticleDate", "Abstract", "AuthorList", "Language",
        "VernacularTitle",
    ))


def _terms_part(docs: DataFrame) -> DataFrame:
    mesh = F.transform(
        F.col("MeshHeadingList"),
        lambda h: F.concat_ws(
            "=", h["Descriptor"]["Value"], _joined(h["Qualifiers"], "UI", "Value", sep=" ")
        ),
    )
    keywords = F.transform(
        F.col("KeywordLists"),
        lambda k: F.concat_ws("=", k["Owner"], _joined(k["Keywords"], "Value", sep=" ")),
    )
    return docs.select(
        F.col("PMID.Value").alias("pmid"),
        F.array_join(mesh, "|").alias("mesh"),
        F.array_join(keywords, "|").alias("keywords"),
        _joined(F.col("CommentsCorrectionsList"), "RefType", "PMID.Value", "Note").alias("corrections"),
        _joined(F.col("ChemicalList"), "RegistryNumber", "NameOfSubstance", "UI").alias("chemicals"),
        _joined(F.col("SupplMeshList"), "Type", "UI", "Name").alias("supplements"),
    )


@query
def nested_terms(spark, d):
    return _terms_part(_docs(
        spark, d, "PMID", "MeshHeadingList", "KeywordList", "CommentsCorrectionsList", "ChemicalList", "SupplMeshList",
    ))


def _lists_part(docs: DataFrame) -> DataFrame:
    other = F.transform(
        F.col("OtherAbstracts"), lambda a: _joined(a["AbstractTexts"], "Label", "Value")
    )
    banks = F.transform(
        F.col("Article.DataBankList.DataBankList"),
        lambda b: F.concat_ws("=", b["DataBankName"], F.array_join(b["AccessionNumberList"], " ")),
    )
    objects = F.transform(
        F.col("PubmedData.ObjectList"),
        lambda o: F.concat_ws("=", o["Type"], _joined(o["Params"], "Name", "Value")),
    )
    references = F.transform(
        F.col("PubmedData.ReferenceList"),
        lambda r: F.concat_ws("=", r["Title"], _joined(r["References"], "Citation", sep=" ")),
    )
    return docs.select(
        F.col("PMID.Value").alias("pmid"),
        F.array_join(other, "#").alias("other_abstracts"),
        F.array_join("GeneSymbolList", "|").alias("genes"),
        _joined(F.col("InvestigatorList"), "ValidYN", "LastName").alias("investigators"),
        _joined(F.col("GeneralNotes"), "Owner", "Value").alias("notes"),
        F.array_join("SpaceFlightMissions", "|").alias("missions"),
        F.array_join(banks, "|").alias("banks"),
        _joined(F.col("Article.GrantList.Grants"), "GrantID", "Acronym", "Agency").alias("grants"),
        _joined(F.col("Article.PublicationTypeList"), "UI", "Value").alias("pub_types"),
        _joined(F.col("PersonalNameSubjectList"), "LastName", "ForeName").alias("names"),
        F.array_join(objects, "|").alias("objects"),
        F.array_join(references, "|").alias("references"),
    )


@query
def nested_lists(spark, d):
    return _lists_part(_docs(
        spark, d, "PMID", "OtherAbstract", "GeneSymbolList", "InvestigatorList", "GeneralNote", "SpaceFlightMission", "Article",
        "DataBankList", "GrantList", "PublicationTypeList", "PersonalNameSubjectList", "ObjectList", "ReferenceList",
    ))


@query
def nested_json(spark, d):
    """Whole documents as JSON texts, read back by path."""
    texts = documents.as_json(_docs(spark, d))
    # one reading of a text, not one per path
    fields = (
        "Owner string, PMID struct<Value: string>, CitationSubsets array<string>, "
        "Article struct<Journal: struct<Title: string>, ArticleTitle: string, Language: array<string>>"
    )
    found = texts.select(F.from_json("document", fields).alias("x"))

    def item(path: str, i: int):
        """An item as `get_json_object` gives it: the text `null` for one that is there without a value."""
        return F.when(F.size(path) > i, F.coalesce(F.get(path, F.lit(i)), F.lit("null")))

    return found.select(
        F.col("x.PMID.Value").alias("pmid"),
        F.col("x.Owner").alias("owner"),
        F.col("x.Article.Journal.Title").alias("journal"),
        F.col("x.Article.ArticleTitle").alias("title"),
        item("x.Article.Language", 0).alias("first_language"),
        item("x.CitationSubsets", 1).alias("subset"),
    )


# ---- files written and read back --------------------------------------


@query
def tsv_round_trip(spark, d):
    path = new_path(spark, "tsv")
    tsv.write_tsv(relations.abstract(v.bib_articles(spark, d)), "abstract", path)
    return tsv.read_tsv(spark, "abstract", path)


@query
def tsv_main_round_trip(spark, d):
    path = new_path(spark, "tsv")
    tsv.write_tsv(relations.main(v.bib_articles(spark, d, only=MAIN)), "main", path)
    return tsv.read_tsv(spark, "main", path)


# Rows of one corpus file: a gzip file is one task, so its size is bounded.
FILE_ROWS = 1_000_000
FILE_ARTICLES = 30_000
FILE_DOCUMENTS = 1_000


def _fingerprint(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """(relation, n_rows, fingerprint): a sum of hashes of whole rows, empty texts counting as missing ones."""
    values = [
        F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("~")) for c in columns or sorted(df.columns)
    ]
    digits = F.substring(F.md5(F.concat_ws("|", *values)), 1, 8)
    return df.agg(
        F.lit(name).alias("relation"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.conv(digits, 16, 10).cast("bigint")), F.lit(0)).alias("fingerprint"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _dated_store(spark, dated) -> Store:
    """Dated orders (pmid, date) written as XML with a DOI each, and applied."""
    id_t = schemas.ARTICLE_IDS["ArticleId"].dataType.elementType
    doi = v.build(id_t, {"_VALUE": v.text("10.9/", F.col("pmid")), "_IdType": F.lit("doi")})
    journal = {"JournalIssue": {"PubDate": F.col("date")}}
    citation = {"PMID": {"_VALUE": v.text(F.col("pmid"))}, "Article": {"Journal": journal}}
    article = F.struct(
        v.build(schemas.MEDLINE_CITATION, citation).alias("MedlineCitation"),
        v.build(schemas.PUBMED_DATA, {"ArticleIdList": {"ArticleId": F.array(doi)}}).alias("PubmedData"),
    )
    records = dated.select(
        _numbered("24", F.format_string("%08d", F.expr(f"pmid div {FILE_ARTICLES}"))).alias("file"),
        F.lit(ARTICLE).alias("kind"),
        F.col("pmid").cast("bigint").alias("seq"),
        F.to_xml(article, {"rowTag": schemas.ARTICLE_TAG}).alias("value"),
    )
    store = Store(spark, new_path(spark, "store"))
    store.update(write_lines(records, new_path(spark, "corpus")), tables=["ids"])
    return store


@query
def store_rejects_keep_ids(spark, d):
    """Ten forms of dates, three of them unreadable: every readable PMID has its `ids` row."""
    return _dated_store(spark, _order_dates(spark, d)).read("ids").select("pmid", "doi")


@query
def pmid_wide(spark, d):
    """Keys above 2**31 through XML, store and lookup."""
    dated = _order_dates(spark, d).withColumn("pmid", F.col("pmid") + 3_000_000_000)
    ids = _dated_store(spark, dated).read("ids")
    return lookup.pmids_to_dois(ids, dated.select("pmid"))


def _numbered(year, *number):
    """Corpus file name whose number has eight digits, in lexical order."""
    return v.text("pubmed", year, "n", *number, ".xml.gz")


def _fanned_out(spark, d) -> str:
    """All relations of the documents, and a deletion list, as the folders of a fan-out."""
    doc = F.col("MedlineCitation.PMID._VALUE").cast("bigint")
    number = F.format_string("%08d", F.floor(doc / FILE_DOCUMENTS))
    records = v.bib_articles(spark, d, FILE_DOCUMENTS).select(
        "*", _numbered("24", number).alias("file_name"), F.array(v.text(doc + 1), F.lit("no number")).alias("deletes")
    )
    out = new_path(spark, "tsv")
    tsv.write_fan_out(records, out, compression="gzip")
    return out


def _file_columns(relation: str) -> list[str]:
    return sorted(c for c in schemas.columns(relation) if c not in schemas.TSV_DROPS.get(relation, ()))


@query
def tsv_fan_out(spark, d):
    """Rows and a hash over all columns of every relation, and of the deletion list, out of a fan-out's folders."""
    out = _fanned_out(spark, d)
    parts = [
        _fingerprint(tsv.read_tsv(spark, r, f"{out}/relation={r}"), r, _file_columns(r)) for r in schemas.RELATIONS
    ]
    return _union([*parts, _fingerprint(tsv.read_deleted(spark, out), "deleted")])


@query
def store_load_tsv(spark, d):
    """The same files loaded into a store in bulk, all its tables read."""
    store = Store(spark, new_path(spark, "store"))
    store.load_tsv(_fanned_out(spark, d))
    parts = [_fingerprint(store.read(r), r, _file_columns(r)) for r in schemas.RELATIONS]
    return _union([*parts, _fingerprint(store.read("rejects"), "rejects")])


@query
def bulk_first_wins(spark, d):
    """Change rows as files of `main`: the first row of each article stays."""
    rows = v.bib_changes(spark, d).select("file_name", "seq", "pmid", "doi")
    out = new_path(spark, "tsv")
    columns = [F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in schemas.columns("main")]
    lines = rows.repartition("file_name").sortWithinPartitions("file_name", "seq")
    root = F.regexp_replace("file_name", r"\.xml\.gz$", "").alias("root")
    lines = lines.select(root, *columns)
    fields = tsv.to_rows(lines, "main", keep=["root"])
    fields.write.partitionBy("root").options(**tsv.WRITE).csv(f"{out}/relation=main")
    return bulk.first_wins(bulk.read(spark, "main", out)).select("pmid", "doi", "file_name")


def _ids_corpus(spark, d) -> str:
    """Identifiers of the orders as XML corpus files by year and key range."""
    year = F.substring(F.col("journal_year").cast("string"), 3, 2)
    part = F.format_string("%08d", F.expr(f"pmid div {FILE_ROWS}"))
    rows = v.bib_ids(spark, d).select(
        _numbered(year, part).alias("file_name"),
        F.lit("U").alias("op"),
        F.col("pmid").alias("seq"),
        "*",
    )
    return write_corpus(rows, new_path(spark, "corpus"))


@query
def xml_round_trip(spark, d):
    articles = xml.scan_articles(spark, _ids_corpus(spark, d), schema=schemas.IDS_ARTICLE)
    return relations.identifiers(articles).drop("journal_issue")


@query
def xml_records_per_file(spark, d):
    articles = xml.scan_articles(spark, _ids_corpus(spark, d), schema=schemas.article_of())
    return xml.records_per_file(articles).select("file_name", "n_articles", "n_doi")


def _articles_corpus(spark, d, *parts: str) -> DataFrame:
    """Documents written as XML articles with the given parts, and scanned again."""
    pmid = F.col("MedlineCitation.PMID._VALUE").cast("bigint")
    body = F.struct(*[F.col(f"MedlineCitation.Article.{p}").alias(p) for p in parts])
    citation = F.struct(F.col("MedlineCitation.PMID").alias("PMID"), body.alias("Article"))
    number = F.format_string("%08d", F.floor(pmid / FILE_DOCUMENTS))
    records = v.bib_articles(spark, d).select(
        _numbered("24", number).alias("file"),
        F.lit(ARTICLE).alias("kind"),
        pmid.alias("seq"),
        F.to_xml(
            F.struct(citation.alias("MedlineCitation")), {"rowTag": schemas.ARTICLE_TAG}
        ).alias("value"),
    )
    schema = schemas.article_of(*(f"MedlineCitation.Article.{p}" for p in parts))
    return xml.scan_articles(spark, write_lines(records, new_path(spark, "corpus")), schema=schema)


@query
def xml_author_rows(spark, d):
    return relations.authors(_articles_corpus(spark, d, "AuthorList"))


@query
def xml_abstract_rows(spark, d):
    return relations.abstract(_articles_corpus(spark, d, "Abstract"))


def _escaped(value):
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(sign), F.lit(name))
    return value


def _marked_up_corpus(spark, d) -> str:
    """Documents as XML whose titles, abstracts and references have tags inside; every list of references in the one before."""
    doc, text = F.col("doc_id"), _escaped(F.col("text"))
    lines = F.split(text, "\n")
    listed = F.transform(
        lines, lambda x, i: v.text("<ReferenceList><Title>T", i, "</Title><Reference><Citation>", x, "<b>", i, "</b></Citation></Reference>")
    )
    value = v.text(
        "<PubmedArticle><MedlineCitation><PMID>", doc, "</PMID><Article><ArticleTitle><i>", F.col("lang"), "</i> ", text,
        "<sub>", doc, "</sub></ArticleTitle><Abstract><AbstractText Label='L' NlmCategory='RESULTS'>", text,
        "<mml:math xmlns:mml='http://x'><mml:mi>&#945;&lt;</mml:mi></mml:math></AbstractText></Abstract></Article><CoiStatement>",
        F.col("source"), "<sup>", F.col("lang"), "</sup></CoiStatement></MedlineCitation><PubmedData>",
        F.array_join(listed, ""), F.repeat(F.lit("</ReferenceList>"), F.size(lines)), "</PubmedData></PubmedArticle>",
    )
    number = F.format_string("%08d", F.floor(doc / FILE_DOCUMENTS))
    records = v.table(spark, d, "documents").where("text IS NOT NULL").select(
        _numbered("24", number).alias("file"), F.lit(ARTICLE).alias("kind"), doc.alias("seq"), value.alias("value")
    )
    return write_lines(records, new_path(spark, "corpus"))


@query
def full_text_rows(spark, d):
    """Titles, abstracts and statements with tags inside, out of XML in one projection: whole, and up to the first tag."""
    articles = xml.scan_articles(spark, _marked_up_corpus(spark, d), schema=schemas.article_of("MedlineCitation"))
    whole = relations.rows_of("main")[0], relations.rows_of("abstract")[0]
    leading = relations.rows_of("main", text="leading")[0]
    return articles.select(
        whole[0]["pmid"].alias("pmid"),
        whole[0]["title"].alias("title"),
        whole[0]["coi"].alias("coi"),
        whole[1]["text"].alias("text"),
        leading["title"].alias("leading_title"),
        leading["coi"].alias("leading_coi"),
    )


@query
def deep_reference_rows(spark, d):
    """Reference lists nested as deep as a document has lines, in document order."""
    schema = schemas.article_of("PubmedData.ReferenceList")
    return relations.refs(xml.scan_articles(spark, _marked_up_corpus(spark, d), schema=schema)).select(
        "pmid", "list_title", "list_index", "ref_index", "citation"
    )


def _events_corpus(spark, d) -> tuple[str, DataFrame]:
    """Change rows of the events as corpus files by day and sequence range."""
    day = F.substring("file_name", 12, 2)
    part = F.format_string("%06d", F.expr(f"seq div {FILE_ROWS}"))
    rows = v.bib_changes(spark, d).withColumn("file_name", _numbered("24", day, part))
    rows = rows.select(
        "*",
        F.lit("J").alias("journal_name"),
        F.lit("1").alias("journal_volume"),
        F.lit(2024).alias("journal_year"),
        F.lit("1").alias("journal_month"),
    )
    return write_corpus(rows, new_path(spark, "corpus")), rows.select("file_name").distinct()


@query
def files_listed(spark, d):
    """The corpus folder as a sorted file listing; contents are not read."""
    corpus, _ = _events_corpus(spark, d)
    return inventory.gz_sorted(inventory.list_files(spark, corpus)).select("file_name")


@query
def xml_deleted_log(spark, d):
    """Delete lists of the corpus, one row per entry."""
    return xml.scan_deletes(spark, _events_corpus(spark, d)[0]).select("pmid", "file_name")


@query
def xml_store_snapshot(spark, d):
    """Corpus files applied by the batch loader in two calls, newer files first."""
    corpus, files = _events_corpus(spark, d)
    names = [r.file_name for r in files.orderBy("file_name").collect()]
    paths = [f"{corpus}/file={n}" for n in names]
    store = Store(spark, new_path(spark, "store"))
    half = len(paths) // 2
    store.apply(paths[half:], tables=["ids"])
    store.apply(paths[:half], tables=["ids"])
    return store.read("ids").select("pmid", "doi")


@query
def store_statuses(spark, d):
    """Outcome of applying all files after half of them were applied."""
    corpus, files = _events_corpus(spark, d)
    names = [r.file_name for r in files.orderBy("file_name").collect()]
    paths = [f"{corpus}/file={n}" for n in names]
    store = Store(spark, new_path(spark, "store"))
    store.apply(paths[: len(paths) // 2], tables=[])
    return store.apply(paths, tables=[])


@query
def xml_stream_snapshot(spark, d):
    """The same corpus applied by the streaming ingest in two micro-batches."""
    corpus, _ = _events_corpus(spark, d)
    store = Store(spark, new_path(spark, "store"))
    ingest(store, corpus, new_path(spark, "stream"), 15, ["ids"]).awaitTermination()
    return store.read("ids").select("pmid", "doi")


@query
def stream_snapshot(spark, d):
    """Change rows arriving as files; the state is that of the whole log."""
    source = new_path(spark, "changes")
    rows = v.bib_changes(spark, d)
    part = F.expr(f"seq div {FILE_ROWS}")
    rows.repartition("file_name", part).write.partitionBy("file_name").parquet(source)
    stream = (
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 10).parquet(source)
    )
    log = ChangeLog(spark, new_path(spark, "log"))
    log.start(stream.select(rows.columns), new_path(spark, "stream")).awaitTermination()
    return log.snapshot()


@query
def stream_state_snapshot(spark, d):
    """Newer change rows first, older ones after a restart; the winners are kept in the stream's state."""
    source, check = new_path(spark, "changes"), new_path(spark, "stream")
    rows = v.bib_changes(spark, d)
    late = F.dayofmonth("ts") > 15
    arrivals = v.table(spark, d, "events").select(F.col("event_id").alias("seq"), late.alias("_first"))
    rows = rows.join(arrivals, "seq").select(*rows.columns, "_first")
    state = ChangeState(spark, new_path(spark, "state"))
    for first in (True, False):
        part = rows.where(F.col("_first") == first).drop("_first")
        part.repartition("file_name").write.partitionBy("file_name").mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).option("maxFilesPerTrigger", 40).parquet(source)
        state.start(stream.select(part.columns), check).awaitTermination()
    return state.snapshot()


def _deliver(spark, corpus: str, source: str) -> None:
    """The files of a corpus written once more, one file each, their lines in order."""
    name, at = corpus_name(F.col("_metadata.file_path")).alias("file"), F.monotonically_increasing_id().alias("at")
    lines = spark.read.text(corpus, recursiveFileLookup=True).select("value", name, at)
    # a sort by file alone, which the writer adds, mixes a file's lines when it spills
    lines = lines.repartition("file").sortWithinPartitions("file", "at").select("value", "file")
    lines.write.mode("append").partitionBy("file").option("compression", "gzip").text(source)


@query
def stream_deletion_log(spark, d):
    """Delete lists of the corpus as a stream, each file delivered twice: no entry is logged twice."""
    corpus, _ = _events_corpus(spark, d)
    source = new_path(spark, "delivered")
    for k in (1, 2):
        _deliver(spark, corpus, source)
    log = deletion_log_once(xml.stream_deletes(spark, f"{source}/file=*", 40))
    out = new_path(spark, "log")
    write = log.writeStream.format("parquet").option("checkpointLocation", new_path(spark, "stream"))
    write.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@query
def stream_article_rows(spark, d):
    """Articles of the corpus as a stream of rows."""
    out = new_path(spark, "rows")
    articles = xml.stream_articles(spark, f"{_ids_corpus(spark, d)}/file=*", 3, schemas.IDS_ARTICLE)
    write = relations.identifiers(articles).writeStream.format("parquet")
    write = write.option("checkpointLocation", new_path(spark, "stream")).trigger(availableNow=True)
    write.start(out).awaitTermination()
    return spark.read.parquet(out).drop("journal_issue")


def _document_store(spark, d) -> Store:
    """The documents' articles applied by `update`, a few files at a time."""
    store = Store(spark, new_path(spark, "store"))
    store.reset()
    store.update(_marked_up_corpus(spark, d), max_files=40, tables=["main", "abstract", "refs"])
    return store


@query
def store_update(spark, d):
    return _document_store(spark, d).read("main").select("pmid", "title", "coi")


@query
def store_compact(spark, d):
    """The same after the deltas were folded into a new base."""
    store = _document_store(spark, d)
    store.compact()
    return store.read("abstract")


@query
def store_documents(spark, d):
    found = _document_store(spark, d).documents()
    return found.select(
        F.col("PMID.Value").alias("pmid"), F.col("CoiStatement").alias("coi"), F.size("PubmedData.ReferenceList").alias("n_lists")
    )


@query
def store_reset(spark, d):
    """Tables after a reset: none of the rows and files applied before, and applying them again works."""
    corpus = _marked_up_corpus(spark, d)
    store = Store(spark, new_path(spark, "store"))
    store.update(corpus, tables=["ids"])
    before = store.applied()
    store.reset()
    parts = [store.read(t).agg(F.lit(t).alias("relation"), F.count(F.lit(1)).alias("n_rows")) for t in ("updates", "ids", "main")]
    gone = _union(parts)
    store.update(corpus, tables=["ids"])
    again = store.applied().join(before, "file_name", "left_semi")
    return gone.unionByName(again.agg(F.lit("again").alias("relation"), F.count(F.lit(1)).alias("n_rows")))


PARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "nested_citation": _citation_part, "nested_article": _article_part, "nested_terms": _terms_part, "nested_lists": _lists_part,
}


@query
def document_sink(spark, d):
    """Whole documents written as JSON in parts of even size, read back with their schema: a hash over all fields."""
    docs = _docs(spark, d)
    out = new_path(spark, "documents")
    documents.write_json(docs, out)
    back = spark.read.schema(docs.schema).json(out)
    return _union([_fingerprint(part(back), name) for name, part in PARTS.items()])


@query
def document_variant(spark, d):
    """Whole documents stored as VARIANT, read by path."""
    out = new_path(spark, "documents")
    documents.write_variant(_docs(spark, d), out)
    at = {
        "pmid": "$.PMID.Value", "owner": "$.Owner", "journal": "$.Article.Journal.Title", "title": "$.Article.ArticleTitle",
        "first_language": "$.Article.Language[0]", "subset": "$.CitationSubsets[1]",
    }
    found = spark.read.parquet(out)
    return found.select(*(F.try_variant_get("document", path, "string").alias(name) for name, path in at.items()))
