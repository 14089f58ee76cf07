"""Schemas: the nested citation record, the flat relations, the store tables.

Every leaf of the XML schema is a string.  The XML source turns a whole row
into NULL when one leaf does not cast, so casting is left to the projections.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


def _list(t: T.DataType) -> T.ArrayType:
    return T.ArrayType(t, True)


# Mixed content: an array item per run of own text.  The scan marks tags inside it as text (functions/text.py), which makes
# one run of the whole content.
MIXED = _struct(_VALUE=_list(S))
# Elements of mixed content.
MIXED_ELEMENTS = (
    "ArticleTitle", "VernacularTitle", "AbstractText", "Affiliation", "Citation", "CoiStatement", "CollectiveName",
    "Keyword", "Param", "Suffix",
)
DATE = _strings("Year", "Month", "Day")
IDENTIFIERS = _list(_strings("_VALUE", "_Source"))
ARTICLE_IDS = _struct(ArticleId=_list(_strings("_VALUE", "_IdType")))
AFFILIATIONS = _list(_struct(Affiliation=MIXED, Identifier=IDENTIFIERS))
ABSTRACT_TEXT = _list(_struct(_VALUE=_list(S), _Label=S, _NlmCategory=S))
PERSON = {"LastName": S, "ForeName": S, "Initials": S, "Suffix": S}
TERM = _strings("_VALUE", "_UI", "_MajorTopicYN")
TERMS = _list(TERM)

ARTICLE = _struct(
    Journal=_struct(
        ISSN=_strings("_VALUE", "_IssnType"),
        JournalIssue=_struct(
            _CitedMedium=S,
            Volume=S,
            Issue=S,
            PubDate=_strings("Year", "Month", "Day", "Season", "MedlineDate"),
        ),
        Title=S,
        ISOAbbreviation=S,
    ),
    ArticleTitle=MIXED,
    Pagination=_strings("StartPage", "EndPage", "MedlinePgn"),
    ELocationID=_list(_strings("_VALUE", "_EIdType", "_ValidYN")),
    Abstract=_struct(AbstractText=ABSTRACT_TEXT, CopyrightInformation=S),
    AuthorList=_struct(
        Author=_list(
            _struct(
                **PERSON,
                CollectiveName=MIXED,
                Identifier=IDENTIFIERS,
                AffiliationInfo=AFFILIATIONS,
            )
        )
    ),
    Language=_list(S),
    DataBankList=_struct(
        _CompleteYN=S,
        DataBank=_list(
            _struct(
                DataBankName=S,
                AccessionNumberList=_struct(AccessionNumber=_list(S)),
            )
        ),
    ),
    GrantList=_struct(
        _CompleteYN=S,
        Grant=_list(_strings("GrantID", "Acronym", "Agency", "Country")),
    ),
    PublicationTypeList=_struct(PublicationType=_list(_strings("_VALUE", "_UI"))),
    VernacularTitle=MIXED,
    ArticleDate=_list(_strings("_DateType", "Year", "Month", "Day")),
)

MEDLINE_CITATION = _struct(
    _Owner=S,
    _Status=S,
    _VersionID=S,
    _VersionDate=S,
    _IndexingMethod=S,
    PMID=_strings("_VALUE", "_Version"),
    DateCompleted=DATE,
    DateRevised=DATE,
    Article=ARTICLE,
    MedlineJournalInfo=_strings("Country", "MedlineTA", "NlmUniqueID", "ISSNLinking"),
    ChemicalList=_struct(
        Chemical=_list(
            _struct(RegistryNumber=S, NameOfSubstance=_strings("_VALUE", "_UI"))
        )
    ),
    SupplMeshList=_struct(SupplMeshName=_list(_strings("_VALUE", "_Type", "_UI"))),
    CitationSubset=_list(S),
    CommentsCorrectionsList=_struct(
        CommentsCorrections=_list(
            _struct(
                _RefType=S,
                RefSource=S,
                # one sample of the format spells the attribute VersionID
                PMID=_strings("_VALUE", "_Version", "_VersionID"),
                Note=S,
            )
        )
    ),
    GeneSymbolList=_struct(GeneSymbol=_list(S)),
    MeshHeadingList=_struct(
        MeshHeading=_list(_struct(DescriptorName=TERM, QualifierName=TERMS))
    ),
    NumberOfReferences=S,
    PersonalNameSubjectList=_struct(PersonalNameSubject=_list(_struct(**PERSON))),
    OtherID=_list(_strings("_VALUE", "_Source")),
    OtherAbstract=_list(
        _struct(AbstractText=ABSTRACT_TEXT, CopyrightInformation=S)
    ),
    KeywordList=_list(
        _struct(
            _Owner=S,
            Keyword=_list(_struct(_VALUE=_list(S), _MajorTopicYN=S)),
        )
    ),
    CoiStatement=MIXED,
    SpaceFlightMission=_list(S),
    InvestigatorList=_struct(
        Investigator=_list(
            _struct(
                _ValidYN=S,
                **PERSON,
                Identifier=IDENTIFIERS,
                AffiliationInfo=AFFILIATIONS,
            )
        )
    ),
    GeneralNote=_list(_strings("_VALUE", "_Owner")),
)

PUBMED_DATA = _struct(
    ArticleIdList=ARTICLE_IDS,
    ObjectList=_struct(
        Object=_list(
            _struct(_Type=S, Param=_list(_struct(_VALUE=_list(S), _Name=S)))
        )
    ),
    ReferenceList=_list(
        _struct(
            Title=S,
            Reference=_list(_struct(Citation=MIXED, ArticleIdList=ARTICLE_IDS)),
            ReferenceList=_list(
                _struct(
                    Title=S,
                    Reference=_list(_struct(Citation=MIXED, ArticleIdList=ARTICLE_IDS)),
                )
            ),
        )
    ),
)

PUBMED_ARTICLE = _struct(MedlineCitation=MEDLINE_CITATION, PubmedData=PUBMED_DATA)
DELETE_CITATION = _struct(PMID=_list(_strings("_VALUE", "_Version")))


def article_of(*paths: str) -> T.StructType:
    """The schema of an article with the parts at these dotted paths only, its PMID and its identifiers."""

    def cut(struct: T.StructType, wanted: list[list[str]]) -> T.StructType:
        fields = []
        for field in struct:
            below = [path[1:] for path in wanted if path[0] == field.name]
            if below:
                fields.append(T.StructField(field.name, field.dataType if [] in below else cut(field.dataType, below)))
        return T.StructType(fields)

    every = ("MedlineCitation.PMID", "PubmedData.ArticleIdList", *paths)
    return cut(PUBMED_ARTICLE, [path.split(".") for path in every])


#: What the `ids` relation reads.
IDS_ARTICLE = article_of("MedlineCitation.Article.Journal")

ROOT_TAG = "PubmedArticleSet"
ARTICLE_TAG = "PubmedArticle"
BOOK_TAG = "PubmedBookArticle"
DELETE_TAG = "DeleteCitation"


# Relation and column names of the flat tables, in file order.
RELATIONS: dict[str, str] = {
    "main": (
        "pmid bigint, doi string, pii string, pmcid string, date_completed string, "
        "date_revised string, issn_value string, issn_type string, "
        "journal_title string, volume string, issue string, pub_date string, "
        "iso_abbrev string, title string, vernacular_title string, pages string, "
        "coi string, n_references string, n_chems int, n_supp_mesh int, n_mesh int, "
        "n_authors int, n_keyword_lists int, n_keywords int, medline_date_raw string"
    ),
    "abstract": (
        "pmid bigint, element_id int, label string, category string, text string"
    ),
    "authors": (
        "pmid bigint, auth_order int, is_collective boolean, is_first boolean, "
        "is_last boolean, last_name string, fore_name string, initials string, "
        "suffix string, orcid string, affiliation string, ringgold_id string, "
        "isni_id string, grid_id string"
    ),
    "chem": "pmid bigint, registry_number string, name string, ui_id string",
    "comments_corrections": (
        "pmid bigint, ref_type string, ref_source string, note string, ref_pmid string"
    ),
    "data_bank": "pmid bigint, is_complete boolean, name string, acc_number string",
    "grants": (
        "pmid bigint, is_complete boolean, grant_id string, acronym string, "
        "agency string, country string"
    ),
    "keywords": "pmid bigint, owner string, is_major boolean, keyword string",
    "languages": "pmid bigint, language string",
    "mesh": (
        "pmid bigint, heading_id int, is_major boolean, ui_id string, value string"
    ),
    "notes": "pmid bigint, text string, owner string",
    "personal_names": (
        "pmid bigint, last_name string, fore_name string, initials string, suffix string"
    ),
    "pub_types": "pmid bigint, ui_id string, value string",
    "refs": (
        "pmid bigint, list_title string, list_index int, ref_index int, "
        "citation string, ref_pmid string, ref_doi string, ref_pii string"
    ),
    "space": "pmid bigint, mission string",
    "supp_mesh": "pmid bigint, type string, ui_id string, value string",
}

AFFILIATION_ROWS = (
    "pmid bigint, auth_order int, aff_order int, affiliation string, ringgold_id string, isni_id string, grid_id string"
)
IDS = (
    "pmid bigint, doi string, journal_name string, journal_volume string, "
    "journal_year int, journal_issue string, journal_month string"
)
UPDATES = "file_name string"
DELETED = "pmid bigint, file_name string"
REJECTS = "file_name string, pmid string, reason string, detail string, kept boolean"
CHANGES = "pmid bigint, op string, file_name string, seq bigint"

# Columns written to a tab separated file: the auto id comes first and is
# empty; `n_keywords` holds the number of keyword lists there.
TSV_RENAMES = {"main": {"n_keyword_lists": "n_keywords"}}
TSV_DROPS = {"main": ["n_keywords", "medline_date_raw"]}


def parse(ddl: str) -> T.StructType:
    """Turn a DDL column list into a StructType without needing a session."""
    types = {
        "int": T.IntegerType(),
        "bigint": T.LongType(),
        "string": T.StringType(),
        "boolean": T.BooleanType(),
    }
    fields = [c.split() for c in ddl.split(",")]
    return T.StructType([T.StructField(n, types[t], True) for n, t in fields])


TABLES: dict[str, T.StructType] = {
    **{name: parse(ddl) for name, ddl in RELATIONS.items()},
    "affiliations": parse(AFFILIATION_ROWS),
    "ids": parse(IDS),
    "updates": parse(UPDATES),
    "deleted": parse(DELETED),
    "rejects": parse(REJECTS),
    "changes": parse(CHANGES),
}


def columns(table: str) -> list[str]:
    return TABLES[table].fieldNames()


def tsv_schema(relation: str) -> T.StructType:
    """Columns of `<root>_<relation>.tsv`, all text, with the leading auto id."""
    drops = set(TSV_DROPS.get(relation, ()))
    renames = TSV_RENAMES.get(relation, {})
    names = [renames.get(c, c) for c in columns(relation) if c not in drops]
    return _strings("id", *names)
