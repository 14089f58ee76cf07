"""Article identifiers."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.text import as_key, default


def _of_type(ids: Column, id_type: str) -> Column:
    return F.filter(ids, lambda x: x["_IdType"] == F.lit(id_type))


def first_id(ids: Column, id_type: str) -> Column:
    """First identifier of a type, NULL when there is none."""
    return F.get(_of_type(ids, id_type), F.lit(0))["_VALUE"]


def last_id(ids: Column, id_type: str) -> Column:
    """Last identifier of a type, `''` when there is none."""
    return default(F.try_element_at(_of_type(ids, id_type), F.lit(-1))["_VALUE"])


def article_id(pubmed_data: Column, id_type: str) -> Column:
    """DOI, PII or PMCID of an article, `''` when absent."""
    return default(first_id(pubmed_data["ArticleIdList"]["ArticleId"], id_type))


def last_of_source(identifiers: Column, source: str) -> Column:
    matches = F.filter(identifiers, lambda x: x["_Source"] == F.lit(source))
    return default(F.try_element_at(matches, F.lit(-1))["_VALUE"])


def pmid(medline_citation: Column) -> Column:
    return as_key(medline_citation["PMID"]["_VALUE"])


def pmid_with_fallback(article: Column) -> Column:
    """PMID of the identifier list when it also has a DOI, else the citation's."""
    ids = article["PubmedData"]["ArticleIdList"]["ArticleId"]
    has_doi = F.exists(ids, lambda x: x["_IdType"] == F.lit("doi"))
    listed = F.when(has_doi, as_key(first_id(ids, "pubmed")))
    return F.coalesce(listed, pmid(article["MedlineCitation"]))


def _folds() -> tuple[str, str]:
    """Letters that are a letter of ASCII with marks, and that letter; by rule, from the characters' decompositions."""
    found = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        if len(bare) == 1 and bare.isascii():
            found[chr(code)] = bare.lower()
    return "".join(found), "".join(found.values())


_FOLDED, _BARE = _folds()


def doi_fold(doi: Column) -> Column:
    """Comparison form of a DOI in which neither case nor accents count; `''` matches nothing."""
    return F.translate(F.regexp_replace(doi_key(doi), r"\p{Mn}+", ""), _FOLDED, _BARE)


def doi_key(doi: Column) -> Column:
    """Comparison form of a DOI: case does not count, `''` matches nothing."""
    return F.lower(F.when(doi != "", doi))
