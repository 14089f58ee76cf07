"""Queries over the nested view put together only the parts of an article that they read."""

import pytest
from conftest import SF, rows

from citeloom.operators import documents, relations
from citeloom.plans import driver_views as v
from citeloom.plans.queries import MAIN, QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_identifiers_do_not_read_the_texts(spark):
    found = plan(QUERIES["first_id_by_type"](spark, SF))
    assert "doc_id" in found and "text:string" not in found


@pytest.mark.parametrize("name", ["main_rows", "nested_terms", "nested_article"])
def test_no_references_where_they_are_not_read(spark, name):
    assert "10.3/" not in plan(QUERIES[name](spark, SF))


def test_items_are_not_copied_by_a_cast(spark):
    assert "cast(transform(" not in plan(QUERIES["nested_lists"](spark, SF))


def test_main_of_the_parts_read_is_that_of_whole_articles(spark):
    whole, part = v.bib_articles(spark, SF), v.bib_articles(spark, SF, only=MAIN)
    assert whole.schema.simpleString() == part.schema.simpleString()
    assert rows(relations.main(part)) == rows(relations.main(whole))


def test_documents_keep_every_part_without_a_choice(spark):
    docs = documents.documents(v.bib_articles(spark, SF))
    n = docs.where("size(Article.AuthorList) > 0 AND size(MeshHeadingList) > 0 AND size(PubmedData.ReferenceList) > 0").count()
    assert n > 0
