import json

import pytest
from conftest import rows

from citeloom.operators import lookup

ROWS = [
    (1, "10.1/Abc"), (2, "10.1/abc"), (3, ""), (4, ""), (5, "10.2/x"), (6, "10.3/q\"uote"),
]


@pytest.fixture(scope="module")
def ids(spark):
    return spark.createDataFrame(ROWS, "pmid int, doi string")


def single(df):
    return tuple(df.first())


def test_single(ids):
    assert single(lookup.pmid_to_doi(ids, 5)) == (0, "success", "10.2/x", 1)
    assert single(lookup.pmid_to_doi(ids, "5")) == (0, "success", "10.2/x", 1)
    assert single(lookup.pmid_to_doi(ids, 3)) == (0, "success", "", 1)
    missing = (2, "pmid value not found in database", None, 0)
    assert single(lookup.pmid_to_doi(ids, 99)) == missing
    assert single(lookup.pmid_to_doi(ids, "junk")) == missing
    assert single(lookup.doi_to_pmid(ids, "10.1/ABC")) == (0, "success", 1, 2)
    assert single(lookup.doi_to_pmid(ids, "")) == (2, "doi value not found in database", None, 0)
    with pytest.raises(ValueError, match="pmid"):
        lookup.pmid_to_doi(ids, None)
    with pytest.raises(ValueError, match="doi"):
        lookup.doi_to_pmid(ids, None)


def test_single_body(ids):
    body = lookup.single_body(lookup.pmid_to_doi(ids, 99), "doi").first().body
    assert json.loads(body) == {
        "status": 2, "message": "pmid value not found in database", "doi": None,
    }


def batch(spark, ids, text, name, translate, other):
    found = translate(ids, lookup.requests(spark, text, name))
    return [r.value for r in lookup.compat(found, other).orderBy("pos").collect()]


def test_batches_keep_order_and_duplicates(spark, ids):
    got = batch(spark, ids, "5,99,5,3,,junk", "pmid", lookup.pmids_to_dois, "doi")
    assert got == ["10.2/x", "-1", "10.2/x", "", "-1", "-1"]
    got = batch(spark, ids, "10.2/X,10.1/abc,,10.9/z,10.2/x", "doi", lookup.dois_to_pmids, "pmid")
    assert got == ["5", "1", "-1", "-1", "5"]
    with pytest.raises(ValueError, match="pmids"):
        lookup.pmids_to_dois(ids, ids.select("doi"))
    with pytest.raises(ValueError, match="dois"):
        lookup.dois_to_pmids(ids, ids.select("pmid"))


def test_list_requests_may_hold_commas(spark, ids):
    more = ids.union(spark.createDataFrame([(7, "10.4/a,b")], "pmid int, doi string"))
    found = lookup.dois_to_pmids(more, lookup.requests(spark, ["10.4/A,B", None], "doi"))
    assert rows(found.select("pos", "pmid", "status"), "pos") == [(0, 7, 0), (1, None, 2)]


def test_bodies(spark, ids):
    found = lookup.pmids_to_dois(ids, lookup.requests(spark, "6,99,3", "pmid"))
    body = lookup.batch_body(found, "doi", []).first().body
    assert json.loads(body) == {
        "status": 0, "message": "retrieving dois for pmids", "dois": ['10.3/q"uote', -1, ""],
    }
    found = lookup.dois_to_pmids(ids, lookup.requests(spark, "10.2/x,none", "doi"))
    body = lookup.batch_body(found, "pmid", []).first().body
    assert json.loads(body)["pmids"] == [5, -1]


def test_hot_request_key_and_no_broadcast(spark, ids):
    """A third of the requests ask for one DOI; sort-merge joins give the same."""
    requests = spark.range(3000).selectExpr(
        "id AS pos", "CASE WHEN id % 3 = 0 THEN '10.2/X' WHEN id % 3 = 1 THEN '' ELSE 'n' || id END AS doi"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup.dois_to_pmids(ids, requests)
        assert found.count() == 3000
        assert found.filter("pmid = 5").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_request_side_is_what_is_broadcast(spark, ids, tmp_path):
    """The big table is filtered by the keys, not shuffled."""
    path = str(tmp_path / "ids")
    lookup.with_doi_key(ids).write.parquet(path)
    table = spark.read.parquet(path)
    plan = lookup.dois_to_pmids(table, lookup.requests(spark, "10.2/x", "doi"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi, BuildRight" in text and "SortMergeJoin" not in text
    single_plan = lookup.doi_to_pmid(table, "10.2/X")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doi_key,10.2/x)" in single_plan


def test_single_lookups_cast_as_batches_do(spark):
    ids = spark.createDataFrame([(1000, "10.1/A")], "pmid int, doi string")
    for junk in ("99999999999999999999", "1_000", "x", ""):
        assert lookup.pmid_to_doi(ids, junk).first()["status"] == lookup.NOT_FOUND
    assert lookup.pmid_to_doi(ids, " 1000 ").first()["doi"] == "10.1/A"
    assert lookup.doi_to_pmid(ids, "10.1/a").first()["pmid"] == 1000
    assert lookup.doi_to_pmid(ids, "").first()["status"] == lookup.NOT_FOUND


def test_accents_and_case(spark, tmp_path):
    """Each form of comparison, letters with marks composed or not, and a stored form that the scan filters by."""
    from citeloom.plans.store import Store

    dois = ["10.1/Émile", "10.1/EMILE", "10.1/émile", "10.1/émile", "10.1/ømile", "10.1/ǟ", ""]
    ids = spark.createDataFrame(list(enumerate(dois)), "pmid bigint, doi string")

    def found(doi, ignore):
        row = lookup.doi_to_pmid(ids, doi, ignore).first()
        return row.pmid, row.n_matches

    assert found("10.1/ÉMILE", "case") == (0, 2) and found("10.1/émîlé", "case") == (None, 0)
    assert found("10.1/ÉMILE", "accents") == (0, 4) and found("10.1/émîlé", "accents") == (0, 4)
    assert found("10.1/omile", "accents") == (None, 0) and found("10.1/A", "accents") == (5, 1)
    assert found("", "accents") == (None, 0)
    with pytest.raises(ValueError):
        lookup.doi_to_pmid(ids, "x", "spaces")
    store = Store(spark, str(tmp_path))
    store.reset()
    plan = lookup.doi_to_pmid(store.read("ids"), "10.1/É", "accents")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doi_fold,10.1/e)" in plan
