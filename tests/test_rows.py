import random
from contextlib import contextmanager

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.operators import changes, lookup, ordinals
from citeloom.operators.joins import join_keyed


def test_ordinals_of_hot_groups(spark):
    """A key with most rows is ranked in pieces; the result is the same."""
    random.seed(1)
    data = [(1 if i % 3 else i, random.randrange(50), i) for i in range(3000)]
    df = spark.createDataFrame(data, "pmid int, a int, b int").repartition(7)
    expected = []
    groups = {}
    for k, a, b in data:
        groups.setdefault(k, []).append((a, b))
    for k, items in groups.items():
        expected += [(k, a, b, i) for i, (a, b) in enumerate(sorted(items))]
    got = ordinals.ordinal_within(df, ["pmid"], ["a", "b"])
    assert dict(got.dtypes)["ordinal"] == "bigint"
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    # the same with the hot key NULL
    got = ordinals.ordinal_within(df.withColumn("pmid", F.expr("nullif(pmid, 1)")), ["pmid"], ["a", "b"])
    assert sorted((1 if k is None else k, *x) for k, *x in got.collect()) == sorted(expected)


def test_edge_flags(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (2, 5)], "pmid int, pos int")
    got = ordinals.edge_flags(df, "pmid", "pos").select("pmid", "pos", "is_first", "is_last", "n_items")
    assert rows(got) == [
        (1, 0, True, False, 3), (1, 1, False, False, 3), (1, 2, False, True, 3), (2, 5, True, True, 1),
    ]


def test_child_counts(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pmid int")
    children = spark.createDataFrame([(1,), (1,), (3,)], "pmid int")
    assert rows(ordinals.child_counts(parents, children)) == [(1, 2), (2, 0)]


def test_cascade_and_parents(spark):
    children = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "pmid int, v string")
    gone = spark.createDataFrame([(2,)], "pmid int")
    assert rows(changes.cascade(children, gone)) == [(1, "a"), (3, "d")]
    parents = spark.createDataFrame([(1,), (2,)], "pmid int")
    assert rows(changes.with_parent(children, parents)) == [(1, "a"), (2, "b"), (2, "c")]
    assert rows(changes.orphans(children, parents)) == [(3, "d")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    log = spark.range(1000).selectExpr(
        "1 AS pmid", "'U' AS op", "'f' AS file_name", "id AS seq", "id AS payload"
    )
    assert rows(changes.snapshot(log)) == [(1, "U", "f", 999, 999)]
    plan = changes.latest(log)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


@contextmanager
def skew_settings(spark):
    """Sort-merge joins, and thresholds that a small table exceeds."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, value in conf.items():
        spark.conf.set(k, value)
    try:
        yield
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_joins_split_a_hot_key(spark):
    """A third of the rows share a key; no task gets all of them."""
    n = 150_000
    data = spark.range(n).repartition(8).selectExpr(
        "IF(id % 3 = 0, 'k7', concat('k', id % 20000)) AS pmid", "id AS pos", "uuid() AS pad"
    )
    with skew_settings(spark):
        ids = spark.range(20_000).selectExpr("CAST(id AS INT) AS pmid", "concat('K', id) AS doi")
        kept = data.select("pmid").filter("pmid <> 'k7'").distinct()
        for df, hot in (
            (lookup.dois_to_pmids(ids, data.withColumnRenamed("pmid", "doi")), "doi = 'k7'"),
            (ordinals.edge_flags(data, "pmid", "pos"), "pmid = 'k7'"),
            (changes.cascade(data, kept), "pmid = 'k7'"),
        ):
            out = df.agg(
                F.sum(F.xxhash64(*df.columns) % 10), F.count_if(F.expr(hot)).alias("n")
            )
            assert out.collect()[0].n >= n // 3
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan


def test_join_of_different_widths(spark):
    left = spark.createDataFrame([(1,), (2,)], "pmid bigint")
    right = spark.createDataFrame([(2,)], "pmid int")
    assert rows(join_keyed(left, right, ["pmid"], "left_anti")) == [(1,)]
    with pytest.raises(ValueError):
        join_keyed(left, right.selectExpr("string(pmid) AS pmid"), ["pmid"], "left_semi")


CHANGE = st.tuples(
    st.integers(1, 3), st.sampled_from("UD"), st.sampled_from(["f1", "f2", "f3"]), st.integers(0, 3)
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=st.lists(CHANGE, min_size=1, max_size=12))
def test_snapshot_is_the_replay_in_order(spark, log):
    state = {}
    for pmid, op, file_name, seq in sorted(log, key=lambda c: (c[2], c[1] == "D", c[3])):
        if op == "D":
            state.pop(pmid, None)
        else:
            state[pmid] = (pmid, op, file_name, seq)
    df = spark.createDataFrame(log, "pmid int, op string, file_name string, seq int")
    assert rows(changes.snapshot(df)) == sorted(state.values())


def test_parts_of_an_article_give_the_rows_of_the_whole(spark):
    """A scan that parses only what a relation reads gives what the whole article gives."""
    from conftest import FIXTURES

    from citeloom.operators import relations
    from citeloom.sources import schemas, xml

    names = [str(FIXTURES / f"{n}.xml") for n in ("children", "authors", "references", "mixed", "pubmed21n0001")]
    cases = {
        "ids": (relations.identifiers, schemas.IDS_ARTICLE),
        "authors": (relations.authors, schemas.article_of("MedlineCitation.Article.AuthorList")),
        "refs": (relations.refs, schemas.article_of("PubmedData.ReferenceList")),
        "main": (relations.main, schemas.article_of("MedlineCitation")),
    }
    for make, schema in cases.values():
        whole, part = (make(xml.scan_articles(spark, names, schema=s)) for s in (schemas.PUBMED_ARTICLE, schema))
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))
    assert schemas.article_of()["MedlineCitation"].dataType.fieldNames() == ["PMID"]
    assert schemas.article_of()["PubmedData"].dataType.fieldNames() == ["ArticleIdList"]
