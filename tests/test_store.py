import itertools

from conftest import FIXTURES, rows

from pyspark.sql import functions as F

from citeloom.plans.store import Store
from citeloom.sources import schemas

FILES = [f"pubmed21n000{i}.xml.gz" for i in (1, 2, 3, 4)]
IDS = [(101, "10.1000/new"), (103, "10.1000/back")]
AUTHORS = [(101, 0, "New"), (101, 1, "Other"), (103, 0, "New"), (103, 1, "Other")]
DELETED = [
    (102, "pubmed21n0002.xml.gz"),
    (103, "pubmed21n0002.xml.gz"),
    (104, "pubmed21n0004.xml.gz"),
    (999, "pubmed21n0004.xml.gz"),
]


def check(store, children=("authors", "languages")):
    assert rows(store.read("ids").select("pmid", "doi")) == IDS
    assert rows(store.read("main").select("pmid", "doi")) == IDS
    assert rows(store.read("authors").select("pmid", "auth_order", "last_name")) == AUTHORS
    assert rows(store.read("deleted")) == DELETED
    assert [x[0] for x in rows(store.applied())] == FILES
    assert rows(store.documents().select("PMID.Value")) == [("101",), ("103",)]
    assert rows(store.read("changes").select("pmid", "op")) == [
        (101, "U"), (102, "D"), (103, "U"), (104, "D"), (999, "D"),
    ]
    main = [x.pmid for x in store.read("main").select("pmid").collect()]
    for name in children:
        assert store.read(name).filter(~F.col("pmid").isin(main)).count() == 0


def test_one_batch(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path))
    status = store.apply([f"{corpus}/{f}" for f in FILES])
    assert rows(status) == [(f, 2) for f in FILES]
    check(store, schemas.RELATIONS)
    # a second time nothing happens
    again = store.apply([f"{corpus}/{f}" for f in FILES])
    assert rows(again) == [(f, 1) for f in FILES]
    assert rows(store.read("ids").select("pmid", "doi")) == IDS


def test_any_order_gives_the_same_tables(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path))
    for i in (1, 3, 2, 0):
        store.apply([f"{corpus}/{FILES[i]}"], tables=["main", "ids"])
    check(store)
    store.compact()
    check(store)
    assert store.read("superseded").count() == 0


def test_every_order_of_change_rows(spark):
    from citeloom.operators import changes

    log = [
        (1, "U", "f1", 0, "a"), (1, "U", "f2", 5, "b"), (1, "D", "f2", 0, ""),
        (1, "U", "f3", 0, "c"), (2, "U", "f1", 1, "x"), (2, "D", "f1", 0, ""),
    ]
    for order in itertools.permutations(log):
        best = {}
        for row in order:
            key = (row[2], row[1] == "D", row[3])
            if row[0] not in best or key > best[row[0]][0]:
                best[row[0]] = (key, row)
        assert sorted(v[1] for v in best.values() if v[1][1] == "U") == [log[3]]
    for order in [log, log[::-1], log + log]:
        df = spark.createDataFrame(order, "pmid int, op string, file_name string, seq bigint, doi string")
        assert rows(changes.snapshot(df)) == [log[3]]
        assert rows(changes.deletion_log(df.distinct())) == [(1, "f2"), (2, "f1")]


def test_late_old_file_does_not_resurrect(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path))
    store.apply([f"{corpus}/{FILES[3]}"], tables=["ids"])
    store.apply([f"{corpus}/{FILES[1]}"], tables=["ids"])
    assert rows(store.read("ids").select("pmid", "doi")) == [(101, "10.1000/new")]


def test_update_and_reset(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path))
    store.reset()
    assert store.read("main").count() == 0
    assert store.read("main").schema.fieldNames() == schemas.columns("main")
    store.update(corpus, max_files=3)
    check(store)
    store.reset()
    assert store.applied().count() == 0 and store.read("authors").count() == 0


def test_a_malformed_record_loses_only_itself(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path))
    status = store.apply([str(FIXTURES / "broken.xml"), f"{corpus}/{FILES[0]}"], tables=[])
    assert rows(status) == [("broken.xml", 2), (FILES[0], 2)]
    assert [x[0] for x in rows(store.read("ids").select("pmid"))] == [1, 3, 101, 102, 103]
    bad = '<PubmedArticle><MedlineCitation><PMID Version="1">2</PMID><Article></MedlineCitation></PubmedArticle>'
    assert rows(store.read("rejects")) == [("broken.xml", "2", "malformed_record", bad, False)]


def test_a_cut_off_file_gives_its_whole_records(spark, tmp_path):
    text = (FIXTURES / "mixed.xml").read_text(encoding="utf-8")
    short, whole = tmp_path / "in" / "pubmed21n0001.xml", tmp_path / "again" / "pubmed21n0001.xml"
    for path, content in ((short, text[: text.index("<PMID Version=\"1\">3<")]), (whole, text)):
        path.parent.mkdir()
        path.write_text(content, encoding="utf-8")
    store = Store(spark, str(tmp_path / "store"))
    assert rows(store.apply([str(short)], tables=["ids"])) == [("pubmed21n0001.xml", None)]
    assert [x[0] for x in rows(store.read("ids").select("pmid"))] == [1, 2]
    found = rows(store.read("rejects").select("pmid", "reason", "kept"))
    assert found == [(None, "cut_off_file", True), (None, "malformed_record", False)]
    # the whole file can still be applied
    assert rows(store.apply([str(whole)], tables=["ids"])) == [("pubmed21n0001.xml", 2)]
    assert [x[0] for x in rows(store.read("ids").select("pmid"))] == [1, 2, 3, 4, 5, 6]


def test_rejected_articles_are_listed(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.apply([str(FIXTURES / "dates.xml"), str(FIXTURES / "authors.xml")], tables=["main"])
    kept = rows(store.read("rejects").groupBy("reason", "kept").count())
    assert kept == [
        ("bad_pub_date", True, 5),
        ("unknown_affiliation_id_source", True, 1),
        ("unknown_author_id_source", True, 1),
    ]
    # pmids 1-4 come from both files; the later file name wins
    # a date that cannot be read leaves the article in every table
    assert store.read("main").count() == 21
    assert store.read("main").filter("pub_date IS NULL").count() == 5
    assert store.read("ids").count() == 21


def test_missing_parts_raise_nothing_on_an_empty_store(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.applied().count() == 0
    assert store.read("ids").count() == 0


def test_bulk_load_keeps_the_first_article(spark, corpus, tmp_path):
    """101 and 104 come twice: the first stays in main, rows of children of both stay; deletes are only logged."""
    from citeloom.sources import tsv, xml

    out = str(tmp_path / "tsv")
    tsv.write_fan_out(xml.scan_records(spark, corpus), out)
    store = Store(spark, str(tmp_path / "store"))
    store.load_tsv(out)
    every = xml.scan_articles(spark, corpus).orderBy("file_name", "seq").collect()
    first = {}
    for a in every:
        first.setdefault(int(a.MedlineCitation.PMID._VALUE), a.MedlineCitation.Article.ArticleTitle)
    main = {x.pmid: x.title for x in store.read("main").collect()}
    assert main == {k: t._VALUE[0] if t and t._VALUE else None for k, t in first.items()}
    languages = spark.createDataFrame([(int(a.MedlineCitation.PMID._VALUE), x) for a in every for x in a.MedlineCitation.Article.Language or []], "a int, b string")
    assert rows(store.read("languages")) == rows(languages)
    assert rows(store.read("deleted")) == DELETED and [x[0] for x in rows(store.applied())] == FILES
    assert rows(store.apply([f"{corpus}/{f}" for f in FILES])) == [(f, 1) for f in FILES]
    import pytest

    with pytest.raises(ValueError, match="empty store"):
        store.load_tsv(out)


def test_bulk_load_checks_parents_and_is_overridden_by_updates(spark, corpus, tmp_path):
    from citeloom.sources import tsv, xml

    out = tmp_path / "tsv"
    first = xml.scan_records(spark, f"{corpus}/{FILES[0]}")
    tsv.write_fan_out(first, str(out))
    lost = spark.createDataFrame([(7, "eng")], "pmid bigint, language string")
    tsv.write_tsv(lost, "languages", str(out / "relation=languages" / "root=pubmed21n0001"), "append")
    store = Store(spark, str(tmp_path / "store"))
    store.load_tsv(str(out))
    assert rows(store.read("rejects")) == [(FILES[0], "7", "missing_parent", "languages", False)]
    assert store.read("languages").filter("pmid = 7").count() == 0
    store.apply([f"{corpus}/{f}" for f in FILES[1:]])
    assert rows(store.read("ids").select("pmid", "doi")) == IDS
    assert rows(store.read("authors").select("pmid", "auth_order", "last_name")) == AUTHORS
    store.compact()
    assert rows(store.read("main").select("pmid", "doi")) == IDS


def test_bulk_load_shuffles_keys_not_rows(spark):
    """Orphans are found by key; with them at hand the other rows are kept without a shuffle, null keys being orphans."""
    from citeloom.plans import bulk

    columns = "pmid bigint, language string, file_name string"
    found = spark.createDataFrame([(1, "eng", "f"), (2, "ger", "f"), (None, "fre", "f"), (2, "ger", "f")], columns)
    main = spark.createDataFrame([(1,)], "pmid bigint")
    lost = bulk.lost(found, main)
    assert lost.columns == ["pmid", "file_name"] and sorted(lost.collect(), key=str) == [(2, "f"), (2, "f"), (None, "f")]
    few = spark.createDataFrame([(2, "f"), (None, "f")], "pmid bigint, file_name string")
    assert rows(bulk.kept(found, few)) == [(1, "eng", "f")]


def test_tables_are_compressed_well(spark, corpus, tmp_path):
    import pyarrow.parquet as pq

    store = Store(spark, str(tmp_path))
    store.apply([f"{corpus}/{f}" for f in FILES], tables=["main"])
    for table in ("articles", "main"):
        files = list(tmp_path.glob(f"batches/*/table={table}/*.parquet"))
        groups = [pq.ParquetFile(f).metadata for f in files]
        used = {g.row_group(0).column(0).compression for g in groups if g.num_row_groups}
        assert used == {"ZSTD"}, (table, used)
