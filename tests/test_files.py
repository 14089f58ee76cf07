import glob
from collections import Counter

import pytest
from conftest import FIXTURES, rows
from pyspark.sql import functions as F

from citeloom.functions import files
from citeloom.operators import inventory, relations
from citeloom.sources import schemas, tsv, xml


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "file_name string")


def test_scan_order_and_lineage(spark, corpus):
    a = xml.scan_articles(spark, corpus)
    got = a.filter("file_name = 'pubmed21n0002.xml.gz'").orderBy("seq")
    assert [r[0] for r in got.select("MedlineCitation.PMID._VALUE").collect()] == [
        "101", "102", "104", "104",
    ]


def test_deletes_books_and_counts(spark, corpus):
    deletes = xml.scan_deletes(spark, corpus)
    assert rows(deletes.select("pmid", "file_name")) == [
        (102, "pubmed21n0002.xml.gz"),
        (103, "pubmed21n0002.xml.gz"),
        (104, "pubmed21n0004.xml.gz"),
        (999, "pubmed21n0004.xml.gz"),
    ]
    assert rows(xml.count_books(spark, corpus)) == [("pubmed21n0001.xml.gz", 1)]
    assert rows(xml.records_per_file(xml.scan_articles(spark, corpus), deletes)) == [
        ("pubmed21n0001.xml.gz", 3, 1, 0),
        ("pubmed21n0002.xml.gz", 4, 4, 2),
        ("pubmed21n0003.xml.gz", 1, 1, 0),
        ("pubmed21n0004.xml.gz", 0, 0, 2),
    ]


def test_malformed_input(spark):
    path = str(FIXTURES / "broken.xml")
    with pytest.raises(Exception, match="malformed record in broken.xml"):
        xml.scan_articles(spark, path).collect()
    loose = xml.scan_articles(spark, path, "PERMISSIVE")
    seen = loose.orderBy("seq").select("MedlineCitation.PMID._VALUE", "is_corrupt").collect()
    assert [(r.is_corrupt, r._VALUE) for r in seen] == [(False, "1"), (True, None), (False, "3")]
    with pytest.raises(ValueError):
        xml.scan_articles(spark, path, "DROPMALFORMED")


def test_one_scan_gives_articles_and_deletes(spark, corpus):
    records = xml.scan_records(spark, corpus)
    kinds = {k: n for k, n in records.groupBy("kind").count().collect()}
    assert kinds == {"article": 8, "deletes": 2, "book": 1, "end": 4}
    both = records.select("file_name", "kind", "MedlineCitation.PMID._VALUE", "deletes")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    found = xml.deleted(records)
    assert rows(found.select("pmid")) == [(102,), (103,), (104,), (999,)]


def test_files_without_compression_are_split(spark, tmp_path):
    """Records cross the borders of splits; none is lost, doubled or out of order."""
    one = "<PubmedArticle><MedlineCitation><PMID>{}</PMID><Article><ArticleTitle>{}</ArticleTitle></Article></MedlineCitation></PubmedArticle>\n"
    text = "".join(one.format(i, "t" * (i % 50)) for i in range(3000))
    (tmp_path / "a.xml").write_text(f"<PubmedArticleSet>{text}<DeleteCitation><PMID>5</PMID></DeleteCitation></PubmedArticleSet>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        a = xml.scan_articles(spark, str(tmp_path))
        assert a.rdd.getNumPartitions() > 4
        got = a.orderBy("seq").select(F.col("MedlineCitation.PMID._VALUE").cast("int")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [x[0] for x in got] == list(range(3000))


def test_listing_and_gaps(spark, corpus):
    listed = inventory.gz_sorted(inventory.list_files(spark, corpus))
    assert [r.file_name for r in listed.collect()] == [f"pubmed21n000{i}.xml.gz" for i in (1, 2, 3, 4)]
    assert listed.filter("length <= 0").count() == 0
    remote = names(spark, "b.gz", "a.gz", "c.txt")
    mirror = names(spark, "a.gz")
    assert rows(inventory.missing(remote, mirror)) == [("b.gz",), ("c.txt",)]
    assert [r[0] for r in inventory.unapplied(remote, mirror).collect()] == ["b.gz"]
    assert inventory.combine(remote, mirror).count() == 4
    assert rows(inventory.after(remote, "b.gz")) == [("c.txt",)]


def test_file_kind(spark):
    listing = names(
        spark, "pubmed21n1062.xml.gz", "pubmed21n1063.xml.gz", "pubmed22n0001.xml.gz", "odd.gz",
        "pubmed21n10000.xml.gz", "pubmed21n00001000.xml",
    )
    kinds = {r.file_name: r.kind for r in inventory.file_kind(listing).collect()}
    assert kinds == {
        "pubmed21n1062.xml.gz": "baseline",
        "pubmed21n1063.xml.gz": "update",
        "pubmed22n0001.xml.gz": "reject",
        "odd.gz": "reject",
        "pubmed21n10000.xml.gz": "update",
        "pubmed21n00001000.xml": "baseline",
    }


def test_files_are_ordered_by_number(spark):
    """9999 comes before 10000, years are numbers (99 after 21), other names come first, by name."""
    order = ["a.gz", "pubmed21n9999.xml.gz", "pubmed21n10000.xml.gz", "pubmed22n0001.xml.gz", "pubmed99n0001.xml.gz"]
    listing = names(spark, *reversed(order))
    assert [r[0] for r in inventory.unapplied(listing, names(spark, "none.gz")).collect()] == order
    after = inventory.after(listing, "pubmed21n9999.xml.gz").collect()
    assert sorted(r[0] for r in after) == order[2:]


def test_names_of_paths(spark):
    paths = [
        ("file:/c/pubmed21n0001.xml.gz", "pubmed21n0001.xml.gz"),
        ("/c/file=pubmed21n0001.xml.gz/part-0.txt.gz", "pubmed21n0001.xml.gz"),
        ("/c/file=pubmed21n0001.xml.gz", "pubmed21n0001.xml.gz"),
        ("/c/other.xml", "other.xml"),
    ]
    df = spark.createDataFrame(paths, "path string, name string")
    assert df.filter(files.corpus_name(F.col("path")) != F.col("name")).count() == 0
    root = df.select(files.root_name(F.lit("pubmed21n0001.xml.gz")).alias("r")).first().r
    assert root == "pubmed21n0001"


def test_tsv_bytes(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, True, 'say "hi"', None)], "pmid int, is_complete boolean, name string, acc_number string"
    )
    out = str(tmp_path / "x")
    tsv.write_tsv(df.coalesce(1), "data_bank", out)
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{out}/part-*"))
    assert text == '""\t"1"\t"1"\t"say ""hi"""\t""\n'


def test_tsv_round_trip_of_awkward_text(spark, tmp_path):
    values = ["tab\there", "line\nbreak", "back\\slash", 'q"uote', "é α", "\\", "a\\\"b", "x\r\ny"]
    df = spark.createDataFrame(
        [(i, v, "NLM") for i, v in enumerate(values)], "pmid int, text string, owner string"
    )
    out = str(tmp_path / "x")
    tsv.write_tsv(df, "notes", out)
    assert rows(tsv.read_tsv(spark, "notes", out), "pmid") == rows(df, "pmid")


def test_main_tsv_has_the_counted_lists(spark, scan, tmp_path):
    out = str(tmp_path / "x")
    main = relations.main(scan("children.xml"))
    tsv.write_tsv(main, "main", out)
    back = tsv.read_tsv(spark, "main", out)
    assert back.columns == [
        c for c in schemas.columns("main") if c not in ("n_keywords", "medline_date_raw")
    ]
    assert back.filter("pmid = 1").first().n_keyword_lists == 2
    assert len(schemas.tsv_schema("main")) == 24


def test_fan_out(spark, corpus, tmp_path):
    records = xml.scan_records(spark, corpus)
    tmp_path = tmp_path / "tsv"
    out = str(tmp_path)
    tsv.write_fan_out(records, out)
    articles = xml.scan_articles(spark, corpus)
    filled = {name for name, df in relations.shred(articles).items() if not df.isEmpty()}
    assert {p.name for p in tmp_path.iterdir() if p.is_dir()} == {f"relation={r}" for r in filled | {"deleted"}}
    roots = {p.name for p in (tmp_path / "relation=main").iterdir() if p.is_dir()}
    assert roots == {f"root=pubmed21n000{i}" for i in (1, 2, 3)}
    back = tsv.read_tsv(spark, "authors", str(tmp_path / "relation=authors/root=pubmed21n0003"))
    assert rows(back.select("pmid", "auth_order", "last_name")) == [(103, 0, "New"), (103, 1, "Other")]
    assert rows(tsv.read_deleted(spark, out)) == [
        (102, "pubmed21n0002"), (103, "pubmed21n0002"), (104, "pubmed21n0004"), (999, "pubmed21n0004"),
    ]


def test_fan_out_holds_what_each_relation_alone_writes(spark, scan, tmp_path):
    """Every relation of every fixture, with one scan in the plan."""
    names = ("children.xml", "authors.xml", "abstracts.xml", "references.xml", "mixed.xml")
    staged = str(tmp_path / "articles")
    xml.scan_articles(spark, [str(FIXTURES / n) for n in names]).write.parquet(staged)
    articles = spark.read.parquet(staged)
    tsv.write_fan_out(articles, str(tmp_path / "out"))
    for name, df in relations.shred(articles).items():
        plain = [tuple(None if v == "" else v for v in row) for row in rows(df.drop(*schemas.TSV_DROPS.get(name, ())))]
        folder = tmp_path / "out" / f"relation={name}"
        back = rows(tsv.read_tsv(spark, name, str(folder))) if folder.exists() else []
        assert Counter(back) == Counter(plain)
    opened = scan("children.xml").withColumn("deletes", F.lit(None).cast("array<string>")).select(F.inline(tsv.lines()))
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_surrounding_blanks_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "  padded  ", "\tNLM\t")], "pmid int, text string, owner string")
    tsv.write_tsv(df, "notes", str(tmp_path / "x"))
    assert rows(tsv.read_tsv(spark, "notes", str(tmp_path / "x"))) == [(1, "  padded  ", "\tNLM\t")]


def test_variants_are_stored_in_small_row_groups(spark, scan, tmp_path):
    """A reader's batch is a row group at most, so whole documents need no more memory than one has."""
    import pyarrow.parquet as pq

    from citeloom.operators import documents

    one = documents.documents(scan("children.xml")).limit(1)
    noise = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(300)), lambda i: F.sha2(F.concat_ws("-", "id", i), 256)))
    many = one.drop("CoiStatement").crossJoin(spark.range(0, 2000, 1, 1)).withColumn("CoiStatement", noise).drop("id")
    documents.write_variant(many, str(tmp_path / "v"))
    groups = 0
    for file in glob.glob(f"{tmp_path}/v/part-*"):
        meta = pq.ParquetFile(file).metadata
        sizes = [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
        assert max(sizes) < 16 << 20
        groups += len(sizes)
    assert groups > 1
    back = spark.read.parquet(str(tmp_path / "v"))
    assert back.select(F.expr("variant_get(document, '$.CoiStatement', 'string')").alias("c")).distinct().count() == 2000


def test_documents_are_written_without_a_shuffle(spark, scan, tmp_path):
    """Neither JSON documents nor a fan-out's lines are shuffled: each task's rows end in its own files."""
    from citeloom.operators import documents

    four = spark.range(0, 40, 1, 4)
    docs = four.crossJoin(F.broadcast(documents.documents(scan("children.xml")))).drop("id")
    documents.write_json(docs, str(tmp_path / "json"))
    assert len(glob.glob(f"{tmp_path}/json/part-*")) == docs.rdd.getNumPartitions() == 4
    assert spark.read.schema(docs.schema).json(str(tmp_path / "json")).count() == docs.count()
    records = four.crossJoin(F.broadcast(xml.scan_records(spark, str(FIXTURES / "children.xml")))).drop("id")
    tsv.write_fan_out(records, str(tmp_path / "tsv"), compression="gzip")
    files = glob.glob(f"{tmp_path}/tsv/relation=main/root=*/part-*")
    assert len(files) == 4 and all(f.endswith(".gz") for f in files)
    assert tsv.read_tsv(spark, "main", str(tmp_path / "tsv/relation=main")).count() == records.where("kind = 'article'").count()


def test_json_of_documents_is_read_once(spark):
    """All paths of a text come from one reading."""
    from conftest import SF

    from __spark_entry__ import queries

    plan = queries()["nested_json"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and plan.count("from_json") == 1


def test_json_items_without_a_value_are_the_text_null(spark, tmp_path):
    from __spark_entry__ import queries

    docs = spark.createDataFrame(
        [(1, "one\ntwo", None, "s"), (2, "three", "en", None)], "doc_id bigint, text string, lang string, source string"
    )
    docs.withColumn("n_chars", F.length("text").cast("bigint")).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    found = queries()["nested_json"](spark, str(tmp_path)).select("pmid", "owner", "first_language", "subset")
    assert rows(found, "pmid") == [("1", "s", "null", "s"), ("2", None, "en", "null")]
