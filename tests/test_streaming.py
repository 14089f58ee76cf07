from pathlib import Path

from conftest import rows
from test_store import FILES, check

from citeloom.operators import changes
from citeloom.plans.store import Store
from citeloom.sources import xml
from citeloom.streaming.ingest import ChangeLog, ChangeState, deletion_log_once, deletion_log_stream, ingest


def test_ingest_equals_batch_and_runs_once(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    where = str(tmp_path / "checkpoint")
    ingest(store, corpus, where, 2, ["main", "ids"]).awaitTermination()
    check(store, ["languages"])
    before = store._live().batches
    ingest(store, corpus, where, 2, ["main", "ids"]).awaitTermination()
    assert store._live().batches == before
    # a lost checkpoint is no harm: the ledger still knows the files
    ingest(store, corpus, str(tmp_path / "fresh"), 2, ["main", "ids"]).awaitTermination()
    assert store._live().batches == before


def test_row_streams(spark, corpus, tmp_path):
    out, seen = str(tmp_path / "a"), str(tmp_path / "b")
    q = (
        xml.stream_articles(spark, corpus, 1)
        .selectExpr("MedlineCitation.PMID._VALUE AS pmid", "file_name")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ca"))
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 8
    deletes = xml.stream_deletes(spark, corpus, 1).selectExpr("pmid", "file_name", "'D' AS op")
    q = (
        deletion_log_stream(deletes)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cb"))
        .trigger(availableNow=True)
        .start(seen)
    )
    q.awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(seen))] == [102, 103, 104, 999]


def test_change_log_ignores_arrival_order(spark, tmp_path):
    schema = "pmid int, op string, file_name string, seq bigint"
    source = str(tmp_path / "in")
    late_first = [
        [(1, "D", "f3", 0), (2, "U", "f3", 1)],
        [(1, "U", "f2", 0)],
        [(1, "U", "f1", 0), (2, "U", "f1", 1), (3, "U", "f1", 2)],
    ]
    log = ChangeLog(spark, str(tmp_path / "log"))
    for part in late_first:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        log.start(stream, str(tmp_path / "cp")).awaitTermination()
    assert rows(log.snapshot()) == [(2, "U", "f3", 1), (3, "U", "f1", 2)]
    every = spark.read.schema(schema).parquet(source)
    assert rows(changes.snapshot(every)) == rows(log.snapshot())


def test_files_are_named(corpus):
    assert len(FILES) == 4


def test_two_streams_write_one_log(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"))
    assert log.snapshot().count() == 0
    schema = "pmid bigint, op string, file_name string, seq bigint"
    for k in (1, 2):
        source = str(tmp_path / f"in{k}")
        spark.createDataFrame([(k, "U", "pubmed21n0001.xml.gz", k)], schema).write.parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        log.start(stream, str(tmp_path / f"check{k}")).awaitTermination()
    assert sorted(r["pmid"] for r in log.snapshot().collect()) == [1, 2]


def test_state_survives_restarts_and_late_files(spark, tmp_path):
    """Winners of three triggers with a restart before each are those of all rows; tombstones stay."""
    schema = "pmid bigint, op string, file_name string, seq bigint, doi string"
    f = "pubmed21n000{}.xml.gz".format
    parts = [
        [(1, "U", f(3), 5, "c"), (2, "D", f(3), 0, None), (None, "U", f(3), 6, "no key")],
        [(1, "U", f(1), 0, "a"), (2, "U", f(2), 9, "late"), (3, "U", f(2), 1, "x"), (1, "U", f(3), 5, "c")],
        [(3, "D", f(4), 0, None), (1, "U", f(4), 2, "d")],
    ]
    state, source = ChangeState(spark, str(tmp_path / "state")), str(tmp_path / "in")
    assert state.snapshot().count() == 0
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        state.start(spark.readStream.schema(schema).parquet(source), str(tmp_path / "cp")).awaitTermination()
    every = spark.read.schema(schema).parquet(source)
    assert rows(state.winners()) == rows(changes.latest(every))
    assert rows(state.snapshot().where("pmid IS NOT NULL")) == [(1, "U", f(4), 2, "d")]
    # a late row wins nothing: what the second epoch wrote for 1 and 2 are the winners of before
    second = spark.read.parquet(str(tmp_path / "state" / "epoch=1")).where("pmid < 3")
    assert rows(second.select("pmid", "op", "file_name")) == [(1, "U", f(3)), (2, "D", f(3))]


def test_a_redelivered_file_logs_nothing(spark, corpus, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    source.mkdir()
    for name in ("pubmed21n0002.xml.gz", "pubmed21n0004.xml.gz"):
        for folder in ("a", "b"):
            (source / folder).mkdir(exist_ok=True)
            (source / folder / name).write_bytes((Path(corpus) / name).read_bytes())
            log = deletion_log_once(xml.stream_deletes(spark, f"{source}/*", 1))
            q = log.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out)
            q.awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(out))] == [102, 103, 104, 999]


def test_ingest_compacts(spark, corpus, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    ingest(store, corpus, str(tmp_path / "cp"), 1, ["ids"], compact_after=2).awaitTermination()
    live = store._live()
    assert live.base and len(live.deltas) < 2
    assert [r.pmid for r in store.read("ids").orderBy("pmid").collect()] == [101, 103]


def test_stream_parses_a_record_once_and_on_all_cores(spark, corpus, tmp_path):
    """The filter of a stream's records asks for nothing parsed; few files are dealt to all cores before they are parsed."""
    write = xml.stream_articles(spark, corpus, 1).selectExpr("MedlineCitation.PMID._VALUE AS pmid").writeStream
    q = write.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("from_xml" in line for line in filters)
    assert "Exchange hashpartitioning(value" in plan


def test_malformed_article_still_fails_the_stream(spark, tmp_path):
    import gzip

    import pytest
    from pyspark.errors import StreamingQueryException

    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "pubmed21n0009.xml.gz", "wt") as out:
        out.write("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>1</PMID></PubmedArticle></PubmedArticleSet>")
    articles = xml.stream_articles(spark, str(tmp_path / "in"), 1).selectExpr("MedlineCitation.PMID._VALUE AS pmid")
    write = articles.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    with pytest.raises(StreamingQueryException, match="malformed record"):
        write.start(str(tmp_path / "out")).awaitTermination()


def test_delivered_files_keep_their_lines_in_order(spark, tmp_path):
    import gzip

    from citeloom.plans.queries import _deliver

    lines = {f"pubmed24n000{k}.xml.gz": [f"{k} line {i * 7919 % 4001}" for i in range(4000)] for k in (1, 2, 3)}
    for name, own in lines.items():
        folder = tmp_path / "corpus" / f"file={name}"
        folder.mkdir(parents=True)
        with gzip.open(folder / "part-0.txt.gz", "wt") as out:
            out.write("\n".join(own) + "\n")
    conf = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf()
    setting = "spark.shuffle.spill.numElementsForceSpillThreshold"
    conf.set(setting, "500")  # a sort of more rows spills, as one of a large file does
    try:
        _deliver(spark, str(tmp_path / "corpus"), str(tmp_path / "again"))
    finally:
        conf.remove(setting)
    for name, own in lines.items():
        (part,) = (tmp_path / "again" / f"file={name}").glob("*.gz")
        with gzip.open(part, "rt") as back:
            assert back.read().split("\n")[:-1] == own
