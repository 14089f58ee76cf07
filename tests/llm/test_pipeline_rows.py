"""Numbering of rows without copies of them, rows dropped without a shuffle of texts, the fit in blocks."""

import numpy as np
import pytest
from helpers import table, text

import corpus_pipeline
from citeloom.llm import quality


def _stored_names(monkeypatch):
    names, plain = [], corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: (names.append(name), plain(df, name))[1])
    return names


def test_rows_of_files_are_not_copied(spark, tmp_path, monkeypatch):
    rows = [(i % 50, text(i % 70, 30)) for i in range(300)] + [(None, None), (None, None)]
    table(spark, rows).repartition(7).write.parquet(str(tmp_path / "a b"))
    docs, names = spark.read.parquet(str(tmp_path / "a b")), _stored_names(monkeypatch)
    for stage in (corpus_pipeline.exact_stage, corpus_pipeline.near_stage):
        from_files = sorted(map(str, stage(spark, docs, "").collect()))
        assert "numbered" not in names
        copied = stage(spark, table(spark, rows), "")
        assert "numbered" in names and from_files == sorted(map(str, copied.collect()))
        names.clear()


@pytest.mark.parametrize("change", ["filter", "explode", "union"])
def test_parts_of_files_are_copied(spark, tmp_path, monkeypatch, change):
    table(spark, [(i, text(i, 9)) for i in range(40)]).write.parquet(str(tmp_path / "d"))
    docs, names = spark.read.parquet(str(tmp_path / "d")), _stored_names(monkeypatch)
    docs = {"filter": docs.where("doc_id <> 3"), "explode": docs.join(spark.range(2).toDF("twice")), "union": docs.union(docs)}[change]
    numbered = corpus_pipeline._numbered(docs)
    assert "numbered" in names and numbered.select("n").distinct().count() == docs.count()


def test_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    spark.range(200_000).selectExpr("id AS doc_id", "concat('some words of a text ', id div 3) AS text").repartition(3).write.parquet(str(tmp_path / "d"))
    rows = corpus_pipeline._numbered(spark.read.parquet(str(tmp_path / "d")))
    gone = rows.where("id % 3 = 1").select("n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        left = corpus_pipeline._without(rows, gone)
        plan = left._jdf.queryExecution().executedPlan().toString()
        found = {r[0] for r in left.select("doc_id").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert found == {i for i in range(200_000) if i % 3 != 1}


def test_fit_holds_one_block_in_double_precision(monkeypatch):
    r = np.random.default_rng(1)
    x, y = r.normal(size=(500, 6)).astype(np.float32), r.integers(0, 2, 500).astype(float)
    whole = quality.fit_logistic(x, y, np.ones(500))
    monkeypatch.setattr(quality, "_BLOCK", 64)
    seen, plain = [], quality._sigmoid
    monkeypatch.setattr(quality, "_sigmoid", lambda z: (seen.append(len(z)), plain(z))[1])
    assert np.allclose(quality.fit_logistic(x, y, np.ones(500)), whole, rtol=1e-9, atol=1e-12) and max(seen) == 64
