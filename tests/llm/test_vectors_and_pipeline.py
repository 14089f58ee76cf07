"""Embedding near-duplicates by brute force, the pipeline and the registered queries."""

import re

import duckdb
import numpy as np
import pytest
from helpers import ROOT, odd_texts, table, text, words
from test_dedup import plain_components

import corpus_pipeline
from __spark_entry__ import queries
from citeloom.llm import embedding_dedup
from citeloom.llm.embedding_dedup import near_vectors
from citeloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def clusters(seed=0, n=700, d=24):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(40, d))
    out = [list(map(float, centres[i % 40] + r.normal(size=d) * 0.12 * (i % 5))) for i in range(n)]
    return out + [out[7]] * 150 + [[2 * x for x in out[9]]]


@pytest.mark.parametrize("shard_rows", [65_536, 90])
def test_vectors(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(embedding_dedup, "LEAST_SHARDS", 2)
    monkeypatch.setattr(embedding_dedup, "QUERY_ROWS", 400)
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    good = clusters()
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows = [(5 + 2 * i, v, 1, i, "x") for i, v in enumerate(good + odd)] + [(None, good[0], 0, 0, "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, id int, unit string").repartition(3)
    got = {r["id"]: r for r in near_vectors(df).collect()}
    assert len(got) == len(rows)
    x = np.array(good)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    ids = [5 + 2 * i for i in range(len(good + odd))]
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)))] + [(ids[-2], ids[-1])]
    want = plain_components(ids, links)
    missed = sum(int(near[i].sum()) - 1 - got[ids[i]]["n_links"] for i in range(len(good)))
    assert 0 <= missed <= 0.02 * len(links) and (shard_rows != 90 or missed == 0)
    for i in ids[len(good) : -2]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    if not missed:
        assert {i: got[i]["component_id"] for i in ids} == want
    assert got[None]["kept"] and near_vectors(df.limit(0)).count() == 0


def plain_near(rows):
    """(number, id) of the row that stays of each group of rows whose shingle sets reach 0.75."""
    def shingles(t):
        w = words(t, True)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    groups = {}
    for n, c in plain_components(list(range(len(rows))), links).items():
        groups.setdefault(c, []).append((rows[n][0] is None, rows[n][0] or 0))
    return sorted(min(g) for g in groups.values())


def test_pipeline_stages(spark):
    """Rows, not ids, go: repeated ids with other texts, rows repeated whole, rows without id, clashing names."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "personal_data", "packing"]
    near_copy = text(1, 120).replace("der", "zzz", 1)
    rows = [(10 + 3 * i, t) for i, t in enumerate(odd_texts())]
    rows += [rows[6], (None, "no id here"), (None, "no id here"), (5, near_copy), (5, "unrelated words of a text " * 3), (5, text(3, 20))]
    docs = table(spark, rows).withColumnRenamed("digest", "_gone").withColumnRenamed("row", "component").withColumnRenamed("n", "kept2")
    exact = corpus_pipeline.exact_stage(spark, docs, SF)
    best = {}
    for key, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        best[low] = max(best.get(low, (False, 0)), (key is not None, key or 0))
    got = exact.select("doc_id", "text", "_gone", "component", "kept2").collect()
    assert exact.columns == docs.columns and sorted((r[0] is not None, r[0] or 0) for r in got) == sorted(best.values())
    assert all(r["_gone"] == "d" and r["component"] == "r" and r["kept2"] == 7 for r in got)
    kept = [(r["doc_id"], r["text"]) for r in got]
    near = corpus_pipeline.near_stage(spark, exact, SF)
    left = [(r["doc_id"], r["text"]) for r in near.collect()]
    assert near.columns == docs.columns and sorted((k is None, k or 0) for k, _ in left) == plain_near(kept)
    assert (5, "unrelated words of a text " * 3) in left and set(left) <= set(kept)
    private = corpus_pipeline.private_stage(spark, table(spark, [(1, "to a.b@c.example.com"), (2, None), (3, text(1, 5))]), SF)
    rows = {r["doc_id"]: r for r in private.collect()}
    assert rows[1]["n_chars"] == len(rows[1]["text"]) and rows[3]["text"] == text(1, 5) and rows[2]["text"] is None
    assert private.columns == table(spark).columns
    bare = corpus_pipeline.private_stage(spark, table(spark, [(1, "to a.b@c.example.com")]).select("doc_id", "text"), SF)
    assert bare.columns == ["doc_id", "text"] and bare.count() == 1


def test_pipeline_runs(spark, tmp_path):
    out = queries()["pipeline"](spark, SF).collect()
    documents = {r[0] for r in duckdb.execute(f"SELECT doc_id FROM '{SF}/documents.parquet'").fetchall()}
    assert out and {r["doc_id"] for r in out} < documents
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert queries()["pipeline"](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = queries()[name](spark, SF)
    rows = sorted((tuple(r[c] for c in sorted(got.columns)) for r in got.collect()), key=str)
    assert rows
    if name in ORACLE:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
        found = con.execute(ORACLE[name])
        names = [d[0] for d in found.description]
        want = [tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall()]
        assert sorted(names) == sorted(got.columns) and rows == sorted(want, key=str)


def test_odd_rows_are_all_there(spark):
    assert table(spark).count() == len(odd_texts()) + 2
