"""Graphs travel as rows: no value of a table that op9 stores or shuffles grows with a shard."""

import numpy as np
import pyarrow as pa
from helpers import ROOT

from citeloom.llm import embedding_dedup, hnsw


def vectors(n, d=16, seed=4):
    v = np.random.default_rng(seed).normal(size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_a_graph_comes_back_from_its_nodes():
    for n in (1, 2, 50, 2000):
        graph = hnsw.build(vectors(n))
        again = hnsw.unpacked(vectors(n), hnsw.packed(graph))
        assert graph.entry == again.entry and len(graph.links) == len(again.links)
        assert all((a == b).all() for a, b in zip(graph.links, again.links))


def test_cells_in_batches_of_any_size():
    """Nodes and queries of several cells, cut anywhere, give the links of a comparison with all."""
    v = vectors(60, 3)
    unit = [x.tobytes() for x in v]
    links = hnsw.packed(hnsw.build(v))
    rows = []
    for part in (0, 1):
        rows += [(0, part, 24, False, i, i, unit[i], links[i]) for i in range(60)]
        rows += [(0, part, 24, True, 0, i, unit[i], None) for i in range(part, 60, 2)]
    rows += [(1, 0, 24, True, 0, 7, unit[7], None)]  # a shard without vectors of this length
    names = ["shard", "part", "size", "asked", "no", "id", "unit", "links"]
    table = pa.table([pa.array(c) for c in zip(*rows)], names=names)
    near = v @ v.T >= 0.95
    want = {(a, b) for a, b in zip(*np.nonzero(np.triu(near, 1)))}
    for size in (1, 7, 1000):
        got = set()
        for batch in embedding_dedup.cell_links(iter(table.to_batches(max_chunksize=size)), 0.95):
            got |= set(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        assert want and got == want


def test_stored_rows_are_single_nodes(spark, monkeypatch):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT
    found, plain = {}, embedding_dedup.stored

    def stored(df, name):
        found[name] = plain(df, name)
        return found[name]

    monkeypatch.setattr(embedding_dedup, "stored", stored)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors(300))], "vec_id bigint, embedding array<double>")
    embedding_dedup.near_vectors(df).collect()
    assert max(len(r["unit"]) for r in found["graphs"].collect()) == 16 * 8 and found["graphs"].count() == 300
