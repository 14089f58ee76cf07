"""Near-duplicate embeddings by small-world graphs, one for each shard.

Equal vectors are one class.  Classes are dealt by a hash into shards of up to SHARD_ROWS, each with its own graph, and
every class is searched in every shard.  A graph travels as one row per node and queries follow it row by row, so that a
task holds one graph and some queries, and Spark no large value.  A query's beam is doubled as long as its worst member is still close to the
threshold, so that large clusters are found whole.  Of every QUERY_ROWS queries AUDITED are also compared with all vectors of
the shard, and starts again with twice the beam until RECALL of their links are found; at the end of that stands the
comparison with all vectors.  Found pairs are verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm import hnsw
from citeloom.llm.graph import components
from citeloom.llm.shared import arrow_stage, sorted_join, stored

THRESHOLD = 0.95
SHARD_ROWS = 65_536
LEAST_SHARDS = 8
QUERY_ROWS = 16_384
RANGE_BLOCKS = 4
LEAST_CELLS = 32
BEAM = 32
MARGIN = 0.02
AUDITED = 64
RECALL = 0.99
COMPARED = 1 << 20
EMITTED = 1 << 16


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, the unit vector in double precision (binary) and its digest; null for vectors that link with nothing."""
    types = pa.schema([("id", pa.int64()), ("unit", pa.binary()), ("digest", pa.binary())])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        units: list[bytes | None] = []
        for value in batch.column(1):
            unit = None
            if value.is_valid and len(value.values) and not value.values.null_count:
                x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and (size := np.abs(x).max()) > 0:
                    x = x / size
                    unit = (x / np.sqrt(x @ x) + 0.0).tobytes()
            units.append(unit)
        yield {"id": batch.column(0), "unit": units, "digest": [u and xxhash.xxh3_128_digest(u) for u in units]}

    source = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return arrow_stage(source, step, "id bigint, unit binary, digest binary", types)


def shard_links(graph: hnsw.Graph, exact: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple]:
    """Row numbers of queries and of vectors with a cosine of at least threshold."""
    single = queries.astype(np.float32)
    loose = np.float32(threshold - 1e-4)

    def beamed(rows: np.ndarray, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        while len(rows):
            if 2 * beam >= len(exact):
                step = max(1, COMPARED // len(exact))
                for a in range(0, len(rows), step):
                    q, v = np.nonzero(single[rows[a : a + step]] @ graph.vectors.T >= loose)
                    yield rows[a : a + step][q], v
                return
            wide = []
            for a in range(0, len(rows), 256):
                part = rows[a : a + 256]
                ids, cos = graph.search(single[part], beam)
                again = cos[:, -1] >= threshold - MARGIN
                wide.append(part[again])
                q, k = np.nonzero((cos >= loose) & ~again[:, None])
                yield part[q], ids[q, k]
            rows, beam = np.concatenate(wide), 2 * beam

    def found(rows: np.ndarray, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for q, v in beamed(rows, beam):
            good = np.zeros(len(q), bool)
            for a in range(0, len(q), 16_384):
                s = slice(a, a + 16_384)
                good[s] = np.einsum("qd,qd->q", queries[q[s]], exact[v[s]]) >= threshold
            yield q[good], v[good]

    audit = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(np.int64))
    truth = sum(int((queries[audit[a : a + 16]] @ exact.T >= threshold).sum()) for a in range(0, len(audit), 16))
    beam = BEAM
    while 2 * beam < len(exact) and sum(len(q) for q, _ in found(audit, beam)) < RECALL * truth:
        beam *= 2
    yield from found(np.arange(len(queries)), beam)


def matrix(values: pa.Array) -> np.ndarray:
    """Binary values of one length as rows of double precision, without a copy."""
    values = values.cast(pa.large_binary())
    _, where, body = values.buffers()
    at = np.frombuffer(where, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(body, np.uint8)[at[0] : at[-1]].view(np.float64).reshape(len(values), -1)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Pieces of batches, sorted by their first columns, in which these have one value."""
    for batch in batches:
        if not len(batch):
            continue
        same = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(keys)])
        cut = np.flatnonzero((same[:, 1:] != same[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(batch)]):
            yield tuple(same[:, a].tolist()), batch.slice(a, b - a)


def graph_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, size, id, unit) sorted by shard and size to those of each graph: shard, size, no, id, unit, links."""
    types = pa.schema(
        [("shard", pa.int64()), ("size", pa.int32()), ("no", pa.int32())]
        + [("id", pa.int64()), ("unit", pa.binary()), ("links", pa.binary())]
    )

    def nodes(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = hnsw.build(np.concatenate([matrix(p.column(3)).astype(np.float32) for p in parts]))
        links, first = hnsw.packed(graph), 0
        for p in parts:
            n = len(p)
            own = links[first : first + n]
            columns = [np.full(n, key[0]), np.full(n, key[1]), np.arange(first, first + n), p.column(2), p.column(3), own]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types)], schema=types)
            first += n

    now: tuple | None = None
    parts: list[pa.RecordBatch] = []
    for key, part in runs(batches, 2):
        if key != now and parts:
            yield from nodes(now, parts)
            parts = []
        now = key
        parts.append(part)
    if parts:
        yield from nodes(now, parts)


class Cell:
    """A shard's graph as it comes in rows, and the queries that wait for it."""

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.nodes: list[pa.RecordBatch] = []
        self.graph: hnsw.Graph | None = None
        self.waiting: list[pa.RecordBatch] = []

    def _load(self) -> None:
        """One graph of all nodes, which go."""
        self.ids = np.concatenate([p.column(5).to_numpy() for p in self.nodes])
        self.exact = np.concatenate([matrix(p.column(6)) for p in self.nodes])
        links = [x for p in self.nodes for x in p.column(7).to_pylist()]
        self.nodes = []
        self.graph = hnsw.unpacked(self.exact, links)

    def links(self, last: bool = False) -> Iterator[np.ndarray]:
        """Pairs of ids of the queries that wait, the lesser first, once there are enough or they are the last."""
        if self.waiting and (last or sum(map(len, self.waiting)) >= QUERY_ROWS):
            if self.nodes:
                self._load()
            if self.graph is not None:
                own = np.concatenate([p.column(5).to_numpy() for p in self.waiting])
                queries = np.concatenate([matrix(p.column(6)) for p in self.waiting])
                for q, v in shard_links(self.graph, self.exact, queries, self.threshold):
                    pair = np.stack((own[q], self.ids[v]), axis=1)
                    yield np.sort(pair[pair[:, 0] != pair[:, 1]], axis=1)
            self.waiting = []


def cell_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows (shard, part, size, asked, no, id, unit, links), sorted: a graph's nodes before their queries."""
    types = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs() -> Iterator[np.ndarray]:
        now, cell = None, Cell(threshold)
        for key, part in runs(batches, 4):
            if key[:3] != now:
                yield from cell.links(last=True)
                now, cell = key[:3], Cell(threshold)
            if key[3]:
                cell.waiting.append(part)
                yield from cell.links()
            else:
                cell.nodes.append(part)
        yield from cell.links(last=True)

    def batch(out: list[np.ndarray]) -> pa.RecordBatch:
        found = np.unique(np.concatenate(out), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=types)

    out: list[np.ndarray] = []
    for pair in pairs():
        out.append(pair)
        if sum(map(len, out)) >= EMITTED:
            yield batch(out)
            out = []
    if out:
        yield batch(out)


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of vectors: id, n_links, component_id, kept.

    n_links counts the other rows linked directly, copies included; component_id is the least id reachable over links,
    the row's own included; kept says that it is the row's own.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, and so do vectors of different lengths.  Rows without an id stay outside:
    component_id null, kept true.  Repeated rows count each.  Other columns are not read.
    """
    rows = stored(unit_vectors(vectors, id_col, vector_col), "unit-vectors")
    classes = (
        rows.where("unit IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit"))
    )
    classes = stored(classes.withColumn("size", F.octet_length("unit")), "vector-classes")
    count = classes.count()
    shards = max(LEAST_SHARDS, -(-count // SHARD_ROWS))
    ranges = max(-(-count // (RANGE_BLOCKS * QUERY_ROWS)), -(-LEAST_CELLS // shards))
    spot = F.xxhash64("digest")
    placed = classes.select(F.pmod(spot, F.lit(shards)).alias("shard"), "size", "id", "unit")
    asked = classes.select("id", "unit", "size", F.pmod(F.shiftright(spot, 20), F.lit(ranges)).alias("part"))

    placed = placed.repartition("shard", "size").sortWithinPartitions("shard", "size")
    kind = "shard bigint, size int, no int, id bigint, unit binary, links binary"
    graphs = stored(placed.mapInArrow(graph_nodes, kind), "graphs")

    names = ("shard", "part", "size", "asked", "no", "id", "unit", "links")
    every_range = graphs.withColumn("part", F.explode(F.expr(f"sequence(0L, {ranges - 1}L)"))).withColumn("asked", F.lit(False))
    every_shard = asked.withColumn("shard", F.explode(F.expr(f"sequence(0L, {shards - 1}L)"))).withColumn("asked", F.lit(True))
    every_shard = every_shard.withColumn("no", F.lit(0)).withColumn("links", F.lit(None).cast("binary"))
    cells = every_range.select(*names).unionByName(every_shard.select(*names)).repartition("shard", "part", "size")
    cells = cells.sortWithinPartitions("shard", "part", "size", "asked", "no")
    found = cells.mapInArrow(lambda batches: cell_links(batches, threshold), "a bigint, b bigint")
    links = stored(found.distinct(), "vector-links")

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("id").alias("b"), "copies")
    linked = sorted_join(both, copies, "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("others"))
    known = (
        classes.select("digest", "id", "copies")
        .join(linked, "id", "left")
        .join(components(links), "id", "left")
        .select(
            F.col("digest").alias("class_digest"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    same = (rows["digest"] == known["class_digest"]) & rows["id"].isNotNull()
    component = F.coalesce("component_id", "id")
    return rows.join(known, same, "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
