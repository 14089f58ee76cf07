"""Hierarchical navigable small-world graphs in numpy: built and searched for many vectors at once.

A node's level is drawn from its number by a hash.  Nodes are inserted in batches: a batch is searched in the graph so
far, its own nodes are compared with each other, and neighbours are chosen so that they are closer to the node than to
one another, which keeps paths between clusters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from citeloom.llm.words import mix

LINKS = 16
BUILD_BEAM = 48
BATCH = 256
EXPAND = 4


def levels(n: int) -> np.ndarray:
    u = (mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.minimum((-np.log(u + 1e-18) / np.log(LINKS)).astype(np.int64), 6)


@dataclass
class Graph:
    """Unit vectors (float32) and for each level the neighbours of each node, -1 where there are fewer."""

    vectors: np.ndarray
    links: list[np.ndarray] = field(default_factory=list)
    entry: int = 0

    def _search(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes of each query that a beam reaches from its start nodes: numbers and cosines, best first."""
        n, q, links = len(self.vectors), len(queries), self.links[level]
        rows = np.arange(q)[:, None]
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        ids = np.full((q, beam), -1)
        cos = np.full((q, beam), -np.inf, np.float32)
        opened = np.ones((q, beam), bool)
        width = min(beam, start.shape[1])
        first = start[:, :width]
        ids[:, :width] = first
        cos[:, :width] = np.where(first < 0, -np.inf, np.einsum("qd,qkd->qk", queries, self.vectors[first]))
        opened[:, :width] = first < 0
        seen[rows, np.where(first < 0, n, first)] = True
        active = np.arange(q)
        while len(active):
            rank = np.where(opened[active], -np.inf, cos[active])
            best = np.argpartition(-rank, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND] if beam > 1 else np.zeros((len(active), 1), int)
            lane = np.arange(len(active))[:, None]
            use = rank[lane, best] > -np.inf
            opened[active[:, None], best] = True
            near = links[np.where(use, ids[active[:, None], best], 0)]
            near = np.where(use[:, :, None], near, -1).reshape(len(active), -1)
            near = np.sort(np.where(near < 0, n, near), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            near[seen[active[:, None], near]] = n
            seen[active[:, None], near] = True
            keep = near < n
            most = int(keep.sum(axis=1).max())
            if most:
                order = np.argsort(~keep, axis=1, kind="stable")[:, :most]
                near, keep = near[lane, order], keep[lane, order]
                own = np.einsum("qd,qkd->qk", queries[active], self.vectors[np.where(keep, near, 0)])
                all_cos = np.concatenate((cos[active], np.where(keep, own, -np.inf)), axis=1)
                all_ids = np.concatenate((ids[active], np.where(keep, near, -1)), axis=1)
                all_opened = np.concatenate((opened[active], ~keep), axis=1)
                top = np.argpartition(-all_cos, beam - 1, axis=1)[:, :beam]
                cos[active], ids[active], opened[active] = all_cos[lane, top], all_ids[lane, top], all_opened[lane, top]
            active = active[(~opened[active]).any(axis=1)]
        order = np.argsort(-cos, axis=1, kind="stable")
        return ids[rows, order], cos[rows, order]

    def search(self, queries: np.ndarray, beam: int, down_to: int = 0) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(queries), 1), self.entry)
        for level in range(len(self.links) - 1, down_to, -1):
            start, _ = self._search(queries, start, 4, level)
        return self._search(queries, start, beam, down_to)

    def _choose(self, ids: np.ndarray, cos: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (best first) those closer to the node than to one chosen before, then the closest."""
        q, k = ids.shape
        good = ids >= 0
        if k <= most:
            return np.where(good, ids, -1)
        vectors = self.vectors[np.where(good, ids, 0)]
        between = np.einsum("qid,qjd->qij", vectors, vectors)
        chosen = np.zeros((q, k), bool)
        for j in range(k):
            closest = np.where(chosen, between[:, j], -np.inf).max(axis=1)
            chosen[:, j] = good[:, j] & (closest < cos[:, j])
        rank = np.where(chosen, 0, np.where(good, 1, 2)) * k + np.arange(k)
        order = np.argsort(rank, axis=1)[:, :most]
        rows = np.arange(q)[:, None]
        return np.where(good[rows, order], ids[rows, order], -1)

    def _connect(self, nodes: np.ndarray, ids: np.ndarray, cos: np.ndarray, level: int) -> None:
        links = self.links[level]
        most = links.shape[1]
        chosen = self._choose(ids, cos, LINKS)
        links[nodes, : chosen.shape[1]] = chosen
        source = np.repeat(nodes, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hit, at, n = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(hit), BATCH):
            part = slice(a, a + BATCH)
            new = np.full((len(hit[part]), int(n[part].max())), -1)
            row = np.repeat(np.arange(len(new)), n[part])
            col = np.arange(n[part].sum()) - np.repeat(np.cumsum(n[part]) - n[part], n[part])
            new[row, col] = source[at[part][0] : at[part][0] + n[part].sum()]
            both = np.concatenate((links[hit[part]], new), axis=1)
            both = np.sort(both, axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            score = np.einsum("qd,qkd->qk", self.vectors[hit[part]], self.vectors[np.where(both < 0, 0, both)])
            score = np.where(both < 0, -np.inf, score)
            order = np.argsort(-score, axis=1, kind="stable")[:, : 4 * most]
            rows = np.arange(len(new))[:, None]
            kept = self._choose(both[rows, order], score[rows, order], most)
            links[hit[part], : kept.shape[1]] = kept
            links[hit[part], kept.shape[1] :] = -1


def _unlinked(n: int, top: int) -> list[np.ndarray]:
    return [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(top + 1)]


def _entry(level: np.ndarray) -> int:
    """The first node of the highest level."""
    return int(np.argmax(level))


def build(vectors: np.ndarray) -> Graph:
    """A graph over unit vectors."""
    n = len(vectors)
    graph = Graph(np.ascontiguousarray(vectors, np.float32))
    if not n:
        return graph
    level = levels(n)
    top = int(level.max())
    graph.links = _unlinked(n, top)
    order = np.argsort(-level, kind="stable")  # upper levels first: all nodes of a level are there before the lower ones
    graph.entry = _entry(level)
    done = 1
    while done < n:
        nodes = order[done : done + min(BATCH, done)]
        own = graph.vectors[nodes]
        inner = own @ own.T
        np.fill_diagonal(inner, -np.inf)
        start = np.full((len(nodes), 1), graph.entry)
        for k in range(top, -1, -1):
            here = np.flatnonzero(level[nodes] >= k)
            if not len(here):
                start, _ = graph._search(own, start, 4, k)
                continue
            ids, cos = graph._search(own, start, BUILD_BEAM, k)
            start = ids[:, :4]
            mates = np.argsort(-inner[np.ix_(here, here)], axis=1)[:, :LINKS]
            mate_cos = inner[np.ix_(here, here)][np.arange(len(here))[:, None], mates]
            mate_ids = np.where(np.isfinite(mate_cos), nodes[here][mates], -1)
            all_ids, all_cos = np.concatenate((ids[here], mate_ids), axis=1), np.concatenate((cos[here], mate_cos), axis=1)
            best = np.argsort(-all_cos, axis=1, kind="stable")[:, :BUILD_BEAM]
            rows = np.arange(len(here))[:, None]
            graph._connect(nodes[here], all_ids[rows, best], all_cos[rows, best], k)
        done += len(nodes)
    return graph


def packed(graph: Graph) -> list[bytes]:
    """Each node's neighbours, from the lowest level to its own."""
    level = levels(len(graph.vectors))
    return [b"".join(graph.links[k][i].tobytes() for k in range(n + 1)) for i, n in enumerate(level.tolist())]


def unpacked(vectors: np.ndarray, packs: list[bytes]) -> Graph:
    """The graph of vectors that packed gave."""
    level = levels(len(vectors))
    graph = Graph(np.ascontiguousarray(vectors, np.float32), _unlinked(len(vectors), int(level.max())), _entry(level))
    flat = np.frombuffer(b"".join(packs), np.int32)
    first = np.cumsum([0, *map(len, packs)])[:-1] // 4
    for k, links in enumerate(graph.links):
        own = np.flatnonzero(level >= k)
        start = first[own] + (LINKS * (k + 1) if k else 0)
        for a in range(0, len(own), 4096):
            links[own[a : a + 4096]] = flat[start[a : a + 4096, None] + np.arange(links.shape[1])]
    return graph
