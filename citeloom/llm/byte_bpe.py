"""Byte-level BPE with a rank file, encoded and decoded by DuckDB inside each task.

A task cuts its documents at white space, where the pattern always cuts too, splits each different chunk by the pattern
and gives the pieces it has not met to a recursive query: rows of (word, position, token) join the merge table, each
round contracts every word's leftmost pair of least rank, until no pair is left.  Where no merge of the file can lower
the rank of a neighbouring pair (checked for each token when the file is read), the other pairs of that rank in the word
are contracted in the same round, left to right, with the same result.  A piece of over LONG_PIECE bytes, which the
database's memory might not hold, is contracted by a heap of its pairs, in memory in proportion to the piece.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.interning import Kept, intern, spell
from citeloom.llm.shared import arrow_stage
from citeloom.llm.words import Block, blocks, kinds, span_hashes

KEPT_CHUNKS = 200_000
QUERY_BYTES = 100_000
BLOCK_BYTES = 1 << 20
LONG_WORD = 64
LONG_PIECE = 20_000
DECODE_IDS = 1 << 17

#: One contraction of each word a round.  k is 65536 times the word plus the position, which counts from 0 without gaps;
#: best is 65536 times the rank plus the position.  A word without pairs ends as done.
_CONTRACT = """
WITH RECURSIVE step(k, tok, done) AS (
    SELECT w * 65536 + pos, tok, false FROM word_bytes
  UNION ALL
    SELECT s.k - CASE WHEN s.k & 65535 > b.best & 65535 THEN 1 ELSE 0 END,
           CASE WHEN s.k & 65535 = b.best & 65535 THEN b.best >> 16 ELSE s.tok END, b.best IS NULL
    FROM step s LEFT JOIN (
        SELECT x.k >> 16 AS w, min(m.merged * 65536 + (x.k & 65535)) AS best
        FROM step x JOIN step y ON y.k = x.k + 1 JOIN merges m ON m.pair = (x.tok << 32) | y.tok
        WHERE NOT x.done AND NOT y.done GROUP BY x.k >> 16
    ) b ON b.w = s.k >> 16
    WHERE NOT s.done AND (b.best IS NULL OR s.k & 65535 <> (b.best & 65535) + 1)
)
SELECT k >> 16 AS w, list(tok ORDER BY k) AS ids FROM step WHERE done GROUP BY k >> 16 ORDER BY w
"""

#: For long words: every other pair of a run of least pairs in a round, where that comes to the same.
_CONTRACT_RUNS = """
WITH RECURSIVE step(w, pos, tok, done) AS (
    SELECT w, pos, tok, false FROM word_bytes
  UNION ALL
    SELECT w, pos, tok, done FROM (
        SELECT w, pos, CASE WHEN cut THEN best ELSE tok END AS tok, best IS NULL AS done,
               coalesce(lag(cut) OVER (PARTITION BY w ORDER BY pos), false) AS eaten
        FROM (
            SELECT *, hit AND CASE WHEN safe THEN (row_number() OVER (PARTITION BY w, hit, run ORDER BY pos)) % 2 = 1
                                   ELSE nth = 1 END AS cut
            FROM (
                SELECT *, rn - nth AS run
                FROM (
                    SELECT *, row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS nth
                    FROM (
                        SELECT *, coalesce(merged = best, false) AS hit
                        FROM (
                            SELECT s.*, m.merged, m.safe, min(m.merged) OVER (PARTITION BY w) AS best
                            FROM (
                                SELECT *, lead(tok) OVER o AS nxt, row_number() OVER o AS rn
                                FROM step WHERE NOT done WINDOW o AS (PARTITION BY w ORDER BY pos)
                            ) s LEFT JOIN merges m ON m.l = s.tok AND m.r = s.nxt
                        )
                    )
                )
            )
        )
    ) WHERE NOT eaten
)
SELECT w, list(tok ORDER BY pos) AS ids FROM step WHERE done GROUP BY w ORDER BY w
"""

_DECODE = """
SELECT d, string_agg(hex, '' ORDER BY pos) AS hex FROM ids JOIN vocabulary USING (id) GROUP BY d ORDER BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _database() -> duckdb.DuckDBPyConnection:
    return duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "100MB", "temp_directory": ""})


class Encoder:
    """The merge table of one rank file in an in-memory DuckDB of one thread, and the ids of chunks met lately."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.kept = Kept(KEPT_CHUNKS)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        lowered = {x for x, m in zip(left, merged) if m < x} | {x for x, m in zip(right, merged) if m < x}
        merges = pa.table({"l": left, "r": right, "merged": merged, "safe": [m not in lowered for m in merged]})
        self.db = _database()
        self.db.register("merges_in", merges)
        self.db.execute("CREATE TABLE merges AS SELECT *, (l << 32) | r AS pair FROM merges_in")
        self.db.unregister("merges_in")
        self.pairs: dict[int, int] = {}

    def _long_pairs(self) -> dict[int, int]:
        """The rank of each pair of tokens (left times 2**32 plus right), read when the first long piece comes."""
        if not self.pairs:
            rows = self.db.sql("SELECT pair, merged FROM merges").fetchnumpy()
            self.pairs = dict(zip(*(x.tolist() for x in rows.values())))
        return self.pairs

    def _contract_long(self, word: bytes) -> bytes:
        """The leftmost pair of least rank in turn, from the sorted first pairs and a heap of those that arise."""
        pairs = self._long_pairs()
        data, n = np.frombuffer(word, np.uint8), len(word)
        first = np.array([pairs.get(int(a) << 32 | int(b), -1) for a in self.byte_ids for b in self.byte_ids], np.int64)
        rank = first[data[:-1].astype(np.int64) * 256 + data[1:]]
        at = np.flatnonzero(rank >= 0)
        known = np.sort(rank[at] << 40 | at)
        tok = array("i", self.byte_ids[data].astype(np.int32).tobytes())
        after = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
        before = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        heap: list[int] = []
        mask = (1 << 40) - 1

        def least() -> Iterator[int]:
            for a in range(0, len(known), 1 << 16):
                for key in known[a : a + (1 << 16)].tolist():
                    while heap and heap[0] < key:
                        yield heapq.heappop(heap)
                    yield key
            while heap:
                yield heapq.heappop(heap)

        for key in least():
            i, merged = key & mask, key >> 40
            j = after[i]
            if tok[i] < 0 or j >= n or pairs.get(tok[i] << 32 | tok[j]) != merged:
                continue  # one of the two has gone into another token
            tok[i], tok[j] = merged, -1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (own := pairs.get(merged << 32 | tok[k])) is not None:
                    heapq.heappush(heap, own << 40 | i)
            if h >= 0 and (own := pairs.get(tok[h] << 32 | merged)) is not None:
                heapq.heappush(heap, own << 40 | h)
        ids = np.frombuffer(tok, np.int32)
        return ids[ids >= 0].astype("<u4").tobytes()

    def _contract(self, words: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(words), np.uint8)
        length = np.array([len(w) for w in words], np.int64)
        w = np.repeat(np.arange(len(words)), length)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(length) - length, length)
        self.db.register("word_bytes", pa.table({"w": w, "pos": pos, "tok": self.byte_ids[data]}))
        long = length.max() > LONG_WORD
        found = self.db.sql(_CONTRACT_RUNS if long else _CONTRACT).to_arrow_table()
        self.db.unregister("word_bytes")
        ids = found.column("ids").combine_chunks()
        flat, at = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
        return [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]

    def _learn(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """The ids of pieces; one that is a token itself has that id."""
        found: dict[bytes, bytes] = {}
        short: list[bytes] = []
        long: list[bytes] = []
        for piece in pieces:
            if (rank := self.ranks.get(piece)) is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(piece) > LONG_PIECE:
                found[piece] = self._contract_long(piece)
            else:
                (long if len(piece) > LONG_WORD else short).append(piece)
        for words in (short, long):
            words.sort(key=len)  # those that need as many rounds together
            a = 0
            while a < len(words):
                b, size = a, 0
                while b < len(words) and (b == a or size + len(words[b]) <= QUERY_BYTES):
                    size += len(words[b])
                    b += 1
                found.update(zip(words[a:b], self._contract(words[a:b])))
                a = b
        return found

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of spans of texts in a row, and how many each has; of ASCII without apostrophe they are pieces."""
        split = [
            [c] if c.isascii() and b"'" not in c else [p.encode() for p in self.pattern.findall(c.decode())] for c in chunks
        ]
        ids = self._learn({p for own in split for p in own})
        found = [ids[own[0]] if len(own) == 1 else b"".join([ids[p] for p in own]) for own in split]
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) for x in found], np.int64) // 4


class Decoder:
    """The bytes of each id of one rank file, in an in-memory DuckDB of one thread."""

    def __init__(self, path: str) -> None:
        ranks = read_ranks(path)
        self.db = _database()
        self.db.register("names_in", pa.table({"id": list(ranks.values()), "hex": [t.hex() for t in ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM names_in")
        self.db.unregister("names_in")

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids, by an ordered aggregation over (list, position, id)."""
        out = [b""] * len(ids)
        length = np.array([len(x) for x in ids], np.int64)
        if not length.sum():
            return out
        d = np.repeat(np.arange(len(ids)), length)
        pos = np.arange(len(d)) - np.repeat(np.cumsum(length) - length, length)
        flat = np.concatenate(ids).astype(np.int64)
        for a in range(0, len(flat), DECODE_IDS):
            b = a + DECODE_IDS
            self.db.register("ids", pa.table({"d": d[a:b], "pos": pos[a:b], "id": flat[a:b]}))
            found = self.db.sql(_DECODE).to_arrow_table()
            self.db.unregister("ids")
            for k, text in zip(found.column("d").to_pylist(), found.column("hex").to_pylist()):
                out[k] += bytes.fromhex(text)
        return out


_open: dict[tuple, Encoder | Decoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _open:
        _open[path, pattern] = Encoder(path, pattern)
    return _open[path, pattern]


def decoder(path: str) -> Decoder:
    if (path,) not in _open:
        _open[path,] = Decoder(path)
    return _open[path,]


def _spans(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pattern cuts whatever stands beside it: at ASCII white space and between letters, digits and signs (see kinds).

    A space before a word goes with the word; of other white space before a word the last character is a piece of its
    own, and so is what stands before that; white space at a document's end is one piece.
    """
    data, at = block.data, block.at
    own = block.start > np.repeat(at[:-1], np.diff(block.first))  # the word does not begin its document
    before = np.zeros(len(block.start), bool)
    before[own] = data[block.start[own] - 1] == 32
    kind = kinds(data)
    cut = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1
    cut = cut[~np.isin(cut, at)]
    start, end = [np.sort(np.append(block.start - before, cut))], [np.sort(np.append(block.end, cut))]
    # white space from a document's begin or a word's end to the next word or the document's end
    doc = np.repeat(np.arange(len(block)), np.diff(block.first))
    gap_from = np.concatenate((at[:-1], block.end))
    following = np.concatenate((block.first[:-1], np.arange(1, len(block.end) + 1)))
    owner = np.concatenate((np.arange(len(block)), doc))
    last = following == block.first[owner + 1]
    gap_to = np.where(last, at[owner + 1], np.append(block.start, 0)[following])
    width = gap_to - gap_from
    tail = last & (width > 0)
    start.append(gap_from[tail]), end.append(gap_to[tail])
    head = ~last & (width > 1)
    start.append(gap_from[head]), end.append(gap_to[head] - 1)
    single = ~last & (width > 0)
    single[single] = data[gap_to[single] - 1] != 32
    start.append(gap_to[single] - 1), end.append(gap_to[single])
    start, end = np.concatenate(start), np.concatenate(end)
    order = np.argsort(start, kind="stable")
    return start[order], end[order], np.searchsorted(start[order], at)


#: Lead bytes of white space that is not ASCII; texts with them are split by the pattern as a whole.
_WIDE = np.zeros(256, bool)
_WIDE[[0xE1, 0xE2, 0xE3]] = True


def encode_block(codec: Encoder, block: Block) -> Iterator[bytes]:
    data, at = block.data, block.at
    wide = _WIDE[data] | ((data >= 0x1C) & (data <= 0x1F))
    wide[1:] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
    odd = np.diff(np.concatenate(([0], np.cumsum(wide)))[at]) > 0
    start, end, first = _spans(block)
    if odd.any():
        plain = ~np.repeat(odd, np.diff(first))
        starts, ends = [start[plain]], [end[plain]]
        for i in np.flatnonzero(odd):
            pieces = codec.pattern.findall(data[at[i] : at[i + 1]].tobytes().decode())
            size = np.array([len(p.encode()) for p in pieces], np.int64)
            ends.append(at[i] + np.cumsum(size))
            starts.append(ends[-1] - size)
        start, end = np.concatenate(starts), np.concatenate(ends)
        order = np.argsort(start, kind="stable")
        start, end = start[order], end[order]
        first = np.searchsorted(start, at)
    hashes = span_hashes(data, start, end)
    codes, sample = intern(hashes)
    raw = data.tobytes()

    def learn(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return codec.encode([raw[a:b] for a, b in zip(start[sample[new]].tolist(), end[sample[new]].tolist())])

    ids, where = spell(codes, *codec.kept.values(hashes[sample], learn), first)
    for a, b in zip(where[:-1], where[1:]):
        yield ids[a:b].tobytes()


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit); null and empty texts have none.

    Special tokens' names are ordinary text.  Repeated rows and rows without an id come back each; other columns are not
    read.
    """
    types = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for block in blocks(batch.column(1), size=BLOCK_BYTES):
            yield {
                "doc_id": batch.column(0).slice(block.row, len(block)),
                "ids": list(encode_block(encoder(path, pattern), block)),
            }

    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return arrow_stage(source, step, "doc_id bigint, ids binary", types)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded (binary) of rows of doc_id and ids."""
    types = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column(1)
        for a in range(0, len(ids), 256):
            part = ids.slice(a, 256)
            lists = [np.frombuffer(x, "<u4") for x in part.fill_null(b"").to_pylist()]
            decoded = decoder(path).decode(lists)
            yield {"doc_id": batch.column(0).slice(a, 256), "ids": part, "decoded": decoded}

    return arrow_stage(encoded.select("doc_id", "ids"), step, "doc_id bigint, ids binary, decoded binary", types)
