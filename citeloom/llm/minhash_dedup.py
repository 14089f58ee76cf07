"""Near-duplicates by MinHash with tensored banding.

Two small collections of bands are hashed, LEFT bands of two MinHashes and RIGHT bands of one.  Every pair of a left and
a right band forms the key of one table, so 24 MinHashes serve 54 tables of three.  Documents of similarity 0.75 share a
key with a probability of 0.999, of 0.8 with 0.9998.

Texts with the same shingle set are one class, which stands for all its copies.  Per key the class that collides most
(the hub, such as the original of a group of edited copies) is compared with all others first: linear in the size of a
bucket.  There a sketch (the 24 MinHashes, of which 9 must agree) drops chance collisions before full sets are compared, with a
probability below 0.0001 of losing a pair of similarity 0.75.  Once those links have been joined to components, only
classes are open that share a key with another component.  Among them an exact join finds all other pairs of different
components that can link: such pairs have one of their rarest shingles in common, and in a group of edited copies the
rarest are the edits.  Copies with the same edit but too many others are told apart there by parities: each set's shingles
are counted modulo 2 in BITS bins, and two sets differ by at least as many shingles as bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.graph import components
from citeloom.llm.shared import arrow_stage, sorted_join, stored
from citeloom.llm.shingles import shingle_sets
from citeloom.llm.words import U, constants

LEFT, RIGHT = 9, 6
HASHES = 2 * LEFT + RIGHT
AGREE = 9
PERCENT = 75
BITS = 1024
_MUL = constants(HASHES, 7)[:, None]
_ADD = constants(HASHES, 8)[:, None]


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """HASHES values of 32 bits, each the least of a random order of the shingles."""
    least = np.full(HASHES, np.iinfo(U).max, U)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        mixed = (part ^ _ADD) * _MUL
        np.minimum(least, ((mixed ^ (mixed >> U(29))) * U(0x94D049BB133111EB)).min(axis=1), out=least)
    return (least >> U(16)).astype(np.uint32).view(np.int32)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, number of shingles, a 128-bit digest of the set, its MinHashes."""
    types = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sketch", pa.list_(pa.int32()))]
    )

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        n, digest, sketch = [], [], []
        for s in shingle_sets(batch.column(1)):
            n.append(len(s))
            digest.append(xxhash.xxh3_128_digest(s.tobytes()))
            sketch.append(minhashes(s) if len(s) else None)
        yield {"id": batch.column(0), "n": n, "digest": digest, "sketch": sketch}

    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return arrow_stage(source, step, "id bigint, n bigint, digest binary, sketch array<int>", types)


def tensored_keys(sketch: Column) -> Column:
    """The table keys: each left band of two MinHashes with each right band of one."""
    left = [F.xxhash64(F.lit(i), sketch[2 * i], sketch[2 * i + 1]) for i in range(LEFT)]
    right = [F.xxhash64(F.lit(i), sketch[2 * LEFT + i]) for i in range(RIGHT)]
    return F.transform(
        F.sequence(F.lit(0), F.lit(LEFT * RIGHT - 1)),
        lambda t: F.xxhash64(
            t, F.element_at(F.array(*left), (t / RIGHT).cast("int") + 1), F.element_at(F.array(*right), t % RIGHT + 1)
        ),
    )


def parities(hashes: np.ndarray) -> np.ndarray:
    """BITS bins, each the parity of the number of its shingles, as integers of 64 bits."""
    bins = ((hashes * U(0x9E3779B97F4A7C15)) >> U(32)) % U(BITS)
    return np.packbits((np.bincount(bins.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The sets of some documents as sorted 64-bit hashes, and their parities."""
    types = pa.schema([("id", pa.int64()), ("shingles", pa.binary()), ("bits", pa.list_(pa.int64()))])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        sets = list(shingle_sets(batch.column(1)))
        yield {"id": batch.column(0), "shingles": [s.tobytes() for s in sets], "bits": [parities(s) for s in sets]}

    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return arrow_stage(source.join(ids, "id", "left_semi"), step, "id bigint, shingles binary, bits array<bigint>", types)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, and the sizes of the intersection and the union of their full sets."""
    types = pa.schema([(name, pa.int64()) for name in ("a", "b", "common", "all")])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        common, every = [], []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            both = np.concatenate((x, y))
            both.sort(kind="stable")
            common.append(int((both[1:] == both[:-1]).sum()))
            every.append(len(both) - common[-1])
        yield {"a": batch.column(0), "b": batch.column(1), "common": common, "all": every}

    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return arrow_stage(both, step, "a bigint, b bigint, common bigint, all bigint", types)


def rare_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Each set's rarest shingles: id, n, shingle, pos (from 0, rarest first).

    Two sets of n and m shingles link only with at least (n + m) * percent / (100 + percent) in common, so the n less
    that many, plus one, rarest of one and the same of the other have one in common.  The rows reach as far as any
    partner can need.
    """
    types = pa.schema([("id", pa.int64()), ("shingle", pa.int64())])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for id_, own in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = np.frombuffer(own.as_buffer(), np.int64)
            yield {"id": np.full(len(values), id_), "shingle": values}

    every = arrow_stage(sets.select("id", "shingles"), step, "id bigint, shingle bigint", types)
    many = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"))
    ranked = sorted_join(every, many, "shingle").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("sets", "shingle"))).alias("r"))
    n = F.size("r")
    need = (n - F.ceil(n * percent / 100) + 1).cast("int")
    prefix = ranked.select("id", n.cast("bigint").alias("n"), F.posexplode(F.slice("r", F.lit(1), need)).alias("pos", "x"))
    return prefix.where("x.sets > 1").select("id", "n", "pos", F.col("x.shingle").alias("shingle"))


def _same(one: Column, two: Column) -> list[Column]:
    return [one[i] == two[i] for i in range(HASHES)]


def _promising(n: Column, m: Column, same: list[Column], percent: int) -> Column:
    agree = sum((x.cast("int") for x in same), F.lit(0))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (agree >= AGREE)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept.

    component_id is the least id reachable over links, the row's own included; kept says that it is the row's own.
    Null and empty texts and texts without words have no shingles and link with nothing.  Rows without an id stay
    outside: component_id null, kept true.  Repeated rows of an id come back each.  Other columns are not read.
    """
    rows = stored(sketches(docs, id_col, text_col), "sketches")
    linkable = rows.where("n > 0 AND id IS NOT NULL")
    classes = stored(
        linkable.groupBy("digest").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.first("sketch").alias("sketch")),
        "set-classes",
    )
    keys = classes.select("id", F.explode(tensored_keys(F.col("sketch"))).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(sorted_join(keys, shared, "key"), "bucket-members")

    met = members.groupBy("id").agg(F.sum(F.col("size") - 1).alias("met"))
    known = stored(met.join(classes, "id").select("id", "met", "n", "sketch"), "met-classes")
    ranked = members.join(known.select("id", "met"), "id")
    hubs = stored(ranked.groupBy("key").agg(F.max_by("id", F.struct("met", "id")).alias("hub")), "hubs")
    sets = stored(full_sets(docs, known.select("id"), id_col, text_col).dropDuplicates(["id"]), "full-sets")

    # every class with the hubs of its buckets
    stars = (
        members.join(hubs, "key").where("id != hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    )
    first = known.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    second = known.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    hopeful = _promising(F.col("n_a"), F.col("n_b"), _same(F.col("s_a"), F.col("s_b")), percent)
    stars = stars.join(first, "a").join(second, "b").where(hopeful).select("a", "b")
    stars = stored(compared(stars, sets), "star-pairs")
    is_link = F.col("common") * 100 >= F.col("all") * percent
    links = stars.where(is_link).select("a", "b")

    # what shares a key but no component yet
    placed = (
        members.join(components(links), "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = stored(placed.join(mixed.select("key"), "key").groupBy("id").agg(F.min("component").alias("component")), "open")
    # each with the hub it was compared with that collides most, itself maybe, and what they have in common
    rank = known.select(F.col("id").alias("b"), F.col("met"))
    own = known.select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("n").alias("common"))
    homes = stars.select("a", "b", "common").unionByName(own).join(rank, "b").groupBy(F.col("a").alias("id"))
    homes = homes.agg(F.max(F.struct("met", "b", "common")).alias("h")).select("id", F.col("h.b").alias("home"), F.col("h.common").alias("core"))
    prefixes = rare_prefixes(sets.join(open_.select("id"), "id", "left_semi"), percent).join(open_, "id").join(homes, "id")
    prefixes = stored(prefixes.join(sets.select("id", "bits"), "id"), "prefixes")
    sizes = prefixes.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("rows"))
    largest = sizes.groupBy("shingle").agg(
        F.max_by("component", F.struct("rows", "component")).alias("largest"), F.count(F.lit(1)).alias("components")
    )
    mixed = largest.where("components > 1").drop("components")
    shared = stored(sorted_join(prefixes, mixed, "shingle"), "shared-prefixes")
    names = ("id", "n", "pos", "component", "home", "core", "bits")
    one = shared.where("component != largest")
    one = one.select("shingle", *(F.col(c).alias(f"{c}_a") for c in names))
    two = shared.select("shingle", "largest", *(F.col(c).alias(f"{c}_b") for c in names))
    need = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    differ = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(BITS // 64)), F.lit(0))
    left = sorted_join(
        one,
        two,
        (one["shingle"] == two["shingle"])
        & (F.col("component_a") != F.col("component_b"))
        & ((F.col("component_b") == F.col("largest")) | (F.col("id_a") < F.col("id_b")))
        & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
        & (F.col("pos_a") <= F.col("n_a") - need)
        & (F.col("pos_b") <= F.col("n_b") - need)
        # in common are at most the lesser share of the same home and the lesser rest
        & (
            (F.col("home_a") != F.col("home_b"))
            | (F.least("core_a", "core_b") + F.least(F.col("n_a") - F.col("core_a"), F.col("n_b") - F.col("core_b")) >= need)
        )
        & (F.col("n_a") + F.col("n_b") - differ >= 2 * need),
    ).select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    more = stored(compared(left, sets), "other-pairs").where(is_link).select("a", "b")

    found = components(links.unionByName(more))
    placed = (
        classes.select("digest", "id").join(found, "id", "left")
        .select("digest", F.coalesce("component", "id").alias("component_id"))
    )
    with_class = rows.select("id", "n", "digest").join(
        placed, (rows["digest"] == placed["digest"]) & (rows["n"] > 0) & rows["id"].isNotNull(), "left"
    )
    component = F.coalesce("component_id", "id")
    return with_class.select(
        "id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
