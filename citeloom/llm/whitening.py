"""Whitening of embeddings along the principal components of their covariance.

Spark sums the integer entries exactly, then the products of centred vectors (one small matrix per task, added up in a
shuffle).  The covariance, whose size depends on the dimensions alone, is taken apart on the driver by spectral divide and
conquer: the polar factor of the covariance less a shift, from the QR-based dynamically weighted Halley iteration, gives
the projector on the eigenvectors above the shift; each side is an invariant subspace that is split again, down to single
components.  Those are broadcast, and every vector is projected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.shared import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: The covariance is held on the driver: at most so many dimensions (a matrix of 32 MB).
MOST_DIMENSIONS = 2048
#: Entries beyond this do not add up exactly in 64 bits.
LARGEST = 2.0**31
EPS = np.finfo(float).eps


def polar_sign(a: np.ndarray) -> np.ndarray | None:
    """The orthogonal polar factor of a symmetric matrix: its eigenvalues become 1 or -1; None where it is singular.

    The weights of each step follow from l, a lower bound of the least singular value of the scaled matrix, and drive all
    singular values to 1 in about six steps.  A step is a QR decomposition of the matrix above the identity.
    """
    n = len(a)
    size = np.linalg.norm(a)
    if size == 0:
        return None
    x = a / size
    try:
        l = 0.9 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        return None
    if not l > n * EPS:
        return None
    for _ in range(30):
        l2 = l * l
        d = np.cbrt(4 * (1 - l2) / l2**2)
        root = np.sqrt(1 + d)
        alpha = root + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * root)) / 2
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, np.eye(n)]))
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        step = np.linalg.norm(new - x)
        x = new
        l = min(1.0, l * (alpha + beta * l2) / (1 + gamma * l2))
        if step < np.cbrt(EPS) * 1e-2 and abs(1 - l) < 10 * EPS:
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Shifts to try: the median of the diagonal, then ever finer steps between the ends of the spectrum."""
    diagonal = np.diag(a)
    yield float(np.median(diagonal))
    yield float(np.mean(diagonal))
    reach = np.abs(a).sum(axis=1) - np.abs(diagonal)
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    for parts in (2, 3, 5, 9, 17, 33, 65, 129, 257, 1025, 4097):
        for k in range(1, parts):
            yield low + (high - low) * k / parts


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift."""
    n = len(a)
    r = np.random.default_rng(7)
    for shift in _shifts(a):
        sign = polar_sign(a - shift * np.eye(n))
        if sign is None:
            continue
        projector = (sign + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e3 * n * EPS:
            continue
        above, _ = np.linalg.qr(projector @ r.normal(size=(n, k)))
        above, _ = np.linalg.qr(projector @ above)
        below = r.normal(size=(n, n - k))
        for _ in range(2):
            below -= projector @ below
            below -= above @ (above.T @ below)
            below, _ = np.linalg.qr(below)
        if np.linalg.norm(below.T @ a @ above) <= 1e3 * n * EPS * np.linalg.norm(a):
            return above, below
    return None


def principal_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down and their unit eigenvectors (as columns) of a symmetric matrix.

    A block whose eigenvalues cannot be told apart is a multiple of the identity: any basis of it will do.
    """
    values: list[float] = []
    vectors: list[np.ndarray] = []
    whole = np.linalg.norm(a)
    todo = [np.eye(len(a))]
    while todo:
        basis = todo.pop()
        block = basis.T @ a @ basis
        block = (block + block.T) / 2
        off = np.linalg.norm(block - np.diag(np.diag(block)))
        parts = None if len(block) == 1 or off <= len(block) * EPS * whole else _split(block)
        if parts:
            todo += [basis @ p for p in parts]
        else:
            values += np.diag(block).tolist()
            vectors += list(basis.T)
    order = np.argsort(-np.array(values), kind="stable")
    found = np.array(vectors)[order].T if vectors else np.zeros((0, 0))
    # one step of Rayleigh-Ritz to first order takes off what rounding along the splits has left
    h = found.T @ a @ found
    e = np.diag(h).copy()
    gap = e[None, :] - e[:, None]
    close = np.abs(gap) <= 1e-6 * max(whole, 1e-300)
    turn = np.where(close, 0, h / np.where(close, 1, gap))
    found, _ = np.linalg.qr(found + found @ (turn - np.diag(np.diag(turn))))
    return np.einsum("ij,ik,kj->j", found, a, found), found


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and x of the vectors without null or non-finite entries."""
    value = F.col(f"`{vector_col}`").cast("array<double>")
    # NaN is greater than any number here
    good = value.isNotNull() & F.forall(value, lambda c: F.coalesce(F.abs(c) <= float(np.finfo(float).max), F.lit(False)))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT)
    source = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.when(good, value).alias("v"))
    kept = source.where(F.col("v").isNotNull() & (F.size("v") > 0))
    large = F.exists("v", lambda c: F.abs(c) > LARGEST)
    message = F.lit(f"an entry beyond {LARGEST:.0f} is too large for exact sums")
    return kept.select("id", F.when(large, F.raise_error(message).cast("array<bigint>")).otherwise(x).alias("x"))


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many vectors there are, and the exact sum of each dimension."""
    length = F.size("x")
    lengths = [r[0] for r in rows.groupBy(length.alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(2).collect()]
    if len(lengths) > 1:
        raise ValueError(f"vectors differ in length: {sorted(lengths)}")
    if not lengths:
        return 0, np.zeros(0, np.int64)
    d = lengths[0]
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; the covariance is held on the driver up to {MOST_DIMENSIONS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            n += len(batch)
            total += _matrix(batch.column(1), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(np.append(total, n))], names=["k", "s"])

    out = np.zeros(d + 1, np.int64)
    for k, s in rows.mapInArrow(run, "k bigint, s bigint").groupBy("k").agg(F.sum("s")).collect():
        out[k] = s
    return int(out[d]), out[:d]


def _covariance(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Each task adds up the products of its centred vectors; the tasks' matrices are added in a shuffle, row by row."""
    d, mean = len(sums), sums / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for a in range(0, len(batch), 8192):
                centred = _matrix(batch.column(1).slice(a, 8192), d) - mean
                total += centred.T @ centred
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i * d + j), pa.array(total[i, j])], names=["k", "s"])

    out = np.zeros(d * d)
    for k, s in rows.mapInArrow(run, "k bigint, s double").groupBy("k").agg(F.sum("s")).collect():
        out[k] = s
    upper = out.reshape(d, d) / n
    return upper + np.triu(upper, 1).T


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The sum over dimensions of (n * x - S)**2, exact; null where it passes 64 bits."""
    if n * (float(np.abs(x).max(initial=0)) + 1) < 2.0**62:
        apart = n * x - sums
        if ((apart.astype(float) ** 2).sum(axis=1) < 2.0**62).all():
            return pa.array((apart * apart).sum(axis=1), pa.int64())
    apart = n * x.astype(object) - sums.astype(object)
    exact = (apart * apart).sum(axis=1).tolist()
    return pa.array([v if v < 2**63 else None for v in exact], pa.int64())


def _project(rows: DataFrame, n: int, sums: np.ndarray, weights: np.ndarray) -> DataFrame:
    """id, deviation and the whitened coordinates; weights has a column per component."""
    d, mean, k = len(sums), sums / n, weights.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 8192):
                part = batch.slice(a, 8192)
                x = _matrix(part.column(1), d)
                white = (x - mean) @ shared.value
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * k), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _deviations(x, n, sums), lists], names=["id", "deviation", "white"]
                )

    return rows.mapInArrow(run, "id bigint, deviation bigint, white array<double>")


def _identity_error(white: DataFrame, k: int) -> float:
    """The largest entry of the covariance of the whitened vectors less the identity; covar_pop centres as it goes."""
    at = [F.get("white", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*(F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found))


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1, by falling variance), n, deviation, whitened, explained,
    identity_error.

    An entry c counts as the integer floor(1024 * c) + 100000.  Vectors that are null or hold null or non-finite entries
    are dropped, and empty ones; vectors of different lengths and entries beyond 2**31 raise an error.  Repeated rows and
    rows without an id count like any other.  deviation is null where it passes 64 bits.  Components without variance (a
    share below 1e-13 of the trace) cannot be scaled and give no rows, so a single vector, or equal ones, gives none; an
    empty table gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = stored(_usable(vectors, id_col, vector_col), "vectors")
    n, sums = _sums(rows)
    if not n:
        return spark.createDataFrame([], schema)
    covariance = _covariance(rows, n, sums)
    trace = float(np.trace(covariance))
    values, found = principal_components(covariance)
    k = int(np.count_nonzero(values[:components] > 1e-13 * trace)) if trace > 0 else 0
    if not k:
        return spark.createDataFrame([], schema)
    white = stored(_project(rows, n, sums, found[:, :k] / np.sqrt(values[:k])), "whitened")
    error = _identity_error(white, k)
    share = F.array(*(F.lit(float(v / trace)) for v in values[:k]))
    opened = white.select("id", "deviation", F.posexplode("white").alias("i", "whitened"))
    return opened.select(
        F.col("id").alias("vec_id"),
        (F.col("i") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
