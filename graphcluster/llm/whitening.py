"""Operator 11: embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The rows that count are the vectors without null and non-finite entries; an entry c
becomes the integer floor(64 c) + 1000000.  X are these rows centred, n of them; the
components are the right singular vectors of X, and their singular values s give the
eigenvalues s^2 / n of the covariance.

A step alternates u = X v - beta u' and v = X'u - alpha v', each made orthogonal to
all earlier vectors of its kind, in one distributed pass: tasks multiply their rows
with v and with the earlier u, and return sums of the length of a row and of the
number of steps.  The long vectors u are never stored; they are kept by their
coordinates z (u = X z), which each task expands for its rows, so a lost executor
costs its partitions of one pass.  A v that vanishes (a repeated or zero singular
value) is replaced by a new start orthogonal to the others.  The steps end when the
wanted components have settled, or all dimensions are used; the singular value
decomposition of the small bidiagonal matrix yields components and deviations.

Sums of the integers, and so means, deviations and the trace, are exact; the sums
over rows are shuffled by their position, never one task's rows.

Cases: vectors that are null, or hold null or non-finite entries, are dropped; if the
rest have different lengths, the most frequent one counts (of equally frequent ones the
longest) and the others are dropped too; repeated rows count as often as they come;
ties of eigenvalues are in no certain order; directions in which the rows don't differ
(eigenvalue zero up to rounding) have no component, so one row, or equal rows, give
none; an empty table gives an empty result; null ids pass through; columns named
like an output are replaced, all others pass through; entries of 2^34 and more and sums
beyond 64 bits raise ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField

from graphcluster.llm.common import arrow_map, enter, ship

COMPONENTS = 32
FACTOR, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)   #: 64 c must be below
SEED = 11
SETTLED = 1e-14            #: residual of a wanted singular value, in parts of the largest
ZERO = 1e-12               #: a singular value below this part of the largest is zero


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, sums of a dimension, unit components (one a row), their
    eigenvalues and shares of the trace, steps taken."""
    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    steps: int


def integers(vectors: pa.Array, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors count, and their integers as rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    length = np.asarray(vectors.value_lengths().fill_null(-1))
    at = np.flatnonzero(length == (-2 if size is None else size))
    if not len(at):
        return np.empty(0, np.int64), np.empty((0, size or 0), np.int64)
    flat = vectors.take(pa.array(at)).flatten().cast(pa.float64())
    c = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(at), size or 0)
    fine = np.isfinite(c).all(axis=1)
    at, c = at[fine], np.floor(FACTOR * c[fine])
    if (np.abs(c) >= LARGEST).any():
        raise OverflowError("an entry is too large to whiten")
    return at, c.astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, rounded once."""
    return numerators(x, n, sums) / n


def numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact."""
    if n * int(np.abs(x).max(initial=0)) >= 1 << 62:
        raise OverflowError("too many rows for exact 64-bit numerators")
    return n * x - sums


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The sum of (n x - S)^2 over a row, exact."""
    a = numerators(x, n, sums)
    if int(np.abs(a).max(initial=0)) ** 2 * max(1, a.shape[1]) < 1 << 63:
        return (a * a).sum(axis=1)
    exact = [sum(v * v for v in row) for row in a.tolist()]
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation doesn't fit into 64 bits")
    return np.array(exact, np.int64)


def _added(parts: DataFrame, kind: str) -> dict[int, object]:
    """The sums of arrays over all rows, by position."""
    rows = parts.select(F.posexplode("a").alias("k", "x")).groupBy("k").agg(F.sum(F.col("x").cast(kind)).alias("x"))
    return {r["k"]: r["x"] for r in rows.collect()}


def _sums(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        n, total = 0, [0] * size
        for b in batches:
            _, x = integers(b.column(0), size)
            n += len(x)
            total = [t + s for t, s in zip(total, x.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_pydict({"a": pa.array([[n, *total]], pa.list_(pa.int64()))})
    return run


def _rows(size: int, n: int, sums: np.ndarray):
    """Centred rows, packed by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(__name__)
        for b in batches:
            _, x = integers(b.column(0), size)
            if len(x):
                yield pa.RecordBatch.from_pydict({"data": pa.array([centred(x, n, sums).tobytes()], pa.binary())})
    return run


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for b in batches:
        for data in b.column(0):
            yield np.frombuffer(data.as_buffer(), np.float64).reshape(-1, size)


def _step(z: np.ndarray, w: np.ndarray):
    """Sums for one step over the rows x: of u'(Xw) for the earlier u = X z, of |Xw|^2,
    and of X'(Xw)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earlier, square, back = np.zeros(z.shape[1]), 0.0, np.zeros(len(w))
        for x in _blocks(batches, len(w)):
            y = x @ w
            earlier += (x @ z).T @ y
            square += float(y @ y)
            back += x.T @ y
        yield pa.RecordBatch.from_pydict({"a": pa.array([np.concatenate([[square], back, earlier])],
                                                        pa.list_(pa.float64()))})
    return run


def bidiagonalise(rows: DataFrame, size: int, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Singular values (falling) and right singular vectors of the packed rows: the
    wanted ones, or fewer if there are no more."""
    rng = np.random.default_rng(SEED)
    v, z = np.zeros((size, 0)), np.zeros((size, 0))  # columns: v_j, coordinates of u_j
    back = np.zeros((size, 0))                       # columns: X'u_j
    alphas: list[float] = []
    betas: list[float] = []                          # betas[j] joins step j to step j + 1

    def fresh(candidate: np.ndarray) -> np.ndarray:
        for _ in range(2):
            candidate = candidate - v @ (v.T @ candidate)
        return candidate

    new, beta = rng.standard_normal(size), 0.0
    new /= np.linalg.norm(new)
    while True:
        v = np.column_stack([v, new])
        w = new - beta * z[:, -1] if beta else new
        got = _added(rows.mapInArrow(_step(z, w), "a array<double>"), "double")
        got = np.array([got[k] for k in range(len(got))])
        square, product, earlier = got[0], got[1:1 + size], got[1 + size:]
        # u is made orthogonal to the earlier ones; the same holds for X'u and z
        alpha = float(np.sqrt(max(0.0, square - earlier @ earlier)))
        top = max([*alphas, *betas, alpha])
        if alpha > ZERO * top:
            z = np.column_stack([z, (w - z @ earlier) / alpha])
            back = np.column_stack([back, (product - back @ earlier) / alpha])
        else:  # nothing of X lies this way
            alpha = 0.0
            z, back = (np.column_stack([m, np.zeros(size)]) for m in (z, back))
        alphas.append(alpha)
        new = fresh(back[:, -1] - alpha * v[:, -1])
        beta = float(np.linalg.norm(new))
        b = np.diag(alphas) + np.diag(betas, 1)
        left, values, right = np.linalg.svd(b)
        k = min(wanted, len(values))
        residual = beta * np.abs(left[-1, :k]) if beta > ZERO * top else np.zeros(k)
        if len(alphas) == size or len(alphas) >= wanted and (residual <= SETTLED * values[0]).all() and beta > ZERO * top:
            break
        if beta > ZERO * top:
            new /= beta
        else:  # all that this start reaches is found; go on with another one
            beta, new = 0.0, fresh(rng.standard_normal(size))
            new /= np.linalg.norm(new)
            new = fresh(new)
            new /= np.linalg.norm(new)
        betas.append(beta)
    some = values[:k] > ZERO * values[0] if values[0] > 0 else np.zeros(k, bool)
    return values[:k][some], (v @ right[:k].T)[:, some].T, len(alphas)


def fit(df: DataFrame, vector: str = "embedding", wanted: int = COMPONENTS) -> Whitening | None:
    """Fit to all rows that count; None if there is none."""
    spark = df.sparkSession
    ship(spark)
    vectors = df.select(F.col(vector).cast("array<double>").alias("v"))
    lengths = (vectors.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
               .groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    if not lengths:
        return None
    size = lengths[0]["d"]
    got = _added(vectors.mapInArrow(_sums(size), "a array<long>"), "decimal(38,0)")
    exact = [int(got[k]) for k in range(size + 1)]
    if max(map(abs, exact)) >= 1 << 62:
        raise OverflowError("a sum of entries doesn't fit into 64 bits")
    n, sums = exact[0], np.array(exact[1:], np.int64)
    rows = vectors.mapInArrow(_rows(size, n, sums), "data binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if size:
            values, components, steps = bidiagonalise(rows, size, min(wanted, size))
        else:
            values, components, steps = np.zeros(0), np.zeros((0, 0)), 0
    finally:
        rows.unpersist()
    total = vectors.mapInArrow(_trace(size, n, sums), "x decimal(38,0)").agg(F.sum("x")).first()[0]
    eigenvalues = values ** 2 / n
    trace = float(total or 0) / n ** 3
    return Whitening(n, sums, components, eigenvalues, eigenvalues / trace if trace else eigenvalues, steps)


def _trace(size: int, n: int, sums: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import decimal
        total = 0
        for b in batches:
            total += sum(deviations(integers(b.column(0), size)[1], n, sums).tolist())
        yield pa.RecordBatch.from_pydict({"x": pa.array([decimal.Decimal(total)], pa.decimal128(38, 0))})
    return run


def transform(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The rows that count, with deviation and whitened (a value for each component)."""
    size = len(model.sums)
    scaled = (model.components / np.sqrt(model.eigenvalues)[:, None]).T if len(model.components) else np.zeros((size, 0))

    def whitened(vectors: pa.Array) -> list:
        at, x = integers(vectors, size)
        y = centred(x, model.n, model.sums) @ scaled
        deviation, out = np.zeros(len(vectors), np.int64), [None] * len(vectors)
        deviation[at] = deviations(x, model.n, model.sums)
        for k, row in zip(at.tolist(), y):
            out[k] = row
        return [pa.array(deviation), pa.array(out, pa.list_(pa.float64()))]

    columns = [c for c in df.columns if c.lower() not in ("deviation", "whitened")]
    made = arrow_map(df.select(*columns, F.col(vector).cast("array<double>").alias("_v")), ["_v"],
                     [StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))], whitened)
    return made.where(F.col("whitened").isNotNull()).drop("_v")


def _products(size: int):
    """Sums of a batch's whitened rows and of their products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(size), np.zeros((size, size))
        for b in batches:
            y = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            first += y.sum(axis=0)
            second += y.T @ y
        yield pa.RecordBatch.from_pydict({"a": pa.array([np.concatenate([first, second.ravel()])],
                                                        pa.list_(pa.float64()))})
    return run


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity."""
    k = len(model.components)
    if not k:
        return 0.0
    got = _added(whitened.select("whitened").mapInArrow(_products(k), "a array<double>"), "double")
    got = np.array([got[i] for i in range(len(got))]) / model.n
    mean, second = got[:k], got[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """A row for each vector that counts and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding"))
    model = fit(rows, "embedding", wanted)
    if model is None or not len(model.components):
        kind = rows.schema["vec_id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, "
                                                   "whitened double, explained double, identity_error double")
    made = transform(rows, model).drop("embedding")
    error = identity_error(made, model)
    explained = F.array(*map(F.lit, model.explained.tolist()))
    return (made.select("vec_id", "deviation", F.posexplode("whitened").alias("_k", "whitened"))
            .select("vec_id", (F.col("_k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(explained, F.col("_k")).alias("explained"),
                    F.lit(error).alias("identity_error")))
