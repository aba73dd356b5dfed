"""Operator 8: embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised; the distance of two unit vectors follows from their
cosine.  A table's hash is a group of quantised Gaussian projections,
floor((a . v + b) / width), taken together with the vector's label and length.
Vectors that share a bucket in some table are compared by their exact cosine in
double precision.  With the given sizes a pair at the threshold (distance 0.2)
is found with probability 1 - (1 - 0.867^6)^16 = 0.9999, closer pairs more often.

Equal vectors of a label are one row with a number of copies.  A bucket is
compared as a whole: the task returns, per row, its links and one vertex of its
component there, never a pair.  A pair that meets in several tables is counted
in the first of them only; the rows carry their hashes of all tables for that.
A bucket larger than a block is dealt to blocks by hash, and each pair of blocks
is a task of bounded size.

Cases: a vector that is null, empty, zero, or holds null or non-finite numbers,
and a vector with a null label, links with nothing; vectors of different length
are not compared; repeated rows count as vectors of their own; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphcluster.llm.common import Table, partitions, ship
from graphcluster.llm.components import components

COSINE = 0.98
TABLES = 16
PROJECTIONS = 6
WIDTH = 1.2
SEED = 8
BLOCK_ROWS = 1024   #: rows of a block of a bucket


@lru_cache(maxsize=64)
def _projections(dim: int, tables: int, projections: int, width: float, seed: int):
    rng = np.random.default_rng([seed, dim])
    return rng.normal(size=(dim, tables * projections)), rng.random(tables * projections) * width


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    top = np.abs(v).max(axis=1, keepdims=True)  # scaled first: squares of huge numbers overflow
    v = v / top
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def bucket_codes(vectors: np.ndarray, labels: np.ndarray, tables: int, projections: int,
                 width: float, seed: int) -> np.ndarray:
    """64-bit bucket of each vector in each table."""
    a, b = _projections(vectors.shape[1], tables, projections, width, seed)
    cell = np.floor((unit(vectors) @ a + b) / width).astype(np.int64).astype(np.uint64)
    cell = cell.reshape(len(vectors), tables, projections)
    with np.errstate(over="ignore"):
        code = (labels.astype(np.int64).astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
                + np.arange(tables, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                + np.uint64(vectors.shape[1]))
        for p in range(projections):
            code = (code ^ cell[:, :, p]) * np.uint64(0xD6E8FEB86659FD93)
            code ^= code >> np.uint64(32)
    return code.astype(np.int64)


def _usable(x) -> np.ndarray | None:
    if x is None or not len(x):
        return None
    v = np.array([np.nan if y is None else y for y in x], dtype=np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sig, full, raw = [], [], []
        for label, x in zip(b.column("label").to_pylist(), b.column("embedding").to_pylist()):
            v = _usable(x) if label is not None else None
            if v is None:
                sig.append(None), full.append(None), raw.append(None)
                continue
            data = (v + 0.0).tobytes()  # one form of zero
            d = hashlib.blake2b(data + str(label).encode(), digest_size=16).digest()
            sig.append(int.from_bytes(d[:8], "little", signed=True))
            full.append(d)
            raw.append(data)
        yield pa.RecordBatch.from_arrays(
            [b.column("vec_id"), b.column("label"), pa.array(sig, pa.int64()), pa.array(full, pa.binary()),
             pa.array(raw, pa.binary())], names=["vec_id", "label", "sig", "sig128", "vector"])


def _hash(tables, projections, width, seed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [x.as_py() for x in b.column("vector")]
            label = np.array([hash_label(x) for x in b.column("label").to_pylist()], dtype=np.int64)
            codes = np.zeros((len(raw), tables), dtype=np.int64)
            lens = np.array([len(x) for x in raw])
            for n in np.unique(lens):
                at = np.flatnonzero(lens == n)
                v = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), -1)
                codes[at] = bucket_codes(v, label[at], tables, projections, width, seed)
            yield pa.RecordBatch.from_arrays(
                [b.column("sig"), b.column("copies"), b.column("vector"),
                 pa.array(list(codes), pa.list_(pa.int64()))], names=["sig", "copies", "vector", "codes"])
    return run


def hash_label(x) -> int:
    return x if isinstance(x, int) else int.from_bytes(
        hashlib.blake2b(str(x).encode(), digest_size=8).digest(), "little", signed=True)


def _labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    label = np.arange(n)
    while len(a):
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    return label


def _compare(cosine: float):
    def solve(rows) -> tuple[list, list, list]:
        sig = np.array([r[0] for r in rows], dtype=np.int64)
        copies = np.array([r[1] for r in rows], dtype=np.int64)
        side = np.array([r[4] for r in rows])
        codes = np.array([r[3] for r in rows], dtype=np.int64)
        table = rows[0][5]
        lens = {len(r[2]) for r in rows}
        if len(lens) > 1:  # a collision of 64-bit buckets
            parts = [solve([r for r in rows if len(r[2]) == n]) for n in lens]
            return tuple(sum((p[k] for p in parts), []) for k in range(3))
        v = unit(np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(len(rows), -1))
        near = np.triu(v @ v.T >= cosine, 1)
        if (side != 2).any():
            near &= side[:, None] != side[None, :]
        a, b = np.nonzero(near)
        if not len(a):
            return [], [], []
        label = _labels(a, b, len(rows))
        # the codes hold the label too, so rows of a bucket have one label
        new = ~(codes[a, :table] == codes[b, :table]).any(axis=1)
        links = np.zeros(len(rows), dtype=np.int64)
        np.add.at(links, a[new], copies[b[new]])
        np.add.at(links, b[new], copies[a[new]])
        some = np.zeros(len(rows), dtype=bool)
        some[a] = some[b] = True
        return sig[some].tolist(), links[some].tolist(), sig[label[some]].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out],
                                              names=["sig", "links", "star"])

        for b in batches:
            columns = (b.column(c).to_pylist() for c in
                       ("task", "sig", "copies", "vector", "codes", "side", "table"))
            for r in zip(*columns):
                if r[0] != task:
                    if len(rows) > 1:
                        yield batch(solve(rows))
                    task, rows = r[0], []
                rows.append(r[1:])
        if len(rows) > 1:
            yield batch(solve(rows))
    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", cosine: float = COSINE, tables: int = TABLES,
                    projections: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id and kept."""
    spark = vectors.sparkSession
    ship(spark)
    parts = partitions(spark)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    rows = Table(vectors.select(F.col(key).alias("vec_id"), F.col(label).alias("label"),
                                F.col(embedding).alias("embedding"))
                 .mapInArrow(_signatures, f"vec_id {kinds[key]}, label {kinds[label]}, sig long, "
                                          "sig128 binary, vector binary"), "vectors").df
    reps = Table(rows.where(F.col("sig").isNotNull()).groupBy("sig", "sig128").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
        F.first("label").alias("label"), F.first("vector").alias("vector")), "vector-reps").df
    hashed = Table(reps.select("sig", "copies", "label", "vector").mapInArrow(
        _hash(tables, projections, width, seed),
        "sig long, copies long, vector binary, codes array<long>"), "vector-codes").df

    cells = hashed.select("sig", F.posexplode("codes").alias("table", "cell"))
    sizes = Table(cells.groupBy("cell", "table").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"),
                  "cell-sizes").df
    count = F.ceil(F.col("rows") / block_rows).cast("int")
    i = F.pmod(F.xxhash64(F.lit("block"), "sig"), count).cast("int")
    todo = F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.struct(
        F.xxhash64("cell", "table", F.least("i", j), F.greatest("i", j)).alias("task"),
        F.when(F.col("i") == j, F.lit(2)).when(F.col("i") < j, F.lit(0)).otherwise(F.lit(1)).alias("side")))
    work = (hashed.select("sig", "copies", "vector", "codes", F.posexplode("codes").alias("table", "cell"))
            .join(sizes, ["cell", "table"]).withColumn("i", i).withColumn("t", F.explode(todo))
            .select("t.task", "t.side", "sig", "copies", "vector", "codes", "table"))
    found = Table(work.repartition(parts, "task").sortWithinPartitions("task", "sig")
                  .mapInArrow(_compare(cosine), "sig long, links long, star long"), "vector-links").df

    roots = components(found.select(F.col("sig").alias("a"), F.col("star").alias("b"))).df
    links = found.groupBy("sig").agg(F.sum("links").alias("links"))
    rooted = Table(reps.drop("vector").join(roots, reps.sig == roots.node, "left").drop("node")
                   .withColumn("root", F.coalesce("root", "sig")).join(links, "sig", "left"), "vector-roots").df
    lowest = Table(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "vector-lowest").df
    classes = Table(rooted.join(lowest, "root").select(
        F.col("sig").alias("_sig"), F.col("sig128").alias("_sig128"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-classes").df
    out = rows.join(classes, (F.col("sig") == F.col("_sig")) & (F.col("sig128") == F.col("_sig128")), "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
