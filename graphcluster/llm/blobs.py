"""Packed postings: many (key, owner) pairs per row instead of a row for each.

A posting is a 64-bit hash that belongs to an owner (a document or a set of
words).  Tasks deal postings to buckets by the hash and send one row per bucket
and batch: the owners, how many hashes each has, and the hashes, as packed
arrays.  The shuffle then moves a little more than the eight bytes of each
hash, and the receiver works on whole numpy arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLUSH = 1_000_000    #: postings held by a task before they are sent
SCHEMA = "bucket long, owner binary, size binary, count binary, hash binary, extra binary"


def bucket_keys(spark: SparkSession, n: int) -> list[int]:
    """A key for each of ``n`` shuffle partitions, so that buckets spread one to one."""
    at = F.pmod(F.hash(F.col("id")), F.lit(n))
    rows = spark.range(24 * n).groupBy(at.alias("p")).agg(F.min("id").alias("k")).collect()
    found = {r["p"]: r["k"] for r in rows}
    return [found.get(p, p) for p in range(n)]


class Packer:
    """Collects postings of owners and makes rows of ``SCHEMA``."""

    def __init__(self, keys: list[int]):
        self.keys = np.asarray(keys, dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.owner: list[int] = []
        self.size: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.extras: list[np.ndarray] = []
        self.held = 0

    def add(self, owner: int, size: int, hashes: np.ndarray, extra: np.ndarray | None = None) -> None:
        self.owner.append(owner)
        self.size.append(size)
        self.hashes.append(hashes)
        if extra is not None:
            self.extras.append(extra)
        self.held += len(hashes)

    def rows(self, where: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """One row per bucket; the bucket of a posting comes from its hash, or is
        that of its owner (``where``: one bucket per owner)."""
        if not self.held:
            self.clear()
            return
        n = len(self.keys)
        h = np.concatenate(self.hashes)
        extra = np.concatenate(self.extras) if self.extras else None
        lens = np.fromiter(map(len, self.hashes), np.int64, len(self.hashes))
        own = np.repeat(np.arange(len(lens)), lens)
        bucket = bucket_of(h, n) if where is None else np.asarray(where)[own]
        order = np.argsort(bucket, kind="stable")  # keeps the owners' order inside a bucket
        h, own, bucket = h[order], own[order], bucket[order]
        if extra is not None:
            extra = extra[order]
        owner, size = np.asarray(self.owner, np.int64), np.asarray(self.size, np.uint32)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(h)]):
            o = own[a:b]
            first = np.flatnonzero(np.diff(o, prepend=-1))
            count = np.diff(np.append(first, len(o))).astype(np.uint32)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([self.keys[bucket[a]]], pa.int64()),
                "owner": pa.array([owner[o[first]].tobytes()], pa.binary()),
                "size": pa.array([size[o[first]].tobytes()], pa.binary()),
                "count": pa.array([count.tobytes()], pa.binary()),
                "hash": pa.array([h[a:b].tobytes()], pa.binary()),
                "extra": pa.array([extra[a:b].tobytes() if extra is not None else None], pa.binary())})
        self.clear()


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """Bring the rows of a bucket together."""
    return rows.repartition(n, "bucket")


def repeated(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, size and hash of the postings of a partition whose hash two owners have
    at least, each pair of hash and owner once, in the order of hash and owner."""
    owner, size, h, _ = unpack(batches)
    if not len(h):
        return owner, size, h
    order = np.argsort(h)
    same = h[order]
    same = same[1:] == same[:-1]
    some = np.zeros(len(h), bool)  # most hashes come once and leave here
    some[order[1:][same]] = some[order[:-1][same]] = True
    del order, same
    owner, size, h = owner[some], size[some], h[some]
    order = np.lexsort((owner, h))
    owner, size, h = owner[order], size[order], h[order]
    fresh = np.ones(len(h), bool)  # an owner sent by several tasks counts once
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    owner, size, h = owner[fresh], size[fresh], h[fresh]
    keep = owners_of(h) > 1
    return owner[keep], size[keep], h[keep]


def owners_of(h: np.ndarray) -> np.ndarray:
    """For each entry of a sorted array, how often its value occurs."""
    if not len(h):
        return np.empty(0, np.int64)
    first = np.flatnonzero(np.diff(h, prepend=h[0] ^ np.uint64(1)))
    count = np.diff(np.append(first, len(h)))
    return np.repeat(count, count)


def unpack(batches: Iterator[pa.RecordBatch], extra_type=None):
    """All postings of a partition: owner, size, hash (and extra) arrays of equal length."""
    owner, size, hashes, extras = [], [], [], []
    for b in batches:
        for o, s, c, h, x in zip(b.column("owner"), b.column("size"), b.column("count"),
                                 b.column("hash"), b.column("extra")):
            count = np.frombuffer(c.as_buffer(), np.uint32)
            owner.append(np.repeat(np.frombuffer(o.as_buffer(), np.int64), count))
            size.append(np.repeat(np.frombuffer(s.as_buffer(), np.uint32), count))
            hashes.append(np.frombuffer(h.as_buffer(), np.uint64))
            if extra_type is not None:
                extras.append(np.frombuffer(x.as_buffer(), extra_type))
    if not hashes:
        empty = np.empty(0, np.uint64)
        return empty.astype(np.int64), empty.astype(np.uint32), empty, empty.astype(extra_type or np.uint32)
    return (np.concatenate(owner), np.concatenate(size), np.concatenate(hashes),
            np.concatenate(extras) if extras else None)
