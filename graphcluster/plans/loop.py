"""Written intermediate tables.

Iterative operators build one lazy plan from the previous round's state.
Without a cut the plan (and the recovery lineage) grows with the round number,
so each state is written as a Parquet table into the session's checkpoint
folder (a shared filesystem on a cluster) and read back: a lost executor
re-reads the files instead of replaying earlier rounds.

A written table beats ``DataFrame.checkpoint()`` here: the plan is computed
once, the data is columnar and compressed, and the re-read scan carries exact
file sizes, so the planner's broadcast decisions rest on measured sizes.

Tables also make hot keys splittable.  Adaptive execution splits a skewed join
only if *both* sides are shuffled for it; an aggregate on the join key reuses
its own shuffle and is not.  So the small aggregated side of a join on a hot
key (hubs, labels, cluster sizes, pivots) is written first.  A join that feeds
an aggregate on the same key is split only if the session allows the extra
shuffle, which ``store`` sets while it writes.

Figures that a loop decides by (how many rows, sums of a column) are observed by
the write itself and come with the handle, so no further job reads the table.

A ``Stored`` is the only handle to a table: whoever holds it may ``drop`` it;
nothing is ever deleted by way of a DataFrame.  Tables that back a lazily
returned DataFrame stay in the checkpoint folder with the application.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from graphcluster.session import scratch_dir

FORCE_SPLIT = "spark.sql.adaptive.forceOptimizeSkewedJoin"
# Joins whose smaller side has shuffle partitions below this are hashed, not sorted; a
# session that has set its own value keeps it.
HASH_JOIN, HASH_SIDE = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m"


@contextmanager
def split_skew(spark: SparkSession) -> Iterator[None]:
    """While it lasts, skewed joins are split even if that costs a shuffle, and joins
    with a small side are hashed."""
    before = spark.conf.get(FORCE_SPLIT, "false")
    hashed = spark.conf.get(HASH_JOIN, None)
    spark.conf.set(FORCE_SPLIT, "true")
    if hashed is None:
        spark.conf.set(HASH_JOIN, HASH_SIDE)
    try:
        yield
    finally:
        spark.conf.set(FORCE_SPLIT, before)
        if hashed is None:
            spark.conf.unset(HASH_JOIN)


@dataclass(frozen=True)
class Stored:
    """A written table and the figures observed while it was written."""
    df: DataFrame
    path: str
    metrics: dict = field(default_factory=dict)

    def drop(self) -> None:
        release_path(self.df.sparkSession, self.path)


def store(df: DataFrame, name: str = "table", **metrics: Column) -> Stored:
    """Write ``df`` as Parquet under the checkpoint folder; the handle reads it back.

    ``metrics`` are aggregates over the rows; a sum over no rows counts as 0.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    seen = Observation()
    watched = df.observe(seen, *[F.coalesce(m, F.lit(0)).alias(k) for k, m in metrics.items()]) if metrics else df
    with split_skew(spark):
        watched.write.mode("overwrite").parquet(path)
    found = {k: int(v) for k, v in seen.get.items()} if metrics else {}
    return Stored(spark.read.schema(df.schema).parquet(path), path, found)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """A written table that stays with the application."""
    return store(df, name).df


def release_path(spark: SparkSession, path: str) -> None:
    """Delete a folder written by this module (missing folders are ignored)."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
