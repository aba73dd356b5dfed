"""The guard: a subset of independent moves whose joint cost change is negative.

Movers are ranked by ``(delta, vid)`` in their source and in their target cluster and
those with ``delta + (r_src - 1) + (r_dst - 1) < 0`` are kept.  Nothing is sorted for
that: a histogram of the deltas of each cluster, summed up, tells between which
ranks a mover lies, and for almost all movers both ends say the same.  The others are
at a boundary: movers of one cluster with one delta, of which some are kept.  Only
the first ``-delta`` of these can be, so their places are found from the lowest ids
of each of several parts of the group, and a cluster that holds a third of all movers
is never one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphcluster.functions.packing import KEY_OFFSET, pack, packed_id
from graphcluster.plans.loop import Stored, shuffle_partitions, store

MODES = (True, False, "rank", "one")


def _before(moves: DataFrame, side: str, cluster: str) -> DataFrame:
    """Per cluster and delta: how many movers have a smaller delta, and how many this one."""
    lower = Window.partitionBy(cluster).orderBy("delta").rowsBetween(Window.unboundedPreceding, -1)
    return (moves.groupBy(cluster, "delta").agg(F.count("*").alias(f"_same_{side}"))
            .withColumn(f"_less_{side}", F.coalesce(F.sum(f"_same_{side}").over(lower), F.lit(0))))


def _placed(moves: DataFrame) -> DataFrame:
    """The moves with the least and the largest value of the guard's sum."""
    joins = _before(moves.where(~F.col("fresh")), "dst", "to_cid").withColumn("fresh", F.lit(False))
    return (moves.join(_before(moves, "src", "from_cid"), ["from_cid", "delta"])
            .join(joins, ["fresh", "to_cid", "delta"], "left")
            .withColumn("_low", F.col("delta") + F.col("_less_src") + F.coalesce("_less_dst", F.lit(0)))
            .withColumn("_high", F.col("_low") + F.col("_same_src") - 1 + F.coalesce(F.col("_same_dst") - 1, F.lit(0))))


def _places(placed: DataFrame, side: str, cluster: str) -> DataFrame:
    """``(vid, _at_<side>)``: 0-based places by id among the movers of a boundary group,
    for those that are low enough to be kept."""
    edge = (placed.where((F.col("_low") < 0) & (F.col("_high") >= 0) & (F.col(f"_same_{side}") > 1))
            .select(cluster, "delta").distinct())
    parts = shuffle_partitions(placed)
    room = -(F.col("delta") + F.col(f"_less_{side}"))
    first = F.row_number().over(Window.partitionBy(cluster, "delta", "_part").orderBy("vid"))
    place = F.row_number().over(Window.partitionBy(cluster, "delta").orderBy("vid")) - 1
    return (placed.join(edge, [cluster, "delta"], "left_semi")
            .select("vid", cluster, "delta", room.alias("_room"), F.pmod(F.hash("vid"), F.lit(parts)).alias("_part"))
            .withColumn("_k", first).where(F.col("_k") <= F.col("_room"))
            .withColumn(f"_at_{side}", place).select("vid", f"_at_{side}"))


def guarded(moves: DataFrame, mode: bool | str) -> tuple[DataFrame, list[Stored]]:
    """The moves that the guard keeps, and the tables behind them."""
    if mode is True or mode == "rank":
        edge = F.count_if((F.col("_low") < 0) & (F.col("_high") >= 0))
        placed = store(_placed(moves), "placed", edge=edge)
        sure = placed.df.where(F.col("_high") < 0).select(*moves.columns)
        if not placed.metrics["edge"]:
            return sure, [placed]
        known = placed.df.where((F.col("_low") < 0) & (F.col("_high") >= 0))
        entering = placed.df.where(~F.col("fresh"))
        known = (known.join(_places(placed.df, "src", "from_cid"), "vid", "left")
                 .join(_places(entering, "dst", "to_cid"), "vid", "left"))
        # one mover of its kind is at place 0; one without a place is too far back
        at = [F.when(F.col(f"_same_{side}") > 1, F.col(f"_at_{side}")).otherwise(F.lit(0)) for side in ("src", "dst")]
        more = store(known.where(F.col("_low") + at[0] + at[1] < 0).select(*moves.columns), "boundary")
        return sure.unionByName(more.df), [placed, more]
    if mode == "one":
        key = F.min(pack(F.lit(KEY_OFFSET) + F.col("delta"), F.col("vid"))).alias("m")
        first: Column = packed_id(F.col("m")).alias("vid")
        leaders = moves.groupBy("from_cid").agg(key).select(first)
        joiners = (moves.where(~F.col("fresh")).groupBy("to_cid").agg(key)
                   .select(first, F.lit(True).alias("_first_in")))
        keep = (moves.join(leaders, "vid", "left_semi").join(joiners, "vid", "left")
                .where(F.col("fresh") | F.col("_first_in").isNotNull()))
        return keep.select(*moves.columns), []
    raise ValueError(f"guard must be True, 'rank' or 'one', got {mode!r}")


def guard_moves(moves: DataFrame, mode: bool | str = True) -> DataFrame:
    """Keep a subset of independent moves whose joint cost change is negative.

    For non-adjacent movers the joint change is the sum of the deltas plus one
    missing pair for every two movers leaving the same cluster and every two
    joining the same cluster (other cross terms only lower it).  ``'rank'``
    (``True``): rank movers by ``(delta, vid)`` inside their source and their
    target cluster and keep those with ``delta + (r_src - 1) + (r_dst - 1) < 0``.
    ``'one'``: only the first leaver and the first joiner per cluster.
    """
    return guarded(moves, mode)[0]
