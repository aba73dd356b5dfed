"""Parallel PIVOT.

The order of two neighbours never changes, so it is settled once: every edge is one
row ``(lead, vid)`` from the end that comes first in ``(prio, id)`` order to the
other, and priorities are not carried on.  Round r works on the *active edges*: the
rows between two unassigned vertices, plus one self row ``(v, v)`` per unassigned
vertex so that isolated ones stay visible.

* pivot:   unassigned ``vid`` without a row from another ``lead`` -- a per-row
           comparison reduced with ``max``, so it runs as a map-side-combined
           hash aggregate.
* assign:  rows whose ``lead`` is a pivot (nothing leads a pivot, so all its
           neighbours are there); ``vid`` takes the smallest of them
           (``tie='min_id'``), a pivot by its self row its own id.
* shrink:  rows touching a vertex assigned this round are dropped, so the
           work of a round is proportional to what is still unclustered.

The pivots and the new labels of a round are written as vertex-sized tables
before they are joined to the active edges: they are computed once, the planner
knows their sizes, the writes observe how many rows they are (a round has no other
job), and both sides of each join are shuffled for it, so a hub's
rows can be split.

The pivot set equals that of sequential PIVOT in ``(prio, id)`` order.  With
``tie='min_prio'`` each non-pivot is finally re-attached to its lowest-priority
adjacent pivot, which reproduces the labels of sequential PIVOT.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphcluster.functions.packing import pack, packed_id
from graphcluster.functions.priority import beats, hash_priority
from graphcluster.operators.graph import canonical_edges, neighbours, vertices_of
from graphcluster.operators.rank import group_rank
from graphcluster.plans.loop import Stored, store

ORDERS = ("hash", "permutation")
TIES = ("min_id", "min_prio")


def _draw(seed: int, order: str, method: str):
    parts = [F.lit(seed), "vid"] if order == "hash" else [F.lit(seed), F.lit("perm"), "vid"]
    return hash_priority(*parts, method=method)


def permutation_rank(vertices: DataFrame, seed: int = 0, partitions: int | None = None,
                     method: str = "md5") -> DataFrame:
    """A seeded random permutation: ``(vid, rank)`` with ranks ``1..N``.

    The draw is a hash of ``(seed, 'perm', vid)``; the rank is a distributed
    zipWithIndex over ``(draw, vid)`` (``group_rank`` with one group), so no
    task ever holds more than one range partition.
    """
    draws = vertices.select("vid", _draw(seed, "permutation", method).alias("draw"))
    return group_rank(draws, [F.lit(0)], ["draw", "vid"], "rank", partitions).select("vid", "rank")


def pivot_priorities(vertices: DataFrame, order: str = "hash", seed: int = 0,
                     method: str = "md5") -> DataFrame:
    """``(vid, prio)`` for the chosen PIVOT order.

    PIVOT only compares priorities, so for a permutation the draw itself serves:
    ``(draw, vid)`` orders the vertices as their ranks would.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}, got {order!r}")
    return vertices.select("vid", _draw(seed, order, method).alias("prio"))


def active_edges(edges: DataFrame, prio: DataFrame) -> DataFrame:
    """``(lead, vid)`` for canonical ``edges``, the end that comes first leading, plus self rows."""
    ps = prio.select(F.col("vid").alias("src"), F.col("prio").alias("sprio"))
    pd = prio.select(F.col("vid").alias("dst"), F.col("prio").alias("dprio"))
    first = beats(F.col("sprio"), F.col("src"), F.col("dprio"), F.col("dst"))
    rows = edges.select("src", "dst").join(ps, "src").join(pd, "dst").select(
        F.when(first, F.col("src")).otherwise(F.col("dst")).alias("lead"),
        F.when(first, F.col("dst")).otherwise(F.col("src")).alias("vid"))
    return rows.unionByName(prio.select(F.col("vid").alias("lead"), "vid"))


def pivot_select(active: DataFrame) -> DataFrame:
    """Pivots of a round: vertices that no active neighbour leads."""
    return (active.groupBy("vid").agg(F.max(F.col("lead") != F.col("vid")).alias("led"))
            .where(~F.col("led")).select("vid"))


def pivot_assign(active: DataFrame, pivots: DataFrame) -> DataFrame:
    """New labels of a round ``(vid, cid)``: pivots take their own id, their
    unassigned neighbours the smallest adjacent pivot id."""
    return (active.join(pivots.select(F.col("vid").alias("lead")), "lead", "left_semi")
            .groupBy("vid").agg(F.min("lead").alias("cid")))


def pivot_round(active: DataFrame) -> tuple[Stored, Stored]:
    """One PIVOT round: the new labels ``(vid, cid)`` and the active rows that survive them."""
    pivots = store(pivot_select(active), "pivots")
    fresh = store(pivot_assign(active, pivots.df), "fresh", assigned=F.count("*"),
                  pivots=F.count_if(F.col("vid") == F.col("cid")))
    gone = fresh.df.select("vid")
    kept = store(active.join(gone, "vid", "left_anti")
                 .join(gone.select(F.col("vid").alias("lead")), "lead", "left_anti")
                 .select("lead", "vid"), "active", rows=F.count("*"))
    pivots.drop()
    return fresh, kept


@dataclass
class PivotResult:
    assign: DataFrame          # (vid, cid)
    rounds: list[tuple[int, int, int]]   # (round, pivots, assigned)
    table: Stored              # the table behind ``assign``; the caller may drop it

    def history(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.rounds, "round INT, pivots BIGINT, assigned BIGINT")


def pivot_cluster(edges: DataFrame, vertices: DataFrame | None = None, order: str = "hash",
                  seed: int = 0, tie: str = "min_id", canonical: bool = False,
                  priorities: DataFrame | None = None, method: str = "md5") -> PivotResult:
    """Cluster an undirected graph with parallel PIVOT.

    ``edges`` may hold duplicates, reversed pairs and self-loops; they are
    canonicalised first, and self-loop endpoints (and ``vertices``) stay as
    vertices.  Every vertex ends in exactly one cluster; the loop ends when
    none is left unassigned (each round has at least one pivot: the lowest
    unassigned vertex).  ``canonical=True`` skips canonicalisation for edges
    that are already simple with ``src < dst``.  ``priorities(vid, prio)``
    replaces the ``order`` draw with given ranks (it must cover every vertex).
    ``method`` is the hash of the draw (see ``hash_priority``).
    """
    if tie not in TIES:
        raise ValueError(f"tie must be one of {TIES}, got {tie!r}")
    used: list[Stored] = []
    if canonical:
        canon = edges.select("src", "dst")
    else:
        used.append(store(canonical_edges(edges), "edges"))
        canon = used[-1].df
    verts = vertices_of(edges, vertices)
    if priorities is not None:
        given = priorities.select(F.col("vid").cast("bigint"), F.col("prio").cast("bigint"))
        used.append(store(verts.join(given, "vid", "left"), "prio"))
        if not used[-1].df.where(F.col("prio").isNull()).isEmpty():
            raise ValueError("priorities must cover every vertex")
    else:
        used.append(store(pivot_priorities(verts, order, seed, method), "prio"))
    prio = used[-1].df

    active = store(active_edges(canon, prio), "active", rows=F.count("*"))
    done: list[Stored] = []
    while active.metrics["rows"]:
        fresh, kept = pivot_round(active.df)
        active.drop()
        active = kept
        done.append(fresh)
    active.drop()
    rounds = [(rnd, t.metrics["pivots"], t.metrics["assigned"]) for rnd, t in enumerate(done, 1)]
    labels = prio.select("vid", F.col("vid").alias("cid")).where(F.lit(False))
    for fresh in done:
        labels = labels.unionByName(fresh.df)
    result = store(labels, "pivot_rounds")
    if tie == "min_prio":
        done.append(result)
        result = store(reattach_min_prio(canon, prio, result.df.select("vid", "cid"), used), "pivot")
    for table in [*done, *used]:
        table.drop()
    return PivotResult(result.df.select("vid", "cid"), rounds, result)


def reattach_min_prio(canon: DataFrame, prio: DataFrame, assign: DataFrame,
                      used: list[Stored]) -> DataFrame:
    """Give every non-pivot its lowest-priority adjacent pivot (sequential PIVOT
    labels); the tables behind the result are added to ``used``."""
    pivots = assign.where(F.col("vid") == F.col("cid")).select("vid")
    used.append(store(prio.join(pivots, "vid", "left_semi").select(
        F.col("vid").alias("nbr"), F.col("prio").alias("nprio")), "pivot-prio"))
    used.append(store(neighbours(canon).join(used[-1].df, "nbr")
                      .groupBy("vid").agg(F.min(pack(F.col("nprio"), F.col("nbr"))).alias("m"))
                      .select("vid", packed_id(F.col("m")).alias("best")), "best-pivot"))
    return (assign.join(used[-1].df, "vid", "left")
            .select("vid", F.when(F.col("vid") == F.col("cid"), F.col("cid"))
                    .otherwise(F.col("best")).alias("cid")))
