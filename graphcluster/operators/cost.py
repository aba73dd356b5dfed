"""Correlation-clustering cost.

disagreements = cut edges (ends in different clusters)
              + missing pairs (non-adjacent pairs inside a cluster)
              = cut + sum_C n_C (n_C - 1) / 2 - inside.

All numbers are computed by aggregations; the two one-row aggregates are
combined with a union and a second aggregate, never a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphcluster.operators.graph import cluster_sizes, degrees, intra_cluster_edges, triplets
from graphcluster.plans.loop import materialize


def pair_count(n: str = "n") -> Column:
    """n (n - 1) / 2 as DECIMAL(38, 0), exact for every BIGINT n: the even one of
    the two factors is halved."""
    c = F.col(n).cast("bigint")
    even = (c % 2) == 0
    half, other = F.expr(f"CAST({n} AS BIGINT) div 2"), F.when(even, c - 1).otherwise(c)
    return half.cast("decimal(19,0)") * other.cast("decimal(19,0)")


def _same_cluster_flags(edges: DataFrame, assign: DataFrame) -> DataFrame:
    t = triplets(edges.select("src", "dst"), assign.select("vid", "cid"))
    return t.select((F.col("src_cid") == F.col("dst_cid")).alias("same"))


def cut_edges(edges: DataFrame, assign: DataFrame) -> DataFrame:
    """One row ``(cut_edges)``: edges whose ends lie in different clusters."""
    return _same_cluster_flags(edges, assign).agg(
        F.coalesce(F.sum(F.when(~F.col("same"), 1)), F.lit(0)).cast("bigint").alias("cut_edges"))


def disagreements(edges: DataFrame, assign: DataFrame) -> DataFrame:
    """One row ``(edges, inside_edges, cut_edges, missing_pairs, disagreements)``.

    ``edges`` must be canonical (see ``canonical_edges``); ``assign`` covers
    every endpoint.
    """
    e = _same_cluster_flags(edges, assign).agg(
        F.count("*").cast("bigint").alias("edges"),
        F.coalesce(F.sum(F.when(F.col("same"), 1)), F.lit(0)).cast("bigint").alias("inside"))
    p = cluster_sizes(assign).agg(
        F.coalesce(F.sum(pair_count()), F.lit(0)).cast("decimal(38,0)").alias("pairs"))
    both = (e.select("edges", "inside", F.lit(0).cast("decimal(38,0)").alias("pairs"))
            .unionByName(p.select(F.lit(0).cast("bigint").alias("edges"),
                                  F.lit(0).cast("bigint").alias("inside"), "pairs")))
    s = both.agg(F.sum("edges").alias("edges"), F.sum("inside").alias("inside"),
                 F.sum("pairs").alias("pairs"))
    return s.select(
        F.col("edges").cast("bigint").alias("edges"),
        F.col("inside").cast("bigint").alias("inside_edges"),
        (F.col("edges") - F.col("inside")).cast("bigint").alias("cut_edges"),
        (F.col("pairs") - F.col("inside")).cast("bigint").alias("missing_pairs"),
        (F.col("edges") - 2 * F.col("inside") + F.col("pairs")).cast("bigint")
        .alias("disagreements"))


def vertex_disagreement(edges: DataFrame, assign: DataFrame) -> DataFrame:
    """Per vertex ``(vid, cid, size, degree, same, disagreement)``.

    ``same`` = neighbours in the own cluster; the vertex's share of the cost is
    ``(size - 1 - same) + (degree - same)``; the graph cost is the sum / 2.
    """
    a = assign.select("vid", "cid")
    deg = degrees(edges)
    inside = intra_cluster_edges(edges, a)
    same = (inside.select(F.explode(F.array("src", "dst")).alias("vid"))
            .groupBy("vid").agg(F.count("*").alias("same")))
    sizes = materialize(cluster_sizes(a).withColumnRenamed("n", "size"), "sizes")
    same = materialize(same, "same")
    deg = materialize(deg, "degrees")
    out = (a.join(sizes, "cid").join(deg, "vid", "left").join(same, "vid", "left")
           .select("vid", "cid", F.col("size").cast("bigint").alias("size"),
                   F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree"),
                   F.coalesce("same", F.lit(0)).cast("bigint").alias("same")))
    return out.withColumn(
        "disagreement",
        ((F.col("size") - 1 - F.col("same")) + (F.col("degree") - F.col("same"))).cast("bigint"))
