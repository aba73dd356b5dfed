"""Verifiers for a clustering and for a matching.

Each returns one row with every finding (the job scripts raise on an invalid
row); all checks are distributed aggregations and anti-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphcluster.operators.cost import vertex_disagreement
from graphcluster.operators.graph import canonical_edges, distinct_pairs, vertices_of
from graphcluster.plans.loop import materialize


def _one_row(parts: dict[str, DataFrame]) -> DataFrame:
    """Combine one-row, one-column aggregates into one row via union + aggregate."""
    names = list(parts)
    unioned = None
    for name, df in parts.items():
        cols = [F.col(name).cast("bigint").alias(name) if n == name
                else F.lit(None).cast("bigint").alias(n) for n in names]
        piece = df.select(*cols)
        unioned = piece if unioned is None else unioned.unionByName(piece)
    return unioned.agg(*[F.max(n).alias(n) for n in names])


def verify_clustering(edges: DataFrame, assign: DataFrame) -> DataFrame:
    """``(duplicates, missing, unknown, unassigned, valid, disagreements)``.

    duplicates: solution rows whose vertex already appeared; missing: graph
    vertices without a row; unknown: distinct ids that aren't in the graph;
    unassigned: rows whose vertex or label is NULL.  ``disagreements`` is
    computed for a valid solution only (else NULL), on one row per vertex, so
    that repeated rows never multiply in a join.  ``edges`` are read and told apart
    once: the vertices and both uses of the canonical edges read a table of pairs.
    """
    pairs = materialize(distinct_pairs(edges), "pairs")
    sol = assign.select("vid", "cid")
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    rows = (vertices_of(pairs).select("vid", one.alias("graph"), zero.alias("rows"), zero.alias("nulls"))
            .unionByName(sol.select("vid", zero.alias("graph"), one.alias("rows"),
                                    (F.col("vid").isNull() | F.col("cid").isNull()).cast("bigint").alias("nulls"))))
    per = rows.groupBy("vid").agg(*[F.sum(c).alias(c) for c in ("graph", "rows", "nulls")])
    named = F.col("vid").isNotNull()
    found = per.agg(*[F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(n) for n, x in (
        ("duplicates", F.when(named & (F.col("rows") > 1), F.col("rows") - 1)),
        ("missing", F.when(named & (F.col("rows") == 0), 1)),
        ("unknown", F.when(named & (F.col("graph") == 0), 1)),
        ("unassigned", F.col("nulls")))])
    once = materialize(sol.where(F.col("vid").isNotNull() & F.col("cid").isNotNull())
                       .groupBy("vid").agg(F.min("cid").alias("cid")), "solution")
    cost = vertex_disagreement(pairs.where(F.col("src") < F.col("dst")), once).agg(
        F.coalesce(F.sum(F.col("disagreement").cast("decimal(38,0)")), F.lit(0)).alias("twice"))
    names = ["duplicates", "missing", "unknown", "unassigned"]
    none = F.lit(None)
    row = (found.select(*names, none.cast("decimal(38,0)").alias("twice"))
           .unionByName(cost.select(*[none.cast("bigint").alias(n) for n in names],
                                    F.col("twice").cast("decimal(38,0)").alias("twice")))
           .agg(*[F.max(n).alias(n) for n in [*names, "twice"]]))
    valid = F.lit(True)
    for n in names:
        valid = valid & (F.col(n) == 0)
    return row.select(*names, valid.alias("valid"),
                      F.when(valid, F.expr("twice div 2")).cast("bigint").alias("disagreements"))


def verify_matching(edges: DataFrame, matching: DataFrame) -> DataFrame:
    """``(duplicates, foreign, max_degree, valid, size)``.

    duplicates: rows repeating an unordered pair; foreign: distinct pairs not
    in the graph; max_degree: largest number of matching rows at one vertex.
    """
    graph = canonical_edges(edges)
    m = matching.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    rows = m.agg(F.count("*").alias("size"))
    dup = m.groupBy("src", "dst").agg(F.count("*").alias("k")).agg(
        F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("duplicates"))
    foreign = m.distinct().join(graph, ["src", "dst"], "left_anti").agg(
        F.count("*").alias("foreign"))
    maxdeg = (m.select(F.explode(F.array("src", "dst")).alias("vid"))
              .groupBy("vid").agg(F.count("*").alias("d"))
              .agg(F.coalesce(F.max("d"), F.lit(0)).alias("max_degree")))
    row = _one_row({"duplicates": dup, "foreign": foreign, "max_degree": maxdeg, "size": rows})
    valid = (F.col("duplicates") == 0) & (F.col("foreign") == 0) & (F.col("max_degree") <= 1)
    return row.select("duplicates", "foreign", "max_degree", valid.alias("valid"),
                      F.when(valid, F.col("size")).alias("size"))
