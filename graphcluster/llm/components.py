"""Connected components of an edge table by alternating star contraction.

Each round joins every vertex's larger neighbours to its smallest one (large
star) and then its smaller neighbours to the smallest one (small star), until
the edges form stars.  The number of rounds grows with the logarithm of the
longest path.  The minima are written as tables before they are joined, so both
sides of a join are shuffled and a vertex with many edges is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphcluster.llm.common import Table


def _print(edges: DataFrame) -> tuple:
    """Count and order-free fingerprint of an edge table."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> Table:
    """Table (node, root) of every vertex with an edge; root is the component's smallest vertex.

    Null ends, loops and repeated edges are ignored; without edges it is empty.
    """
    start = edges.where((F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = Table(start, "cc-edges")
    seen = _print(now.df)
    while seen[0]:
        both = now.df.union(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = Table(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), "cc-low")
        large = Table(both.join(low.df, "u").where(F.col("v") > F.col("u"))
                      .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        low2 = Table(large.df.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = (large.df.join(low2.df, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low2.df.select("u", F.col("m").alias("v"))).distinct())
        after = Table(small, "cc-edges")
        for t in (now, low, large, low2):
            t.drop()
        now, before = after, seen
        seen = _print(now.df)
        if seen == before:
            break
    stars = now.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = Table(stars.union(stars.select(F.col("root").alias("node"), "root").distinct()), "components")
    now.drop()
    return out
