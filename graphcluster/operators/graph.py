"""Graph views over edge and vertex DataFrames.

An undirected graph is a DataFrame ``edges(src BIGINT, dst BIGINT)``; vertex
attributes live in DataFrames keyed by ``vid``.  GraphX's triplets, message
passing and subgraphs become equi-joins and grouped aggregations, so Spark
does map-side partial aggregation of messages and AQE handles skewed hubs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphcluster.plans.loop import Stored, materialize, store


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected simple graph: smaller id first, self-loops and duplicates removed."""
    return (
        edges.select(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst"))
        .where(F.col("src") < F.col("dst"))
        .distinct()
    )


def distinct_pairs(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Unordered pairs ``(src, dst)``, smaller id first, without duplicates; self-loops stay,
    and an edge of which one end is NULL is a self-loop of the other.  Raw edges are read
    and shuffled once for it: ``canonical_edges`` are its rows with ``src < dst``, its ends
    are all vertices."""
    return edges.select(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst")).distinct()


def edge_stats(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """One row: raw rows, self-loops, and rows that duplicate another as an unordered pair."""
    lo, hi = F.least(src, dst), F.greatest(src, dst)
    per_pair = edges.groupBy(lo.alias("a"), hi.alias("b")).agg(F.count("*").alias("k"))
    return per_pair.agg(
        F.coalesce(F.sum("k"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("k"))), F.lit(0))
        .cast("bigint").alias("self_loops"),
        F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).cast("bigint").alias("duplicates"),
    )


def vertices_of(edges: DataFrame, extra: DataFrame | None = None,
                src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct endpoint ids (one scan), plus optional extra vertices ``(vid)``."""
    v = edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias("vid"))
    if extra is not None:
        v = v.unionByName(extra.select(F.col("vid").cast("bigint").alias("vid")))
    return v.where(F.col("vid").isNotNull()).distinct()


def neighbours(edges: DataFrame) -> DataFrame:
    """Symmetric adjacency ``(vid, nbr)``: each edge emitted in both directions, one scan."""
    both = F.array(
        F.struct(F.col("src").alias("vid"), F.col("dst").alias("nbr")),
        F.struct(F.col("dst").alias("vid"), F.col("src").alias("nbr")),
    )
    return edges.select(F.explode(both).alias("e")).select("e.vid", "e.nbr")


def triplets(edges: DataFrame, attrs: DataFrame, key: str = "vid") -> DataFrame:
    """Edges with both endpoint attributes: columns ``src, dst, src_<c>, dst_<c>``."""
    cols = [c for c in attrs.columns if c != key]
    s = attrs.select(F.col(key).alias("src"), *[F.col(c).alias(f"src_{c}") for c in cols])
    d = attrs.select(F.col(key).alias("dst"), *[F.col(c).alias(f"dst_{c}") for c in cols])
    return edges.select("src", "dst").join(s, "src").join(d, "dst").select(
        "src", "dst", *[f"src_{c}" for c in cols], *[f"dst_{c}" for c in cols])


def aggregate_messages(edges: DataFrame, attrs: DataFrame,
                       agg: Callable[[Column], Column],
                       to_src: Column | None = None, to_dst: Column | None = None,
                       name: str = "msg") -> DataFrame:
    """Send a message along each edge and reduce per receiving vertex.

    ``to_src`` / ``to_dst`` are expressions over the triplet columns (NULL means
    "send nothing"); ``agg`` reduces them, e.g. ``F.min`` or ``F.sum``.  The
    reduction runs as a partial + final hash aggregate (a map-side combine).
    Returns ``(vid, <name>)`` for vertices that received at least one message.
    """
    if to_src is None and to_dst is None:
        raise ValueError("aggregate_messages needs to_src and/or to_dst")
    t = triplets(edges, attrs)
    msgs = []
    if to_src is not None:
        msgs.append(F.struct(F.col("src").alias("vid"), to_src.alias("m")))
    if to_dst is not None:
        msgs.append(F.struct(F.col("dst").alias("vid"), to_dst.alias("m")))
    out = t.select(F.explode(F.array(*msgs)).alias("x")).select("x.vid", "x.m")
    return out.where(F.col("m").isNotNull()).groupBy("vid").agg(agg(F.col("m")).alias(name))


def degrees(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(vid, degree)``; vertices given in ``vertices`` without edges get degree 0."""
    deg = neighbours(edges).groupBy("vid").agg(F.count("*").alias("degree"))
    if vertices is None:
        return deg
    return (vertices.select("vid").join(deg, "vid", "left")
            .select("vid", F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree")))


def subgraph(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with both ends in ``vertices(vid)`` (two semi-joins).  The distinct
    ids are written first, so that a hub's edges can be split."""
    keep = materialize(vertices.select("vid").distinct(), "subgraph-ids")
    return (edges.join(keep.withColumnRenamed("vid", "src"), "src", "left_semi")
            .join(keep.withColumnRenamed("vid", "dst"), "dst", "left_semi")
            .select("src", "dst"))


def intra_cluster_edges(edges: DataFrame, assign: DataFrame) -> DataFrame:
    """Edges whose ends share a cluster: ``(src, dst, cid)``."""
    s = assign.select(F.col("vid").alias("src"), F.col("cid").alias("cid"))
    d = assign.select(F.col("vid").alias("dst"), F.col("cid").alias("dcid"))
    return (edges.select("src", "dst").join(s, "src").join(d, "dst")
            .where(F.col("cid") == F.col("dcid")).select("src", "dst", "cid"))


def cluster_sizes(assign: DataFrame) -> DataFrame:
    """``(cid, n)``: members per cluster."""
    return assign.groupBy("cid").agg(F.count("*").alias("n"))


def relabel(assign: DataFrame, key: str | list[str] = "cid") -> DataFrame:
    """Canonical labels: every cluster is named by its smallest member id.

    ``key`` may be several columns (e.g. ``['fresh', 'cid']`` for clusters made
    in the same round), so temporary labels never collide with live ones.  The
    labels are written first, so that a giant cluster can be split.
    """
    return relabelled(assign, key)[0]


def relabelled(assign: DataFrame, key: str | list[str] = "cid",
               extra: list[str] | None = None) -> tuple[DataFrame, Stored]:
    """``relabel`` (with ``extra`` columns of ``assign``) and the table of labels,
    which the caller drops once the result is written."""
    keys = [key] if isinstance(key, str) else list(key)
    labels = store(assign.groupBy(*keys).agg(F.min("vid").alias("_label")), "labels")
    out = assign.join(labels.df, keys).select("vid", F.col("_label").alias("cid"), *(extra or []))
    return out, labels
