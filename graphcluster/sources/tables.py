"""Graphs derived from tables.

There is no edge table among the inputs, so edges are derived from
co-membership: items that share a basket (parts in an order, users active
in the same hour, documents containing the same sentence).

Linking every pair of a basket would emit all pairs within a group, which is
quadratic in the largest basket (one basket may hold a third of all rows).
Instead each basket is a **star**: every member is linked to the basket's hub,
the member with the smallest hash of ``(seed, basket, item)``.  The edge count
is at most the number of (basket, member) rows, every basket stays connected,
and the hub choice is deterministic and spread evenly.

All steps are distinct / grouped aggregates (map-side combined, so a hot
basket shrinks before the shuffle) and one equi-join on the basket key.  The
members and the hubs are written first, so both sides of that join are
shuffled for it and adaptive execution can split a hot basket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from graphcluster.functions.packing import pack, packed_id
from graphcluster.functions.priority import hash_priority
from graphcluster.operators.graph import canonical_edges
from graphcluster.plans.loop import materialize

INTEGERS = (ByteType, ShortType, IntegerType, LongType)
# Sentence splitting for the shared-sentence graph.
SENTENCE_SPLIT = r"[.!?][ \t\n\r\f]+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def star_rows(df: DataFrame, item: str | Column, basket: str | Column, seed: int = 0) -> DataFrame:
    """Raw star rows ``(src=item, dst=hub)``, one per (basket, member): hub rows are
    self-loops and a pair repeats once per basket that produced it."""
    return _stars(materialize(_members(df, item, basket).distinct(), "members"), seed)


def _members(df: DataFrame, item: str | Column, basket: str | Column) -> DataFrame:
    """``(item, basket)`` rows without nulls; a basket that is no integer is a string."""
    rows = df.select(_col(item).cast("bigint").alias("item"), _col(basket).alias("basket"))
    if not isinstance(rows.schema["basket"].dataType, INTEGERS):
        rows = rows.withColumn("basket", F.col("basket").cast("string"))
    return rows.where(F.col("item").isNotNull() & F.col("basket").isNotNull())


def _stars(members: DataFrame, seed: int) -> DataFrame:
    """Star rows of a table of members, one per row."""
    rank = hash_priority(F.lit(seed), F.col("basket"), F.col("item"))
    hubs = materialize(members.groupBy("basket").agg(F.min(pack(rank, F.col("item"))).alias("m"))
                       .select("basket", packed_id(F.col("m")).alias("hub")), "hubs")
    return members.join(hubs, "basket").select(F.col("item").alias("src"),
                                               F.col("hub").alias("dst"))


def cooccurrence_edges(df: DataFrame, item: str | Column, basket: str | Column,
                       seed: int = 0) -> DataFrame:
    """Canonical edges ``(src, dst)`` of the basket stars (see module doc).

    A repeated member gives its edge again, which is dropped with the edge's other
    repeats, so members are not told apart first; rows that stand by their basket in the
    input meet before a shuffle.  ``df`` is read twice: give a table.
    """
    return canonical_edges(_stars(_members(df, item, basket), seed))


def greedy_matching(edges: DataFrame, seed: int = 0) -> DataFrame:
    """A matching inside canonical ``edges``: the edges that are the lowest
    ``(hash(seed, src, dst), src, dst)`` edge at both of their ends."""
    key = F.struct(hash_priority(F.lit(seed), "src", "dst").alias("h"),
                   F.col("src").alias("s"), F.col("dst").alias("d"))
    keyed = edges.select("src", "dst", key.alias("k"))
    ends = keyed.select(F.explode(F.array("src", "dst")).alias("vid"), "k")
    lowest = ends.groupBy("vid").agg(F.min("k").alias("k"))
    hits = lowest.groupBy("k").agg(F.count("*").alias("ends")).where(F.col("ends") == 2)
    return hits.select(F.col("k.s").alias("src"), F.col("k.d").alias("dst"))


def sentences(docs: DataFrame, min_len: int = 1) -> DataFrame:
    """``(doc_id, sentence)``: whole texts split on sentence ends, trimmed; pieces
    without a character are no sentences (``min_len`` may ask for longer ones)."""
    parts = docs.select("doc_id", F.explode(F.split(F.col("text"), SENTENCE_SPLIT)).alias("s"))
    return (parts.select("doc_id", F.trim(F.col("s")).alias("sentence"))
            .where(F.length("sentence") >= min_len))


def shared_sentence_edges(docs: DataFrame, min_len: int = 1, seed: int = 0) -> DataFrame:
    """Documents linked through sentences they contain verbatim (sentence = basket)."""
    s = sentences(docs, min_len).select("doc_id", F.md5(F.col("sentence")).alias("basket"))
    return cooccurrence_edges(materialize(s, "sentences"), "doc_id", "basket", seed)


# ---------------------------------------------------------------------------
# The three graphs used by the queries, tests and bench.

def _read(spark, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def parts_graph(spark, sf_dir: str, seed: int = 0) -> DataFrame:
    """``gp``: parts linked through the orders that contain them."""
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey")
    return cooccurrence_edges(li, "l_partkey", "l_orderkey", seed)


def users_graph(spark, sf_dir: str, seed: int = 0) -> DataFrame:
    """``gu``: users linked through (event type, hour) slots they were active in."""
    ev = _read(spark, sf_dir, "events", "user_id", "event_type", "ts")
    slot = F.concat_ws(":", F.col("event_type"), F.date_format(F.col("ts"), "yyyy-MM-dd HH"))
    return cooccurrence_edges(ev, "user_id", slot, seed)


def documents_graph(spark, sf_dir: str, seed: int = 0) -> DataFrame:
    """``gd``: documents linked through shared sentences."""
    docs = _read(spark, sf_dir, "documents", "doc_id", "text")
    return shared_sentence_edges(docs, seed=seed)


GRAPHS = {"gp": parts_graph, "gu": users_graph, "gd": documents_graph}
