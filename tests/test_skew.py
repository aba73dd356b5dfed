"""Hot keys: a basket with a third of the rows, a hub vertex, a giant cluster."""

from __future__ import annotations

import gc
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from graph_models import assign_df, edges_df, labels_of, py_cost, random_graph, simple
from graphcluster.operators import graph as G
from graphcluster.operators import localsearch as L
from graphcluster.operators import pivot as P
from graphcluster.operators.cost import vertex_disagreement
from graphcluster.operators.pivot import pivot_cluster
from graphcluster.plans import loop
from graphcluster.plans.job import cluster
from graphcluster.sources.tables import cooccurrence_edges, star_rows


def test_hot_basket_gives_a_star_not_a_clique(spark):
    # basket 0 holds 3000 of 9000 rows; the others hold 3 items each
    hot = spark.range(0, 3000).select(F.lit(0).alias("basket"), F.col("id").alias("item"))
    cold = spark.range(0, 6000).select((F.col("id") / 3 + 1).cast("bigint").alias("basket"),
                                       (F.col("id") + 10000).alias("item"))
    e = cooccurrence_edges(hot.unionByName(cold), "item", "basket")
    counts = e.agg(F.count("*").alias("n")).first()["n"]
    assert counts == 2999 + 2000 * 2          # one edge per non-hub member


def test_hub_vertex_pivot(spark):
    pairs = [(0, v) for v in range(1, 1500)] + [(v, v + 1) for v in range(1, 1499, 2)]
    lab = labels_of(pivot_cluster(edges_df(spark, pairs), seed=1).assign)
    assert len(lab) == 1500
    vs = sorted(lab)
    assert py_cost(pairs, lab) <= py_cost(pairs, {v: v for v in vs}) + 1500


def final_plan(df, monkeypatch=None):
    """The plan that ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark, monkeypatch):
    """Low thresholds, no broadcast: a key with a third of the rows must be split.
    Yields the plans of all tables written meanwhile."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", loop.FORCE_SPLIT: "true"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


N = 60_000


def spread(df):
    return loop.materialize(df.repartition(12))


def hub_edges(spark):
    """Half of the edges at vertex 0."""
    return spread(spark.range(1, N).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("src"),
                                           (F.col("id") + 1).alias("dst")))


def giant(spark):
    """Half of the vertices in cluster 0."""
    return spread(spark.range(0, N + 1).select(F.col("id").alias("vid"),
                                               F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("cid")))


def test_hot_basket_splits(hot):
    rows = spread(hot.range(0, 2 * N).select(F.col("id").alias("item"), F.when(F.col("id") % 2 == 0, 0).otherwise(
        F.col("id")).alias("basket")))
    assert "skew=true" in final_plan(star_rows(rows, "item", "basket"))


def test_giant_cluster_splits(hot):
    a = giant(hot)
    assert "skew=true" in final_plan(G.relabel(a))
    moves = hot.createDataFrame([(2, 0, 4, False, -1)], "vid long, from_cid long, to_cid long, fresh boolean, delta long")
    assert "skew=true" in final_plan(L.apply_moves(a, moves))
    assert "skew=true" in final_plan(vertex_disagreement(hub_edges(hot), a))


def test_hub_splits(hot):
    e, a = hub_edges(hot), giant(hot)
    assert "skew=true" in final_plan(G.subgraph(e, a.where("vid % 3 < 2")))
    adj = loop.materialize(G.neighbours(e))
    hist = loop.materialize(L.neighbour_clusters(adj, a))
    moves = loop.materialize(L.best_moves(a, hist, G.cluster_sizes(a)))
    assert "skew=true" in final_plan(L.neighbour_clusters(adj, a))
    assert "skew=true" in final_plan(L.best_moves(a, adj.groupBy("vid", F.col("nbr").alias("nbr_cid")).agg(
        F.count("*").alias("n")).transform(spread), G.cluster_sizes(a)))
    for lead, hub in (True, -1), (False, 2 * N):  # the hub comes before, or after, all its neighbours
        prio = loop.materialize(G.vertices_of(e).select(
            "vid", F.when(F.col("vid") == 0, hub).otherwise(F.col("vid")).cast("bigint").alias("prio")))
        active = spread(P.active_edges(e, prio))
        pivots = loop.materialize(P.pivot_select(active))
        assigned = P.pivot_assign(active, pivots)
        assert ("skew=true" in final_plan(assigned)) == lead
        gone = loop.materialize(assigned).select("vid")
        at_hub = gone.withColumnRenamed("vid", "lead") if lead else gone
        assert "skew=true" in final_plan(active.join(at_hub, at_hub.columns[0], "left_anti"))
    assert moves.count() >= 0


def test_messages_to_a_hub_split_under_default_settings(hot):
    e = hub_edges(hot)
    a = spread(hot.range(0, N + 1).select(F.col("id").alias("vid"), (F.col("id") % 3).alias("cid")))
    hot.conf.set(loop.FORCE_SPLIT, "false")
    lowest = G.aggregate_messages(e, a, F.min, to_src=F.col("dst_cid"), to_dst=F.col("src_cid"))
    same = F.when(F.col("src_cid") == F.col("dst_cid"), F.lit(1))
    for messages in (lowest, G.aggregate_messages(e, a, F.sum, to_src=same, to_dst=same)):
        assert "skew=true" in final_plan(messages)


def test_hub_splits_inside_tables(hot, monkeypatch):
    """Joins whose result is written at once: their plans, caught as they are written."""
    plans = []
    real = loop.store

    def caught(df, name="table", **metrics):
        with loop.split_skew(df.sparkSession):
            plans.append((name, final_plan(df)))
        return real(df, name, **metrics)

    e = hub_edges(hot)
    adj = loop.materialize(G.neighbours(e))
    everyone = loop.materialize(G.vertices_of(e).select(
        "vid", F.col("vid").alias("from_cid"), F.lit(-1).alias("to_cid"), F.lit(False).alias("fresh"),
        F.lit(-1).cast("bigint").alias("delta")))
    monkeypatch.setattr(L, "store", caught)
    L.independent_set(everyone, adj, 0, 1, "all")
    L.independent_set(everyone, adj, 0, 1, "improving")
    found = [p for n, p in plans if n == "blocked"]
    assert len(found) == 2 and all("skew=true" in p for p in found)


def test_vertices_are_counted_where_they_were_joined(hot, monkeypatch):
    """The histogram is not shuffled by vertex and cluster, unless a hub was split."""
    plans = []
    real = loop.store

    def caught(df, name="table", **metrics):
        with loop.split_skew(df.sparkSession):
            if name == "ls_state":
                plans.append(final_plan(df).split("== Initial Plan ==")[0])
        return real(df, name, **metrics)

    monkeypatch.setattr(L, "store", caught)
    path = spread(hot.range(0, N).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))
    a = spread(hot.range(0, N + 1).select(F.col("id").alias("vid"), F.expr("id - id % 4").alias("cid")))
    for e in (path, hub_edges(hot)):
        adj = loop.materialize(G.neighbours(e))
        state = L._first_state(a, adj, "max_overlap", True)
        inside = e.where("src div 4 = dst div 4").count()
        assert state.metrics["inside2"] == 2 * inside
        used = state.df.where("delta < 0").selectExpr("vid", "cid AS from_cid", "dest AS to_cid", "fresh", "delta")
        after, moved, counted = L._next_state(state.df, used, adj, "max_overlap", True)
        assert moved and counted * L.MOST >= N
    assert len(plans) == 4
    again = [bool(re.search(r"hashpartitioning\(vid#\d+L, cid#\d+L, nbr_cid#\d+L", p)) for p in plans]
    assert again == [False, False, True, True]
    assert all("skew=true" in p for p in plans[2:])


def test_held_frames_outlive_their_parents(spark):
    """Tables are deleted by their handles alone."""
    kept = loop.store(spark.range(0, 1000).select(F.col("id").alias("v")))
    derived = kept.df.where("v % 2 = 0")
    path = kept.path
    del kept
    gc.collect()
    others = [loop.store(spark.range(0, 5)) for _ in range(20)]
    frames = [spark.range(0, 5).select("id") for _ in range(300)]
    for t in others:
        t.drop()
    assert len(frames) == 300 and derived.count() == 500
    loop.release_path(spark, path)


def test_cluster_leaves_only_its_result(spark):
    folder = spark.sparkContext.getCheckpointDir()
    local = folder.split(":", 1)[-1] if folder.startswith("file:") else folder
    seen = set(os.listdir(local))
    rng = random.Random(3)
    for order, mode in (("hash", "regular"), ("permutation", "simultaneous"), ("hash", "inner")):
        res = cluster(edges_df(spark, random_graph(rng, 40, 0.15)), order, mode, 4, 1)
        left = set(os.listdir(local)) - seen
        assert len(left) == 1 and next(iter(left)).startswith("ls_state"), left
        assert res.assign.count() == res.vertices
        seen |= left


def test_search_stops_when_nothing_improves(spark):
    rng = random.Random(17)
    pairs = random_graph(rng, 40, 0.12)
    vs = sorted({v for e in simple(pairs) for v in e})
    res = L.local_search(edges_df(spark, pairs), assign_df(spark, {v: 0 for v in vs}), 40, 5)
    assert res.stopped and len(res.rounds) < 40
    assert res.rounds[1][2] > 1                          # several leavers at once
    costs = [c for _, c, _ in res.rounds]
    assert costs == sorted(costs, reverse=True) and costs[-1] == py_cost(pairs, labels_of(res.assign))


def test_xxhash_priorities_cluster_too(spark):
    pairs = random_graph(random.Random(9), 30, 0.2)
    res = cluster(edges_df(spark, pairs), "hash", "regular", 3, 1, method="xxhash64",
                  vertices=spark.createDataFrame([(999,)], "vid long"))
    lab = labels_of(res.assign)
    assert lab[999] == 999 and py_cost(pairs, lab) == res.cost


def test_written_joins_with_a_small_side_are_hashed(hot):
    """No join of a written table sorts while one side's shuffle partitions are small; a
    value that the session has set stays."""
    hot.conf.set(loop.FORCE_SPLIT, "false")
    e, a = hub_edges(hot), giant(hot)
    with loop.split_skew(hot):
        plan = final_plan(e.join(a.withColumnRenamed("vid", "src"), "src"))
    plan = plan.split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin(skew=true)" in plan and "SortMergeJoin" not in plan
    assert hot.conf.get(loop.HASH_JOIN, None) is None
    hot.conf.set(loop.HASH_JOIN, "0")
    try:
        with loop.split_skew(hot):
            assert hot.conf.get(loop.HASH_JOIN) == "0"
        assert hot.conf.get(loop.HASH_JOIN) == "0"
    finally:
        hot.conf.unset(loop.HASH_JOIN)
