"""Graph views, builders and costs on hand-made graphs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from graph_models import assign_df, edges_df, py_cost, simple
from graphcluster.operators import graph as G
from graphcluster.operators.cost import cut_edges, disagreements, vertex_disagreement
from graphcluster.sources.tables import cooccurrence_edges, greedy_matching, star_rows


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_canonical_edges_drops_loops_duplicates_and_orients(spark):
    e = edges_df(spark, [(2, 1), (1, 2), (3, 3), (2, 3), (3, 2), (5, 4), (-7, 10)])
    assert rows(G.canonical_edges(e)) == [(-7, 10), (1, 2), (2, 3), (4, 5)]
    st = G.edge_stats(e).first()
    assert (st["rows"], st["self_loops"], st["duplicates"]) == (7, 1, 2)


def test_vertices_keep_self_loop_endpoints_and_extras(spark):
    e = edges_df(spark, [(1, 2), (9, 9)])
    extra = spark.createDataFrame([(42,)], "vid BIGINT")
    assert rows(G.vertices_of(e, extra)) == [(1,), (2,), (9,), (42,)]


def test_neighbours_degrees_subgraph(spark):
    e = edges_df(spark, [(0, 1), (0, 2), (0, 3), (2, 3)])
    assert len(G.neighbours(e).collect()) == 8
    v = spark.createDataFrame([(0,), (1,), (2,), (3,), (7,)], "vid BIGINT")
    assert rows(G.degrees(e, v)) == [(0, 3), (1, 1), (2, 2), (3, 2), (7, 0)]
    keep = spark.createDataFrame([(0,), (2,), (3,)], "vid BIGINT")
    assert rows(G.subgraph(e, keep)) == [(0, 2), (0, 3), (2, 3)]


def test_triplets_and_messages(spark):
    e = edges_df(spark, [(1, 2), (2, 3), (3, 4)])
    a = assign_df(spark, {1: 10, 2: 10, 3: 30, 4: 30})
    t = G.triplets(e, a)
    assert rows(t, "src", "dst", "src_cid", "dst_cid") == [(1, 2, 10, 10), (2, 3, 10, 30),
                                                           (3, 4, 30, 30)]
    m = G.aggregate_messages(e, a, F.min, to_src=F.col("dst_cid"), to_dst=F.col("src_cid"))
    assert rows(m) == [(1, 10), (2, 10), (3, 10), (4, 30)]
    same = F.when(F.col("src_cid") == F.col("dst_cid"), F.lit(1))
    s = G.aggregate_messages(e, a, F.sum, to_src=same, to_dst=same)
    assert rows(s) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    assert rows(G.intra_cluster_edges(e, a)) == [(1, 2, 10), (3, 4, 30)]


def test_relabel_uses_smallest_member(spark):
    a = assign_df(spark, {5: 100, 3: 100, 9: 7, 8: 200})
    assert rows(G.relabel(a)) == [(3, 3), (5, 3), (8, 8), (9, 9)]
    assert rows(G.cluster_sizes(a)) == [(7, 1), (100, 2), (200, 1)]


# FIXTURES.md section 2: cost of one cluster / singletons / optimum
FIXTURE_COSTS = {
    "triangle": ([(1, 2), (2, 3), (1, 3)], 0, 3, {1: 1, 2: 1, 3: 1}, 0),
    "path3": ([(1, 2), (2, 3)], 1, 2, {1: 1, 2: 1, 3: 3}, 1),
    "path4_zero": ([(0, 1), (1, 2), (2, 3)], 3, 3, {0: 0, 1: 0, 2: 2, 3: 2}, 1),
    "two_K4_bridge": ([(a, b) for g in ((1, 2, 3, 4), (5, 6, 7, 8)) for a in g for b in g
                       if a < b] + [(4, 5)], 15, 13,
                      {v: (1 if v <= 4 else 5) for v in range(1, 9)}, 1),
    "star4": ([(0, 1), (0, 2), (0, 3), (0, 4)], 6, 4, {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}, 3),
    "tri_pendant": ([(1, 2), (2, 3), (1, 3), (3, 4)], 2, 4, {1: 1, 2: 1, 3: 1, 4: 4}, 1),
    "two_pivots": ([(1, 3), (2, 3), (2, 4)], 3, 3, {1: 1, 3: 1, 2: 2, 4: 2}, 1),
}


def test_costs_on_fixture_graphs(spark):
    for name, (pairs, one, single, opt, opt_cost) in FIXTURE_COSTS.items():
        vs = sorted({v for e in pairs for v in e})
        e = G.canonical_edges(edges_df(spark, pairs))
        for labels, want in (({v: 0 for v in vs}, one), ({v: v for v in vs}, single),
                             (opt, opt_cost)):
            assert py_cost(pairs, labels) == want, name
            row = disagreements(e, assign_df(spark, labels)).first()
            assert row["disagreements"] == want, name
            assert row["cut_edges"] == cut_edges(e, assign_df(spark, labels)).first()[0]
            per = vertex_disagreement(e, assign_df(spark, labels))
            assert sum(r["disagreement"] for r in per.collect()) == 2 * want, name


def test_empty_graph_costs(spark):
    e = edges_df(spark, [])
    a = assign_df(spark, {})
    row = disagreements(e, a).first()
    assert (row["edges"], row["disagreements"]) == (0, 0)


def test_star_cooccurrence_is_linear_and_connected(spark):
    data = [(b, i) for b, items in {1: [1, 2, 3, 4], 2: [3, 5], 3: [6], 4: [1, 2]}.items()
            for i in items] + [(1, 2)]  # a repeated (basket, item) row
    df = spark.createDataFrame(data, "basket BIGINT, item BIGINT")
    raw = star_rows(df, "item", "basket").collect()
    assert len(raw) == 4 + 2 + 1 + 2            # one row per distinct (basket, member)
    e = rows(cooccurrence_edges(df, "item", "basket"))
    pairs = {(a, b) for a in range(7) for b in range(7) if a < b}
    assert set(e) <= pairs
    # every basket's members are connected through the basket hub
    for items in ([1, 2, 3, 4], [3, 5], [1, 2]):
        comp = {items[0]}
        for _ in items:
            comp |= {b for a, b in e if a in comp and b in items} | {
                a for a, b in e if b in comp and a in items}
        assert comp == set(items)
    assert len(e) <= 3 + 1 + 1


def test_greedy_matching_is_a_matching(spark):
    import random
    rng = random.Random(3)
    pairs = simple([(rng.randrange(30), rng.randrange(30)) for _ in range(120)])
    m = rows(greedy_matching(edges_df(spark, pairs)))
    seen = [v for e in m for v in e]
    assert len(seen) == len(set(seen)) and m and set(m) <= set(pairs)


def test_edges_need_no_table_of_distinct_members(spark, monkeypatch):
    """Repeated members and integer baskets give the edges of the distinct members' stars,
    and only the hubs are written for them."""
    from graphcluster.sources import tables as T
    rng = random.Random(5)
    some = [(rng.randrange(40), rng.choice([None, *range(12)])) for _ in range(400)]
    df = spark.createDataFrame(some + some, "item BIGINT, basket BIGINT")
    want = rows(G.canonical_edges(star_rows(df, "item", "basket", 3)))
    assert want == rows(G.canonical_edges(star_rows(df, "item", F.col("basket").cast("string"), 3)))
    written, real = [], T.materialize
    monkeypatch.setattr(T, "materialize", lambda df, name="table": written.append(name) or real(df, name))
    assert rows(cooccurrence_edges(df, "item", "basket", 3)) == want
    assert written == ["hubs"]
