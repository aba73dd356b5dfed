"""PIVOT: hand-worked labels (priority = id) and properties on random graphs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from graph_models import edges_df, labels_of, py_pivot, py_prio, random_graph, simple
from graphcluster.operators import graph as G
from graphcluster.operators.pivot import permutation_rank, pivot_cluster

# FIXTURES.md section 2, PIVOT column (priority = vertex id, labels = pivot id)
FIXTURE_PIVOT = {
    "triangle": ([(1, 2), (2, 3), (1, 3)], {1: 1, 2: 1, 3: 1}),
    "path3": ([(1, 2), (2, 3)], {1: 1, 2: 1, 3: 3}),
    "path4_zero": ([(0, 1), (1, 2), (2, 3)], {0: 0, 1: 0, 2: 2, 3: 2}),
    "two_K4_bridge": ([(a, b) for g in ((1, 2, 3, 4), (5, 6, 7, 8)) for a in g for b in g
                       if a < b] + [(4, 5)], {v: (1 if v <= 4 else 5) for v in range(1, 9)}),
    "star4": ([(0, 1), (0, 2), (0, 3), (0, 4)], {v: 0 for v in range(5)}),
    "tri_pendant": ([(1, 2), (2, 3), (1, 3), (3, 4)], {1: 1, 2: 1, 3: 1, 4: 4}),
    "two_pivots": ([(1, 3), (2, 3), (2, 4)], {1: 1, 3: 1, 2: 2, 4: 2}),
}


def by_id(spark, labels):
    return spark.createDataFrame([(v, v) for v in labels], "vid BIGINT, prio BIGINT")


@pytest.mark.parametrize("name", sorted(FIXTURE_PIVOT))
def test_fixture_labels(spark, name):
    pairs, want = FIXTURE_PIVOT[name]
    res = pivot_cluster(edges_df(spark, pairs), priorities=by_id(spark, want))
    assert labels_of(res.assign) == want
    assert sum(r[2] for r in res.rounds) == len(want)


def test_path3_tie_rules(spark):
    # priorities 3 < 1 < 2: vertices 1 and 3 are pivots together
    pri = spark.createDataFrame([(3, 0), (1, 1), (2, 2)], "vid BIGINT, prio BIGINT")
    e = edges_df(spark, [(1, 2), (2, 3)])
    assert labels_of(pivot_cluster(e, priorities=pri, tie="min_id").assign) == {1: 1, 2: 1, 3: 3}
    assert labels_of(pivot_cluster(e, priorities=pri, tie="min_prio").assign) == {1: 1, 2: 3, 3: 3}


def test_zero_id_loops_duplicates_isolated(spark):
    e = edges_df(spark, [(0, 1), (1, 0), (0, 1), (5, 5), (1, 2)])
    extra = spark.createDataFrame([(9,)], "vid BIGINT")
    lab = labels_of(pivot_cluster(e, extra).assign)
    assert set(lab) == {0, 1, 2, 5, 9}
    assert lab[5] == 5 and lab[9] == 9        # self-loop-only and isolated: singletons


def test_empty_graph(spark):
    res = pivot_cluster(edges_df(spark, []))
    assert res.assign.count() == 0 and res.rounds == []


@pytest.mark.parametrize("seed", [0, 7])
def test_hash_pivot_equals_sequential_pivot(spark, seed):
    rng = random.Random(seed)
    pairs = random_graph(rng, 40, 0.12) + random_graph(rng, 25, 0.3, offset=100)
    vs = sorted({v for e in simple(pairs) for v in e})
    prio = {v: py_prio(seed, v) for v in vs}
    want, pivots = py_pivot(vs, pairs, prio)
    e = edges_df(spark, pairs)
    got = labels_of(pivot_cluster(e, order="hash", seed=seed, tie="min_prio").assign)
    assert got == want
    got_id = labels_of(pivot_cluster(e, order="hash", seed=seed, tie="min_id").assign)
    assert {v for v, c in got_id.items() if v == c} == pivots
    # every non-pivot sits next to its pivot; pivots are independent and maximal
    nbr = {v: set() for v in vs}
    for a, b in simple(pairs):
        nbr[a].add(b); nbr[b].add(a)
    for v, c in got_id.items():
        assert v == c or c in nbr[v]
        assert v in pivots or nbr[v] & pivots
    assert all(not (nbr[p] & pivots) for p in pivots)


def test_result_independent_of_partitioning(spark):
    rng = random.Random(11)
    pairs = random_graph(rng, 60, 0.1)
    e = edges_df(spark, pairs)
    base = labels_of(pivot_cluster(e, seed=3).assign)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = labels_of(pivot_cluster(e.repartition(5).orderBy(F.rand(1)), seed=3).assign)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == again


def test_permutation_rank_is_a_seeded_permutation(spark):
    v = spark.range(0, 500).select(F.col("id").alias("vid"))
    order = sorted(range(500), key=lambda x: (py_prio(5, "perm", x), x))
    for parts in (1, 7):
        r = {x["vid"]: x["rank"] for x in permutation_rank(v, seed=5, partitions=parts).collect()}
        assert [r[x] for x in order] == list(range(1, 501))


def test_permutation_order_matches_sequential(spark):
    rng = random.Random(2)
    pairs = random_graph(rng, 30, 0.15)
    vs = sorted({v for e in simple(pairs) for v in e})
    rank = {x: i for i, x in enumerate(sorted(vs, key=lambda x: (py_prio(4, "perm", x), x)))}
    want, _ = py_pivot(vs, pairs, rank)
    got = labels_of(pivot_cluster(edges_df(spark, pairs), order="permutation", seed=4,
                                  tie="min_prio").assign)
    assert got == want


def test_bad_arguments(spark):
    e = edges_df(spark, [(1, 2)])
    with pytest.raises(ValueError):
        pivot_cluster(e, order="random")
    with pytest.raises(ValueError):
        pivot_cluster(e, tie="any")
    assert G.canonical_edges(e).count() == 1
